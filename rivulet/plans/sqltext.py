"""SQL text pieces for the DuckDB twins of the registered queries (check
digits, HMAC, base64url). Used only to write the oracle SQL."""

from __future__ import annotations

# Written out here, not taken from the library that the SQL checks.
CPF_1 = (10, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_2 = (11, 10, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_1 = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_2 = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def check_digit_sql(d: str, weights: tuple[int, ...]) -> str:
    s = " + ".join(f"TRY_CAST(substr({d}, {i + 1}, 1) AS INTEGER) * {w}" for i, w in enumerate(weights))
    return f"(CASE WHEN ({s}) % 11 > 2 THEN 11 - ({s}) % 11 ELSE 0 END)"


def complete_sql(base: str, first: tuple[int, ...], second: tuple[int, ...]) -> str:
    with_d1 = f"({base} || CAST({check_digit_sql(base, first)} AS VARCHAR))"
    return f"({with_d1} || CAST({check_digit_sql(with_d1, second)} AS VARCHAR))"


def cpf_complete_sql(base9: str) -> str:
    return complete_sql(base9, CPF_1, CPF_2)


def cnpj_complete_sql(base12: str) -> str:
    return complete_sql(base12, CNPJ_1, CNPJ_2)


def digits_sql(c: str) -> str:
    return f"COALESCE(regexp_replace({c}, '[^0-9]', '', 'g'), '')"


def valid_sql(c: str, first: tuple[int, ...], second: tuple[int, ...]) -> str:
    d, n = digits_sql(c), len(first)
    return (f"COALESCE(length({d}) = {n + 2} AND TRY_CAST(substr({d}, {n + 1}, 1) AS INTEGER) = {check_digit_sql(d, first)} "
            f"AND TRY_CAST(substr({d}, {n + 2}, 1) AS INTEGER) = {check_digit_sql(d, second)}, false)")


def cpf_valid_sql(c: str) -> str:
    return valid_sql(c, CPF_1, CPF_2)


def cnpj_valid_sql(c: str) -> str:
    return valid_sql(c, CNPJ_1, CNPJ_2)


def draw_sql(seed: int, key: str, modulus: int) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|' || CAST({key} AS VARCHAR)), 1, 15) AS BIGINT) % {modulus})"


def b64url_sql(blob: str) -> str:
    return f"replace(replace(replace(to_base64({blob}), '+', '-'), '/', '_'), '=', '')"


def b64url_decode_sql(text: str) -> str:
    t = f"replace(replace({text}, '-', '+'), '_', '/')"
    return f"from_base64({t} || repeat('=', CAST((4 - length({t}) % 4) % 4 AS INTEGER)))"


def hmac256_sql(msg_text: str, secret: str) -> str:
    key = secret.encode().ljust(64, b"\0")  # secrets of at most a block
    ipad, opad = bytes(x ^ 0x36 for x in key), bytes(x ^ 0x5C for x in key)
    inner = f"unhex(sha256(unhex('{ipad.hex()}') || encode({msg_text})))"
    return f"unhex(sha256(unhex('{opad.hex()}') || {inner}))"
