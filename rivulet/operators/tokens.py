"""Signed tokens (HS256/384/512) for rows, and an audit of a
token log. Signing is HMAC from ``sha2`` built-ins (see
``functions.signing``), so it runs inside codegen on every executor."""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.signing import ALGORITHMS, b64url, b64url_decode_text, b64url_text, hmac_sha2
from rivulet.functions.json import is_json
from rivulet.functions.text import col_of
from rivulet.operators.records import staged

# Reasons an audited token is refused (our names; the reference passes the
# library's exception text through).
REASON_EMPTY = "empty_token"
REASON_SEGMENTS = "wrong_number_of_segments"
REASON_HEADER = "bad_header"
REASON_ALGORITHM = "unsupported_algorithm"
REASON_SIGNATURE = "invalid_signature"
REASON_PAYLOAD = "bad_payload"
REASON_EXPIRED = "expired"


def header_json(alg: str) -> str:
    return json.dumps({"typ": "JWT", "alg": alg}, separators=(",", ":"))


def claims_json(claims: Mapping[str, Column | str] | Sequence[str], exp: Column | None = None) -> Column:
    """Claims → JSON object text (values as text); ``exp`` (seconds) last."""
    items = claims.items() if isinstance(claims, Mapping) else [(c, c) for c in claims]
    fields = [col_of(v).cast("string").alias(k) for k, v in items]
    if exp is not None:
        fields.append(exp.cast("long").alias("exp"))
    return F.to_json(F.struct(*fields))


def sign(payload_json: Column, secret: str, alg: str = "HS256") -> Column:
    """JSON claims text → ``header.payload.signature`` (base64url parts)."""
    bits = ALGORITHMS[alg]
    head = base64.urlsafe_b64encode(header_json(alg).encode()).rstrip(b"=").decode()
    signing_input = F.concat(F.lit(head + "."), b64url_text(payload_json))
    return F.concat(signing_input, F.lit("."), b64url(hmac_sha2(signing_input, secret, bits)))


def sign_rows(df: DataFrame, claims: Mapping[str, Column | str] | Sequence[str], secret: str,
              alg: str = "HS256", expires_s: int = 0, now: int | Column | None = None,
              out: str = "authorization") -> DataFrame:
    """A signed token of each row's claims in column ``out``; with
    ``expires_s`` > 0 an ``exp`` claim = now + expires_s (``now`` in epoch
    seconds is an argument, so a run can be repeated)."""
    if alg not in ALGORITHMS:
        raise ValueError(f"unsupported algorithm {alg!r}; HS256, HS384, HS512 only")
    exp = None
    if expires_s and expires_s > 0:
        if now is None:
            base = F.unix_timestamp(F.current_timestamp())
        else:
            base = now if isinstance(now, Column) else F.lit(int(now))
        exp = base.cast("long") + F.lit(int(expires_s))
    return df.withColumn(out, sign(claims_json(claims, exp), secret, alg))


def audit_tokens(df: DataFrame, token: str, secret: str, now: int | Column,
                 valid_col: str = "token_valid", reason_col: str = "token_error") -> DataFrame:
    """Each token checked → ``valid_col`` and the refusal reason (null
    when the token is valid). Parts, header, signature and payload are staged,
    each worked out once per row. An expiry that is not a number is a bad
    payload."""
    names = list(df.columns)
    df, parts = staged(df, "_parts", F.split(col_of(token), r"\.", -1))
    df, alg = staged(df, "_alg", F.get_json_object(b64url_decode_text(F.get(parts, 0)), "$.alg"))
    signed = F.concat(F.get(parts, 0), F.lit("."), F.get(parts, 1))
    want = F.lit(None).cast("string")
    for name, bits in reversed(list(ALGORITHMS.items())):
        want = F.when(alg == F.lit(name), b64url(hmac_sha2(signed, secret, bits))).otherwise(want)
    df, expected = staged(df, "_expected", want)
    df, payload = staged(df, "_payload", b64url_decode_text(F.get(parts, 1)))
    df, exp_text = staged(df, "_exp", F.get_json_object(payload, "$.exp"))
    exp, t = exp_text.try_cast("decimal(38,6)"), col_of(token)
    now_c = now if isinstance(now, Column) else F.lit(int(now))
    reason = (F.when(F.coalesce(F.length(t), F.lit(0)) == 0, F.lit(REASON_EMPTY))
            .when(F.size(parts) != 3, F.lit(REASON_SEGMENTS))
            .when(alg.isNull(), F.lit(REASON_HEADER))
            .when(expected.isNull(), F.lit(REASON_ALGORITHM))
            .when(expected != F.get(parts, 2), F.lit(REASON_SIGNATURE))
            .when(~is_json(payload) | (exp_text.isNotNull() & exp.isNull()), F.lit(REASON_PAYLOAD))
            .when(exp.isNotNull() & (now_c.cast("long") >= exp), F.lit(REASON_EXPIRED)))
    return (df.withColumn(reason_col, reason).withColumn(valid_col, F.col(reason_col).isNull())
            .select(*names, reason_col, valid_col))


def audit_counts(audited: DataFrame, reason_col: str = "token_error") -> DataFrame:
    """Tokens per outcome (``valid`` or the reason)."""
    return (audited.select(F.coalesce(F.col(reason_col), F.lit("valid")).alias("outcome"))
            .groupBy("outcome").agg(F.count(F.lit(1)).alias("n_tokens")))
