import base64
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from rivulet.functions.signing import b64url, b64url_decode_text, hmac_sha2
from rivulet.operators import tokens as K

SECRET = "s3cret"


def b64u(b: bytes) -> str:
    return base64.urlsafe_b64encode(b).rstrip(b"=").decode()


def py_token(claims: dict, secret: str, alg="HS256") -> str:
    bits = {"HS256": hashlib.sha256, "HS384": hashlib.sha384, "HS512": hashlib.sha512}[alg]
    head = b64u(json.dumps({"typ": "JWT", "alg": alg}, separators=(",", ":")).encode())
    body = b64u(json.dumps(claims, separators=(",", ":")).encode())
    sig = hmac.new(secret.encode(), f"{head}.{body}".encode(), bits).digest()
    return f"{head}.{body}.{b64u(sig)}"


@pytest.mark.parametrize("bits", [256, 384, 512])
@pytest.mark.parametrize("secret", ["k", "x" * 200])
def test_hmac_matches_python(spark, bits, secret):
    msgs = ["", "abc", "é" * 100, "x" * 1000]
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    got = [bytes(r[0]) for r in df.select(hmac_sha2("m", secret, bits)).collect()]
    want = [hmac.new(secret.encode(), m.encode(), getattr(hashlib, f"sha{bits}")).digest() for m in msgs]
    assert got == want


def test_b64url_long_payload_has_no_line_breaks(spark):
    text = "y" * 300  # base64 of this is over 76 characters
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(b64url(F.col("t").cast("binary")).alias("e")).first().e
    assert r == b64u(text.encode()) and "\n" not in r
    back = df.select(b64url_decode_text(b64url(F.col("t").cast("binary")))).first()[0]
    assert back == text


@pytest.mark.parametrize("alg", ["HS256", "HS384", "HS512"])
def test_sign_rows_equals_reference_construction(spark, alg):
    df = spark.createDataFrame([(1, "ann"), (2, "bob " * 40)], "id long, name string")
    out = K.sign_rows(df, {"sub": "id", "name": "name"}, SECRET, alg, expires_s=60, now=1000)
    for r in out.collect():
        assert r.authorization == py_token({"sub": str(r.id), "name": r.name, "exp": 1060}, SECRET, alg)


def test_audit_reasons(spark):
    good = py_token({"sub": "1", "exp": 2000}, SECRET)
    h, p, s = good.split(".")
    other_payload = b64u(b'{"sub":"2"}')
    rows = [
        ("valid", good, 1000),
        ("payload", f"{h}.{other_payload}.{s}", 1000),
        ("signature", f"{h}.{p}.{s[::-1]}", 1000),
        ("secret", py_token({"sub": "1"}, "other"), 1000),
        ("expired", good, 2000),
        ("two", f"{h}.{p}", 1000),
        ("empty", "", 1000),
        ("null", None, 1000),
        ("hs512", py_token({"sub": "1", "name": "z" * 90}, SECRET, "HS512"), 1000),
    ]
    df = spark.createDataFrame(rows, "case string, token string, now long")
    got = {r.case: r for r in K.audit_tokens(df, "token", SECRET, F.col("now")).collect()}
    assert got["valid"].token_valid and got["hs512"].token_valid
    assert got["payload"].token_error == K.REASON_SIGNATURE
    assert got["signature"].token_error == K.REASON_SIGNATURE
    assert got["secret"].token_error == K.REASON_SIGNATURE
    assert got["expired"].token_error == K.REASON_EXPIRED
    assert got["two"].token_error == K.REASON_SEGMENTS
    assert got["empty"].token_error == K.REASON_EMPTY
    assert got["null"].token_error == K.REASON_EMPTY
    counts = {r.outcome: r.n_tokens for r in K.audit_counts(K.audit_tokens(df, "token", SECRET, F.col("now"))).collect()}
    assert counts["valid"] == 2 and counts[K.REASON_SIGNATURE] == 3
