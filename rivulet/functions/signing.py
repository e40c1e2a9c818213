"""HMAC-SHA2 and base64url as Column expressions built from ``sha2``,
``concat`` and ``base64`` only: the key pads are made once on the driver
from the secret, the per-row work stays in the JVM. The pads reach the rows as
the value of a one-row relation (a scalar subquery), so neither secret nor pads are
in a plan, a log or the history of a query."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import col_of

# Fixed values of HMAC (RFC 2104) and of the HS token family.
IPAD = 0x36
OPAD = 0x5C
BLOCK_BYTES = {256: 64, 384: 128, 512: 128}
ALGORITHMS = {"HS256": 256, "HS384": 384, "HS512": 512}


def key_pads(secret: str | bytes, bits: int) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8") if isinstance(secret, str) else bytes(secret)
    block = BLOCK_BYTES[bits]
    if len(key) > block:
        key = hashlib.new(f"sha{bits}", key).digest()
    key = key.ljust(block, b"\0")
    return bytes(b ^ IPAD for b in key), bytes(b ^ OPAD for b in key)


def pad_columns(secret: str | bytes, bits: int) -> tuple[Column, Column]:
    """The key pads as scalar subqueries."""
    spark = SparkSession.active()
    pads = spark.createDataFrame([key_pads(secret, bits)], "ipad binary, opad binary")
    return pads.select("ipad").scalar(), pads.select("opad").scalar()


def hmac_sha2(message: Column | str, secret: str | bytes, bits: int = 256) -> Column:
    """HMAC-SHA2 of a STRING (UTF-8) or BINARY column → BINARY digest."""
    ipad, opad = pad_columns(secret, bits)
    msg_bin = col_of(message).cast("binary")
    inner = F.unhex(F.sha2(F.concat(ipad, msg_bin), bits))
    return F.unhex(F.sha2(F.concat(opad, inner), bits))


def b64url(binary: Column) -> Column:
    """base64url without padding. ``base64`` wraps long output with CRLF, so
    line breaks are removed together with the padding."""
    return F.regexp_replace(F.translate(F.base64(binary), "+/", "-_"), "[=\r\n]", "")


def b64url_text(text: Column | str) -> Column:
    return b64url(col_of(text).cast("binary"))


def b64url_decode(text: Column | str) -> Column:
    """base64url (padding optional) → BINARY; bad input → null."""
    t = F.translate(col_of(text), "-_", "+/")
    pad = F.array_join(F.array_repeat(F.lit("="), F.pmod(F.lit(4) - F.length(t), F.lit(4)).cast("int")), "")
    return F.try_to_binary(F.concat(t, pad), F.lit("base64"))


def b64url_decode_text(text: Column | str) -> Column:
    """base64url → UTF-8 text; bad input → null."""
    return b64url_decode(text).cast("string")
