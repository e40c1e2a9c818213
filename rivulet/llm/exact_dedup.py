"""Exact dedup: group by a 128-bit content hash, keep one stable id, compare
bytes inside the groups.

A group of copies may hold a third of all rows, so nothing is keyed by the
hash alone: rows are grouped by (hash, salt), the salt coming from the id, and
only one row per (hash, salt) is combined over the whole group. The group's
text goes back to each salt, where every member is compared with it byte by
byte. Hashes under which different texts met are grouped again by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.blocks import small_batches
from rivulet.llm.staged import drop, stage

ROWS_PER_SALT = 20_000
LEAST_SALTS = 64


def md5_128(text: bytes) -> bytes:
    return hashlib.md5(text, usedforsecurity=False).digest()


def _digests(hash128: Callable[[bytes], bytes]):
    """Column function: text to (128-bit hash, SHA-256 hex) of its bytes after
    lower-casing A-Z; null is empty."""

    @F.arrow_udf("struct<h: binary, sha: string>")
    def digests(text: pa.Array) -> pa.Array:
        low = [x or b"" for x in pc.ascii_lower(text).cast(pa.binary()).to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([hash128(x) for x in low], pa.binary()),
             pa.array([hashlib.sha256(x).hexdigest() for x in low], pa.string())], ["h", "sha"])

    return digests


@F.arrow_udf(T.BooleanType())
def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.equal(pc.ascii_lower(pc.fill_null(a, "")), pc.ascii_lower(pc.fill_null(b, "")))


@F.arrow_udf(T.StringType())
def _folded(a: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(a, ""))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     keep: str = "smallest", carry: tuple[str, ...] = (),
                     hash128: Callable[[bytes], bytes] = md5_128) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256
    and the ``carry`` columns (prefixed ``x_``, so that names cannot clash).

    Texts are equal when identical after lower-casing A-Z; null is the empty
    text. ``keep`` says whether the smallest or the largest id stays. A null
    id stays only in a group without any other id. Of rows that repeat the
    staying id, exactly one is kept. An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    big = keep == "largest"
    salts = max(LEAST_SALTS, -(-docs.count() // ROWS_PER_SALT))
    rows = (
        docs.select(
            F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
            *[F.col(f"`{c}`").alias(f"x_{c}") for c in carry])
        .withColumn("d", _digests(hash128)("t"))
        .withColumn("h", F.col("d.h")).withColumn("sha", F.col("d.sha")).drop("d")
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    )
    best = (F.max if big else F.min)("id")
    over = Window.partitionBy("h")
    groups = (
        rows.select("h", "salt", "id").groupBy("h", "salt")
        .agg(F.count(F.lit(1)).alias("n"), best.alias("id"))
        .select("h", "salt", F.sum("n").over(over).alias("size"),
                (F.max if big else F.min)("id").over(over).alias("keep_id"))
        .withColumn("keep_salt", F.pmod(F.xxhash64("keep_id"), F.lit(salts)))
    )
    order = F.col("id").desc_nulls_last() if big else F.col("id").asc_nulls_last()
    joined = (
        rows.join(groups, ["h", "salt"])
        .withColumn("t", F.when(F.col("size") > 1, F.col("t")))  # only these are compared
        .withColumn("rn", F.row_number().over(Window.partitionBy("h", "salt").orderBy(order, F.xxhash64("t"))))
        .withColumn("kept", (F.col("rn") == 1) & (F.col("salt") == F.col("keep_salt")))
        .drop("rn", "keep_salt")
    )
    found, _ = stage(joined, "exact_groups")

    several = found.where("size > 1")
    stays = several.where("kept").select("h", F.col("t").alias("kept_text"))
    per_salt = several.select("h", "salt").distinct().join(stays, "h")
    clashes, path = stage(
        several.join(per_salt, ["h", "salt"]).where(~_same("t", "kept_text")).select("h").distinct(), "exact_clashes")
    out = ["id", "keep_id", "size", "kept", "sha", *[f"x_{c}" for c in carry]]
    if clashes.isEmpty():
        drop(docs.sparkSession, [path])
        result = found.select(*out)
    else:
        exact = Window.partitionBy("h", "f")
        again = (
            found.join(clashes, "h", "left_semi").withColumn("f", _folded("t"))
            .withColumn("size", F.count(F.lit(1)).over(exact))
            .withColumn("keep_id", (F.max if big else F.min)("id").over(exact))
            .withColumn("kept", F.row_number().over(exact.orderBy(order, F.xxhash64("t"))) == 1)
        )
        result = found.join(clashes, "h", "left_anti").select(*out).unionByName(again.select(*out))
    return result.select(
        F.col("id").alias(id_col), "keep_id", F.col("size").cast("long").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"), *[f"x_{c}" for c in carry])


def drop_exact_duplicates(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    cols = docs.columns
    found = exact_duplicates(docs, id_col, text_col, keep, carry=tuple(cols))
    return found.where("kept").select(*[F.col(f"x_{c}").alias(c) for c in cols])
