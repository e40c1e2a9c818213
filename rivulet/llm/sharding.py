"""Sharding by proportional stratified interleaving.

Rows of each source (stratum) are put in a seeded random order; the row of
rank r among n gets the fractional rank (2r - 1) / 2n. All rows, sorted by
that fraction, are a sequence in which every stretch holds every source in
its share of the whole, so cutting it into equal stretches gives shards that
match the mixture. Row counts of shards differ by at most one.

No window ever covers a whole source or the whole table: ranks are taken in
hash buckets inside a source and in buckets of the fraction, and start from
prefix sums over per-bucket counts. A source holding most rows is as spread
out as any other. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.session import materialize

LAW = "rows"


def _shuffle_key(seed: int, id_col: str) -> Column:
    """60 bits of md5(seed|id): the seeded random order (null id: empty)."""
    text = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def interleave(rows: DataFrame, n_shards: int, id_col: str = "doc_id", stratum: str = "source",
               seed: int = 17, buckets: int = 1024, fraction_buckets: int = 4096) -> DataFrame:
    """All ``rows`` with two more columns, ``shard`` (int, 0 to n_shards - 1)
    and ``slot`` (long, the row's place in its shard, gapless from 0).

    ``rows`` should be narrow (ids, sizes), since they are shuffled twice. A
    null stratum is a stratum of its own; a null id counts as the empty id.
    Rows with equal ids are ordered by their other columns, so only rows equal
    in all columns are interchangeable. An empty table gives an empty table.
    Columns of ``rows`` named shard or slot are replaced.
    """
    names = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    base = rows.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
        F.when(F.col(stratum).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(stratum).cast("string"))).alias("s"),
        _shuffle_key(seed, id_col).alias("h"),
    ).withColumn("b", F.col("h") % buckets)

    # One small row per (stratum, bucket); read three times, so kept as a table.
    counts = materialize(base.groupBy("s", "b").agg(F.count(F.lit(1)).alias("c")), "shard_counts")
    total = counts.agg(F.sum("c")).first()[0] or 0
    inside = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "s", "b",
        F.coalesce(F.sum("c").over(inside), F.lit(0)).alias("before"),
        F.sum("c").over(Window.partitionBy("s")).alias("n"),
    )
    ids = [f"c{i}" for i in range(len(names))]
    rank = F.row_number().over(Window.partitionBy("s", "b").orderBy("h", *ids))
    ranked = (
        base.join(offsets, ["s", "b"])
        .withColumn("r", F.col("before") + rank)
        .withColumn("fb", F.expr(f"((2 * r - 1) * {fraction_buckets}L) div (2 * n)"))
    )

    # How many rows of a stratum of n lie in each fraction bucket follows from
    # n alone: the ranks below bucket x are those with (2r - 1) * B < 2 * n * x.
    B = fraction_buckets
    upto = lambda x: f"((2 * n * ({x}) + {3 * B - 1}L) div {2 * B}L - 1)"
    starts = (
        counts.groupBy("s").agg(F.sum("c").alias("n"))
        .select("n", F.explode(F.expr(f"sequence(1L, least(n, {B}L))")).alias("i"))
        .select(
            F.expr(f"if(n < {B}L, ((2 * i - 1) * {B}L) div (2 * n), i - 1)").alias("fb"),
            F.expr(f"if(n < {B}L, 1L, {upto('i')} - {upto('i - 1')})").alias("c"),
        )
        .groupBy("fb").agg(F.sum("c").alias("c"))
        .select("fb", F.coalesce(F.sum("c").over(
            Window.orderBy("fb").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    )  # at most fraction_buckets rows
    place = F.row_number().over(
        Window.partitionBy("fb").orderBy((2 * F.col("r") - 1).cast("double") / (2 * F.col("n")).cast("double"), "s", "r"))
    placed = ranked.join(F.broadcast(starts), "fb").withColumn("pos", F.col("start") + place - 1)
    return (
        placed.withColumn("sh", F.expr(f"(pos * {n_shards}L) div {max(total, 1)}L"))
        .select(
            *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
            F.col("sh").cast("int").alias("shard"),
            F.expr(f"pos - (sh * {total}L + {n_shards - 1}L) div {n_shards}L").alias("slot"),
        )
    )


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """Documents to shards: doc_id, size (UTF-8 bytes of the text, none for
    null, plus 1), text_crc32, law, shard, slot, grown_shard (null: only a key
    law can say where a row goes in a grown set of shards)."""
    narrow = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col("source").alias("source"),
    )
    out = interleave(narrow, n_shards)
    return out.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
