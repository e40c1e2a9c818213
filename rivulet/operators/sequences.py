"""Gap-free sequence numbers per key, continuing stored counters.

``row_number() over (partition by key order by ...)`` would put every row
of a key in one task; a key holding a third of the table would then be one
task's work. Instead:

1. the rows, and the stored counters as a row before each key's first, are
   range-partitioned on (key, order) and sorted within partitions: sampled
   bounds split a hot key's rows over many partitions, in order;
2. one pass over each sorted partition numbers the rows of each key from 1 in
   that partition and notes the counter that it has met. The result is written
   as a table under ``spark.checkpoint.dir``, so every later use sees the same
   numbers, even if executors are lost and work is redone;
3. only the first key of a partition can have begun in an earlier one. A row
   per partition (its first and last key, and how many rows these have) tells
   how far each first key has come: one offset per partition;
4. id = counter, or for rows of a partition's first key that partition's
   offset, + number.

That is one exchange of the data; no window runs over it, and no task holds
more than one range partition. Null is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize

MAX_PARTITIONS = 20_000   # range partitions: a border row of each reaches the driver


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _changes(key: pa.Array, last) -> np.ndarray:
    """True where a row's key differs from the one before it (the first row:
    from ``last``, a 1-row array, or always); null equals null."""
    n = len(key)
    out = np.ones(n, bool)
    if n > 1:
        a, b = key.slice(1), key.slice(0, n - 1)
        same = pc.fill_null(pc.equal(a, b), False)
        both_null = pc.and_(pc.is_null(a), pc.is_null(b))
        out[1:] = ~pc.or_(same, both_null).to_numpy(zero_copy_only=False)
    if last is not None and n:
        out[0] = key[0].as_py() != last
    return out


def _numbered(batches):
    """(row, kind, base) of a sorted partition to (pid, row, kind, pos, number,
    base, head): the number within key and partition, the counter met in this
    partition (0 if none), and whether the row belongs to the first key."""
    pid, last, number, base, head, pos = TaskContext.get().partitionId(), None, 0, 0, True, 0
    started = False
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key = batch.column("key")
        new = _changes(key, last if started else None)
        if not started:
            new[0] = False
        started, last = True, key[n - 1].as_py()
        is_row = batch.column("kind").to_numpy(zero_copy_only=False) == 1
        group = np.cumsum(new)
        # rows of the same key before this batch count on
        upto = np.cumsum(is_row)
        at_start = np.concatenate([[0], upto[np.flatnonzero(new)] - is_row[new]])
        number_of = upto - at_start[group] + np.where(group == 0, number, 0)
        stored = np.where(is_row, 0, batch.column("base").fill_null(0).to_numpy(zero_copy_only=False))
        best = np.zeros(group[-1] + 1, np.int64)
        np.maximum.at(best, group, stored)
        best[0] = max(best[0], base)
        heads = (group == 0) & head
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, pid, np.int32)), key, batch.column("row"), batch.column("kind"),
             pa.array(np.arange(pos, pos + n)), pa.array(number_of), pa.array(best[group]), pa.array(heads)],
            ["pid", "key", "row", "kind", "pos", "number", "base", "head"])
        number, base, head, pos = int(number_of[-1]), int(best[-1]), bool(heads[-1]), pos + n


def _tagged(df: DataFrame, ks: list[str], os_: list[str], counters: DataFrame | None, counter_col: str,
            partitions: int | None) -> DataFrame:
    spark = df.sparkSession
    n = min(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_PARTITIONS)
    key = F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(ks)]))
    rows = df.select(key.alias("key"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("base"),
                     F.struct(*[F.col(f"`{o}`") for o in os_]).alias("ord"),
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    if counters is not None:
        stored = F.greatest(F.coalesce(F.col(counter_col).cast("long"), F.lit(0)), F.lit(0))
        rows = rows.unionByName(
            counters.select(key.alias("key"), F.lit(0).alias("kind"), stored.alias("base")), allowMissingColumns=True)
    row_type = rows.schema["row"].dataType.simpleString()
    return materialize(
        rows.repartitionByRange(n, "key", "kind", "ord").sortWithinPartitions("key", "kind", "ord")
        .select("key", "kind", "base", "row")
        .mapInArrow(_numbered, f"pid int, key string, row {row_type}, kind int, pos long, number long, base long, head boolean"),
        "next_ids")


def _offsets(tagged: DataFrame) -> dict[int, int]:
    """How far the first key of each partition has come before it."""
    borders = (tagged.groupBy("pid").agg(
        F.min_by("key", "pos").alias("first"), F.max_by("key", "pos").alias("last"),
        F.max_by("number", "pos").alias("n"), F.max_by("base", "pos").alias("base"),
        F.min("head").alias("whole")).orderBy("pid").collect())  # one row per partition
    out, key, come, any_before = {}, None, 0, False
    for b in borders:
        goes_on = any_before and b["first"] == key
        out[b["pid"]] = come if goes_on else 0
        begun = come if goes_on and b["whole"] else 0
        key, come, any_before = b["last"], begun + b["n"] + b["base"], True
    return {p: n for p, n in out.items() if n}


def _with_ids(tagged: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    spark = tagged.sparkSession
    rows = list(_offsets(tagged).items())
    come = F.broadcast(spark.createDataFrame(rows, "pid int, come long"))  # MAX_PARTITIONS rows at most
    before = F.when(F.col("head"), F.coalesce("come", F.lit(0))).otherwise(F.lit(0))
    return (tagged.where("kind = 1").join(come, "pid", "left")
            .select(*[F.col(f"row.`{c}`").alias(c) for c in columns if c != id_col],
                    (F.col("base") + before + F.col("number")).alias(id_col)))


def _merge_counters(used: DataFrame, ks: list[str], counters: DataFrame | None, counter_col: str) -> DataFrame:
    """``used`` = (keys, _n) rows allocated now → the new counter table. One
    grouping, in which null is a key like any other. Of repeated stored counters
    the largest counts, as it does for the ids."""
    zero = F.lit(0).cast("long")
    used = used.select(*ks, "_n", zero.alias("_old"))
    if counters is not None:
        old = F.greatest(F.coalesce(F.col(counter_col).cast("long"), zero), zero)
        used = used.unionByName(counters.select(*ks, zero.alias("_n"), old.alias("_old")))
    return used.groupBy(*ks).agg((F.sum("_n") + F.max("_old")).cast("long").alias(counter_col))


def next_ids(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str],
             counters: DataFrame | None = None, counter_col: str = "counter",
             id_col: str = "next_id", partitions: int | None = None) -> DataFrame:
    """``df`` plus ``id_col``: for each key, ``counter + 1, counter + 2, ...``
    in ``order_by`` order (a missing, null or negative counter counts as 0).
    ``keys`` + ``order_by`` must be a total order so re-runs give the same
    ids."""
    ks, os_ = _cols(keys), _cols(order_by)
    return _with_ids(_tagged(df, ks, os_, counters, counter_col, partitions), df.columns, id_col)


def updated_counters(df: DataFrame, keys: str | Sequence[str], counters: DataFrame | None = None,
                     counter_col: str = "counter") -> DataFrame:
    """The counter table after allocating ids for ``df``: existing keys are
    raised by their row count, new keys inserted with it, untouched keys
    kept. ``count`` is a partial aggregate (hot keys reduced map-side)."""
    ks = _cols(keys)
    used = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    return _merge_counters(used, ks, counters, counter_col)


def allocate(df: DataFrame, keys: str | Sequence[str], order_by: str | Sequence[str],
             counters: DataFrame | None = None, counter_col: str = "counter",
             id_col: str = "next_id", partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ids, new counter table). Publish both with
    ``sinks.atomic.atomic_append`` so a batch's ids and counters become
    visible together. Both come from the same written pass, so the input is
    not computed again for the counters."""
    ks, os_ = _cols(keys), _cols(order_by)
    tagged = _tagged(df, ks, os_, counters, counter_col, partitions)
    used = (tagged.where("kind = 1").select(*[F.col(f"row.`{k}`").alias(k) for k in ks])
            .groupBy(*ks).agg(F.count(F.lit(1)).alias("_n")))
    return _with_ids(tagged, df.columns, id_col), _merge_counters(used, ks, counters, counter_col)
