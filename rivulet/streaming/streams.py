"""The same operators on streaming frames.

Stateless operators are plain projections/filters, so they apply to a
``readStream`` frame unchanged (O43). A stream enriched by a static table is
a stream-static join (O44), and the transactional append is ``foreachBatch``
calling ``atomic_append`` with the stream's own id and the micro-batch number:
a replayed batch is listed already and changes nothing, and a stream with a
new checkpoint (or another stream on the same root) has batches of its own.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.operators.sequences import next_ids
from rivulet.session import materialize
from rivulet.sinks.atomic import ATTEMPT_COL, BATCH_COL, append_routes, atomic_append, committed_attempts, ensure_root
from rivulet.sinks.txlog import files_of
from rivulet.sources.tables import stream_source


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int | None = None,
                 fixed: Mapping | None = None) -> DataFrame:
    """A driver table (one Parquet file in ``sf_dir``) read as a stream."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return stream_source(spark, sf_dir, schema, file_glob=f"{name}.parquet", fixed=fixed,
                         max_files_per_trigger=max_files_per_trigger)


def _start(stream: DataFrame, each: Callable[[DataFrame, int, str], None], checkpoint: str,
           processing_time: str | None, mode: str = "append") -> StreamingQuery:
    """Start ``each(batch, number, stream id)`` per micro-batch. The id is the
    one in the checkpoint: it outlives restarts, and a new checkpoint has
    another."""
    known: dict[str, str] = {}
    ready = threading.Event()

    def run(batch: DataFrame, number: int) -> None:
        if not ready.wait(60):
            raise RuntimeError("the stream's id is not known")
        each(batch, number, known["id"])

    w = stream.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    query = w.start()
    known["id"] = str(query.id)
    ready.set()
    return query


def _append(spark: SparkSession, targets: Mapping[str, DataFrame], root: str, stream_id: str, number: int) -> dict:
    return atomic_append(spark, targets, root, f"{stream_id}-{number}", stream=stream_id, seq=number)


def append_stream(stream: DataFrame, split: Callable[[DataFrame], Mapping[str, DataFrame]], root: str,
                  checkpoint: str, processing_time: str | None = None,
                  on_result: Callable[[dict], None] | None = None) -> StreamingQuery:
    """Start a stream whose every micro-batch is appended all-or-nothing to
    the targets ``split(batch)`` returns. A failed batch raises, so the
    stream stops and replays that batch id on restart."""
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int, stream_id: str) -> None:
        targets = split(batch)
        if len(targets) > 1:
            # several targets read the same micro-batch: compute it once
            targets = split(materialize(batch, "micro_batch"))
        res = _append(spark, targets, root, stream_id, number)
        if on_result:
            on_result(res)
        if not res["success"]:
            raise RuntimeError(f"batch {number} failed: {res['error_code']} {res['error_message']}")

    ensure_root(spark, root)
    return _start(stream, each, checkpoint, processing_time)


def append_routes_stream(stream: DataFrame, routes: Mapping[str, Column], root: str, checkpoint: str,
                         processing_time: str | None = None, **kw) -> StreamingQuery:
    """``append_routes`` per micro-batch: one scan of it for all targets."""
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int, stream_id: str) -> None:
        res = append_routes(spark, batch, routes, root, f"{stream_id}-{number}", stream=stream_id, seq=number, **kw)
        if not res["success"]:
            raise RuntimeError(f"batch {number} failed: {res['error_code']} {res['error_message']}")

    ensure_root(spark, root)
    return _start(stream, each, checkpoint, processing_time)


def run_available_now(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` stream to drain what is there."""
    query.awaitTermination(timeout_s)
    if query.exception():
        raise query.exception()


# Keyed state lives in RocksDB, inside the JVM; a micro-batch writes the changes of its own keys.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _own_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id in a checkpoint; None if the stream has not run yet."""
    files = files_of(spark, checkpoint)
    return json.loads(files.read("metadata"))["id"] if files.exists("metadata") else None


def stream_counters(spark: SparkSession, root: str, keys, initial: DataFrame | None = None, counter_col: str = "counter",
                    id_col: str = "next_id", without: str | None = None) -> DataFrame:
    """The counter table of a root: per key the largest id that was committed
    (by streams other than ``without``) or the initial counter."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    found = []
    if initial is not None:
        found.append(initial.select(*ks, F.coalesce(F.col(counter_col).cast("long"), F.lit(0)).alias(counter_col)))
    done = committed_attempts(spark, root).where(F.map_contains_key("rows", F.lit("ids")))
    if without is not None:
        done = done.where(~F.col("stream").eqNullSafe(F.lit(without)))
    if not done.isEmpty():
        ids = spark.read.parquet(f"{root.rstrip('/')}/ids")
        on = (ids[BATCH_COL] == done["batch_id_value"]) & (ids[ATTEMPT_COL] == done["attempt_value"])
        found.append(ids.join(done, on, "left_semi").select(*ks, F.col(id_col).alias(counter_col)))
    if not found:
        return None
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return both.groupBy(*ks).agg(F.max(counter_col).alias(counter_col))


def allocate_stream(stream: DataFrame, keys, order_by, root: str, checkpoint: str,
                    initial_counters: DataFrame | None = None, counter_col: str = "counter",
                    id_col: str = "next_id", processing_time: str | None = None) -> StreamingQuery:
    """O18 on a stream: every micro-batch continues the counters of the batches
    before it (target ``ids``).

    The counters are keyed state (a running sum per key, in update mode): a
    micro-batch reads and writes those of its own keys, and nothing is rewritten.
    Rows are counted before they reach a key's counter (partial aggregation), and
    go past it to ``next_ids``, which splits a hot key. The micro-batch is written
    once and read from there, so the state moves once. A stream with a new
    checkpoint begins with ``initial_counters`` and the largest ids that other
    streams committed on the root, so no id is given twice: these are written
    beside its checkpoint before it starts and are a source of the sum, read by
    its first micro-batch."""
    spark = stream.sparkSession
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    ks = [keys] if isinstance(keys, str) else list(keys)
    key = F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(ks)]))
    ensure_root(spark, root)
    start = f"{checkpoint.rstrip('/')}/start"
    if _own_id(spark, checkpoint) is None:
        known = stream_counters(spark, root, ks, initial_counters, counter_col, id_col)
        if known is not None:
            n = F.greatest(F.col(counter_col), F.lit(0))
            known.select(key.alias("key"), n.alias("n")).groupBy("key").agg(F.max("n").alias("n")).write.mode("overwrite").parquet(start)
    claims = stream.select(key.alias("key"), F.lit(1).cast("long").alias("n"))
    if files_of(spark, checkpoint).exists("start/_SUCCESS"):
        claims = claims.unionByName(stream_source(spark, start, "key string, n long"))
    counted = claims.groupBy("key").agg(F.sum("n").alias("upto"))
    row = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    rows = stream.select(key.alias("key"), F.lit(None).cast("long").alias("upto"), row.alias("row"))
    both = rows.unionByName(counted, allowMissingColumns=True)

    def each(batch: DataFrame, number: int, stream_id: str) -> None:
        both = materialize(batch, "claimed")
        got = both.where("upto is null").select("key", "row.*")
        # (the sum is that after this micro-batch; of keys without a row in it nothing is asked)
        own = F.count_if(F.col("upto").isNull())
        before = (both.groupBy("key").agg((F.max("upto") - own).alias("before"), own.alias("own"))
                  .where("own > 0").select("key", "before"))
        ids = next_ids(got, "key", order_by, before, "before", id_col)
        res = _append(spark, {"ids": ids.drop("key")}, root, stream_id, number)
        if not res["success"]:
            raise RuntimeError(f"batch {number} failed: {res['error_code']} {res['error_message']}")

    return _start(both, each, checkpoint, processing_time, "update")
