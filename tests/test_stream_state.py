"""O18 on streams by keyed state: several micro-batches, restarts, a hot key, null
keys, repeated counters, and what a micro-batch writes."""

import os
import time
from collections import defaultdict

from pyspark.sql import functions as F

from rivulet.operators import sequences as Q
from rivulet.session import scratch_path
from rivulet.sinks.atomic import read_committed
from rivulet.streaming import streams
from rivulet.streaming.streams import allocate_stream, run_available_now, stream_counters

SCHEMA = "store string, ts long"


def files_stream(spark, root):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", "1").parquet(f"{root}/src/*")


def put(spark, root, part, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/src/{part}")


def run(spark, root, initial=None, checkpoint="_checkpoint"):
    run_available_now(allocate_stream(files_stream(spark, root), "store", "ts", root, f"{root}/{checkpoint}", initial_counters=initial))


def check(spark, root, rows, start):
    want, n = {}, defaultdict(int, start)
    for store, ts in rows:
        n[store] += 1
        want[ts] = (store, n[store])
    got = {r.ts: (r.store, r.next_id) for r in read_committed(spark, root, "ids").collect()}
    assert got == want


def test_batches_restarts_and_a_hot_key(spark):
    root = scratch_path(spark, "t_state")
    initial = spark.createDataFrame([("hot", 5), ("hot", 9), ("k1", -4), (None, 3), ("idle", 70)], "store string, counter long")
    rows, ts = [], 0
    for part in range(5):
        chunk = []
        for i in range(900):
            ts += 1
            chunk.append(("hot" if i % 3 == 0 else None if i % 100 == 1 else f"k{i % (3 + part)}", ts))
        put(spark, root, part, chunk)
        rows += chunk
        if part != 1:   # (batches 1 and 2 in one run, the others after a restart each)
            run(spark, root, initial)
    check(spark, root, rows, {"hot": 9, None: 3})
    run(spark, root, initial)   # nothing new
    check(spark, root, rows, {"hot": 9, None: 3})
    counters = {r.store: r.counter for r in stream_counters(spark, root, "store", initial).collect()}
    assert counters["hot"] == 9 + 1500 and counters["idle"] == 70 and len({r.batch_id for r in read_committed(spark, root, "ids").collect()}) == 5


def test_a_failed_batch_is_replayed_with_the_same_ids(spark, monkeypatch):
    root = scratch_path(spark, "t_replay")
    rows = [("a", 1), ("b", 2), ("a", 3)]
    put(spark, root, 0, rows)
    real = streams._append

    def lost_after_commit(*a):
        real(*a)
        raise RuntimeError("lost")

    monkeypatch.setattr(streams, "_append", lost_after_commit)
    q = allocate_stream(files_stream(spark, root), "store", "ts", root, f"{root}/_checkpoint")
    try:
        q.awaitTermination()
    except Exception as e:  # noqa: BLE001
        assert "lost" in str(e)
    monkeypatch.setattr(streams, "_append", real)
    more = [("a", 4), ("c", 5)]
    put(spark, root, 1, more)
    run(spark, root)
    check(spark, root, rows + more, {})


def test_a_batch_writes_its_own_keys_only(spark):
    root = scratch_path(spark, "t_bytes")
    initial = spark.range(20_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("store"), F.col("id").alias("counter"))
    put(spark, root, 0, [("s1", 1)])
    run(spark, root, initial)
    sizes = []
    for part, keys in ((1, 1000), (2, 10)):
        put(spark, root, part, [(f"s{i}", 100_000 * part + i) for i in range(keys)])
        time.sleep(1.1)   # file times are whole seconds on some systems
        since = time.time()
        run(spark, root, initial)
        state = f"{root}/_checkpoint/state"
        sizes.append(sum(os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(state) for f in fs
                         if f.endswith(".changelog") and os.path.getmtime(f"{d}/{f}") >= since))
        assert not os.path.exists(f"{root}/counters")
    many, few = sizes
    assert 0 < few < many < 200_000   # 20,000 counters would be more
    ids = {r.store: r.next_id for r in read_committed(spark, root, "ids").where("ts >= 200000").collect()}
    assert ids["s9"] == 9 + 2 and ids["s1"] == 1 + 3


def test_repeated_counters_count_once(spark):
    df = spark.createDataFrame([("a", i) for i in range(3)], "k string, o long")
    counters = spark.createDataFrame([("a", 5), ("a", 7)], "k string, counter long")
    ids, after = Q.allocate(df, "k", "o", counters)
    assert sorted(r.next_id for r in ids.collect()) == [8, 9, 10]
    assert [(r.k, r.counter) for r in after.collect()] == [("a", 10)]
    assert [r.counter for r in Q.updated_counters(df, "k", counters).collect()] == [10]


def test_counters_are_summed_without_a_call_per_key(spark):
    """No worker is asked key by key: the state is Spark's own running sum. The
    counters that a stream begins with are read once, even before any row."""
    root = scratch_path(spark, "t_sum")
    initial = spark.createDataFrame([("a", 5), ("a", 9), ("idle", 70)], "store string, counter long")
    put(spark, root, 0, [])
    q = allocate_stream(files_stream(spark, root), "store", "ts", root, f"{root}/_checkpoint", initial_counters=initial)
    run_available_now(q)
    used = [o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]]
    assert used and set(used) == {"stateStoreSave"}
    rows = [("a", 1), ("b", 2), ("a", 3)]
    put(spark, root, 1, rows)
    run(spark, root, spark.createDataFrame([("a", 500)], "store string, counter long"))   # (too late for other counters)
    check(spark, root, rows, {"a": 9})
