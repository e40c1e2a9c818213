import os

from pyspark.sql import functions as F

from rivulet.session import scratch_path
from rivulet.sinks.atomic import append_lines, atomic_append, committed_batches, read_committed
from rivulet.streaming.streams import append_stream, run_available_now, table_stream


def test_atomic_append_retry_and_failure(spark):
    root = scratch_path(spark, "t_atomic")
    a = spark.range(10).withColumn("v", F.col("id") * 2)
    b = spark.range(3)
    r1 = atomic_append(spark, {"a": a, "b": b}, root, 1)
    assert r1["success"] and r1["insert_successfully_done"] == 2 and r1["rows"] == {"a": 10, "b": 3}
    r1b = atomic_append(spark, {"a": a, "b": b}, root, 1)  # retried batch
    assert r1b["success"]
    assert read_committed(spark, root, "a").count() == 10
    bad = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    r2 = atomic_append(spark, {"a": spark.range(100, 105), "b": bad}, root, 2)
    assert not r2["success"] and r2["error_code"]
    assert read_committed(spark, root, "a").count() == 10  # batch 2 invisible
    assert not os.listdir(f"{root}/a/batch_id=2")          # the failed attempt's folder is gone
    assert sorted(r[0] for r in committed_batches(spark, root).collect()) == ["1"]


def test_append_lines(spark):
    root = scratch_path(spark, "t_lines")
    recs = spark.createDataFrame([(1, "a,1\n\n b,2 \nc,x"), (2, "d,4")], "id long, content string")
    res = append_lines(spark, recs, "content", {
        "good": lambda ls: ls.select("id", F.from_csv("line", "name string, n int").alias("r"))
                             .filter("r.n is not null").select("id", "r.*"),
        "bad": lambda ls: ls.select("id", "line", F.from_csv("line", "name string, n int").alias("r"))
                            .filter("r.n is null").select("id", "line"),
    }, root, 7, keep=("id",))
    assert res["success"] and res["rows"] == {"good": 3, "bad": 1} and res["insert_successfully_done"] == 4
    got = sorted((r.id, r.name, r.n) for r in read_committed(spark, root, "good").collect())
    assert got == [(1, "a", 1), (1, "b", 2), (2, "d", 4)]


def test_stream_equals_batch(spark, sf_small):
    from rivulet.operators.records import to_records
    from rivulet.operators import jsonops as J

    stream = table_stream(spark, sf_small, "events")
    rec = to_records(stream, "event_id", ["event_type"], content="props")
    out = J.json_to_attributes(rec, case="upper").select("record_id", F.to_json("attributes").alias("a"))
    root = scratch_path(spark, "t_stream")
    q = append_stream(out, lambda b: {"attrs": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    got = read_committed(spark, root, "attrs").select("record_id", "a")
    batch_src = spark.read.parquet(f"{sf_small}/events.parquet")
    brec = to_records(batch_src, "event_id", ["event_type"], content="props")
    want = J.json_to_attributes(brec, case="upper").select("record_id", F.to_json("attributes").alias("a"))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # re-running the finished stream adds nothing
    q2 = append_stream(out, lambda b: {"attrs": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q2)
    assert read_committed(spark, root, "attrs").count() == want.count()


def _run_stream(spark, frame, name):
    root = scratch_path(spark, f"t_{name}")
    q = append_stream(frame, lambda b: {name: b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    return read_committed(spark, root, name).drop("batch_id")


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stateless_operators_on_streams(spark, sf_small):
    from rivulet.functions.json import map_json
    from rivulet.operators import lines as L
    from rivulet.operators import tokens as K
    from rivulet.operators import urlops as U

    def urls(df):
        out = U.url_params(df.select("page_id", "url"), "url", prefix="q.", if_empty="none")
        out = U.url_param_first(out, "url", "page")
        return out.select("page_id", map_json("params").alias("params"), "page", "url_failed")

    _same(_run_stream(spark, urls(table_stream(spark, sf_small, "pages")), "urls"),
          urls(spark.read.parquet(f"{sf_small}/pages.parquet")))

    def frags(df):
        return L.split_lines(df.select("doc_id", "text"), "doc_id", "text")["fragments"]

    _same(_run_stream(spark, frags(table_stream(spark, sf_small, "documents")), "frags"),
          frags(spark.read.parquet(f"{sf_small}/documents.parquet")))

    def signed(df):
        return K.sign_rows(df.select("c_custkey", "c_name"), ["c_custkey", "c_name"], "k", "HS384",
                           expires_s=10, now=5)

    _same(_run_stream(spark, signed(table_stream(spark, sf_small, "customer")), "signed"),
          signed(spark.read.parquet(f"{sf_small}/customer.parquet")))


def test_ids_over_micro_batches(spark):
    import tempfile

    from rivulet.sinks.atomic import read_committed
    from rivulet.streaming.streams import allocate_stream

    src = tempfile.mkdtemp(prefix="rivulet-src-")
    rows, ts = [], 0
    for part in range(3):  # three files → three micro-batches
        chunk = []
        for i in range(40):
            ts += 1
            chunk.append(("hot" if i % 2 else f"k{i % 5}", ts))
        rows += chunk
        spark.createDataFrame(chunk, "store string, ts long").coalesce(1).write.parquet(f"{src}/p{part}")
    stream = spark.readStream.schema("store string, ts long").option("maxFilesPerTrigger", "1") \
        .option("recursiveFileLookup", "true").parquet(src)
    initial = spark.createDataFrame([("hot", 5)], "store string, counter long")
    root = scratch_path(spark, "t_ids_stream")
    q = allocate_stream(stream, "store", "ts", root, f"{root}/_checkpoint", initial_counters=initial)
    run_available_now(q)
    got = read_committed(spark, root, "ids").collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.store, []).append((r.ts, r.next_id))
    for k, pairs in by.items():
        pairs.sort()
        start = 6 if k == "hot" else 1
        assert [i for _, i in pairs] == list(range(start, start + len(pairs))), k
    assert len({r.batch_id for r in got}) == 3


def test_processing_time_trigger(spark, sf_small):
    """The loop flow's periodic source: fixed attributes, a processing-time
    trigger; stopped once everything available has been processed."""
    from rivulet.operators import routing as R

    stream = table_stream(spark, sf_small, "events", fixed={"loop_value": 0, "loop_limit": 3}).select(
        "event_id", "loop_value", "loop_limit")
    out = R.loop_end(stream, "loop_value", F.col("loop_limit")).select("event_id", "loop_value", "iterations", "route")
    root = scratch_path(spark, "t_periodic")
    q = append_stream(out, lambda b: {"ends": b}, root, checkpoint=f"{root}/_checkpoint", processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = read_committed(spark, root, "ends")
    n = spark.read.parquet(f"{sf_small}/events.parquet").count()
    assert got.count() == n
    assert got.where("loop_value = 3 AND iterations = 3 AND route = 'endloop'").count() == n


def test_stream_packs_what_the_batch_query_packs(spark, sf_small):
    """Whole, cut, emptied and odd contents: every way an envelope can go."""
    from rivulet.plans.catalog import ORACLE, QUERIES

    got = QUERIES["stream_pack_envelope_events"](spark, sf_small)
    want = QUERIES["pack_envelope_events"](spark, sf_small)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    assert got.where("event_id >= 0").count() == events.count()
    assert got.where("attributes_json like '%no.attribute%'").count() == events.where("event_id % 17 = 0").count()
    assert got.where("not content_valid").count() == events.where("event_id % 13 = 0").count()
    assert ORACLE["stream_pack_envelope_events"] == ORACLE["pack_envelope_events"]
