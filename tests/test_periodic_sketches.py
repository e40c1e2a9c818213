"""Records of a timer (each period once, also over restarts) and stored sketches
against exact counts."""

import time

import pytest
from pyspark.sql import functions as F

from rivulet.operators import urlops as U
from rivulet.session import scratch_path
from rivulet.sinks.atomic import read_committed
from rivulet.sources.periodic import _Reader, read_periodic
from rivulet.streaming.streams import append_stream, run_available_now


def start(spark, root, **kw):
    s = read_periodic(spark, fixed={"loop_value": 0, "loop_limit": 10}, **kw)
    return append_stream(s, lambda b: {"records": b}, root, f"{root}/_checkpoint", processing_time=kw.pop("trigger", None))


def test_each_period_once_over_restarts(spark):
    root = scratch_path(spark, "t_periodic_once")
    for ticks in (5, 5, 12, 40):   # periods that have come by then
        run_available_now(start(spark, root, records=3, first_tick=100, ticks=ticks))
        rows = read_committed(spark, root, "records").collect()
        assert sorted(r.record_id for r in rows) == list(range(300, 300 + 3 * ticks))
    assert all((r.loop_value, r.loop_limit, r.tick) == (0, 10, r.record_id // 3) for r in rows)
    assert all(r.fired_at.timestamp() == r.tick for r in rows)


def test_a_replayed_batch_has_the_same_records():
    r = _Reader({"periodseconds": "0.5", "recordsperperiod": "2", "firsttick": "7", "ticks": "25000"})
    parts = r.partitions({"tick": 7}, {"tick": 25007})
    assert len(parts) == 3
    got = [row for p in parts for row in r.read(p)]
    assert got == [row for p in parts for row in r.read(p)] and [g[0] for g in got] == list(range(14, 50014))
    assert r.initialOffset() == {"tick": 7} and r.latestOffset() == {"tick": 25007}
    with pytest.raises(ValueError):
        _Reader({"periodseconds": "0"})


def test_the_timer_runs(spark):
    root = scratch_path(spark, "t_timer")
    s = read_periodic(spark, period_s=0.5)
    q = append_stream(s, lambda b: {"records": b}, root, f"{root}/_checkpoint", processing_time="500 milliseconds")
    try:
        until = time.time() + 60
        while time.time() < until and (not q.lastProgress or q.lastProgress["batchId"] < 3):
            time.sleep(0.2)
    finally:
        q.stop()
    ticks = sorted(r.tick for r in read_committed(spark, root, "records").collect())
    assert len(ticks) >= 3 and ticks == list(range(ticks[0], ticks[0] + len(ticks)))   # no period missing, none twice
    with pytest.raises(ValueError):
        read_periodic(spark, ticks=3)


def test_sketches_of_parts_against_exact_counts(spark):
    n = 60_000
    urls = spark.range(n).select(
        "id", (F.col("id") % 9).alias("day"),
        F.concat(F.lit("http://h/p?many="), F.col("id") % 30_000, F.lit("&few="), F.col("id") % 40, F.lit("&few=0&hot="),
                 F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise((F.col("id") % 500).cast("string"))).alias("url"))
    exact = {r.key: r for r in U.url_param_stats(urls, "url", "id").collect()}
    root = scratch_path(spark, "t_sketches")
    U.url_param_sketches(urls, "url", "day").write.partitionBy("day").parquet(root)
    stored = spark.read.parquet(root)
    assert stored.count() == 27   # nine parts, three names: no row per value
    got = {r.key: r for r in U.url_param_report(stored).collect()}
    for key, want in exact.items():
        assert (got[key].n_occurrences, got[key].n_urls) == (want.n_occurrences, want.n_urls)
        assert abs(got[key].n_values - want.n_values) <= 0.03 * want.n_values
    assert got["few"].n_values == 40 and got["hot"].n_values == exact["hot"].n_values
    assert [(r["item"], r["count"]) for r in got["few"].top][0] == ("0", n + n // 40)
    assert got["hot"].top[0]["item"] == "x"
    # some parts only, and parts merged before
    days = U.url_param_report(stored.where("day < 4"))
    want = {r.key: r.n_urls for r in U.url_param_stats(urls.where("day < 4"), "url", "id").collect()}
    assert {r.key: r.n_urls for r in days.collect()} == want


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "http://h/", 0)], "id int, url string, day int")
    assert U.url_param_report(U.url_param_sketches(df, "url", "day")).count() == 0
