"""The commit log: racing writers, lost writers, many batches, few files read;
targets prepared before the first write; all targets of one input in one scan."""

import glob
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from rivulet.session import scratch_path
from rivulet.sinks import txlog
from rivulet.sinks.atomic import append_routes, atomic_append, committed_attempts, read_committed, read_routed
from rivulet.sinks.txlog import Files, Log, files_of


def test_put_if_absent_has_one_winner(spark):
    root = scratch_path(spark, "t_put")
    won, gate = [], threading.Barrier(8)

    def race(i):
        files = files_of(spark, root)
        for n in range(20):
            gate.wait()
            if files.put_if_absent(f"x/{n}", f"writer {i}"):
                won.append((n, i))

    threads = [threading.Thread(target=race, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(n for n, _ in won) == list(range(20))
    files = files_of(spark, root)
    assert all(files.read(f"x/{n}") == f"writer {i}" for n, i in won)
    assert not glob.glob(f"{root}/x/.*tmp")


def test_log_on_other_file_systems(spark, monkeypatch):
    """By a rename that refuses an existing target, all files through Hadoop."""
    monkeypatch.setattr(txlog, "files_of", Files)
    monkeypatch.setattr(txlog, "FAN", 3)
    root = scratch_path(spark, "t_rename")
    files = Files(spark, root)
    assert files.put_if_absent("d/a", "first") and not files.put_if_absent("d/a", "second") and files.read("d/a") == "first"
    log = Log(spark, root)
    for i in range(10):
        assert log.commit(f"b{i}", "a", {"t": i})["version"] == i
    assert Log(spark, root).commit("b4", "other", {})["attempt_value"] == "a"
    assert committed_attempts(spark, root).count() == 10


def test_racing_writers_of_one_batch(spark):
    root = scratch_path(spark, "t_race")
    entries, gate = [], threading.Barrier(6)

    def race(i):
        log = Log(spark, root)
        for n in range(15):
            gate.wait()
            entries.append((n, i, log.commit(f"b{n}", f"a{i}", {"t": n})["attempt_value"]))

    threads = [threading.Thread(target=race, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    for n in range(15):
        assert len({won for m, _, won in entries if m == n}) == 1   # all see the same winner
    rows = committed_attempts(spark, root).collect()
    assert sorted(r.batch_id_value for r in rows) == sorted(f"b{n}" for n in range(15))
    assert sorted(r.version for r in rows) == list(range(15))


def test_racing_appends_show_one_attempt(spark):
    root = scratch_path(spark, "t_appends")
    results, gate = [], threading.Barrier(3)

    def race(i):
        gate.wait()
        results.append(atomic_append(spark, {"a": spark.range(10 + i), "b": spark.range(20 + i)}, root, "one"))

    threads = [threading.Thread(target=race, args=(i,)) for i in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert all(r["success"] for r in results) and len({str(r["rows"]) for r in results}) == 1
    n = read_committed(spark, root, "a").count()
    assert results[0]["rows"] == {"a": n, "b": n + 10} and read_committed(spark, root, "b").count() == n + 10


def test_a_slow_clock_does_not_win(spark, monkeypatch):
    import time

    root = scratch_path(spark, "t_clock")
    assert atomic_append(spark, {"a": spark.range(3)}, root, 1)["success"]
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    monkeypatch.setattr(time, "time", lambda: 0.0)
    late = Log(spark, root)
    assert late.commit("1", "late", {"a": 99})["attempt_value"] != "late"
    assert read_committed(spark, root, "a").count() == 3


def put_version(log, i, batch=None):
    """A commit whose writer was lost before index and segments."""
    entry = {"version": i, "batch_id_value": batch or f"b{i}", "attempt_value": f"a{i}", "stream": None, "seq": None,
             "layout": "folders", "rows": {"t": i}}
    assert log.files.put_if_absent(txlog._version_name(i), json.dumps(entry) + "\n")


def test_many_batches_and_few_files(spark):
    root = scratch_path(spark, "t_many")
    n, log = 10_000, Log(spark, root)
    for i in range(n - 2):
        log.commit(f"b{i}", f"a{i}", {"t": i})
    log.commit(f"b{n - 2}", f"a{n - 2}", {"t": n - 2})
    log.commit(f"b{n - 1}", f"a{n - 1}", {"t": n - 1})
    fresh = Log(spark, root)
    assert len(list(fresh.parts())) == 1     # one segment of the second level
    fresh.commit("more", "x", {"t": 1})
    assert fresh.files.reads <= txlog.FAN    # of a commit that knows nothing yet
    before = fresh.files.reads
    fresh.commit("still more", "y", {"t": 1})
    assert fresh.files.reads - before <= 1
    again = Log(spark, root)
    assert again.commit("b17", "z", {"t": 0})["attempt_value"] == "a17" and again.files.reads <= 2
    assert len(list(Log(spark, root).parts())) == 3
    rows = committed_attempts(spark, root)
    assert rows.count() == n + 2 and rows.select("version").distinct().count() == n + 2
    assert rows.where("version < 10000 and rows['t'] <> version").isEmpty()


def test_what_a_lost_writer_owes(spark, monkeypatch):
    """Lost after the commit, before index and segments: nothing is missed."""
    monkeypatch.setattr(txlog, "FAN", 4)
    root = scratch_path(spark, "t_lost")
    for i in range(18):
        put_version(Log(spark, root), i)
    late = Log(spark, root)
    for i in (0, 3, 7, 16, 17):
        assert late.commit(f"b{i}", "late", {})["attempt_value"] == f"a{i}"
    assert committed_attempts(spark, root).count() == 18
    assert os.path.exists(f"{root}/_log/segment2")
    for i in range(18):
        assert Log(spark, root).find(f"b{i}")["version"] == i


def test_all_targets_are_prepared_before_the_first_write(spark):
    root = scratch_path(spark, "t_prepare")
    df = spark.range(3)
    for bad in (lambda: spark.sql("select nothing from nowhere"), df.select("id", "id"), lambda: df.select("other")):
        res = atomic_append(spark, {"good": df, "bad": bad, "last": df}, root, 1)
        assert not res["success"] and res["failed_target"] == "bad" and res["rows"] == {}
        assert not os.path.exists(f"{root}/good")
    assert not atomic_append(spark, {"first": None, "b": df}, root, 1)["success"]
    res = atomic_append(spark, {"good": lambda: df, "blank": None, "last": df}, root, 1)
    assert res["success"] and res["rows"] == {"good": 3, "last": 3}


def test_routes_of_lineitem(spark, sf_small):
    root = scratch_path(spark, "t_routes")
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    routes = {f"q{i}": (F.col("l_quantity") >= 5 * i) & (F.col("l_quantity") < 5 * i + 12) for i in range(7)}
    res = append_routes(spark, li, routes, root, 1)
    assert res["success"] and set(res["rows"]) == {*routes, "unmatched"}
    for name, p in routes.items():
        want = li.where(p)
        assert res["rows"][name] == want.count()
        got = read_routed(spark, root, name).drop("batch_id")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    none = li.where("not (l_quantity < 42)")
    assert res["rows"]["unmatched"] == read_routed(spark, root, "unmatched").count() == none.count()
    assert append_routes(spark, li, routes, root, 1)["rows"] == res["rows"]     # again: left alone
    assert read_routed(spark, root).count() == sum(res["rows"].values())


def test_routes_fail_together_and_keep_columns(spark):
    root = scratch_path(spark, "t_routes2")
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    bad = df.withColumn("v", F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise(F.col("v")))
    routes = {"1": F.col("id") < 3, "b": F.col("v").isNotNull()}
    assert append_routes(spark, df, {"all": F.lit(True)}, root, 0)["success"]
    assert not append_routes(spark, bad, routes, root, 1)["success"]
    assert read_routed(spark, root, "1").count() == 0
    assert not glob.glob(f"{root}/_routed/batch_id=1/*")
    res = append_routes(spark, df, routes, root, 1, multi=False, unmatched=None, columns={"b": ["v"]})
    assert res["rows"] == {"1": 2, "b": 1}
    assert [(r.id, r.v) for r in read_routed(spark, root, "b").collect()] == [(None, "z")]
    assert read_routed(spark, root, "b", ["v"]).columns == ["v"]
    assert not append_routes(spark, df, {}, root, 2)["success"]
    assert not append_routes(spark, df.withColumn("target", F.lit(1)), routes, root, 2)["success"]


def test_routes_plan_has_one_scan(spark, sf_small):
    from rivulet.operators.routing import route_column
    from test_plans import executed_plan

    orders = spark.read.parquet(f"{sf_small}/orders.parquet").select("o_orderkey", "o_totalprice")
    tagged = route_column(orders, {f"t{i}": F.col("o_totalprice") > i for i in range(8)}, name="target")
    plan = executed_plan(tagged)
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan


def test_streams_of_routes(spark, sf_small):
    from rivulet.streaming.streams import append_routes_stream, run_available_now, table_stream

    root = scratch_path(spark, "t_routes_stream")
    routes = {"a": F.col("event_type") == "click", "b": F.col("user_id") % 2 == 0}
    for _ in range(2):   # the finished stream adds nothing
        s = table_stream(spark, sf_small, "events").select("event_id", "event_type", "user_id")
        run_available_now(append_routes_stream(s, routes, root, f"{root}/_checkpoint"))
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    for name, p in routes.items():
        assert read_routed(spark, root, name).count() == ev.where(p).count()
