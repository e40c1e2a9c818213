"""Retries, null keys, large and odd JSON, odd expiries, odd script orders,
and every stateless operator on a stream."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from rivulet.functions.json import is_json, map_json
from rivulet.functions.urls import url_pairs
from rivulet.operators import documents as D
from rivulet.operators import enrich as en
from rivulet.operators import jsonops as J
from rivulet.operators import routing as R
from rivulet.operators import scripts as S
from rivulet.operators import sequences as Q
from rivulet.operators import tokens as K
from rivulet.operators import urlops as U
from rivulet.operators.records import to_records
from rivulet.session import scratch_path
from rivulet.sinks.atomic import atomic_append, committed_batches, read_committed, route_outcome
from rivulet.sinks.logs import attribute_log, attribute_log_stream
from rivulet.streaming.streams import allocate_stream, append_stream, run_available_now, table_stream


def failing(spark, n=5):
    return spark.range(n).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("refused"))).otherwise(F.col("id")).alias("id"))


def test_failed_retry_of_a_committed_batch_changes_nothing(spark):
    root = scratch_path(spark, "t_retry")
    assert atomic_append(spark, {"a": spark.range(10), "b": spark.range(10)}, root, 1)["success"]
    again = atomic_append(spark, {"a": spark.range(3), "b": failing(spark)}, root, 1)
    assert again["success"] and again["rows"] == {"a": 10, "b": 10}  # listed: left alone
    assert not atomic_append(spark, {"a": spark.range(3), "b": failing(spark)}, root, 2)["success"]
    assert (read_committed(spark, root, "a").count(), read_committed(spark, root, "b").count()) == (10, 10)
    assert atomic_append(spark, {"a": spark.range(3), "b": spark.range(4)}, root, 2)["success"]
    assert (read_committed(spark, root, "a").count(), read_committed(spark, root, "b").count()) == (13, 14)


def test_failure_is_a_record_with_the_statement(spark):
    root = scratch_path(spark, "t_record")
    res = atomic_append(spark, {"a": spark.range(2), "b": failing(spark)}, root, 1)
    assert res["failed_target"] == "b" and res["error_message"].endswith("SQLSTATE: P0001")  # whole, not cut
    out = route_outcome(spark.createDataFrame([(1, "x")], "id long, v string"), res, "insert into b ...").first()
    assert out.route == "failure" and out.error_code.startswith("SqlErrCod[") and out.error_message.startswith("insert into b ...: ")
    assert "refused" in out.error_message


def test_read_errors_are_not_an_empty_log(spark):
    root = scratch_path(spark, "t_broken")
    assert committed_batches(spark, root).count() == 0
    assert atomic_append(spark, {"a": spark.range(2)}, root, 1)["success"]
    (version,) = glob.glob(f"{root}/_log/*/*0.json")
    with open(version, "w") as f:
        f.write("not json")
    with pytest.raises(Exception):  # noqa: B017
        committed_batches(spark, root).collect()
    assert not atomic_append(spark, {"a": spark.range(2)}, root, 2)["success"]


def test_new_checkpoint_keeps_what_was_committed(spark, sf_small):
    root = scratch_path(spark, "t_scope")
    n = spark.read.parquet(f"{sf_small}/orders.parquet").count()
    for run in (1, 2):
        s = table_stream(spark, sf_small, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
        run_available_now(allocate_stream(s, "o_custkey", ["o_orderdate", "o_orderkey"], root, f"{root}/_checkpoint{run}"))
        got = read_committed(spark, root, "ids")
        assert got.count() == run * n
        assert got.select("o_custkey", "next_id").distinct().count() == run * n  # no id twice


def test_next_ids_null_and_negative(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("b", 1), ("c", 5)], "k string, o long")
    counters = spark.createDataFrame([("a", -1), ("b", 7), (None, 3), ("z", 4), ("c", None)], "k string, counter long")
    ids, after = Q.allocate(df, "k", "o", counters)
    assert {(r.k, r.o, r.next_id) for r in ids.collect()} == {(None, 1, 4), (None, 2, 5), ("a", 1, 1), ("b", 1, 8), ("c", 5, 1)}
    assert {(r.k, r.counter) for r in after.collect()} == {(None, 5), ("a", 1), ("b", 8), ("z", 4), ("c", 1)}
    _, twice = Q.allocate(df, "k", "o", after)
    assert {(r.k, r.counter) for r in twice.collect()} == {(None, 7), ("a", 2), ("b", 9), ("z", 4), ("c", 2)}


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_next_ids_over_any_borders(spark, partitions):
    rows = [("h" if i % 5 else f"k{i % 3}", i % 40, i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o long, i long").repartition(4)
    counters = spark.createDataFrame([("h", 10), ("k1", 2)], "k string, counter long")
    got = {r.i: r.next_id for r in Q.next_ids(df, "k", ["o", "i"], counters, partitions=partitions).collect()}
    want, seen = {}, {"h": 10, "k1": 2}
    for k, o, i in sorted(rows):
        want[i] = seen[k] = seen.get(k, 0) + 1
    assert got == want


def test_json_of_any_size_and_with_repeated_names(spark):
    big = json.dumps({f"k{i}": "x" * 1000 for i in range(20_500)})
    texts = [big, '{"k":1,"k":2}', '{"a":', '{"a":1} x', "1],[2", '1,"b":2', '1},{"v":2', "[1, 2]", "3", "", "nope"]
    df = spark.createDataFrame([(i, x, {"a": "b"}) for i, x in enumerate(texts)], "id int, content string, attributes map<string,string>")
    ok = [r[0] for r in df.orderBy("id").select(is_json("content")).collect()]
    assert ok == [True, True, False, False, False, False, False, True, True, False, False]
    out = {r.id: r for r in J.pack_envelope(df).collect()}
    assert out[0].content_valid and len(out[0].content) > len(big) * 0.98
    assert out[1].content_valid and '"k":1' in out[1].content
    for i in (2, 3, 4, 5, 6, 10):
        assert not out[i].content_valid and out[i].content == texts[i]  # kept as it was


@pytest.mark.parametrize("exp, reason", [("1000.5", "expired"), ("1.0E3", "expired"), ('"soon"', "bad_payload"), ("{}", "bad_payload"),
                                         ("3000000000", None), ("null", None)])
def test_odd_expiries(spark, exp, reason):
    df = spark.createDataFrame([(f'{{"sub":"x","exp":{exp}}}',)], "p string").select(K.sign(F.col("p"), "s3cret").alias("token"))
    r = K.audit_tokens(df, "token", "s3cret", 2_000_000_000).first()
    assert (r.token_error, r.token_valid) == (reason, reason is None)


def test_script_chunks_by_position(spark):
    rows = [(1, o, f"l{i:02d}") for i, o in enumerate([0, 1000, 2000, 3000, None, 7, 7, 7])]
    for kind in ("long", "string"):
        df = spark.createDataFrame(rows, "k long, o long, line string").withColumn("o", F.col("o").cast(kind))
        got = S.append_script(df, "k", "o", chunk_rows=3).orderBy("chunk").collect()
        assert [r.chunk for r in got] == [0, 1, 2] and [r.script.count("\n") for r in got] == [3, 3, 2]
        assert got[0].script.startswith("l04\n")  # null first
    old = spark.createDataFrame([(1, "old"), (2, None), (3, "alone")], "k long, content string")
    lines = spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "k long, o long, line string")
    content = lambda **kw: {r.k: r.content for r in S.script_into_content(old, lines, "k", "o", **kw).collect()}
    assert content() == {1: "old\nx\n", 2: "y\n", 3: "alone"}
    assert content(reset=True) == {1: "x\n", 2: "y\n", 3: "alone"}


def test_state_digit_outside_its_range_is_ignored(spark):
    df = spark.createDataFrame([(1, 27), (2, None), (3, 4)], "k long, st int")
    g = {r.k: r for r in D.generate_cpf(D.generate_cpf(df, ["k"], 5, F.col("st"), "a"), ["k"], 5, None, "b").collect()}
    assert g[1].a == g[1].b and g[2].a == g[2].b and g[3].a[8] == "4"


def test_logs_of_streams(spark, sf_small):
    s = table_stream(spark, sf_small, "events")
    with pytest.raises(ValueError):
        attribute_log(s, ["event_id"], "/nowhere")
    root = scratch_path(spark, "t_log")
    run_available_now(attribute_log_stream(s, ["event_id", "event_type"], f"{root}/log", f"{root}/_checkpoint"))
    want = spark.read.parquet(f"{sf_small}/events.parquet").select("event_id", "event_type")
    got = spark.read.schema(want.schema).json(f"{root}/log")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def _records(df):
    return to_records(df, "event_id", {"event_type": "event_type", "a.b": F.col("user_id").cast("string")}, content="props")


STATELESS = {
    "O7 route": ("lineitem", lambda d: R.route_column(d.select("l_orderkey", "l_quantity"), {"few": F.col("l_quantity") < 10})),
    "O8 update": ("lineitem", lambda d: R.update_when(d.select("l_orderkey", "l_tax"), "l_tax", F.lit(0.0), F.col("l_tax") > 0.05)),
    "O9 failed": ("orders", lambda d: R.mark_failed(d.select("o_orderkey"), F.col("o_orderkey") % 2 == 0, "odd", "it's odd")),
    "O10 guard": ("documents", lambda d: R.guard_size(d.select("doc_id", "text"), "text", 500)),
    "O11 rename": ("nation", lambda d: en.rename_case(d, "upper")),
    "O21 to json": ("events", lambda d: J.attributes_to_json(_records(d)).select("record_id", "content")),
    "O23 unpack": ("events", lambda d: J.unpack_envelope(J.pack_envelope(_records(d))).select("record_id", "content", map_json("attributes").alias("a"))),
    "O24 attribute": ("events", lambda d: J.content_to_attribute(_records(d), "raw").select("record_id", map_json("attributes").alias("a"))),
    "O26 nest": ("events", lambda d: J.nest_attributes(_records(d), "a", ["a.b"]).select("record_id", "content")),
    "O28 rows": ("pages", lambda d: U.url_param_rows(d, "url", ["page_id"])),
    "O29 multimap": ("pages", lambda d: U.url_param_multimap(d.select("page_id", "url"), "url").select("page_id", F.to_json("param_values").alias("m"))),
    "O31 build": ("pages", lambda d: U.build_query_string(d.select("page_id", url_pairs("url").alias("p")), "p").select("page_id", "query_string")),
    "O33 script": ("nation", lambda d: S.rows_to_insert_script(d, "insert into n", keep=["n_nationkey"])),
    "O34 valid": ("customer", lambda d: D.with_validity(d.select(F.col("c_custkey").cast("string").alias("c")), "c", "ok")),
    "O37 cpf": ("customer", lambda d: D.generate_cpf(d.select("c_custkey"), ["c_custkey"], 3)),
    "O38 cnpj": ("customer", lambda d: D.generate_cnpj(d.select("c_custkey"), ["c_custkey"], 3)),
    "O41 audit": ("customer", lambda d: K.audit_tokens(K.sign_rows(d.select("c_custkey"), ["c_custkey"], "k"), "authorization", "k", 5)),
    "O42 end": ("lineitem", lambda d: R.loop_end(d.select("l_orderkey", F.col("l_linenumber").alias("v")), "v", F.lit(3))),
}


@pytest.mark.parametrize("name", sorted(STATELESS))
def test_stateless_operators_on_a_stream(spark, sf_small, name):
    table, op = STATELESS[name]
    root = scratch_path(spark, "t_op")
    run_available_now(append_stream(op(table_stream(spark, sf_small, table)), lambda b: {"out": b}, root, f"{root}/_checkpoint"))
    got = read_committed(spark, root, "out").drop("batch_id")
    want = op(spark.read.parquet(f"{sf_small}/{table}.parquet"))
    got = got.select(*want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
