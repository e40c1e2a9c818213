from pyspark.sql import functions as F

from rivulet.functions.templates import predicate, render
from rivulet.operators import routing as R
from rivulet.operators import scripts as S


def test_route_multi_and_unmatched(spark):
    df = spark.createDataFrame([(1, 5), (2, 15), (3, None), (4, 50)], "id long, q long")
    routes = {"low": F.col("q") < 10, "mid": F.col("q") < 20, "any_small": F.col("q") < 30}
    out = R.route(df, routes)
    assert sorted(r.id for r in out["low"].collect()) == [1]
    assert sorted(r.id for r in out["mid"].collect()) == [1, 2]
    assert sorted(r.id for r in out["unmatched"].collect()) == [3, 4]
    one = R.route(df, routes, multi=False)
    assert sorted(r.id for r in one["mid"].collect()) == [2]
    col = R.route_column(df, routes)
    assert sorted((r.id, r.route) for r in col.collect()) == [
        (1, "any_small"), (1, "low"), (1, "mid"), (2, "any_small"), (2, "mid"), (3, "unmatched"), (4, "unmatched")]


def test_loop_flow_records(spark):
    df = spark.createDataFrame([(0, 10), (10, 10), (11, 10), (None, 10)], "loop_value int, loop_limit int")
    trace = R.loop_trace(df.withColumn("start", F.col("loop_value")), "start", F.col("loop_limit"))
    by = {}
    for r in trace.collect():
        by.setdefault(r.start, []).append((r.step, r.loop_value, r.route))
    assert sorted(by[0]) == [(i, i, "loop") for i in range(10)] + [(10, 10, "endloop")]
    assert by[10] == [(0, 10, "endloop")]
    assert by[11] == [(0, 11, "unmatched")]
    assert by[None] == [(0, None, "unmatched")]
    end = {(r.iterations, r.route, r.loop_value) for r in R.loop_end(df, "loop_value", F.col("loop_limit")).collect()}
    assert end == {(10, "endloop", 10), (0, "endloop", 10), (0, "unmatched", 11), (0, "unmatched", None)}


def test_update_when_and_templates(spark):
    df = spark.createDataFrame([("0", "10"), (None, "10"), ("10", "10")], "loop_value string, loop_limit string")
    upd = R.update_when(df, "loop_value", render("${loop_value:plus(1)}"), predicate("${loop_value:notNull()}"))
    assert [r.loop_value for r in upd.collect()] == ["1", None, "11"]
    flags = df.select(predicate("${loop_value:lt(${loop_limit})}").alias("lt"),
                      predicate("${loop_value:equals(${loop_limit})}").alias("eq"),
                      render("select * from t where a = '${loop_value}' and b = ${loop_limit}").alias("sql")).collect()
    assert [(r.lt, r.eq) for r in flags] == [(True, False), (None, None), (False, True)]
    assert flags[1].sql == "select * from t where a = '' and b = 10"


def test_failure_routes_and_size_guard(spark):
    df = spark.createDataFrame([(1, "x" * 10), (2, "é" * 6), (3, None)], "id long, content string")
    g = {r.id: r for r in R.guard_size(df, "content", max_bytes=10).collect()}
    assert g[1].route == "success" and g[2].route == "failure" and g[3].route == "success"
    assert g[2].error_code == "content_too_large" and "12 bytes" in g[2].error_message
    parts = R.split_failed(df, F.col("id") != 2, "SqlErrCod[1] ", F.lit("insert into t values ('x')"))
    assert [r.id for r in parts["failure"].collect()] == [2]
    assert parts["failure"].first().error_message == 'insert into t values ("x")'
    assert sorted(r.id for r in parts["success"].collect()) == [1, 3]


def test_iterate_union_and_scripts(spark):
    df = spark.createDataFrame([(7,), (8,)], "v int")
    out = S.iterate_union(df, lambda d: d.select((F.col("v") % F.col("i")).alias("m")), 3)
    assert sorted(r.m for r in out.collect()) == [0, 1, 2]
    assert S.iterate_union(df, lambda d: d.select("i"), 0).count() == 2  # one SELECT: no UNION
    rows = spark.createDataFrame([(1, 2, "a"), (1, 1, None), (2, 1, "c")], "k long, n long, s string")
    lines = S.rows_to_insert_script(rows, "insert into t", ["n", "s"], keep=["k", "n"])
    assert sorted(r.line for r in lines.collect())[0] == "insert into t(n,s) values (1,c);"
    scripts = {r.k: r.script for r in S.append_script(lines, "k", "n").collect()}
    assert scripts[1] == "insert into t(n,s) values (1,null);\ninsert into t(n,s) values (2,a);\n"
    small = {(r.k, r.chunk): r.script for r in S.append_script(lines, "k", "n", chunk_rows=1).collect()}
    assert set(small) == {(1, 0), (1, 1), (2, 0)}


def test_append_script_keeps_old_content_first(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k long, n long, s string")
    lines = S.rows_to_insert_script(rows, "insert into t", ["s"], keep=["k", "n"])
    old = spark.createDataFrame([(1, "previous text")], "k long, content string")
    parts = sorted((r.chunk, r.script) for r in S.append_script(lines, "k", "n", old_content=old).collect())
    assert "".join(p for _, p in parts) == ("previous text\n" "insert into t(s) values (a);\n"
                                            "insert into t(s) values (b);\n")
    assert parts[0][0] == -1


def test_insert_script_quoting(spark):
    rows = spark.createDataFrame([(1, "O'Brien"), (2, None)], "id long, name string")
    plain = sorted(r.line for r in S.rows_to_insert_script(rows, "insert into t", ["id", "name"]).collect())
    assert plain == ["insert into t(id,name) values (1,O'Brien);", "insert into t(id,name) values (2,null);"]
    quoted = sorted(r.line for r in S.rows_to_insert_script(rows, "insert into t", ["id", "name"], quote=True).collect())
    assert quoted == ["insert into t(id,name) values ('1','O''Brien');", "insert into t(id,name) values ('2',null);"]


def test_iterate_sql_over_table_names(spark):
    for i in (1, 2, 3):
        spark.range(i * 10, i * 10 + 3).selectExpr("id % 2 AS v").createOrReplaceTempView(f"part_{i}")
    out = S.iterate_sql(spark, "SELECT v FROM part_#{iterate}", 3)
    assert sorted(r.v for r in out.collect()) == [0, 1]
    # one iteration is the plain SELECT (no UNION, duplicates stay)
    assert S.iterate_sql(spark, "SELECT v FROM part_#{iterate}", "0").count() == 3
    import pytest
    with pytest.raises(ValueError):
        S.iterate_sql(spark, "SELECT 1", "x")
