from pyspark.sql import functions as F

from rivulet.operators import enrich as en


def test_left_enrich_with_marker_null_keys_and_hot_key(spark):
    recs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "k long, name string")
    rows = [(1, i, "x") for i in range(500)] + [(2, 0, "y"), (None, 9, "z")]
    look = spark.createDataFrame(rows, "k long, n long, v string")
    out = en.enrich(recs, look, "k", empty_marker="NORESULT", case="upper")
    assert set(out.columns) == {"k", "name", "N", "V", "NORESULT"}
    got = out.collect()
    assert len(got) == 500 + 1 + 2
    miss = sorted((r.name, r.NORESULT, r.N) for r in got if r.NORESULT is not None)
    assert miss == [("c", "true", None), ("d", "true", None)]
    assert {type(r.N) for r in got if r.N is not None} == {str}
    inner = en.enrich(recs, look, "k", how="inner")
    assert inner.count() == 501
    lo = en.enrich(recs, look, "k", empty_marker="NORESULT", case="upper", hot_rows=40)  # key 1 in 13 pieces
    assert sorted(map(repr, lo.collect())) == sorted(map(repr, out.select(*lo.columns).collect()))


def test_enrich_json_and_last(spark):
    recs = spark.createDataFrame([(1,), (2,)], "k long")
    look = spark.createDataFrame([(1, 10, "p"), (1, 20, "q"), (1, 20, None)], "k long, t long, v string")
    js = sorted((r.k, r.content) for r in en.enrich_json(recs, look.select("k", "v"), "k").collect())
    assert js == [(1, '{"v":"p"}'), (1, '{"v":"q"}'), (1, "{}"), (2, "{}")]
    last = en.enrich_last(recs, look.withColumn("o", F.coalesce("v", F.lit(""))), "k", ["t", "o"],
                          empty_marker="none")
    assert sorted((r.k, r.v, r.none) for r in last.collect()) == [(1, "q", None), (2, None, "true")]


def test_small_side(spark):
    hinted = lambda df, n: "hint broadcast" in str(en.small_side(df, n)._jdf.queryExecution().logical()).lower()
    assert hinted(spark.range(10), 1000) and not hinted(spark.range(100000), 1000)


def test_lookup_columns_overwrite_record_columns(spark):
    recs = spark.createDataFrame([(1, "old", "x"), (2, "keep", "y")], "k long, status string, other string")
    look = spark.createDataFrame([(1, "new", "v1")], "k long, status string, extra string")
    for hot_rows in (None, 1):
        out = en.enrich(recs, look, "k", empty_marker="none", hot_rows=hot_rows)
        assert out.columns == ["k", "status", "other", "extra", "none"]
        got = sorted(map(repr, out.collect()))
        assert got == sorted(map(repr, [
            out.sparkSession.createDataFrame([(1, "new", "x", "v1", None), (2, "keep", "y", None, "true")],
                                             out.schema).collect()[i] for i in range(2)]))
