"""The plan shapes the scale design relies on (executed plans, via explain)."""

import contextlib
import io

import pytest

import __spark_entry__ as se


def executed_plan(df) -> str:
    df.collect()  # the frame's own execution, so explain shows the final adaptive plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_chained_lookups_read_the_records_once(spark, sf_small, no_broadcast):
    from pyspark.sql import functions as F

    from rivulet.operators import enrich as en

    out = spark.read.parquet(f"{sf_small}/customer.parquet").select("c_custkey", "c_name")
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    for i in range(4):
        look = orders.where(F.col("o_orderkey") % 4 == i).groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias(f"n{i}"))
        out = en.enrich(out, look, "c_custkey", empty_marker=f"none{i}")
    plan = executed_plan(out)
    assert plan.count("FileScan parquet") == 5


def test_next_ids_shuffles_the_rows_once(spark, sf_small, no_broadcast):
    from rivulet.operators import sequences as Q

    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    seen = []
    real, Q.materialize = Q.materialize, lambda df, name: (seen.append(executed_plan(df)), real(df, name))[1]
    try:
        out = Q.next_ids(orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    finally:
        Q.materialize = real
    assert seen[0].count("Exchange rangepartitioning") == 1 and "Window" not in seen[0]
    plan = executed_plan(out)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("name", ["url_params_pages", "url_param_multimap_pages", "json_to_attributes_events",
                                  "pack_envelope_events", "sign_customers", "split_lines_documents",
                                  "route_lineitem", "documents_customer"])
def test_row_operators_do_not_shuffle(spark, sf_small, name):
    plan = executed_plan(se.queries()[name](spark, sf_small))
    assert "Exchange" not in plan


def test_scans_are_pruned(spark, sf_small):
    plan = executed_plan(se.queries()["route_lineitem"](spark, sf_small))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in plan


def test_enrich_hot_key_is_split_by_aqe(spark):
    from pyspark.sql import functions as F

    from rivulet.operators import enrich as en

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    old = {k: spark.conf.get(k, None) for k in keys}
    # small thresholds stand in for cluster-sized partitions
    for k, v in zip(keys, ["-1", "-1", "64k", "2", "64k", "false", "16"]):
        spark.conf.set(k, v)
    try:
        n = 300_000  # key 0 holds a third of the records and a third of the lookup rows
        recs = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
        look = spark.range(30).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") * 11).alias("k"),
                                      F.col("id").alias("v"))
        out = en.enrich(recs, look, "k", empty_marker="none")
        agg = out.groupBy(F.col("none").isNull().alias("hit")).count()
        got = {r.hit: r["count"] for r in agg.collect()}
        hot = (n // 3) * 10                      # 100,000 records x 10 lookup rows
        others = sum(1 for i in range(1, 30) if i % 3 and (11 * i) % 3 and 11 * i < n)
        assert got == {True: hot + others, False: n - n // 3 - others}
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            agg.explain()
        plan = buf.getvalue().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
