import time

import pytest

from rivulet.sinks.atomic import atomic_append
from rivulet.session import scratch_path
from rivulet.sources.tables import register_views, run_statement, run_with_timeout, select_rows


def test_select_rows_binds_parameters(spark, sf_small):
    register_views(spark, sf_small, ["orders"])
    df = select_rows(spark, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = :s", {"s": "F"})
    assert dict(df.dtypes) == {"o_orderkey": "string", "o_totalprice": "string"}
    sneaky = select_rows(spark, "SELECT count(*) AS n FROM orders WHERE o_orderstatus = :s",
                         {"s": "F' OR '1'='1"})
    assert sneaky.first().n == "0"  # the value is bound, never spliced into the text


def test_failed_statement_becomes_a_failure_record(spark, sf_small):
    register_views(spark, sf_small, ["orders"])
    ok, err = run_statement(spark, "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
    assert err is None and ok.count() > 0
    bad, err = run_statement(spark, "SELECT no_such_column FROM orders WHERE o_orderstatus = 'F'")
    assert bad is None
    assert err["error_code"].startswith("SqlErrCod[") and err["error_code"].endswith("] ")
    assert err["error_message"] == 'SELECT no_such_column FROM orders WHERE o_orderstatus = "F"'


def test_timeout_cancels_the_job(spark):
    big = spark.range(0, 10**12, numPartitions=8)
    t0 = time.time()
    with pytest.raises(Exception):
        run_with_timeout(spark, lambda: big.selectExpr("sum(id * id) AS s").collect(), 2)
    assert time.time() - t0 < 60
    assert run_with_timeout(spark, lambda: spark.range(10).count(), 30) == 10


def test_first_target_required(spark):
    res = atomic_append(spark, {"a": None, "b": spark.range(1)}, scratch_path(spark, "t_req"), 1)
    assert not res["success"] and res["error_code"] == "SqlErrCod[ValueError] "
