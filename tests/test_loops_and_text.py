"""Loops by rule, SELECTs over many tables, JSON that keeps its text, and
secrets that no plan shows."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from rivulet.functions.json import member_text
from rivulet.operators import jsonops as J
from rivulet.operators import routing as R
from rivulet.operators import scripts as S
from rivulet.operators import tokens as K
from rivulet.session import scratch_path
from test_plans import executed_plan


def test_loop_by_a_rule(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate([(12, 18), (0, 0), (7, 0), (None, 4), (4, None), (1071, 462), (5, -3)])]
    df = spark.createDataFrame(rows, "id int, a long, b long")
    rule = {"a": "b", "b": "a % b"}
    trace = R.loop_rounds(df, rule, "b > 0", "b = 0", 20).collect()
    for i, a, b in rows:
        want, step = [], 0
        while b is not None and b > 0:
            want.append((step, a, b, "loop"))
            a, b, step = b, None if a is None else a % b, step + 1
        want.append((step, a, b, "endloop" if b == 0 else "unmatched"))
        assert sorted((r.step, r.a, r.b, r.route) for r in trace if r.id == i) == want
    end = R.loop_rounds(df, rule, "b > 0", "b = 0", 20, trace=False).collect()
    assert sorted((r.id, r.step) for r in end) == sorted((i, max(r.step for r in trace if r.id == i)) for i, _, _ in rows)
    assert {r.id: r.a for r in end}[5] == math.gcd(1071, 462)


def test_loop_equals_the_plain_one_and_is_bounded(spark):
    df = spark.createDataFrame([(0, 10), (10, 10), (11, 10), (None, 10)], "loop_value int, loop_limit int")
    got = R.loop_rounds(df, {"loop_value": "loop_value + 1"}, "loop_value < loop_limit", "loop_value = loop_limit", 10)
    want = R.loop_trace(df, "loop_value", F.col("loop_limit")).select("loop_value", "loop_limit", "step", "route")
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        R.loop_rounds(df, {"loop_value": "loop_value + 1"}, "loop_value < loop_limit", "true", 9).collect()
    with pytest.raises(ValueError):
        R.loop_rounds(df, {"other": "1"}, "true", "true", 3)
    with pytest.raises(ValueError):
        R.loop_rounds(df.withColumn("step", F.lit(1)), {}, "true", "true", 3)
    assert R.loop_rounds(df.limit(0), {"loop_value": "0"}, "false", "true", 3).count() == 0


def test_a_thousand_tables_in_one_scan(spark):
    root = scratch_path(spark, "t many+tables")
    rows = spark.range(4000).select("id", (F.col("id") % 1000 + 1).cast("int").alias("part"), (F.col("id") % 7).alias("v"))
    rows.repartition("part").write.partitionBy("part").parquet(root)
    got = S.iterate_paths(spark, f"{root}/part=#{{iterate}}", 1000, lambda d: d.select("v", "i"))
    plan = executed_plan(got)
    assert plan.count("FileScan parquet") == 1
    assert {(r.v, r.i) for r in got.collect()} == {(k % 7, k % 1000 + 1) for k in range(4000)}
    values = S.iterate_paths(spark, f"{root}/part=#{{iterate}}", "1000", lambda d: d.select("v"))
    assert sorted(r.v for r in values.collect()) == list(range(7))          # UNION: distinct
    one = S.iterate_paths(spark, f"{root}/part=#{{iterate}}", 0, lambda d: d.select(F.lit(1), "i"))
    assert [tuple(r) for r in one.collect()] == [(1, 1)] * 4                 # a single SELECT: duplicates stay
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        S.iterate_paths(spark, f"{root}/part=#{{iterate}}", 1001, lambda d: d)
    for bad in (root, f"{root}/#{{iterate}}/#{{iterate}}"):
        with pytest.raises(ValueError):
            S.iterate_paths(spark, bad, 2, lambda d: d)


def test_select_texts_beyond_one_plan(spark, monkeypatch):
    monkeypatch.setattr(S, "SQL_COPIES", 3)
    got = S.iterate_sql(spark, "SELECT id % 5 AS v, #{iterate} % 4 AS i FROM range(10)", 8)
    assert sorted((r.v, r.i) for r in got.collect()) == [(v, i) for v in range(5) for i in range(4)]


CASES = ['{"a":1.00,"b":1e3,"c":123456789012345678901234567890.5,"d":1.0E400}', '"x"', '"\\u0041\\n\\"}{,:"', "1.50", "-0", "1E+2", "true", "null",
         "[1.0, {\"content\": 2.50}]", '{"x":1,"x":2.0}', "{}", "[]", '{"attribute":{"a":"1"}}', '""', '{"content":1,"attribute":{"k":"v"}}',
         '"' + "é" * 70_000 + '\\\\"']


def layouts(inner):
    yield '{"content":%s,"attribute":{"k":"v"}}' % inner
    yield '{"attribute":{"k":"v"},"content":%s}' % inner
    yield ' {\n "attribute" : {"k":"v", "k":"v"} , "other":{"content":"no"},"content" :\t%s , "last":[1,{"content":0}] } ' % inner
    yield '{"content":0,"attribute":{"k":"v"},"content":%s}' % inner
    yield '{"cont\\u0065nt":%s,"attribute":{"k":"v"}}' % inner
    yield '{"content": %s ,"attribute":{"k":"v"}}' % inner


def test_json_keeps_its_text(spark):
    texts = [(inner, env) for inner in CASES for env in layouts(inner)]
    for inner, env in texts:
        assert member_text(env, "content") == inner
    rows = [(i, env, {"own": "1"}, inner) for i, (inner, env) in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, content string, attributes map<string,string>, want string")
    for r in J.unpack_envelope(df).collect():
        assert r.content == r.want and r.attributes == {"own": "1", "k": "v"}, r
    plain = spark.createDataFrame([(i, c, a, c) for i, c in enumerate(CASES) for a in ({"k": "v"}, {})], "id int, content string, attributes map<string,string>, want string")
    packed = J.pack_envelope(plain.withColumn("content", F.concat(F.lit(" \n"), "content", F.lit("\t"))))
    for r in packed.collect():
        assert r.content_valid and r.content == '{"content":%s%s}' % (r.want, ',"attribute":{"k":"v"}' if r.attributes else "")
    for r in J.unpack_envelope(packed).collect():
        assert r.content == r.want


def test_envelopes_without_content(spark):
    rows = ['{"attribute":{"k":"v"}}', "{}", "not json", "[1]", "", None]
    df = spark.createDataFrame([(i, c, {}) for i, c in enumerate(rows)], "id int, content string, attributes map<string,string>")
    got = {r.id: r for r in J.unpack_envelope(df).collect()}
    assert [got[i].content for i in range(6)] == ["", "", "", "", "", None]
    assert got[0].attributes == {"k": "v"} and got[4].attributes == {J.NO_ATTRIBUTE: "true"}


def test_member_text_against_a_parser():
    rng = random.Random(6)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind < 5:
            return [1.5, "a\"\\b{}[],:", None, True, -3][kind]
        return [value(depth - 1) for _ in range(rng.randrange(4))] if kind == 5 else {rng.choice("abc"): value(depth - 1) for _ in range(rng.randrange(4))}

    for _ in range(300):
        obj = {k: value(3) for k in rng.sample("abcde", 3)}
        text = json.dumps(obj, indent=rng.choice([None, 1]))
        for k in "abcde":
            got = member_text(text, k)
            assert (got is None) == (k not in obj) and (got is None or json.loads(got) == obj[k])


def test_no_plan_shows_the_secret(spark):
    secret = "hush, hush"
    df = spark.createDataFrame([(1, "x")], "id int, v string")
    signed = K.sign_rows(df, ["id", "v"], secret, "HS512")
    audited = K.audit_tokens(signed, "authorization", secret, 5)
    assert audited.first().token_valid
    for frame in (signed, audited):
        ex = frame._jdf.queryExecution()
        said = (ex.toString() + ex.logical().toJSON() + ex.optimizedPlan().toJSON() + ex.executedPlan().toString()).lower()
        for pad in (0, 0x36, 0x5C):
            key = bytes(b ^ pad for b in secret.encode())
            assert key.hex() not in said and key.decode("latin-1").lower() not in said
            assert ", ".join(str(b) for b in key) not in said
