"""O13/O14 by range alone: every interval and value against a double loop, and
the plan."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import enrich as en
from test_plans import executed_plan, no_broadcast  # noqa: F401


def brute(values, spans, closed=False):
    out = []
    for i, v in values:
        hits = [j for j, a, b in spans if v is not None and a is not None and b is not None and a <= v and (v <= b if closed else v < b)]
        out += [(i, str(j)) for j in hits] or [(i, None)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.id, r.j) for r in df.collect()), key=str)


def frames(spark, values, spans, kind):
    return (spark.createDataFrame(values, f"id int, x {kind}").repartition(4),
            spark.createDataFrame(spans, f"j int, lo {kind}, hi {kind}").repartition(3))


def odd_numbers():
    rng = random.Random(2)
    tiny, inf = 5e-324, math.inf
    points = [0.0, -0.0, tiny, -tiny, 1e300, -1e300, 1.5, 2.0, inf, -inf, None] + [rng.uniform(-100, 100) for _ in range(150)]
    points += [float(2 ** k) for k in range(-4, 60, 7)] + [x for x in points[-30:]]
    ends = [p for p in points if p is not None]
    spans = [(j, *sorted(rng.sample(ends, 2))) for j in range(200)]
    spans += [(200 + j, x, x + rng.choice([1e-9, 0.5, 1, 3, 1e6, 0])) for j, x in enumerate(ends)]
    spans += [(900, None, 5.0), (901, 5.0, None), (902, 7.0, -7.0), (903, -inf, inf), (904, 1e300, inf)]
    return list(enumerate(points)), spans


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("hot", [5, 100_000])
def test_numbers(spark, closed, hot):
    values, spans = odd_numbers()
    df, look = frames(spark, values, spans, "double")
    got = en.enrich_between(df, look, "x", "lo", "hi", closed=closed, empty_marker="none", hot_rows=hot)
    assert rows(got) == brute(values, spans, closed)
    assert got.where("(none = 'true') <> (j is null)").isEmpty()
    inner = en.enrich_between(df, look, "x", "lo", "hi", closed=closed, how="inner", hot_rows=hot)
    assert rows(inner) == [r for r in brute(values, spans, closed) if r[1] is not None]


@pytest.mark.parametrize("kind, make", [
    ("long", lambda n: n - 2 ** 62), ("long", lambda n: n), ("int", lambda n: n),
    ("date", lambda n: datetime.date(1999, 12, 1) + datetime.timedelta(n)),
    ("timestamp", lambda n: datetime.datetime(1969, 12, 31) + datetime.timedelta(seconds=n * 977, microseconds=n)),
    ("decimal(30,10)", lambda n: __import__("decimal").Decimal(n) / 7)])
def test_other_types(spark, kind, make):
    rng = random.Random(4)
    make_ = (lambda n: round(make(n), 10)) if kind.startswith("decimal") else make
    values = [(i, make_(rng.randrange(400))) for i in range(120)] + [(999, None)]
    spans = [(j, make_(a := rng.randrange(400)), make_(a + rng.choice([0, 1, 2, 50, 390]))) for j in range(150)]
    df, look = frames(spark, values, spans, kind)
    assert rows(en.enrich_between(df, look, "x", "lo", "hi")) == brute(values, spans)


def test_with_keys_case_and_overwriting(spark):
    df = spark.createDataFrame([(1, "a", 5, "own"), (2, "b", 5, "own"), (3, None, 5, "own")], "id int, k string, x int, note string")
    look = spark.createDataFrame([("a", 0, 9, "found"), ("b", 6, 9, "not"), (None, 0, 9, "null key")], "k string, lo int, hi int, note string")
    got = en.enrich_between(df, look, "x", "lo", "hi", on="k", empty_marker="none")
    assert {(r.id, r.lo, r.hi, r.note, r.none) for r in got.collect()} == {(1, "0", "9", "found", None), (2, None, None, "own", "true"),
                                                                          (3, None, None, "own", "true")}
    with pytest.raises(ValueError):
        en.enrich_between(df, look.withColumn("x", F.lit(1)), "x", "lo", "hi")
    with pytest.raises(ValueError):
        en.enrich_between(df, look, "note", "lo", "hi")


def test_empty_sides(spark):
    df, look = frames(spark, [(1, 2.0), (2, None)], [(1, 1.0, 3.0)], "double")
    assert rows(en.enrich_between(df, look.limit(0), "x", "lo", "hi")) == [(1, None), (2, None)]
    assert en.enrich_between(df.limit(0), look, "x", "lo", "hi").count() == 0


def test_plan_is_a_keyed_join(spark, no_broadcast):  # noqa: F811
    n = 30_000   # a third of the values and of the intervals are alike
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise(F.col("id") / 10).alias("x"))
    look = spark.range(600).select(F.col("id").alias("j"), F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id") * 5.0).alias("lo"))
    look = look.withColumn("hi", F.col("lo") + 1)
    got = en.enrich_between(df, look, "x", "lo", "hi", how="inner", hot_rows=50).groupBy().count()
    plan = executed_plan(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Window" not in plan
    want = df.hint("broadcast").join(look, (F.col("lo") <= F.col("x")) & (F.col("x") < F.col("hi"))).count()
    assert got.first()[0] == want


def test_what_is_found_is_not_shuffled(spark):
    """Every value lies in every interval: the rows that meet are out of the last
    join, with no exchange above it. Columns that cannot be hashed go along."""
    df = spark.range(300).select("id", (F.col("id") % 7 + 0.5).alias("x"), F.create_map(F.lit("a"), F.lit("b")).alias("attributes"))
    look = spark.range(200).select(F.col("id").alias("j"), (F.col("id") / 1000).alias("lo"), (F.col("id") / 1000 + 9).alias("hi"))
    got = en.enrich_between(df, look, "x", "lo", "hi", hot_rows=50)
    assert len(got.collect()) == 300 * 200
    lines = got._jdf.queryExecution().executedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "_lo" in line)
    assert not any("Exchange" in line for line in lines[:join])
