from pyspark.sql import functions as F

from rivulet.operators import sequences as Q


def brute(rows, counters):
    out, seen = {}, {}
    for key, order, rid in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        seen[key] = seen.get(key, counters.get(key, 0) or 0) + 1
        out[rid] = seen[key]
    return out


def test_hot_key_ids_gap_free_in_order(spark):
    rows = []
    rid = 0
    for i in range(3000):  # one key holds about a third of all rows
        rid += 1
        rows.append(("hot" if i % 3 == 0 else f"k{i % 97}", (i * 7919) % 10007, rid))
    df = spark.createDataFrame(rows, "store string, ts long, rid long")
    counters = spark.createDataFrame([("hot", 100), ("k1", 0), ("k2", None)], "store string, counter long")
    got = {r.rid: r.next_id for r in Q.next_ids(df, "store", ["ts", "rid"], counters, partitions=16).collect()}
    assert got == brute(rows, {"hot": 100, "k1": 0, "k2": None})


def test_batches_continue_counters(spark):
    b1 = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "store string, ts long")
    b2 = spark.createDataFrame([("a", 3), ("c", 1)], "store string, ts long")
    ids1, c1 = Q.allocate(b1, "store", "ts")
    ids2, c2 = Q.allocate(b2, "store", "ts", counters=c1)
    assert sorted((r.store, r.next_id) for r in ids1.collect()) == [("a", 1), ("a", 2), ("b", 1)]
    assert sorted((r.store, r.next_id) for r in ids2.collect()) == [("a", 3), ("c", 1)]
    assert sorted(tuple(r) for r in c2.collect()) == [("a", 3), ("b", 1), ("c", 1)]
    assert b1.select(F.lit(1)).count() == 3
