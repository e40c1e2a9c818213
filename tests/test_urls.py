from urllib.parse import unquote_plus

from pyspark.sql import functions as F

from rivulet.functions import urls as U
from rivulet.operators import urlops as O


def test_multimap_repeated_keys(spark):
    qs = "size=xl&hue=7&size=s&tag=q&tag=r&tag=q"
    df = spark.createDataFrame([(qs,)], "qs string")
    m = df.select(U.multimap(U.query_pairs("qs")).alias("m")).first().m
    assert m == {"hue": ["7"], "size": ["xl", "s"], "tag": ["q", "r", "q"]}


def test_decoded_name_and_value(spark):
    url = "http://shop.example/find?a%3Db=salt%26p%C3%A9pper"
    df = spark.createDataFrame([(1, url)], "id long, url string")
    out = O.url_params(df, "url").first()
    assert out.params == {"a=b": "salt&pépper"}
    assert out.url_failed is False


def test_bare_keys_first_and_all_values(spark):
    qs = "ab=1x&open&cd=3x&ab=4x&ab&note=good+%22day"
    df = spark.createDataFrame([(qs,)], "qs string")
    pairs = U.query_pairs("qs")
    r = df.select(U.first_value(pairs, "ab").alias("k1"), U.first_value(pairs, "open").alias("k2"),
                  U.first_value(pairs, "note").alias("k5"), U.first_value(pairs, "zz").alias("zz"),
                  U.all_values(pairs, "ab").alias("all_k1")).first()
    assert (r.k1, r.k2, r.k5, r.zz) == ("1x", "", 'good "day', None)
    assert r.all_k1 == ["1x", "4x", ""]


def test_last_duplicate_wins_with_prefix(spark):
    url = "http://shop.example/list?p=5&q=6&r=7&r=7b"
    df = spark.createDataFrame([(url,)], "url string")
    out = O.url_params(df, "url", prefix="p.", suffix=".s").first()
    assert out.params == {"p.p.s": "5", "p.q.s": "6", "p.r.s": "7b"}


def test_edge_urls(spark):
    rows = [(1, "http://x.org/a"), (2, "http://x.org/a?"), (3, "http://x.org/a?b=1#frag"),
            (4, "http://x.org/a?q=a+b"), (5, "http://x.org/a?q=%zz"), (6, "http://x .org/a?q=1"), (7, None)]
    df = spark.createDataFrame(rows, "id long, url string")
    out = {r.id: r for r in O.url_params(df, "url", if_empty="no_params").collect()}
    assert out[1].params == {"no_params": "true"} and not out[1].url_failed
    assert out[2].params == {"no_params": "true"}
    assert out[3].params == {"b": "1"}
    assert out[4].params == {"q": "a b"}
    assert out[5].url_failed and out[5].params is None
    assert out[6].url_failed
    assert out[7].url_failed is False


def test_rows_positions(spark):
    df = spark.createDataFrame([(1, "http://h/p?a=1&b&a=2=3")], "id long, url string")
    rows = O.url_param_rows(df, "url", ["id"]).orderBy("pos").collect()
    assert [(r.pos, r.key, r.value) for r in rows] == [(1, "a", "1"), (2, "b", ""), (3, "a", "2=3")]


def test_build_round_trip(spark):
    canonical = ["a=1&b=2", "k=hello+world&flag", "x=%C3%BC&y=1%2B1"]
    df = spark.createDataFrame([(q,) for q in canonical], "qs string")
    got = [r[0] for r in df.select(U.to_query_string(U.query_pairs("qs"))).collect()]
    assert got == canonical
    for q in canonical:  # brute force decode agrees with ours
        first = q.split("&")[0].split("=", 1)
        assert unquote_plus(first[0])


def test_build_rejects_null(spark):
    df = spark.createDataFrame([([("a", None)],)], "pairs array<struct<key:string,value:string>>")
    assert df.select(U.to_query_string(F.col("pairs"))).first()[0] is None


def test_stats(spark):
    rows = [(1, "http://h/?a=1&b=2"), (2, "http://h/?a=1&a=3"), (3, "http://h/x")]
    df = spark.createDataFrame(rows, "id long, url string")
    st = {r.key: r for r in O.url_param_stats(df, "url", "id").collect()}
    assert (st["a"].n_occurrences, st["a"].n_urls, st["a"].n_values) == (3, 2, 2)
    assert (st["b"].n_occurrences, st["b"].n_urls, st["b"].n_values) == (1, 1, 1)
