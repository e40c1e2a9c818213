"""SURVEY §5 properties: unpack(pack(x)) = x; build(parse(q)) = q for a
canonical q; generated documents validate; ids are 1..n per key, no gaps,
over several batches. Each hypothesis example is one DataFrame of many
generated cases, so a handful of Spark jobs cover hundreds of inputs."""

import json
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rivulet.functions import urls as U
from rivulet.operators import jsonops as J
from rivulet.operators import sequences as Q

SETTINGS = dict(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12)
json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**6, 10**6) | text,
    lambda kids: st.lists(kids, max_size=3) | st.dictionaries(text, kids, max_size=3), max_leaves=8)


@settings(**SETTINGS)
@given(st.lists(st.tuples(json_values, st.dictionaries(text, text, max_size=4)), min_size=1, max_size=40))
def test_unpack_pack_is_identity(spark, cases):
    rows = [(i, json.dumps(v), a) for i, (v, a) in enumerate(cases)]
    df = spark.createDataFrame(rows, "record_id long, content string, attributes map<string,string>")
    back = J.unpack_envelope(J.pack_envelope(df, valid_col=None)).collect()
    for r in back:
        v, a = cases[r.record_id]
        assert json.loads(r.content) == v
        assert r.attributes == a


def form_encode(text: str) -> str:
    """Canonical form encoding: letters, digits and . - * _ kept, space as +,
    every other UTF-8 byte as %XX."""
    out = []
    for b in text.encode("utf-8"):
        c = chr(b)
        if c.isascii() and (c.isalnum() or c in ".-*_"):
            out.append(c)
        elif c == " ":
            out.append("+")
        else:
            out.append(f"%{b:02X}")
    return "".join(out)


token = st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cc")), min_size=1, max_size=8)


@settings(**SETTINGS)
@given(st.lists(st.lists(st.tuples(token, st.one_of(st.just(""), token)), min_size=1, max_size=5),
                min_size=1, max_size=40))
def test_build_parse_round_trip(spark, queries):
    canon = ["&".join(form_encode(k) + ("" if v == "" else "=" + form_encode(v)) for k, v in q) for q in queries]
    df = spark.createDataFrame([(q,) for q in canon], "qs string")
    got = [r[0] for r in df.select(U.to_query_string(U.query_pairs("qs"))).collect()]
    assert got == canon


@settings(**SETTINGS)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "hot", "hot", "hot"]), min_size=1, max_size=60),
                min_size=1, max_size=3))
def test_ids_gap_free_over_batches(spark, batches):
    counters, seen, ts = None, {}, 0
    for keys in batches:
        rows = []
        for k in keys:
            ts += 1
            rows.append((k, ts))
        df = spark.createDataFrame(rows, "store string, ts long")
        ids, counters = Q.allocate(df, "store", "ts", counters)
        for r in ids.collect():
            seen.setdefault(r.store, []).append((r.ts, r.next_id))
    for k, pairs in seen.items():
        pairs.sort()
        assert [i for _, i in pairs] == list(range(1, len(pairs) + 1)), k
