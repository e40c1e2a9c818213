import json

from pyspark.sql import functions as F

from rivulet.functions.json import map_json
from rivulet.operators import jsonops as J

REC = "record_id long, content string, attributes map<string,string>"


def test_envelope_round_trip(spark):
    rows = [
        (1, '{"a": 1, "b": {"c": [1, 2]}}', {"x": "1", "y": "ü"}),
        (2, '[1, "two"]', {"x": "2"}),
        (3, '"just text"', {}),
        (4, "", {"x": "4"}),
        (5, None, {"x": "5"}),
        (6, "{bad json", {"x": "6"}),
    ]
    df = spark.createDataFrame(rows, REC)
    packed = J.pack_envelope(df)
    p = {r.record_id: r for r in packed.collect()}
    assert json.loads(p[1].content) == {"content": {"a": 1, "b": {"c": [1, 2]}}, "attribute": {"x": "1", "y": "ü"}}
    assert list(json.loads(p[1].content)) == ["content", "attribute"]
    assert json.loads(p[3].content) == {"content": "just text"}
    assert json.loads(p[4].content) == {"attribute": {"x": "4"}} and p[4].attributes["no.attribute"] == "true"
    assert "no.attribute" not in json.loads(p[4].content)["attribute"]
    assert p[6].content_valid is False and p[6].content == '{bad json'
    back = {r.record_id: r for r in J.unpack_envelope(packed.filter("content_valid").drop("content_valid")).collect()}
    assert json.loads(back[1].content) == {"a": 1, "b": {"c": [1, 2]}}
    assert back[1].content == '{"a": 1, "b": {"c": [1, 2]}}'  # its text is kept
    assert json.loads(back[2].content) == [1, "two"]
    assert back[3].content == '"just text"'
    assert back[1].attributes == {"x": "1", "y": "ü"}


def test_unpack_envelope_attributes_win(spark):
    env = '{"content":{"k":1},"attribute":{"a":"new","b":"2"}}'
    df = spark.createDataFrame([(1, env, {"a": "old", "c": "3"}), (2, "", {"a": "x"})], REC)
    r = {x.record_id: x for x in J.unpack_envelope(df).collect()}
    assert r[1].attributes == {"a": "new", "b": "2", "c": "3"} and r[1].content == '{"k":1}'
    assert r[2].attributes == {"a": "x", "no.attribute": "true"}


def test_json_to_attributes(spark):
    rows = [
        (1, '{"Name": "ann", "AGE": 3, "ok": true, "nested": {"z": 1}}', {"keep": "1"}),
        (2, "{}", {}),
        (3, "", {"keep": "3"}),
        (4, "not json", {}),
        (5, '{"Key": "a", "KEY": "b"}', {}),
    ]
    df = spark.createDataFrame(rows, REC)
    low = {r.record_id: r for r in J.json_to_attributes(df, case="lower").collect()}
    assert low[1].attributes == {"keep": "1", "name": "ann", "age": "3", "ok": "true", "nested": '{"z":1}'}
    assert low[2].attributes == {"json.empty": "{}"}
    assert low[3].attributes == {"keep": "3"} and low[3].content_valid
    assert low[4].content_valid is False and low[4].attributes == {}
    assert low[5].attributes == {"key": "b"}
    dflt = {r.record_id: r for r in J.json_to_attributes(df).collect()}
    assert dflt[5].attributes == {"Key": "a", "KEY": "b"}


def test_content_to_attribute(spark):
    df = spark.createDataFrame([(1, "abc", {}), (2, "", {"z": "1"})], REC)
    r = {x.record_id: x for x in J.content_to_attribute(df, "body", if_empty="EMPTY").collect()}
    assert r[1].attributes == {"body": "abc"} and r[2].attributes == {"z": "1", "body": "EMPTY"}


def test_attributes_to_json(spark):
    attrs = {"a": "1", "b": "", "filename": "f.txt", "uuid": "u", "z": "9"}
    df = spark.createDataFrame([(1, "payload", attrs)], REC)
    listed = J.attributes_to_json(df, " a, b ,missing, filename", destination="attribute").first()
    assert json.loads(listed.attributes["JSONAttributes"]) == {"a": "1", "b": "", "missing": ""}
    nulls = J.attributes_to_json(df, "a,missing", destination="attribute", null_for_missing=True).first()
    assert json.loads(nulls.attributes["JSONAttributes"]) == {"a": "1", "missing": None}
    allj = J.attributes_to_json(df, None, include_content=True).first()
    assert json.loads(allj.content) == {"a": "1", "b": "", "z": "9", "flowfile-content": "payload"}
    assert allj.attributes["mime.type"] == "application/json"
    core = J.attributes_to_json(df, None, include_core=True).first()
    assert "filename" in json.loads(core.content)


def test_nest_attributes_tree(spark):
    attrs = {"order.buyer.name": "Ann", "order.buyer.family": "Lee",
             "order.buyer.place.name": "Main", "order.buyer.place.number": "10",
             "order.buyer.place.zip": "123", "other": "x"}
    names = ["order.buyer.name", "order.buyer.family", "order.buyer.place.name",
             "order.buyer.place.number", "order.buyer.place.zip"]
    df = spark.createDataFrame([(1, None, attrs), (2, "keep", {"other": "y"})], REC)
    r = {x.record_id: x for x in J.nest_attributes(df, "order", names).collect()}
    assert json.loads(r[1].content) == {"order": {"buyer": {"name": "Ann", "family": "Lee", "place": {
        "name": "Main", "number": "10", "zip": "123"}}}}
    assert r[2].content == "keep" and r[2].attributes["no.attribute"] == "no.attribute"
    # names without the root prefix give the same tree; partial groups vanish
    short = [n[len("order."):] for n in names]
    attrs2 = {k[len("order."):]: v for k, v in attrs.items() if k.startswith("order.")}
    del attrs2["buyer.place.name"], attrs2["buyer.place.number"], attrs2["buyer.place.zip"]
    df2 = spark.createDataFrame([(1, None, attrs2)], REC)
    got = json.loads(J.nest_attributes(df2, "order", short).first().content)
    assert got == {"order": {"buyer": {"name": "Ann", "family": "Lee"}}}


def test_map_json_sorted(spark):
    df = spark.createDataFrame([({"b": "1", "a": "2"},)], "m map<string,string>")
    assert df.select(map_json("m")).first()[0] == '{"a":"2","b":"1"}'
    assert df.select(F.lit(1)).count() == 1


def test_nest_group_wins_over_leaf_in_either_order(spark):
    attrs = {"u.a": "leaf", "u.a.b": "deep", "u.c": "x"}
    df = spark.createDataFrame([(1, None, attrs)], REC)
    for names in (["u.a", "u.a.b", "u.c"], ["u.a.b", "u.a", "u.c"]):
        got = json.loads(J.nest_attributes(df, "root", names).first().content)
        assert got == {"root": {"u": {"a": {"b": "deep"}, "c": "x"}}}, names
    # segments equal to the root are skipped anywhere; siblings match case-insensitively
    df2 = spark.createDataFrame([(1, None, {"root.P.name": "n", "p.root.age": "3"})], REC)
    got = json.loads(J.nest_attributes(df2, "root", ["root.P.name", "p.root.age"]).first().content)
    assert got == {"root": {"P": {"name": "n", "age": "3"}}}
