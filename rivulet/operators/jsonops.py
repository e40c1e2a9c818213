"""Records ↔ JSON. All per-row expressions (``to_json``, ``from_json``,
map higher-order functions); the nested layout of O26 is decided at plan time from
the list of names. JSON that is passed through keeps its text: Spark's readers
print numbers anew (``1.00`` as ``1.0``, ``1e400`` as ``"Infinity"``), so content is
embedded and cut out as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.json import is_json, json_member_text, map_json
from rivulet.functions.text import col_of
from rivulet.operators.records import MAP_TYPE, last_win, put_attribute, put_attributes, staged

# Fixed values that must equal the reference's: the record host's core
# attribute names, and the default names used by the JSON operators.
CORE_ATTRIBUTES = ("path", "absolute.path", "filename", "uuid", "priority", "mime.type",
                   "discard.reason", "alternate.identifier")
CONTENT_KEY = "flowfile-content"
JSON_ATTRIBUTE = "JSONAttributes"
MIME_TYPE = "mime.type"
APPLICATION_JSON = "application/json"
NO_ATTRIBUTE = "no.attribute"
JSON_EMPTY = "json.empty"
ENVELOPE_SCHEMA = "struct<content:string,attribute:map<string,string>>"


def _nonempty(c: Column) -> Column:
    return F.coalesce(F.octet_length(c) > 0, F.lit(False))


def attributes_to_json(df: DataFrame, names: str | Sequence[str] | None = None, include_content: bool = False,
                       content_name: str | None = None, destination: str = "content",
                       include_core: bool = False, null_for_missing: bool = False,
                       attributes: str = "attributes", content: str = "content",
                       core: Sequence[str] = CORE_ATTRIBUTES) -> DataFrame:
    """O21. With ``names`` (comma-separated or a list; trimmed) every listed
    name appears, a missing one as ``""`` (or null); core names are dropped
    unless ``include_core``. Without ``names``, all attributes but the core
    set, in key order. Non-empty content is added under ``content_name``.
    Output to ``content`` (plus ``mime.type``) or to attribute
    ``JSONAttributes``."""
    df = last_win(df)
    attrs = F.col(attributes)
    removed = () if include_core else tuple(core)
    if names is not None and (not isinstance(names, str) or names.strip()):
        listed = [n.strip() for n in (names.split(",") if isinstance(names, str) else names)]
        listed = list(dict.fromkeys(n for n in listed if n and n not in removed))
        flat = []
        for n in listed:
            v = F.element_at(attrs, F.lit(n))
            flat += [F.lit(n), v if null_for_missing else F.coalesce(v, F.lit(""))]
        m = F.create_map(*flat) if flat else F.create_map().cast(MAP_TYPE)
        sort_keys = False
    else:
        m = F.map_filter(attrs, lambda k, v: ~k.isin(*removed)) if removed else attrs
        sort_keys = True
    if include_content:
        key = content_name or CONTENT_KEY
        c = F.col(content)
        m = F.when(_nonempty(c), put_attribute(m, key, c)).otherwise(m)
    text = map_json(m, sort_keys=sort_keys)
    if destination == "content":
        return df.withColumns({content: text, attributes: put_attribute(attrs, MIME_TYPE, F.lit(APPLICATION_JSON))})
    if destination == "attribute":
        return df.withColumn(attributes, put_attribute(attrs, JSON_ATTRIBUTE, text))
    raise ValueError("destination must be 'content' or 'attribute'")


JSON_SPACE = " \t\n\r"


def json_text(c: Column | str) -> Column:
    """The text of one JSON value without outer white space; null when the text
    is not JSON."""
    c = col_of(c)
    return F.when(is_json(c), F.btrim(c, F.lit(JSON_SPACE)))


def pack_envelope(df: DataFrame, content: str = "content", attributes: str = "attributes",
                  marker: str = NO_ATTRIBUTE, valid_col: str | None = "content_valid") -> DataFrame:
    """Content ← ``{"content": <content JSON>, "attribute": {...}}``.

    Empty content → no ``content`` member, and attribute ``marker`` = true on
    the record (not inside the envelope). Empty attributes → no
    ``attribute`` member. Content keeps its text (but outer white space);
    content that is not JSON is flagged in ``valid_col`` (false) and stays as it
    is.
    """
    df = last_win(df)
    c, a = F.col(content), F.col(attributes)
    has_c = _nonempty(c)
    df, inner = staged(df, "_inner", json_text(c))
    has_a = F.coalesce(F.size(a) > 0, F.lit(False))
    members = F.concat_ws(",",
                          F.when(has_c, F.concat(F.lit('"content":'), inner)),
                          F.when(has_a, F.concat(F.lit('"attribute":'), F.to_json(a))))
    env = F.concat(F.lit("{"), members, F.lit("}"))
    ok = ~has_c | inner.isNotNull()
    cols = {
        content: F.when(ok, env).otherwise(c),
        attributes: F.when(has_c, a).otherwise(put_attribute(a, marker, F.lit("true"))),
    }
    if valid_col:
        cols[valid_col] = ok
    return df.withColumns(cols).drop("_inner")


def unpack_envelope(df: DataFrame, content: str = "content", attributes: str = "attributes",
                    marker: str = NO_ATTRIBUTE) -> DataFrame:
    """The envelope's attributes are merged over the record's (envelope
    wins); content becomes the inner JSON, its text unchanged (an envelope
    without a content member gives empty content). Empty content → marker.

    An envelope as ``pack_envelope`` makes it is cut by string functions; any
    other layout goes through a scanner in Arrow batches."""
    df = last_win(df)
    c, a = F.col(content), F.col(attributes)
    has_c = _nonempty(c)
    df, env = staged(df, "_env", F.when(has_c, F.from_json(c, ENVELOPE_SCHEMA)))
    df, keys = staged(df, "_keys", F.when(has_c, F.json_object_keys(c)))
    # as packed: content first, then the attributes as to_json prints them
    head, tail = F.lit('{"content":'), F.concat(F.lit(',"attribute":'), F.to_json(env["attribute"]), F.lit("}"))
    tail = F.when(F.size(keys) == 1, F.lit("}")).otherwise(tail)
    packed = F.coalesce(F.startswith(c, head) & F.endswith(c, tail) & (F.size(keys) <= 2)
                        & ((F.size(keys) == 1) | (F.get(keys, 1) == "attribute")), F.lit(False))
    n = F.length(head)
    cut = F.btrim(F.substring(c, n + 1, F.length(c) - n - F.length(tail)), F.lit(JSON_SPACE))
    there = F.array_contains(keys, F.lit("content"))
    df, scanned = staged(df, "_scanned", json_member_text(F.when(there & ~packed, c), "content"))
    inner = F.coalesce(F.when(packed, cut), scanned, F.lit(""))
    env_attrs = env["attribute"]
    out = df.withColumns({
        content: F.when(has_c, inner).otherwise(c),
        attributes: F.when(has_c, put_attributes(a, env_attrs)).otherwise(put_attribute(a, marker, F.lit("true"))),
    })
    return out.drop("_env", "_keys", "_scanned")


def content_to_attribute(df: DataFrame, name: str, if_empty: str | None = None, content: str = "content",
                         attributes: str = "attributes") -> DataFrame:
    """Content becomes attribute ``name``; empty content gives
    ``if_empty`` instead."""
    df = last_win(df)
    c = F.col(content)
    val = F.when(_nonempty(c), c).otherwise(F.lit(if_empty))
    return df.withColumn(attributes, F.when(val.isNotNull(), put_attribute(F.col(attributes), name, val))
                         .otherwise(F.col(attributes)))


def json_to_attributes(df: DataFrame, case: str = "default", empty_marker: str = JSON_EMPTY,
                       content: str = "content", attributes: str = "attributes",
                       valid_col: str | None = "content_valid") -> DataFrame:
    """A flat JSON object's members become attributes (names kept,
    lower- or upper-cased; numbers and booleans as text, nested values as
    JSON text). ``{}`` → attribute ``empty_marker`` holding the content;
    zero-length content → nothing; text that is not a JSON object is flagged
    in ``valid_col`` and adds nothing."""
    if case not in ("default", "lower", "upper"):
        raise ValueError("case must be default, lower or upper")
    df = last_win(df)
    c = F.col(content)
    df, parsed = staged(df, "_parsed", F.when(_nonempty(c), F.from_json(c, MAP_TYPE)))
    ok = ~_nonempty(c) | parsed.isNotNull()
    named = parsed
    if case != "default":
        f = F.lower if case == "lower" else F.upper
        named = F.map_from_arrays(F.transform(F.map_keys(parsed), f), F.map_values(parsed))
    new = F.when(F.size(parsed) > 0, named).when(parsed.isNotNull(), F.create_map(F.lit(empty_marker), c))
    cols = {attributes: put_attributes(F.col(attributes), new)}
    if valid_col:
        cols[valid_col] = ok
    return df.withColumns(cols).drop("_parsed")


# ---------------------------------------------------------------- O26

def _name_tree(root: str, names: Sequence[str]) -> dict:
    """Dotted names → nested dict {segment: subtree | full_name}. Segments
    equal to ``root`` (any case) are skipped; siblings match case-
    insensitively (first spelling kept); a name that is both a leaf and a
    group stays a group."""
    tree: dict = {}
    for full in names:
        segs = [s for s in full.split(".") if s.lower() != root.lower()]
        if not segs:
            continue
        node = tree
        for i, s in enumerate(segs):
            key = next((k for k in node if k.lower() == s.lower()), s)
            last = i == len(segs) - 1
            if last:
                if key not in node:
                    node[key] = full
            else:
                if not isinstance(node.get(key), dict):
                    node[key] = {}
                node = node[key]
    return tree


def _tree_struct(tree: dict, attrs: Column) -> Column:
    fields, leaves = [], []
    for k, sub in tree.items():
        if isinstance(sub, dict):
            col = _tree_struct(sub, attrs)
        else:
            col = F.element_at(attrs, F.lit(sub))
        leaves.append(col)
        fields.append(col.alias(k))
    present = F.lit(False)
    for c in leaves:
        present = present | c.isNotNull()
    return F.when(present, F.struct(*fields))


def nest_attributes(df: DataFrame, root: str, names: Sequence[str], attributes: str = "attributes",
                    content: str = "content", no_attribute: str = NO_ATTRIBUTE) -> DataFrame:
    """Selected dotted attributes → nested JSON under ``root``; leaf
    values are strings; groups with no present leaf are left out. A record
    with none of the names keeps its content and gets attribute
    ``no_attribute`` (= its own name)."""
    df = last_win(df)
    tree = _name_tree(root, names)
    body = _tree_struct(tree, F.col(attributes)) if tree else F.lit(None)
    text = F.to_json(F.struct(body.alias(root)))
    found = body.isNotNull()
    return df.withColumns({
        content: F.when(found, text).otherwise(F.col(content)),
        attributes: F.when(found, F.col(attributes)).otherwise(
            put_attribute(F.col(attributes), no_attribute, F.lit(no_attribute))),
    })
