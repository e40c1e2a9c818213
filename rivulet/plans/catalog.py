"""Registered queries over the driver's tables, and their DuckDB twins.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Output columns are text, INT/BIGINT or BOOLEAN (no floating point),
named identically in the Spark plan and in the SQL. Queries that publish
through a sink (atomic append, streams) write under the session's
``spark.checkpoint.dir`` and return the committed data read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import taxid as T
from rivulet.functions.json import map_json, row_json
from rivulet.operators import documents as D
from rivulet.operators import enrich as en
from rivulet.operators import jsonops as J
from rivulet.operators import lines as L
from rivulet.operators import routing as R
from rivulet.operators import scripts as S
from rivulet.operators import sequences as Q
from rivulet.operators import tokens as K
from rivulet.operators import urlops as U
from rivulet.operators.records import put_attributes, to_records
from rivulet.plans import sqltext as X
from rivulet.plans.compose import compose
from rivulet.session import apply_runtime_conf, scratch_path
from rivulet.sinks.atomic import append_lines, append_routes, atomic_append, read_committed, read_routed
from rivulet.sinks.logs import attribute_log
from rivulet.sources.periodic import read_periodic
from rivulet.sources.tables import read_table, register_views, select_rows, stream_source
from rivulet.streaming.streams import allocate_stream, append_stream, run_available_now, table_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters of the demo queries (arguments, not data).
SECRET = "rivulet-demo-secret"
NOW = 1_700_000_000
EXPIRES_S = 3600
DIM_MAX_BYTES = 8 << 20    # nation/region are fixed-size dimensions; broadcast only within this size


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# ======================================================= O1, O20: bound SELECT

@register("select_orders_json", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CAST(json_object('o_orderkey', CAST(o_orderkey AS VARCHAR), 'o_custkey', CAST(o_custkey AS VARCHAR),
                        'o_orderstatus', o_orderstatus, 'o_orderdate', CAST(o_orderdate AS VARCHAR),
                        'o_orderpriority', o_orderpriority) AS VARCHAR) AS row_json
FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
""")
def q_select_orders_json(spark, sf_dir):
    """O1 + O20: a SELECT with bound parameters; each row as a JSON object."""
    register_views(spark, sf_dir, ["orders"])
    rows = select_rows(
        spark,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders "
        "WHERE o_orderstatus = :status AND o_orderpriority <> :prio",
        {"status": "F", "prio": "5-LOW"})
    return rows.select("o_orderkey", row_json(rows).alias("row_json"))


# ======================================================= O11, O13-O15: enrich

@register("enrich_customer_orders", """
SELECT c.c_custkey, c.c_name,
       CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, o.o_orderstatus,
       CAST(o.o_orderdate AS VARCHAR) AS o_orderdate, o.o_orderpriority,
       CASE WHEN o.o_orderkey IS NULL THEN 'true' END AS no_result
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
""")
def q_enrich_customer_orders(spark, sf_dir):
    """O13 + O14: customers enriched by their orders; none → marker."""
    customer = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    return en.enrich(customer, orders, "c_custkey", empty_marker="no_result", hot_rows=en.HOT_ROWS)


@register("enrich_json_nation_suppliers", """
SELECT n.n_nationkey, n.n_name,
       CASE WHEN s.s_suppkey IS NULL THEN '{}'
            ELSE CAST(json_object('s_suppkey', CAST(s.s_suppkey AS VARCHAR), 's_name', s.s_name) AS VARCHAR)
       END AS content
FROM nation n LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey
""")
def q_enrich_json_nation_suppliers(spark, sf_dir):
    """O14 content form: one JSON object per supplier of a nation, ``{}`` if none."""
    nation = t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = t(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    return en.enrich_json(nation, supplier, "n_nationkey", json_col="content")


@register("enrich_last_order", """
WITH ranked AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
SELECT c.c_custkey, c.c_name,
       CAST(r.o_orderkey AS VARCHAR) AS "O_ORDERKEY", CAST(r.o_orderdate AS VARCHAR) AS "O_ORDERDATE",
       r.o_orderstatus AS "O_ORDERSTATUS",
       CASE WHEN r.o_orderkey IS NULL THEN 'true' END AS no_result
FROM customer c LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) r ON c.c_custkey = r.o_custkey
""")
def q_enrich_last_order(spark, sf_dir):
    """O15 + O11: last order per customer by (date, key); names upper-cased."""
    customer = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate", "o_orderstatus")
    return en.enrich_last(customer, orders, "c_custkey", ["o_orderdate", "o_orderkey"],
                          empty_marker="no_result", case="upper")


@register("enrich_range", """
SELECT c.c_custkey, c.c_name, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, CAST(o.o_custkey AS VARCHAR) AS o_custkey,
       o.o_orderpriority, CASE WHEN o.o_orderkey IS NULL THEN 'true' END AS no_result
FROM customer c LEFT JOIN orders o
  ON o.o_custkey = c.c_custkey AND o.o_totalprice >= c.c_acctbal * 10 AND o.o_orderstatus <> 'P'
""")
def q_enrich_range(spark, sf_dir):
    """O13 as a bound SELECT with an inequality: a customer's orders of ten
    times the balance or more, key names differing."""
    customer = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = t(spark, sf_dir, "orders")
    want = ((F.col("o_custkey") == F.col("c_custkey").outer()) & (F.col("o_totalprice") >= F.col("c_acctbal").outer() * 10)
            & (F.col("o_orderstatus") != "P"))
    out = en.enrich_where(customer, orders, want, empty_marker="no_result")
    return out.select("c_custkey", "c_name", "o_orderkey", "o_custkey", "o_orderpriority", "no_result")


@register("enrich_between_suppliers", """
SELECT c.c_custkey, c.c_name, c.c_acctbal >= 0 AS in_credit, CAST(s.s_suppkey AS VARCHAR) AS s_suppkey, s.s_name,
       CASE WHEN s.s_suppkey IS NULL THEN 'true' END AS no_result
FROM customer c LEFT JOIN (
  SELECT s_suppkey, s_name, s_acctbal AS lo, s_acctbal + CASE WHEN s_suppkey % 50 = 0 THEN 2000 ELSE 10.0 * (s_suppkey % 7) END AS hi
  FROM supplier) s ON s.lo <= c.c_acctbal AND c.c_acctbal < s.hi
""")
def q_enrich_between_suppliers(spark, sf_dir):
    """O13 + O14 by range alone: the suppliers in whose band (from empty to
    very wide) a customer's balance lies; a keyed join over an interval index."""
    customer = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    k = F.col("s_suppkey")
    width = F.when(k % 50 == 0, F.lit(2000.0)).otherwise(F.lit(10.0) * (k % 7))
    bands = t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_acctbal").alias("lo"), (F.col("s_acctbal") + width).alias("hi"))
    out = en.enrich_between(customer, bands, "c_acctbal", "lo", "hi", empty_marker="no_result")
    return out.select("c_custkey", "c_name", (F.col("c_acctbal") >= 0).alias("in_credit"), "s_suppkey", "s_name", "no_result")


# ======================================================= O12: templates

LOOKUP_TEMPLATE = ("select * from lineitem where l_orderkey = ${o_orderkey} "
                   "and l_returnflag <> '${o_orderstatus:toLower()}' -- next ${o_custkey:plus(1)}")


@register("render_order_lookup_sql", """
SELECT o_orderkey,
       'select * from lineitem where l_orderkey = ' || CAST(o_orderkey AS VARCHAR)
       || ' and l_returnflag <> ' || chr(39) || COALESCE(lower(o_orderstatus), '') || chr(39) || ' -- next '
       || COALESCE(CAST(o_custkey + 1 AS VARCHAR), '') AS sql_text,
       o_orderstatus = 'F' AS is_final
FROM orders
""")
def q_render_order_lookup_sql(spark, sf_dir):
    """A ``${...}`` template rendered per order (and a predicate)."""
    from rivulet.functions.templates import predicate, render
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return orders.select("o_orderkey", render(LOOKUP_TEMPLATE).alias("sql_text"),
                         predicate("${o_orderstatus:equals('F')}").alias("is_final"))


# ======================================================= O7, O8, O42, O5: routing

_ROUTE_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS BIGINT) AS qty, 'small' AS route
FROM lineitem WHERE l_quantity < 10
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), 'medium'
FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 30
UNION ALL
SELECT l_orderkey, CAST(l_linenumber + 100 AS BIGINT), CAST(l_quantity AS BIGINT), 'rush'
FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 20
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), CAST(l_quantity AS BIGINT), 'unmatched'
FROM lineitem
WHERE NOT (COALESCE(l_quantity < 10, false) OR COALESCE(l_quantity >= 10 AND l_quantity < 30, false)
           OR COALESCE(l_returnflag = 'R' AND l_quantity >= 20, false))
"""


@register("route_lineitem", _ROUTE_SQL)
def q_route_lineitem(spark, sf_dir):
    """O7 + O8: lineitems routed by quantity band (a row per matched route,
    one scan); the rush route's line number is updated."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    q = F.col("l_quantity")
    routed = R.route_column(li, {
        "small": q < 10,
        "medium": (q >= 10) & (q < 30),
        "rush": (F.col("l_returnflag") == "R") & (q >= 20),
    })
    routed = R.update_when(routed, "l_linenumber", F.col("l_linenumber") + 100, F.col("route") == "rush")
    return routed.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                         q.cast("long").alias("qty"), "route")


LOOP_LIMIT = 5


@register("loop_trace_lineitem", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(v - l_linenumber AS BIGINT) AS step,
       CAST(v AS BIGINT) AS loop_value, CASE WHEN v < {LOOP_LIMIT} THEN 'loop' ELSE 'endloop' END AS route
FROM (SELECT l_orderkey, l_linenumber, unnest(generate_series(l_linenumber, {LOOP_LIMIT})) AS v
      FROM lineitem WHERE l_linenumber <= {LOOP_LIMIT})
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), CAST(0 AS BIGINT), CAST(l_linenumber AS BIGINT), 'unmatched'
FROM lineitem WHERE l_linenumber > {LOOP_LIMIT} OR l_linenumber IS NULL
""")
def q_loop_trace_lineitem(spark, sf_dir):
    """O42 (+ O8's +1 step): the loop flow's visits, one row each."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    tr = R.loop_trace(li, "l_linenumber", F.lit(LOOP_LIMIT))
    return tr.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "step", "loop_value", "route")


@register("loop_end_lineitem", f"""
SELECT l_orderkey,
       CAST(CASE WHEN l_linenumber <= {LOOP_LIMIT} THEN {LOOP_LIMIT} ELSE l_linenumber END AS BIGINT) AS loop_value,
       CAST(CASE WHEN l_linenumber <= {LOOP_LIMIT} THEN {LOOP_LIMIT} - l_linenumber ELSE 0 END AS BIGINT) AS iterations,
       CASE WHEN l_linenumber <= {LOOP_LIMIT} THEN 'endloop' ELSE 'unmatched' END AS route
FROM lineitem
""")
def q_loop_end_lineitem(spark, sf_dir):
    """O42 end state + O5: only the chosen attributes are logged; the log is
    read back."""
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("loop_value"))
    end = R.loop_end(li, "loop_value", F.lit(LOOP_LIMIT))
    path = scratch_path(spark, "loop_end_log")
    log = attribute_log(end, ["l_orderkey", "loop_value", "iterations", "route"], path)
    return spark.read.schema(log.schema).json(path)


EUCLID_ROUNDS = 64   # of numbers under 2**43 (each two rounds halve the larger one)


@register("loop_gcd_orders", """
WITH RECURSIVE r AS (
  SELECT o_orderkey, o_custkey AS a, o_orderkey % 100000 AS b, 0 AS step FROM orders
  UNION ALL
  SELECT o_orderkey, b, a % b, step + 1 FROM r WHERE b > 0
)
SELECT o_orderkey, CAST(a AS BIGINT) AS gcd, CAST(step AS BIGINT) AS rounds, CASE WHEN b = 0 THEN 'endloop' ELSE 'unmatched' END AS route
FROM r WHERE NOT coalesce(b > 0, false)
""")
def q_loop_gcd_orders(spark, sf_dir):
    """O7 + O8 + O42 with a step that depends on the data: each order loops
    until its remainder is 0 (Euclid's rule), as a recursive query."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 100000).alias("b"))
    end = R.loop_rounds(orders, {"a": "b", "b": "a % b"}, "b > 0", "b = 0", max_rounds=EUCLID_ROUNDS, trace=False)
    return end.select("o_orderkey", F.col("a").alias("gcd"), F.col("step").alias("rounds"), "route")


# ======================================================= O9, O10: failure routes

MAX_DOC_BYTES = 20_000


@register("guard_documents", f"""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes,
       CASE WHEN strlen(text) > {MAX_DOC_BYTES} THEN 'failure' ELSE 'success' END AS route,
       CASE WHEN strlen(text) > {MAX_DOC_BYTES} THEN 'content_too_large' END AS error_code,
       CASE WHEN strlen(text) > {MAX_DOC_BYTES}
            THEN 'content has ' || CAST(strlen(text) AS VARCHAR) || ' bytes, over the {MAX_DOC_BYTES} byte limit' END
            AS error_message
FROM documents
""")
def q_guard_documents(spark, sf_dir):
    """O10 + O9: documents over a byte limit go to failure with error columns."""
    d = t(spark, sf_dir, "documents").select("doc_id", "text")
    g = R.guard_size(d, "text", max_bytes=MAX_DOC_BYTES)
    return g.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "route", "error_code",
                    "error_message")


# ======================================================= O21-O26: JSON and attributes

_EVENTS_JSON_CTE = """
WITH e AS (SELECT event_id, event_type, user_id, props FROM events
           UNION ALL SELECT -1 - event_id, event_type, user_id, substr(props, 1, 5) FROM events WHERE event_id % 13 = 0)
"""


# Numbers that a parser would print anew, a repeated name, an escape, outer space.
_ODD_JSON = (' {"a": 1.00, "b":1e3,"c":123456789012345678901234567890.5, "a":"\\u0041", "d":1.0E400, "k":', '.50, "e": [ 1.10 ]}\n')


def _events_records(spark, sf_dir, bad_every: int | None = None, empty_every: int | None = None,
                    odd_every: int | None = None, stream: bool = False) -> DataFrame:
    """All events as records; damaged copies of some (a cut or an emptied
    content, or JSON that is easily changed, under ids of their own) stand beside
    the whole ones. ``stream``: the table read as a stream."""
    ev = table_stream(spark, sf_dir, "events") if stream else t(spark, sf_dir, "events")
    out = ev = ev.select("event_id", "event_type", "user_id", "props")
    for every, props in ((bad_every, F.substring("props", 1, 5)), (empty_every, F.lit(""))):
        if every:
            out = out.unionByName(ev.where(F.col("event_id") % every == 0)
                                  .withColumns({"event_id": -1 - F.col("event_id"), "props": props}))
    if odd_every:
        odd = F.concat(F.lit(_ODD_JSON[0]), F.col("event_id").cast("string"), F.lit(_ODD_JSON[1]))
        out = out.unionByName(ev.where(F.col("event_id") % odd_every == 0)
                              .withColumns({"event_id": -1_000_000_000_000 - F.col("event_id"), "props": odd}))
    return to_records(out, "event_id", ["event_type", "user_id"], content="props")


@register("json_to_attributes_events", _EVENTS_JSON_CTE + """
SELECT event_id,
       CAST(CASE WHEN json_valid(props)
            THEN json_object('K', json_extract_string(props, '$.k'), 'event_type', event_type, 'raw', props,
                             'user_id', CAST(user_id AS VARCHAR))
            ELSE json_object('event_type', event_type, 'raw', props, 'user_id', CAST(user_id AS VARCHAR)) END
         AS VARCHAR) AS attributes_json,
       json_valid(props) AS content_valid
FROM e
""")
def q_json_to_attributes_events(spark, sf_dir):
    """O24 + O25: content kept as attribute ``raw``; its JSON members become
    upper-cased attributes; bad JSON flagged."""
    rec = _events_records(spark, sf_dir, bad_every=13)
    rec = J.content_to_attribute(rec, "raw")
    out = J.json_to_attributes(rec, case="upper")
    return out.select(F.col("record_id").alias("event_id"), map_json("attributes").alias("attributes_json"),
                      "content_valid")


_ENV_ATTRS = "json_object('event_type', event_type, 'user_id', CAST(user_id AS VARCHAR))"
def _envelope_sql(events: str) -> str:
    return f"""
WITH e AS ({events})
SELECT event_id,
       CASE WHEN props = '' THEN '{{"attribute":' || {_ENV_ATTRS} || '}}'
            WHEN NOT json_valid(props) THEN props
            ELSE '{{"content":' || trim(props, ' ' || chr(10)) || ',"attribute":' || {_ENV_ATTRS} || '}}' END
         AS envelope,
       CAST(CASE WHEN props = ''
            THEN json_object('event_type', event_type, 'no.attribute', 'true', 'user_id', CAST(user_id AS VARCHAR))
            ELSE {_ENV_ATTRS} END AS VARCHAR) AS attributes_json,
       props = '' OR json_valid(props) AS content_valid
FROM e
"""


_EVENTS_SQL = "SELECT event_id, event_type, user_id, props FROM events"
_EMPTIED_SQL = "SELECT -1 - event_id AS event_id, event_type, user_id, '' AS props FROM events WHERE event_id % 17 = 0"
_ODD_SQL = ("SELECT -1000000000000 - event_id AS event_id, event_type, user_id, "
            f"'{_ODD_JSON[0]}' || CAST(event_id AS VARCHAR) || '{_ODD_JSON[1]}' AS props FROM events WHERE event_id % 19 = 0")
_CUT_SQL = "SELECT -1 - event_id AS event_id, event_type, user_id, substr(props, 1, 5) AS props FROM events WHERE event_id % 13 = 0"
_ALL_EVENTS_SQL = f"{_EVENTS_SQL} UNION ALL {_CUT_SQL} UNION ALL {_EMPTIED_SQL} UNION ALL {_ODD_SQL}"


def _pack_events(rec: DataFrame) -> DataFrame:
    p = J.pack_envelope(rec)
    return p.select(F.col("record_id").alias("event_id"), F.col("content").alias("envelope"),
                    map_json("attributes").alias("attributes_json"), "content_valid")


@register("pack_envelope_events", _envelope_sql(_ALL_EVENTS_SQL))
def q_pack_envelope_events(spark, sf_dir):
    """Content + attributes → one envelope; empty content → marker; text
    that is not JSON is flagged and stays; JSON keeps its text."""
    return _pack_events(_events_records(spark, sf_dir, bad_every=13, empty_every=17, odd_every=19))


@register("unpack_envelope_events", f"""
WITH e AS ({_EVENTS_SQL} UNION ALL {_EMPTIED_SQL} UNION ALL {_ODD_SQL})
SELECT event_id,
       trim(props, ' ' || chr(10)) AS content,
       CAST(CASE WHEN props = ''
            THEN json_object('event_type', event_type, 'no.attribute', 'true', 'stage', 'packed',
                             'user_id', CAST(user_id AS VARCHAR))
            ELSE json_object('event_type', event_type, 'stage', 'packed', 'user_id', CAST(user_id AS VARCHAR)) END
         AS VARCHAR) AS attributes_json
FROM e
""")
def q_unpack_envelope_events(spark, sf_dir):
    """Pack, change the record's attributes, unpack: the envelope's
    attributes win, other record attributes stay, content comes back as it
    was."""
    p = J.pack_envelope(_events_records(spark, sf_dir, empty_every=17, odd_every=19), valid_col=None)
    p = p.withColumn("attributes", put_attributes(
        F.col("attributes"), F.create_map(F.lit("user_id"), F.lit("x"), F.lit("stage"), F.lit("packed"))))
    u = J.unpack_envelope(p)
    return u.select(F.col("record_id").alias("event_id"), "content", map_json("attributes").alias("attributes_json"))


def _customer_wide(spark, sf_dir) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    n = en.small_side(t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), DIM_MAX_BYTES)
    r = en.small_side(t(spark, sf_dir, "region").select("r_regionkey", "r_name"), DIM_MAX_BYTES)
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
            .join(r, F.col("n_regionkey") == r["r_regionkey"], "inner"))


@register("attributes_to_json_customer", """
SELECT c.c_custkey,
       CAST(json_object('c_name', c.c_name, 'c_mktsegment', c.c_mktsegment, 'missing_attr', '') AS VARCHAR)
         AS json_listed,
       CAST(json_object('c_mktsegment', c.c_mktsegment, 'c_name', c.c_name, 'n_name', n.n_name) AS VARCHAR)
         AS json_all
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_attributes_to_json_customer(spark, sf_dir):
    """Listed attributes (missing → "", core dropped) to an attribute;
    all non-core attributes, key-sorted, to the content."""
    wide = _customer_wide(spark, sf_dir)
    rec = to_records(wide, "c_custkey", {
        "c_name": "c_name", "c_mktsegment": "c_mktsegment", "n_name": "n_name",
        "filename": F.concat(F.lit("cust_"), F.col("c_custkey").cast("string"), F.lit(".txt"))})
    x = J.attributes_to_json(rec, None, destination="content")
    x = J.attributes_to_json(x, "c_name, c_mktsegment ,missing_attr, filename", destination="attribute")
    return x.select(F.col("record_id").alias("c_custkey"),
                    F.element_at("attributes", F.lit(J.JSON_ATTRIBUTE)).alias("json_listed"),
                    F.col("content").alias("json_all"))


NEST_NAMES = ["customer.name", "customer.segment", "customer.nation.name", "customer.nation.region.name"]


@register("nest_attributes_customer", """
SELECT c.c_custkey,
       CAST(json_object('customer', json_object('name', c.c_name, 'segment', c.c_mktsegment,
            'nation', json_object('name', n.n_name, 'region', json_object('name', r.r_name)))) AS VARCHAR)
         AS customer_json
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_nest_attributes_customer(spark, sf_dir):
    """O26 (inside an O6 group): dotted attribute names → nested JSON."""
    wide = _customer_wide(spark, sf_dir)
    rec = to_records(wide, "c_custkey", dict(zip(NEST_NAMES, ["c_name", "c_mktsegment", "n_name", "r_name"])))
    group = compose(lambda d: J.nest_attributes(d, "customer", NEST_NAMES), name="customer_json")
    out = group(rec)
    return out.select(F.col("record_id").alias("c_custkey"), F.col("content").alias("customer_json"))


# ======================================================= O27-O32: URL parameters

_KV_CTE = r"""
WITH p AS (SELECT page_id, url, regexp_extract(url, '\?([^#]*)', 1) AS qs FROM pages),
pc AS (SELECT page_id, list_filter(string_split(qs, '&'), lambda x: x <> '') AS pieces FROM p),
pp AS (SELECT page_id, unnest(pieces) AS piece, unnest(generate_series(1, len(pieces))) AS pos FROM pc),
kv AS (SELECT page_id, pos,
              url_decode(replace(split_part(piece, '=', 1), '+', ' ')) AS key,
              CASE WHEN strpos(piece, '=') > 0
                   THEN url_decode(replace(substr(piece, strpos(piece, '=') + 1), '+', ' ')) ELSE '' END AS value
       FROM pp)
"""


@register("url_params_pages", _KV_CTE + """,
last AS (SELECT page_id, key, arg_max(value, pos) AS value FROM kv GROUP BY page_id, key),
agg AS (SELECT page_id,
               '{' || string_agg(CAST(to_json('http.param.' || key) AS VARCHAR) || ':' || CAST(to_json(value) AS VARCHAR),
                                 ',' ORDER BY 'http.param.' || key) || '}' AS params
        FROM last GROUP BY page_id)
SELECT p.page_id, COALESCE(agg.params, '{"no_params":"true"}') AS params
FROM p LEFT JOIN agg ON p.page_id = agg.page_id
""")
def q_url_params_pages(spark, sf_dir):
    """URL parameters → prefixed attributes (last duplicate wins);
    none → ``no_params=true``."""
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    out = U.url_params(pages, "url", prefix="http.param.", if_empty="no_params")
    return out.select("page_id", map_json("params").alias("params"))


@register("url_param_rows_pages", _KV_CTE + """
SELECT page_id, CAST(pos AS BIGINT) AS pos, key, value FROM kv
""")
def q_url_param_rows_pages(spark, sf_dir):
    """One row per parameter, in order."""
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    return U.url_param_rows(pages, "url", ["page_id"])


@register("url_param_multimap_pages", _KV_CTE + """
SELECT page_id, key, CAST(to_json(list(value ORDER BY pos)) AS VARCHAR) AS values_json
FROM kv GROUP BY page_id, key
""")
def q_url_param_multimap_pages(spark, sf_dir):
    """Name → all values in order (per row, no shuffle)."""
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    mm = U.url_param_multimap(pages, "url")
    return mm.select("page_id", F.explode("param_values").alias("key", "vals")).select(
        "page_id", "key", F.to_json("vals").alias("values_json"))


@register("url_param_first_pages", _KV_CTE + """
SELECT p.page_id,
       (SELECT arg_min(value, pos) FROM kv WHERE kv.page_id = p.page_id AND kv.key = 'ref') AS ref,
       (SELECT arg_min(value, pos) FROM kv WHERE kv.page_id = p.page_id AND kv.key = 'utm_source') AS utm_source
FROM p
""")
def q_url_param_first_pages(spark, sf_dir):
    """First value of a name, else null."""
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    out = U.url_param_first(pages, "url", ["ref", "utm_source"])
    return out.select("page_id", "ref", "utm_source")


@register("url_rebuild_pages", _KV_CTE + """
SELECT page_id,
       string_agg(url_encode(key) || CASE WHEN value = '' THEN '' ELSE '=' || url_encode(value) END, '&'
                  ORDER BY pos) AS query_string
FROM kv GROUP BY page_id
""")
def q_url_rebuild_pages(spark, sf_dir):
    """Parameters → encoded query string (pages that have any)."""
    from rivulet.functions.urls import url_pairs
    pages = t(spark, sf_dir, "pages").select("page_id", url_pairs("url").alias("pairs"))
    out = U.build_query_string(pages.filter(F.size("pairs") > 0), "pairs")
    return out.select("page_id", "query_string")


@register("url_param_stats_pages", _KV_CTE + """
SELECT key, count(*) AS n_occurrences, count(DISTINCT page_id) AS n_urls, count(DISTINCT value) AS n_values
FROM kv GROUP BY key
""")
def q_url_param_stats_pages(spark, sf_dir):
    """Use of each parameter name over all pages."""
    pages = t(spark, sf_dir, "pages").select("page_id", "url")
    return U.url_param_stats(pages, "url", "page_id")


PARTS = 7


@register("url_param_sketches_pages", _KV_CTE + """
SELECT key, count(*) AS n_occurrences, count(DISTINCT page_id) AS n_urls, count(DISTINCT value) AS n_values,
       CAST((SELECT max(n) FROM (SELECT count(*) AS n FROM kv k2 WHERE k2.key = kv.key GROUP BY k2.value)) AS BIGINT) AS n_top
FROM kv GROUP BY key
""")
def q_url_param_sketches_pages(spark, sf_dir):
    """O32 from stored sketches: pages in seven parts, each sketched once and
    appended; the report merges the sketches."""
    pages = t(spark, sf_dir, "pages").select("url", (F.col("page_id") % PARTS).alias("part"))
    root = scratch_path(spark, "url_sketches")
    res = atomic_append(spark, {"sketches": U.url_param_sketches(pages, "url", "part")}, root, 1)
    if not res["success"]:
        raise RuntimeError(f"append failed: {res['error_code']} {res['error_message']}")
    out = U.url_param_report(read_committed(spark, root, "sketches"))
    return out.select("key", "n_occurrences", "n_urls", "n_values", F.get(F.col("top"), 0)["count"].alias("n_top"))


# ======================================================= O17: lines

_LINES_CTE = r"""
WITH l AS (SELECT doc_id,
                  list_filter(list_transform(string_split_regex(text, '\r\n|\r|\n'),
                                             lambda x: regexp_replace(x, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')),
                              lambda x: x <> '') AS ls
           FROM documents)
"""


@register("split_lines_documents", _LINES_CTE + """
SELECT doc_id, sha256(CAST(doc_id AS VARCHAR)) AS fragment_identifier,
       unnest(generate_series(1, len(ls))) AS fragment_index, CAST(len(ls) AS BIGINT) AS fragment_count,
       unnest(ls) AS line
FROM l
""")
def q_split_lines_documents(spark, sf_dir):
    """Every document → numbered, non-blank, trimmed lines."""
    docs = t(spark, sf_dir, "documents").select("doc_id", "text")
    return L.split_lines(docs, "doc_id", "text")["fragments"]


# ======================================================= O18: sequences

@register("next_ids_orders", """
SELECT o.o_orderkey, o.o_custkey,
       CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)
            + COALESCE(c.c_nationkey, 0) AS BIGINT) AS next_id
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_next_ids_orders(spark, sf_dir):
    """Gap-free ids per customer continuing stored counters."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    counters = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                   F.col("c_nationkey").alias("counter"))
    ids = Q.next_ids(orders, "o_custkey", ["o_orderdate", "o_orderkey"], counters)
    return ids.select("o_orderkey", "o_custkey", "next_id")


@register("next_ids_null_keys", """
WITH o AS (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders)
SELECT o_orderkey, k, CAST(row_number() OVER (PARTITION BY k ORDER BY o_orderdate, o_orderkey)
       + COALESCE(c.c_nationkey, 0) AS BIGINT) AS next_id
FROM o LEFT JOIN customer c ON k = c.c_custkey
""")
def q_next_ids_null_keys(spark, sf_dir):
    """Rows without a key are numbered like a key of their own."""
    orders = t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    counters = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("counter"))
    return Q.next_ids(orders, "k", ["o_orderdate", "o_orderkey"], counters).select("o_orderkey", "k", "next_id")


@register("next_ids_counters", """
SELECT COALESCE(c.c_custkey, u.o_custkey) AS o_custkey,
       CAST(COALESCE(c.c_nationkey, 0) + COALESCE(u.n, 0) AS BIGINT) AS counter
FROM customer c FULL OUTER JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) u
  ON c.c_custkey = u.o_custkey
""")
def q_next_ids_counters(spark, sf_dir):
    """The counter table after allocation."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    counters = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                   F.col("c_nationkey").alias("counter"))
    return Q.updated_counters(orders, "o_custkey", counters)


# ======================================================= O19, O16, O33: iterate, scripts

ITERATIONS = 5


@register("iterate_part_sizes", "\nUNION\n".join(
    f"SELECT p_brand, CAST(p_size % {i} AS BIGINT) AS m FROM part" for i in range(1, ITERATIONS + 1)))
def q_iterate_part_sizes(spark, sf_dir):
    """A SELECT run for i = 1..n and UNIONed (distinct)."""
    part = t(spark, sf_dir, "part").select("p_brand", "p_size")
    return S.iterate_union(part, lambda d: d.select("p_brand", (F.col("p_size") % F.col("i")).cast("long").alias("m")),
                           ITERATIONS)


TABLES_N = 250


@register("iterate_tables_orders", f"""
SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(o_orderkey % {TABLES_N} + 1 AS BIGINT) AS i FROM orders
""")
def q_iterate_tables_orders(spark, sf_dir):
    """O19 over many tables: orders kept in 250 tables, the SELECT over all of
    them as one scan."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    root = scratch_path(spark, "many_tables")
    (orders.withColumn("t", (F.col("o_orderkey") % TABLES_N + 1).cast("int")).repartition("t")
     .write.partitionBy("t").parquet(root))
    out = S.iterate_paths(spark, f"{root}/t=#{{iterate}}", TABLES_N, lambda d: d.select("o_orderpriority", "o_orderstatus", "i"))
    return out.select("o_orderpriority", "o_orderstatus", F.col("i").cast("long").alias("i"))


SCRIPT_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
SCRIPT_HEAD = "insert into lineitem_copy"


@register("insert_script_lineitem", f"""
WITH ln AS (SELECT l_orderkey, l_linenumber,
                   '{SCRIPT_HEAD}({",".join(SCRIPT_COLS)}) values ('
                   || {" || ',' || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'null')" for c in SCRIPT_COLS)}
                   || ');' AS line_text
            FROM lineitem)
SELECT l_orderkey, CAST((pos - 1) // 3 AS BIGINT) AS chunk, string_agg(line_text || chr(10), '' ORDER BY pos) AS script
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, line_text) AS pos FROM ln) GROUP BY 1, 2
""")
def q_insert_script_lineitem(spark, sf_dir):
    """O33 + O16: each lineitem as an insert line; each order's lines joined
    in line order (in bounded chunks)."""
    li = t(spark, sf_dir, "lineitem").select(*SCRIPT_COLS)
    lines = S.rows_to_insert_script(li, SCRIPT_HEAD, SCRIPT_COLS, keep=["l_orderkey", "l_linenumber"])
    return S.append_script(lines, "l_orderkey", "l_linenumber", chunk_rows=3)


@register("script_into_content_orders", """
WITH ln AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) AS line FROM lineitem),
sc AS (SELECT l_orderkey, string_agg(line || chr(10), '' ORDER BY l_linenumber, line) AS script FROM ln GROUP BY 1)
SELECT o_orderkey, CASE WHEN script IS NULL THEN o_orderpriority
            WHEN length(o_orderpriority) > 0 THEN o_orderpriority || chr(10) || script ELSE script END AS content
FROM orders LEFT JOIN sc ON o_orderkey = l_orderkey
""")
def q_script_into_content_orders(spark, sf_dir):
    """The script of an order's lines after the order's own content."""
    li = t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
        F.concat(F.col("l_partkey").cast("string"), F.lit(":"), F.col("l_suppkey").cast("string")).alias("line"))
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("content"))
    return S.script_into_content(orders, li, "o_orderkey", "l_linenumber")


# ======================================================= O34-O39: tax IDs

def _docs_frame(spark, sf_dir) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    k = F.col("c_custkey")
    c = D.with_check_digits(c, F.lpad(k.cast("string"), 9, "0"), "cpf0", "cpf")
    c = D.with_check_digits(c, F.concat(F.lpad(k.cast("string"), 8, "0"), F.lit("0001")), "cnpj0", "cnpj")
    cpf, cnpj = F.col("cpf0"), F.col("cnpj0")
    cpf = (F.when(k % 11 == 5, F.substring(cpf, 1, 10))
           .when(k % 7 == 3, F.concat(F.substring(cpf, 1, 10),
                                      ((F.substring(cpf, 11, 1).cast("int") + 1) % 10).cast("string")))
           .otherwise(cpf))
    cnpj = F.when(k % 5 == 1, F.concat(F.substring(cnpj, 1, 13),
                                       ((F.substring(cnpj, 14, 1).cast("int") + 1) % 10).cast("string"))).otherwise(cnpj)
    return c.select("c_custkey", "c_mktsegment", T.cpf_format(cpf, True).alias("cpf"),
                    T.cnpj_format(cnpj, True).alias("cnpj"))


_CPF_RAW = X.cpf_complete_sql("lpad(CAST(c_custkey AS VARCHAR), 9, '0')")
_CNPJ_RAW = X.cnpj_complete_sql("(lpad(CAST(c_custkey AS VARCHAR), 8, '0') || '0001')")
_DOCS_CTE = f"""
WITH raw AS (SELECT c_custkey, c_mktsegment, {_CPF_RAW} AS cpf0, {_CNPJ_RAW} AS cnpj0 FROM customer),
br AS (SELECT c_custkey, c_mktsegment,
              CASE WHEN c_custkey % 11 = 5 THEN substr(cpf0, 1, 10)
                   WHEN c_custkey % 7 = 3 THEN substr(cpf0, 1, 10) || CAST((CAST(substr(cpf0, 11, 1) AS INTEGER) + 1) % 10 AS VARCHAR)
                   ELSE cpf0 END AS cpf1,
              CASE WHEN c_custkey % 5 = 1 THEN substr(cnpj0, 1, 13) || CAST((CAST(substr(cnpj0, 14, 1) AS INTEGER) + 1) % 10 AS VARCHAR)
                   ELSE cnpj0 END AS cnpj1
       FROM raw),
docs AS (SELECT c_custkey, c_mktsegment,
                regexp_replace(cpf1, '(\\d{{3}})(\\d{{3}})(\\d{{3}})(\\d{{2}})', '\\1.\\2.\\3-\\4', 'g') AS cpf,
                regexp_replace(cnpj1, '(\\d{{2}})(\\d{{3}})(\\d{{3}})(\\d{{4}})(\\d{{2}})', '\\1.\\2.\\3/\\4-\\5', 'g') AS cnpj
         FROM br)
"""


@register("documents_customer", _DOCS_CTE + f"""
SELECT c_custkey, cpf, {X.cpf_valid_sql('cpf')} AS cpf_valid, cnpj, {X.cnpj_valid_sql('cnpj')} AS cnpj_valid
FROM docs
""")
def q_documents_customer(spark, sf_dir):
    """CPF/CNPJ per customer (some broken), masked, validated."""
    d = _docs_frame(spark, sf_dir)
    d = D.with_validity(d, "cpf", "cpf_valid", "cpf")
    d = D.with_validity(d, "cnpj", "cnpj_valid", "cnpj")
    return d.select("c_custkey", "cpf", "cpf_valid", "cnpj", "cnpj_valid")


_CPF_DIGITS = X.digits_sql("cpf")


@register("document_quality_segment", _DOCS_CTE + f""",
chk AS (SELECT c_mktsegment,
               CASE WHEN {X.cpf_valid_sql('cpf')} THEN 'valid'
                    WHEN length({_CPF_DIGITS}) <> 11 THEN 'wrong_length' ELSE 'wrong_digit' END AS p
        FROM docs)
SELECT c_mktsegment, count(*) AS n_docs, CAST(count_if(p = 'valid') AS BIGINT) AS n_valid,
       CAST(count_if(p = 'wrong_length') AS BIGINT) AS n_wrong_length,
       CAST(count_if(p = 'wrong_digit') AS BIGINT) AS n_wrong_digit
FROM chk GROUP BY c_mktsegment
""")
def q_document_quality_segment(spark, sf_dir):
    """Share of valid / wrong-length / wrong-digit CPFs per segment."""
    return D.document_quality(_docs_frame(spark, sf_dir), "cpf", "c_mktsegment", kind="cpf")


def _generated_sql(draw: str, suffix: str, complete) -> str:
    """A base of 9 digits, raised by one if all its digits are equal, and its
    check digits."""
    base = f"lpad(CAST({draw} AS VARCHAR){suffix}, 9, '0')"
    raised = f"lpad(CAST({draw} + 1 AS VARCHAR){suffix}, 9, '0')"
    return complete(f"(CASE WHEN {base} = repeat(substr({base}, 1, 1), 9) THEN {raised} ELSE {base} END)")


_CPF_DRAW, _STATE_DRAW = X.draw_sql(7, "c_custkey", 999999999), X.draw_sql(8, "c_custkey", 99999999)
_PLAIN_DRAW, _CNPJ_DRAW = X.draw_sql(8, "c_custkey", 999999999), X.draw_sql(9, "c_custkey", 99999999)


@register("generate_documents_customer", f"""
SELECT c_custkey, {_generated_sql(_CPF_DRAW, "", X.cpf_complete_sql)} AS cpf,
       CASE WHEN c_custkey % 12 <= 9 THEN {_generated_sql(_STATE_DRAW, " || CAST(c_custkey % 12 AS VARCHAR)", X.cpf_complete_sql)}
            ELSE {_generated_sql(_PLAIN_DRAW, "", X.cpf_complete_sql)} END AS cpf_state,
       {X.cnpj_complete_sql(f"(lpad(CAST({_CNPJ_DRAW} AS VARCHAR), 8, '0') || '0001')")} AS cnpj
FROM customer
""")
def q_generate_documents_customer(spark, sf_dir):
    """O37 + O38: one generated CPF (plain, and with a state digit; states 10
    and 11 are ignored) and CNPJ per customer."""
    c = t(spark, sf_dir, "customer").select("c_custkey")
    g = D.generate_cpf(c, ["c_custkey"], seed=7)
    g = D.generate_cpf(g, ["c_custkey"], seed=8, state=F.col("c_custkey") % 12, out="cpf_state")
    return D.generate_cnpj(g, ["c_custkey"], seed=9)


# ======================================================= O40, O41: tokens

_HEAD_B64 = __import__("base64").urlsafe_b64encode(b'{"typ":"JWT","alg":"HS256"}').rstrip(b"=").decode()
_PAYLOAD_SQL = (f"CAST(json_object('sub', CAST(c_custkey AS VARCHAR), 'name', c_name, 'exp', {NOW + EXPIRES_S}) "
                f"AS VARCHAR)")
_SIGNED_SQL = f"""
s0 AS (SELECT c_custkey, c_name, '{_HEAD_B64}.' || {X.b64url_sql(f'encode({_PAYLOAD_SQL})')} AS si FROM customer),
signed AS (SELECT c_custkey, c_name, si || '.' || {X.b64url_sql(X.hmac256_sql('si', SECRET))} AS "authorization" FROM s0)
"""


@register("sign_customers", "WITH " + _SIGNED_SQL + 'SELECT c_custkey, "authorization" FROM signed')
def q_sign_customers(spark, sf_dir):
    """An HS256 token per customer with claims from its columns."""
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    s = K.sign_rows(c, {"sub": "c_custkey", "name": "c_name"}, SECRET, "HS256", expires_s=EXPIRES_S, now=NOW)
    return s.select("c_custkey", "authorization")


_OTHER_PAYLOAD_B64 = __import__("base64").urlsafe_b64encode(b'{"sub":"0","name":"intruder"}').rstrip(b"=").decode()
_AUDIT_CTE = "WITH " + _SIGNED_SQL + f""",
tk AS (SELECT c_custkey,
              CASE WHEN c_custkey % 50 = 0 THEN ''
                   WHEN c_custkey % 5 = 1 THEN split_part("authorization", '.', 1) || '.{_OTHER_PAYLOAD_B64}.'
                                               || split_part("authorization", '.', 3)
                   WHEN c_custkey % 5 = 2 THEN split_part("authorization", '.', 1) || '.' || split_part("authorization", '.', 2)
                                               || '.' || reverse(split_part("authorization", '.', 3))
                   WHEN c_custkey % 5 = 3 THEN split_part("authorization", '.', 1) || '.' || split_part("authorization", '.', 2)
                   ELSE "authorization" END AS token,
              {NOW} + CASE WHEN c_custkey % 5 = 4 AND c_custkey % 2 = 1 THEN 7200 ELSE 0 END AS now_s
       FROM signed),
pt AS (SELECT c_custkey, token, now_s, string_split(token, '.') AS parts FROM tk),
dc AS (SELECT c_custkey, token, now_s, parts,
              TRY(decode({X.b64url_decode_sql('parts[1]')})) AS head,
              TRY(decode({X.b64url_decode_sql('parts[2]')})) AS payload
       FROM pt),
ck AS (SELECT c_custkey, token, now_s, parts, payload,
              CASE WHEN json_valid(head) THEN json_extract_string(head, '$.alg') END AS alg,
              CASE WHEN json_valid(payload) THEN TRY_CAST(json_extract_string(payload, '$.exp') AS BIGINT) END AS exp
       FROM dc),
audit AS (SELECT c_custkey,
    CASE WHEN COALESCE(length(token), 0) = 0 THEN 'empty_token'
         WHEN len(parts) <> 3 THEN 'wrong_number_of_segments'
         WHEN alg IS NULL THEN 'bad_header'
         WHEN alg <> 'HS256' THEN 'unsupported_algorithm'
         WHEN {X.b64url_sql(X.hmac256_sql("parts[1] || '.' || parts[2]", SECRET))} <> parts[3] THEN 'invalid_signature'
         WHEN NOT COALESCE(json_valid(payload), false) THEN 'bad_payload'
         WHEN exp IS NOT NULL AND now_s >= exp THEN 'expired'
    END AS token_error
  FROM ck)
"""


def _audited(spark, sf_dir) -> DataFrame:
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    s = K.sign_rows(c, {"sub": "c_custkey", "name": "c_name"}, SECRET, "HS256", expires_s=EXPIRES_S, now=NOW)
    a, k = F.col("authorization"), F.col("c_custkey")
    part = lambda i: F.split_part(a, F.lit("."), F.lit(i))
    token = (F.when(k % 50 == 0, F.lit(""))
             .when(k % 5 == 1, F.concat(part(1), F.lit("." + _OTHER_PAYLOAD_B64 + "."), part(3)))
             .when(k % 5 == 2, F.concat(part(1), F.lit("."), part(2), F.lit("."), F.reverse(part(3))))
             .when(k % 5 == 3, F.concat(part(1), F.lit("."), part(2)))
             .otherwise(a))
    now = F.lit(NOW) + F.when((k % 5 == 4) & (k % 2 == 1), F.lit(7200)).otherwise(F.lit(0))
    logged = s.select("c_custkey", token.alias("token"), now.alias("now_s"))
    return K.audit_tokens(logged, "token", SECRET, F.col("now_s"))


@register("audit_tokens_customer", _AUDIT_CTE + """
SELECT c_custkey, token_error IS NULL AS token_valid, token_error FROM audit
""")
def q_audit_tokens_customer(spark, sf_dir):
    """A token log (some altered, truncated, expired) audited."""
    return _audited(spark, sf_dir).select("c_custkey", "token_valid", "token_error")


@register("audit_token_counts", _AUDIT_CTE + """
SELECT COALESCE(token_error, 'valid') AS outcome, count(*) AS n_tokens FROM audit GROUP BY 1
""")
def q_audit_token_counts(spark, sf_dir):
    """Tokens per outcome."""
    return K.audit_counts(_audited(spark, sf_dir))


# ======================================================= O3, O4: atomic append

@register("atomic_append_orders", """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS target, o_orderkey, o_orderstatus, o_custkey
FROM orders
""")
def q_atomic_append_orders(spark, sf_dir):
    """O3: orders split over two targets, appended all-or-nothing (the batch
    tried again with a target that fails: nothing changes), and a batch that
    fails outright stays invisible; read back through the manifest."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    closed = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    root = scratch_path(spark, "atomic_orders")
    targets = {"closed": orders.filter(closed), "open": orders.filter(~closed)}
    res = atomic_append(spark, targets, root, 1)
    if not res["success"]:
        raise RuntimeError(f"append failed: {res['error_code']} {res['error_message']}")
    broken = orders.withColumn("o_custkey", F.raise_error(F.lit("refused")).cast("long"))
    for batch in (1, 2):
        atomic_append(spark, targets | {"open": broken}, root, batch)
    return (read_committed(spark, root, "closed").withColumn("target", F.lit("closed"))
            .unionByName(read_committed(spark, root, "open").withColumn("target", F.lit("open")))
            .select("target", "o_orderkey", "o_orderstatus", "o_custkey"))


_BANDS = {f"band{i}": (i * 50_000, (i + 1) * 50_000) for i in range(6)}


@register("append_routes_orders", "\nUNION ALL\n".join(
    [f"SELECT '{name}' AS target, o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice >= {a} AND o_totalprice < {b}"
     for name, (a, b) in _BANDS.items()]
    + ["SELECT 'urgent' AS target, o_orderkey, NULL AS o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'",
       f"""SELECT 'unmatched' AS target, o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT coalesce(o_totalprice >= 0 AND o_totalprice < {6 * 50_000}, false) AND NOT coalesce(o_orderpriority = '1-URGENT', false)"""]))
def q_append_routes_orders(spark, sf_dir):
    """O7 + O3 in one pass: orders to seven targets and the unmatched, one scan
    and one commit; a batch that fails stays invisible; one target with fewer
    columns."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    price = F.col("o_totalprice")
    routes = {name: (price >= a) & (price < b) for name, (a, b) in _BANDS.items()}
    routes["urgent"] = F.col("o_orderpriority") == "1-URGENT"
    columns = {"urgent": ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]}
    root = scratch_path(spark, "routed_orders")
    broken = orders.withColumn("o_custkey", F.raise_error(F.lit("refused")).cast("long"))
    append_routes(spark, broken, routes, root, 1, columns=columns)
    res = append_routes(spark, orders, routes, root, 2, columns=columns)
    if not res["success"]:
        raise RuntimeError(f"append failed: {res['error_code']} {res['error_message']}")
    return read_routed(spark, root).select("target", "o_orderkey", "o_custkey", "o_orderstatus")


@register("append_lines_documents", _LINES_CTE + """
SELECT CASE WHEN length(line) < 40 THEN 'short' ELSE 'long' END AS target, doc_id, count(*) AS n_lines
FROM (SELECT doc_id, unnest(ls) AS line FROM l) GROUP BY 1, 2
""")
def q_append_lines_documents(spark, sf_dir):
    """Document lines as data rows, routed to two targets and appended
    all-or-nothing; counted back from the committed data."""
    docs = t(spark, sf_dir, "documents").select("doc_id", "text")
    root = scratch_path(spark, "append_lines")
    res = append_lines(spark, docs, "text", {
        "short": lambda ls: ls.filter(F.length("line") < 40),
        "long": lambda ls: ls.filter(F.length("line") >= 40),
    }, root, 1, keep=("doc_id",))
    if not res["success"]:
        raise RuntimeError(f"append failed: {res['error_code']} {res['error_message']}")
    back = (read_committed(spark, root, "short").withColumn("target", F.lit("short"))
            .unionByName(read_committed(spark, root, "long").withColumn("target", F.lit("long"))))
    return back.groupBy("target", "doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


# ======================================================= O2, O43, O44: streams

@register("stream_pack_envelope_events", _envelope_sql(_ALL_EVENTS_SQL))
def q_stream_pack_envelope_events(spark, sf_dir):
    """O2 + O43: the events table read as a stream, packed per micro-batch
    (the same operator and the same records as the batch query: whole, cut,
    emptied and odd contents), appended through foreachBatch."""
    packed = _pack_events(_events_records(spark, sf_dir, bad_every=13, empty_every=17, odd_every=19, stream=True))
    root = scratch_path(spark, "stream_envelopes")
    q = append_stream(packed, lambda b: {"envelopes": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    return read_committed(spark, root, "envelopes").select("event_id", "envelope", "attributes_json", "content_valid")


@register("stream_loop_events", """
SELECT event_id, CAST(v AS BIGINT) AS step, CAST(v AS BIGINT) AS loop_value,
       CASE WHEN v < 10 THEN 'loop' ELSE 'endloop' END AS route
FROM (SELECT event_id, unnest(generate_series(0, 10)) AS v FROM events)
""")
def q_stream_loop_events(spark, sf_dir):
    """O2 + O42 + O5 as the loop flow runs: each event from the stream gets
    the fixed attributes loop_value=0, loop_limit=10, loops to 10, and only the
    chosen attributes are logged, per micro-batch."""
    stream = table_stream(spark, sf_dir, "events", fixed={"loop_value": 0, "loop_limit": 10}).select(
        "event_id", "loop_value", "loop_limit")
    trace = R.loop_trace(stream, "loop_value", F.col("loop_limit"))
    logged = attribute_log(trace, ["event_id", "step", "loop_value", "route"])
    root = scratch_path(spark, "stream_loop")
    q = append_stream(logged, lambda b: {"loop_log": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    return read_committed(spark, root, "loop_log").select("event_id", "step", "loop_value", "route")


@register("stream_next_ids_orders", """
SELECT o.o_orderkey, o.o_custkey,
       CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey)
            + COALESCE(c.c_nationkey, 0) AS BIGINT) AS next_id
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
""")
def q_stream_next_ids_orders(spark, sf_dir):
    """O18 on a stream: orders arriving in three micro-batches, by date, get
    per-customer ids that continue the stored counters; the counters are keyed
    state, which outlives the restart between two of them."""
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    counters = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                   F.col("c_nationkey").alias("counter"))
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    first, last = orders.agg(F.min(day), F.max(day)).first()
    third = F.least(F.floor((day - first) * 3 / F.lit(max(last - first, 1))), F.lit(2))
    root = scratch_path(spark, "stream_ids")
    for i in range(3):   # a third that arrives is the next micro-batch, in however many files
        orders.where(third == i).write.parquet(f"{root}/_source/{i}")
        stream = stream_source(spark, f"{root}/_source/*", orders.schema)
        run_available_now(allocate_stream(stream, "o_custkey", ["o_orderdate", "o_orderkey"], root, f"{root}/_checkpoint",
                                          initial_counters=counters))
    return read_committed(spark, root, "ids").select("o_orderkey", "o_custkey", "next_id")


TICKS = 50


@register("stream_periodic_orders", f"""
SELECT i AS tick, 10 AS loop_limit, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey, o.o_orderstatus,
       CASE WHEN o.o_orderkey IS NULL THEN 'true' END AS no_result
FROM range({TICKS}) r(i) LEFT JOIN orders o ON o.o_orderkey % {TICKS} = i
""")
def q_stream_periodic_orders(spark, sf_dir):
    """O2 + O44 as the loop flow starts: a timer makes a record with fixed
    attributes per period, and each looks up its share of the orders."""
    stream = read_periodic(spark, fixed={"loop_limit": 10}, first_tick=0, ticks=TICKS).select("tick", "loop_limit")
    orders = t(spark, sf_dir, "orders").select((F.col("o_orderkey") % TICKS).alias("tick"), "o_orderkey", "o_orderstatus")
    enriched = en.enrich(stream, orders, "tick", empty_marker="no_result")
    root = scratch_path(spark, "stream_periodic")
    q = append_stream(enriched, lambda b: {"orders": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    return read_committed(spark, root, "orders").select("tick", "loop_limit", "o_orderkey", "o_orderstatus", "no_result")


@register("stream_enrich_events", """
SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment, 'events' AS source,
       CASE WHEN c.c_custkey IS NULL THEN 'true' END AS no_result
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
""")
def q_stream_enrich_events(spark, sf_dir):
    """Event stream × customer table (stream-static join), appended
    all-or-nothing per micro-batch."""
    stream = table_stream(spark, sf_dir, "events", fixed={"source": "events"}).select("event_id", "user_id", "source")
    customers = t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    enriched = en.enrich(stream, customers, "user_id", empty_marker="no_result")
    root = scratch_path(spark, "stream_enrich")
    q = append_stream(enriched, lambda b: {"enriched": b}, root, checkpoint=f"{root}/_checkpoint")
    run_available_now(q)
    return read_committed(spark, root, "enriched").select("event_id", "user_id", "c_name", "c_mktsegment", "source",
                                                          "no_result")
