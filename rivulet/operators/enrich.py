"""Per-record lookup, expressed as joins over whole tables.

The reference runs one bound SELECT per record. Over a table that is a join;
Catalyst picks broadcast or sort-merge from table statistics, and AQE
re-plans at run time (a small side becomes a broadcast, hot keys are split).

One lookup is one left outer join with a hit flag, so the records are planned
once however many lookups follow each other. AQE splits a hot key on the
record side. A hot key on the lookup side (one customer holding a third of the
orders) is split by ``hot_rows``: keys with more lookup rows than that are
dealt into so many pieces, and their records meet each piece.

A lookup by range alone (``lo <= value < hi``, no equality) is a keyed join too
(``enrich_between``): each interval lies in the cells of a grid as coarse as the
interval is long, and a value meets the cells that hold it, one per length class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.json import row_json

HOT_ROWS = 100_000   # lookup rows of one key that are not split


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def small_side(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its plan's size estimate is within
    ``max_bytes`` (no job runs); else as it is, for Spark to decide."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def rename_case(df: DataFrame, case: str | None, skip: Sequence[str] = ()) -> DataFrame:
    """Result column names lower- or upper-cased (plan-time only)."""
    if not case:
        return df
    f = {"lower": str.lower, "upper": str.upper}[case]
    return df.toDF(*[c if c in skip else f(c) for c in df.columns])


def enrich(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
           empty_marker: str | None = None, marker_value: str = "true", case: str | None = None,
           as_strings: bool = True, hot_rows: int | None = None) -> DataFrame:
    """One output row per matching lookup row, carrying the record's
    columns plus the lookup's columns (as text, optionally case-renamed).

    ``how="left"`` keeps records without a match once, with null lookup
    columns and, when ``empty_marker`` is given, a column of that name set
    to ``marker_value`` (null on matched rows). A lookup column named like a
    record column overwrites it on matched rows. ``hot_rows`` splits lookup
    keys with more rows than that (at the price of counting them first).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = _keys(on)
    vals = [c for c in lookup.columns if c not in keys]
    side = lookup.select(*keys, *[(F.col(f"`{c}`").cast("string") if as_strings else F.col(f"`{c}`")).alias(c)
                                  for c in vals])
    side = _overwriting(rename_case(side, case, skip=keys), keys, df.columns).withColumn("_hit", F.lit(True))
    records, by = df, keys
    if hot_rows:
        # their records always match, so a piece without a row of its own must
        # not count as "no match"
        records, side, by = _dealt(df, side, keys, hot_rows)
    joined = records.join(side, by, how)
    if hot_rows:
        joined = joined.where(F.col("_hit").isNotNull() | F.col("_pieces").isNull()).drop("_pieces", "_piece")
    return _result(joined, df.columns, [c for c in side.columns if c not in by], empty_marker if how == "left" else None, marker_value)


def _dealt(df: DataFrame, side: DataFrame, keys: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both frames with ``_piece``: rows of ``side`` under a key that has over
    ``hot_rows`` of them are dealt into pieces, and the key's rows of ``df``
    repeated for each; and the columns to join by. At most |side| / hot_rows
    keys are hot."""
    hot = (side.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
           .select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_pieces")))
    value = [F.col(f"`{c}`") for c in side.columns if c not in ("_hit", *keys)]
    side = (side.join(hot, list(keys), "left")
            .withColumn("_piece", F.pmod(F.xxhash64(*value), F.coalesce("_pieces", F.lit(1))).cast("int")).drop("_pieces"))
    df = (df.join(hot, list(keys), "left")
          .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))))
    return df, side, [*keys, "_piece"]


def _overwriting(side: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Lookup columns named like record columns travel as ``_lk_<name>``."""
    return side.toDF(*[f"_lk_{c}" if c not in keys and c in columns else c for c in side.columns])


def _result(joined: DataFrame, columns: Sequence[str], side: Sequence[str], marker: str | None, value: str) -> DataFrame:
    hit = F.col("_hit").isNotNull()
    cols = [F.when(hit, F.col(f"_lk_{c}")).otherwise(F.col(f"`{c}`")).alias(c) if f"_lk_{c}" in side
            else F.col(f"`{c}`") for c in columns]
    cols += [F.col(f"`{c}`") for c in side if c != "_hit" and not c.startswith("_lk_")]
    if marker:
        cols.append(F.when(~hit, F.lit(value)).alias(marker))
    return joined.select(*cols)


def enrich_where(df: DataFrame, lookup: DataFrame, predicate: Column, how: str = "left",
                 empty_marker: str | None = None, marker_value: str = "true", case: str | None = None,
                 as_strings: bool = True) -> DataFrame:
    """O13 for any bound SELECT: ``predicate`` is over the lookup's columns
    and the record's, these written ``F.col(name).outer()``. Spark takes the
    lateral join apart into a join on the predicate, so with an equality in it
    the rest (ranges, inequalities) is a condition of a keyed join; without
    any equality every record meets every lookup row, as the SELECT would (a
    range alone: ``enrich_between``)."""
    # one select: the outer names resolve in the join only, so nothing may ask
    # this frame for its columns before
    named = {c: {"lower": c.lower(), "upper": c.upper()}.get(case, c) for c in lookup.columns}
    named = {c: f"_lk_{n}" if n in df.columns else n for c, n in named.items()}
    side = lookup.where(predicate).select(
        *[(F.col(f"`{c}`").cast("string") if as_strings else F.col(f"`{c}`")).alias(n) for c, n in named.items()],
        F.lit(True).alias("_hit"))
    joined = df.lateralJoin(side, how=how)
    return _result(joined, df.columns, [*named.values(), "_hit"], empty_marker if how == "left" else None, marker_value)


def _axis(c: Column, kind: T.DataType) -> Column:
    """A column as a point on the real line. Rounding to double keeps the order
    (never strictly), which is all that the cells need; the join's residual
    condition compares the values themselves."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise ValueError(f"a range lookup needs numbers, dates or timestamps, not {kind.simpleString()}")


_UNBOUNDED = 5000   # length class of intervals that no double can measure


def _cell(x: Column, level: Column) -> Column:
    return F.when(level == _UNBOUNDED, F.lit(0.0)).otherwise(F.floor(x / F.pow(F.lit(2.0), level)).cast("double"))


def interval_index(lookup: DataFrame, lo: str, hi: str, closed: bool = False) -> DataFrame:
    """``lookup`` with ``_level`` and ``_cell``: an interval is as long as its
    level's cells at most (2**level), so it lies in two or three of them and is
    repeated so often. Empty intervals and null ends match nothing and go."""
    a, b = (_axis(F.col(f"`{c}`"), lookup.schema[c].dataType) for c in (lo, hi))
    holds = F.col(f"`{lo}`") <= F.col(f"`{hi}`") if closed else F.col(f"`{lo}`") < F.col(f"`{hi}`")
    # a measured length of 0 (a closed point, or less than doubles tell apart) has the least class
    level = (F.when(F.isnan(b - a) | (b - a == float("inf")), F.lit(_UNBOUNDED)).when(b - a <= 0, F.lit(-1022))
             .otherwise(F.greatest(F.ceil(F.log2(b - a)), F.lit(-1022))).cast("int"))
    out = lookup.where(holds).withColumns({"_a": a, "_b": b, "_level": level})
    first, last = _cell(F.col("_a"), F.col("_level")), _cell(F.col("_b"), F.col("_level"))
    cells = F.array_distinct(F.array(first, F.least(first + 1, last), last))
    return out.withColumn("_cell", F.explode(cells)).drop("_a", "_b")


def enrich_between(df: DataFrame, lookup: DataFrame, value: str, lo: str, hi: str, on: str | Sequence[str] = (),
                   closed: bool = False, how: str = "left", empty_marker: str | None = None, marker_value: str = "true",
                   case: str | None = None, as_strings: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """O13/O14 by range: the lookup rows with ``lo <= value < hi`` (``closed``:
    ``<= hi``), and equal ``on`` columns if any are given. Numbers, dates or
    timestamps.

    The distinct values are asked first in which length classes they have a match
    at all (a semi-join with the interval index by class and cell, the range itself
    as the residual condition). Each record then meets the index once per such
    class, or none and comes out as having no match; what is found is not moved
    again, so only the inputs are shuffled, however many rows match. Which classes
    exist is asked before: a class is an exponent of a double, so at most some 2,100
    numbers reach the driver (a table of like intervals has a handful). Cells with
    over ``hot_rows`` lookup rows or records are split on that side.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = _keys(on)
    taken = {value, *keys}
    clash = [c for c in lookup.columns if c in taken and c not in keys]
    if clash:
        raise ValueError(f"the lookup has a column named like the value: {clash}")
    index = interval_index(lookup, lo, hi, closed)
    levels = [r["_level"] for r in index.select("_level").distinct().collect()]
    point = _axis(F.col(f"`{value}`"), df.schema[value].dataType)
    all_levels = F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")
    cells = [*keys, "_level", "_cell"]
    values = (df.where(F.col(f"`{value}`").isNotNull()).groupBy(*keys, F.col(f"`{value}`").alias(value)).agg(F.count(F.lit(1)).alias("_m"))
              .withColumn("_level", F.explode(all_levels)).withColumn("_cell", _cell(point, F.col("_level"))))

    named = {c: {"lower": c.lower(), "upper": c.upper()}.get(case, c) for c in lookup.columns if c not in keys}
    named = {c: f"_lk_{n}" if n in df.columns else n for c, n in named.items()}
    plain = [n for c, n in named.items() if as_strings or "map<" not in lookup.schema[c].dataType.simpleString()]
    shown = [(F.col(f"`{c}`").cast("string") if as_strings else F.col(f"`{c}`")).alias(n) for c, n in named.items()]
    ends = [F.col(f"`{lo}`").alias("_lo"), F.col(f"`{hi}`").alias("_hi")]
    index = index.select(*[F.col(f"`{c}`").alias(f"_by_{c}") for c in cells], *ends, *shown, F.lit(True).alias("_hit"))
    x = F.col(f"`{value}`")
    holds = (F.col("_lo") <= x) & ((x <= F.col("_hi")) if closed else (x < F.col("_hi")))

    def meets(columns):
        out = holds
        for c in columns:
            out = (F.col(f"`{c}`") == F.col(f"`_by_{c}`")) & out
        return out

    found = (values.join(index.select(*[f"`_by_{c}`" for c in cells], "_lo", "_hi"), meets(cells), "left_semi")
             .groupBy(*keys, value).agg(F.collect_set("_level").alias("_levels")))
    explode = F.explode_outer if how == "left" else F.explode
    records = (df.join(found, [*keys, value], how).select(*[F.col(f"`{c}`") for c in df.columns], explode("_levels").alias("_level"))
               .withColumn("_cell", _cell(point, F.col("_level"))))
    hot = (index.groupBy(*[f"_by_{c}" for c in cells]).agg(F.count(F.lit(1)).alias("_n"))
           .join(values.select(*[F.col(f"`{c}`").alias(f"_by_{c}") for c in cells], "_m").groupBy(*[f"_by_{c}" for c in cells])
                 .agg(F.sum("_m").alias("_m")), [f"_by_{c}" for c in cells])
           .where((F.col("_n") > hot_rows) | (F.col("_m") > hot_rows))
           .select(*[F.col(f"`_by_{c}`") for c in cells], F.ceil(F.col("_n") / hot_rows).cast("int").alias("_pieces"),
                   F.ceil(F.col("_m") / hot_rows).cast("int").alias("_parts")))
    hot = F.broadcast(hot)   # at most (|df| + |lookup|) / hot_rows rows a length class
    pieces, parts = F.coalesce("_pieces", F.lit(1)), F.coalesce("_parts", F.lit(1))
    mine = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if "map<" not in df.schema[c].dataType.simpleString()])
    records = (records.join(hot.select(*[F.col(f"`_by_{c}`").alias(c) for c in cells], "_pieces", "_parts"), cells, "left")
               # (records without a match meet nothing: they are spread)
               .withColumn("_part", F.when(F.col("_level").isNull(), F.pmod(mine, F.lit(1 << 16))).otherwise(F.pmod(mine, parts)).cast("int"))
               .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_pieces", "_parts"))
    index = (index.join(hot, [f"_by_{c}" for c in cells], "left")
             .withColumn("_by__piece", F.pmod(F.xxhash64("_lo", "_hi", *[F.col(f"`{n}`") for n in plain]), pieces).cast("int"))
             .withColumn("_by__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_pieces", "_parts"))
    # the rows that come out follow the cells and not the inputs' bytes, so cells are dealt over tasks
    joined = records.join(index.hint("merge"), meets([*cells, "_piece", "_part"]), how)
    joined = joined.where(F.col("_hit").isNotNull() | F.col("_level").isNull())
    return _result(joined, df.columns, [*named.values(), "_hit"], empty_marker if how == "left" else None, marker_value)


def enrich_json(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], json_col: str = "content",
                default: str = "{}", hot_rows: int | None = None) -> DataFrame:
    """O14 content form: one JSON object per matching lookup row (values as
    text, nulls left out); a record without match gets ``default``."""
    keys = _keys(on)
    vals = [c for c in lookup.columns if c not in keys]
    side = lookup.select(*keys, row_json(lookup, vals).alias(json_col))
    out = enrich(df, side, keys, how="left", as_strings=False, hot_rows=hot_rows)
    return out.withColumn(json_col, F.coalesce(F.col(json_col), F.lit(default)))


def last_per_key(lookup: DataFrame, on: str | Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """The lookup row with the greatest ``order_by`` per key (``max_by`` is a
    partial aggregate, so a hot key is reduced map-side)."""
    keys = _keys(on)
    vals = [c for c in lookup.columns if c not in keys]
    order = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order_by])
    agg = lookup.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in vals]), order).alias("_last"))
    return agg.select(*keys, *[F.col(f"_last.`{c}`").alias(c) for c in vals])


def enrich_last(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], order_by: Sequence[str | Column],
                **kw) -> DataFrame:
    """When every result row is written into the same record, the last
    one wins; "last" is made explicit by ``order_by`` (a total order)."""
    return enrich(df, last_per_key(lookup, on, order_by), on, **kw)
