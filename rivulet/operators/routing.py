"""Routing, conditional update, failure split, size guard and
the bounded loop, all as projections and filters; a loop whose step is a rule is a
recursive query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import col_of

UNMATCHED = "unmatched"


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def route(df: DataFrame, routes: Mapping[str, Column], multi: bool = True,
          unmatched: str = UNMATCHED) -> dict[str, DataFrame]:
    """O7 as one frame per output: a record goes to every route whose
    predicate is true (or only the first one with ``multi=False``); records
    matching none go to ``unmatched``. A null predicate counts as false."""
    out, seen = {}, F.lit(False)
    for name, p in routes.items():
        p = F.coalesce(p, F.lit(False))
        out[name] = df.filter(p if multi else (p & ~seen))
        seen = seen | p
    out[unmatched] = df.filter(~seen)
    return out


def route_column(df: DataFrame, routes: Mapping[str, Column], multi: bool = True,
                 unmatched: str = UNMATCHED, name: str = "route") -> DataFrame:
    """O7 in one scan: a row per (record, matched route), with the route's
    name in column ``name``; a record matching none gets ``unmatched``."""
    preds = [(n, F.coalesce(p, F.lit(False))) for n, p in routes.items()]
    if not multi:
        first = F.lit(unmatched)
        for n, p in reversed(preds):
            first = F.when(p, F.lit(n)).otherwise(first)
        return df.withColumn(name, first)
    any_hit = F.lit(False)
    for _, p in preds:
        any_hit = any_hit | p
    # one entry per route (null when it does not match) plus "unmatched";
    # nulls are dropped after the explode, which stays inside codegen
    entries = F.array(*[F.when(p, F.lit(n)) for n, p in preds], F.when(~any_hit, F.lit(unmatched)))
    return df.withColumn(name, F.explode(entries)).where(F.col(name).isNotNull())


def update_when(df: DataFrame, col: str, expr: Column, condition: Column | None = None) -> DataFrame:
    """Set a column, only where ``condition`` holds (all rows if None)."""
    if condition is None:
        return df.withColumn(col, expr)
    return df.withColumn(col, F.when(F.coalesce(condition, F.lit(False)), expr).otherwise(F.col(col)))


def mark_failed(df: DataFrame, ok: Column, error_code: str | Column, error_message: str | Column,
                code_col: str = "error_code", message_col: str = "error_message",
                route_col: str | None = "route") -> DataFrame:
    """O9 per row: rows where ``ok`` is not true get the two error columns
    (null on good rows) and ``route`` = success / failure. The message has
    ``'`` replaced by ``"`` as the reference does with statement text."""
    bad = ~F.coalesce(ok, F.lit(False))
    out = df.withColumns({
        code_col: F.when(bad, _as_col(error_code).cast("string")),
        message_col: F.when(bad, F.translate(_as_col(error_message).cast("string"), "'", '"')),
    })
    if route_col:
        out = out.withColumn(route_col, F.when(bad, F.lit("failure")).otherwise(F.lit("success")))
    return out


def split_failed(df: DataFrame, ok: Column, error_code: str | Column, error_message: str | Column,
                 **kw) -> dict[str, DataFrame]:
    """O9 as two frames: ``success`` (input columns) and ``failure`` (input
    plus error columns)."""
    marked = mark_failed(df, ok, error_code, error_message, route_col="_route", **kw)
    return {
        "success": marked.filter(F.col("_route") == "success").select(*df.columns),
        "failure": marked.filter(F.col("_route") == "failure").drop("_route"),
    }


def sql_error_code(code: int | str) -> str:
    """Whole-statement failure code text, as the reference prints it."""
    return f"SqlErrCod[{code}] "


def guard_size(df: DataFrame, content: str | Column = "content", max_bytes: int = 1 << 20,
               route_col: str = "route") -> DataFrame:
    """Records whose content is over ``max_bytes`` (UTF-8) → failure."""
    size = F.coalesce(F.octet_length(col_of(content)), F.lit(0))
    return mark_failed(df, size <= F.lit(max_bytes), "content_too_large",
                       F.concat(F.lit("content has "), size.cast("string"),
                                F.lit(f" bytes, over the {max_bytes} byte limit")),
                       route_col=route_col)


TRACE_BLOCK = 1000   # visits of a record that are made at once


def loop_trace(df: DataFrame, value: str, limit: str | Column, step_col: str = "step",
               value_col: str = "loop_value", route_col: str = "route") -> DataFrame:
    """O42 as trace rows: the loop flow routes ``loop_value < loop_limit`` to
    ``loop`` (then +1) and ``loop_value = loop_limit`` to ``endloop``; one row per
    visit of the router. A start above the limit, or null, is ``unmatched``.

    ``sequence`` counts down when start > stop, so it is only used under the
    ``value <= limit`` guard.
    """
    staged = df.withColumns({"_v": col_of(value).cast("long"), "_lim": col_of(limit).cast("long")})
    if value_col in df.columns:
        staged = staged.drop(value_col)  # the trace value replaces it
    v, lim = F.col("_v"), F.col("_lim")
    runs = v.isNotNull() & lim.isNotNull() & (v <= lim)
    # blocks of visits first, then the visits of each: no array is longer
    # than a block, except the list of blocks
    blocks = F.when(runs, F.sequence(v, lim, F.lit(TRACE_BLOCK))).otherwise(F.array(v))
    out = staged.select("*", F.explode(blocks).alias("_from"))
    visits = F.when(runs, F.sequence(F.col("_from"), F.least(F.col("_from") + (TRACE_BLOCK - 1), lim))).otherwise(F.array("_from"))
    out = out.select("*", F.explode(visits).alias(value_col))
    out = out.withColumn("_pos", F.when(runs, F.col(value_col) - v).otherwise(F.lit(0)))
    route = (F.when(~runs, F.lit(UNMATCHED))
             .when(F.col(value_col) < lim, F.lit("loop")).otherwise(F.lit("endloop")))
    return (out.withColumn(step_col, F.col("_pos").cast("long")).withColumn(route_col, route)
            .drop("_pos", "_from", "_v", "_lim"))


def loop_end(df: DataFrame, value: str, limit: str | Column, route_col: str = "route",
             iterations_col: str = "iterations") -> DataFrame:
    """O42 end state: value raised to the limit (``endloop``) with the count
    of ``loop`` passes, or left as it is (``unmatched``)."""
    v, lim = col_of(value).cast("long"), col_of(limit).cast("long")
    runs = v.isNotNull() & lim.isNotNull() & (v <= lim)
    return df.withColumns({
        iterations_col: F.when(runs, lim - v).otherwise(F.lit(0)).cast("long"),
        route_col: F.when(runs, F.lit("endloop")).otherwise(F.lit(UNMATCHED)),
        value: F.when(runs, lim).otherwise(v),
    })


def loop_rounds(df: DataFrame, step: Mapping[str, str], loop_when: str, end_when: str, max_rounds: int, trace: bool = True,
                step_col: str = "step", route_col: str = "route") -> DataFrame:
    """O7 + O8 + O42 for any rule: a record for which ``loop_when`` holds is routed
    to ``loop``, its columns are updated by ``step`` (column -> SQL expression, all
    over the values before) and it is routed again; else it leaves as ``endloop`` if
    ``end_when`` holds, or ``unmatched``. A null condition does not hold. One row
    per visit with its number (``trace=False``: only the visits that leave).

    A recursive query: each round is one pass over the records that still loop,
    so the work is the number of visits. More than ``max_rounds`` rounds are an
    error (``RECURSION_LEVEL_LIMIT_EXCEEDED``), never a cut result. The limit on
    rows that Spark has for recursive queries is lifted on the session."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    missing = [c for c in step if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    if step_col in df.columns or route_col in df.columns:
        raise ValueError(f"columns named {step_col} or {route_col}")
    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    names = ", ".join(f"`{c}`" for c in df.columns)
    updated = ", ".join(f"CAST({step[c]} AS {kind[c]}) AS `{c}`" if c in step else f"`{c}`" for c in df.columns)
    visits = spark.sql(f"""
        WITH RECURSIVE visits ({names}, `{step_col}`) MAX RECURSION LEVEL {int(max_rounds) + 1} AS (
          SELECT {names}, CAST(0 AS BIGINT) FROM {{records}}
          UNION ALL
          SELECT {updated}, `{step_col}` + 1 FROM visits WHERE {loop_when})
        SELECT * FROM visits""", records=df)
    loops, ends = (F.coalesce(F.expr(c), F.lit(False)) for c in (loop_when, end_when))
    if not trace:
        visits = visits.where(~loops)
    return visits.withColumn(route_col, F.when(loops, "loop").when(ends, "endloop").otherwise(UNMATCHED))
