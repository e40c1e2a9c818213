"""The record shape: ``content STRING`` plus ``attributes MAP<STRING,STRING>``
(map form), or one column per attribute (wide form)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import col_of

MAP_TYPE = "map<string,string>"


def attribute_map(cols: Mapping[str, Column | str] | Sequence[str]) -> Column:
    """Columns → MAP<STRING,STRING>; null values are left out (an attribute
    is either present with a text value or absent). Built with
    ``map_concat`` of one-entry maps, which stays inside codegen."""
    items = cols.items() if isinstance(cols, Mapping) else [(c, c) for c in cols]
    empty = F.create_map().cast(MAP_TYPE)
    parts = []
    for name, c in items:
        v = col_of(c).cast("string")
        parts.append(F.when(v.isNotNull(), F.create_map(F.lit(name), v)).otherwise(empty))
    if not parts:
        return empty
    return parts[0] if len(parts) == 1 else F.map_concat(*parts)


def to_records(df: DataFrame, id_col: str, attributes: Mapping[str, Column | str] | Sequence[str],
               content: Column | str | None = None) -> DataFrame:
    """Wide frame → (record_id, content, attributes)."""
    c = col_of(content).cast("string") if content is not None else F.lit(None).cast("string")
    return df.select(F.col(id_col).alias("record_id"), c.alias("content"),
                     attribute_map(attributes).alias("attributes"))


def to_wide(df: DataFrame, names: Iterable[str], attributes: str = "attributes") -> DataFrame:
    """Map form → one column per (plan-time known) attribute name."""
    return df.withColumns({n: F.element_at(F.col(attributes), F.lit(n)) for n in names})


def last_win(df: DataFrame) -> DataFrame:
    """Operators that merge maps rely on a later duplicate key replacing the
    earlier one (``spark.sql.mapKeyDedupPolicy=LAST_WIN``, a run-time
    setting read when the plan executes); set it on the frame's session."""
    df.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    return df


def put_attributes(m: Column, new: Column) -> Column:
    """Map merge where ``new`` wins (``map_concat`` under LAST_WIN, inside
    codegen); a null ``new`` leaves ``m`` as it is."""
    return F.map_concat(m, F.coalesce(new, F.create_map().cast(MAP_TYPE)))


def put_attribute(m: Column, name: str | Column, value: Column) -> Column:
    return put_attributes(m, F.create_map(name if isinstance(name, Column) else F.lit(name), value))


def staged(df: DataFrame, name: str, expr: Column) -> tuple[DataFrame, Column]:
    """Add ``expr`` as a hidden column so later expressions read it instead
    of recomputing it (callers reference it more than once, which keeps
    Catalyst from inlining it back)."""
    return df.withColumn(name, expr), F.col(name)
