"""Insert-script text built from rows, and the n-fold
iteration of a SELECT."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import col_of
from rivulet.operators.sequences import next_ids
from rivulet.session import scratch_path

# Fixed text pieces of one script line: head(c1,c2) values (v1,v2);
SCRIPT_SEP = ","
SCRIPT_VALUES = " values "
SCRIPT_END = ";"
SCRIPT_NEWLINE = "\n"
SQL_COPIES = 200   # plan branches that iterate_sql makes at once


def insert_line(df: DataFrame, head: str | Column, cols: Sequence[str] | None = None, quote: bool = False) -> Column:
    """``head(c1,c2) values (v1,v2);`` for one row. Values unquoted as
    in the reference (``quote=True`` single-quotes them, doubling inner
    quotes); null prints ``null``."""
    names = list(cols) if cols is not None else df.columns
    vals = []
    for c in names:
        v = F.col(f"`{c}`").cast("string")
        if quote:
            v = F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'"))
        vals.append(F.coalesce(v, F.lit("null")))
    h = head if isinstance(head, Column) else F.lit(head)
    return F.concat(h, F.lit("(" + SCRIPT_SEP.join(names) + ")" + SCRIPT_VALUES + "("),
                    F.concat_ws(SCRIPT_SEP, *vals), F.lit(")" + SCRIPT_END))


def rows_to_insert_script(df: DataFrame, head: str | Column, cols: Sequence[str] | None = None,
                          keep: Sequence[str] = (), quote: bool = False, out: str = "line") -> DataFrame:
    """O33 over a frame: ``keep`` columns plus one script line per row."""
    return df.select(*keep, insert_line(df, head, cols, quote).alias(out))


def append_script(lines: DataFrame, key: str | Sequence[str], order_by: str | Sequence[str], line: str = "line",
                  chunk_rows: int = 1000, old_content: DataFrame | None = None,
                  content: str = "content", reset: bool = False) -> DataFrame:
    """Each record's script = its lines in ``order_by`` order, each
    followed by a newline. With ``old_content`` (and no ``reset``) the old text
    and a newline come first, as chunk -1; a null or empty old text adds
    nothing.

    The text is returned in chunks of exactly ``chunk_rows`` lines (the last:
    the rest), by the lines' position in their record, whatever the type of
    ``order_by``; null comes first. No group larger than a chunk is ever
    gathered in one task. A key's chunks in order give the record's content.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    staged = next_ids(lines.select(*dict.fromkeys([*keys, *order, line])), keys, [*order, line], id_col="_pos")
    chunk = F.floor((F.col("_pos") - 1) / F.lit(chunk_rows)).cast("long")
    entry = F.struct(F.col("_pos").alias("p"), F.coalesce(col_of(line), F.lit("")).alias("l")).alias("_e")
    ordered = F.sort_array(F.collect_list("_e")).getField("l")
    scripts = staged.select(*keys, chunk.alias("chunk"), entry).groupBy(*keys, "chunk").agg(
        F.concat(F.array_join(ordered, SCRIPT_NEWLINE), F.lit(SCRIPT_NEWLINE)).alias("script"))
    if old_content is not None and not reset:
        old = old_content.where(F.length(col_of(content)) > 0).select(
            *keys, F.lit(-1).cast("long").alias("chunk"), F.concat(col_of(content), F.lit(SCRIPT_NEWLINE)).alias("script"))
        scripts = scripts.unionByName(old)
    return scripts


def script_into_content(records: DataFrame, lines: DataFrame, key: str, order_by: str | Sequence[str],
                        line: str = "line", content: str = "content", reset: bool = False) -> DataFrame:
    """O16 as the record carries it: ``records`` with the script appended to
    their content (or in its place, with ``reset``). A record's content is one
    value, so its chunks are joined; a record without lines keeps its content.
    A null key matches the lines of the null key."""
    chunks = append_script(lines, key, order_by, line)
    whole = chunks.groupBy(key).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("chunk", "script"))).getField("script"), "").alias("_script"))
    whole = whole.withColumnRenamed(key, "_key")
    old = F.lit("") if reset else F.when(F.length(col_of(content)) > 0, F.concat(col_of(content), F.lit(SCRIPT_NEWLINE))).otherwise(F.lit(""))
    out = records.join(whole, records[key].eqNullSafe(whole["_key"]), "left")
    text = F.when(F.col("_script").isNotNull(), F.concat(old, "_script")).otherwise(F.col(content))
    return out.withColumn(content, text).select(*records.columns)


def iterate_union(df: DataFrame, select: Callable[[DataFrame], DataFrame], n: int | str,
                  token: str = "i") -> DataFrame:
    """``select`` run for i = 1..n (column ``token``), results UNIONed,
    i.e. distinct over all iterations (one iteration is the plain SELECT,
    duplicates kept, as there is no UNION). n < 1 counts as 1; a non-number
    is an error. One scan: each row is repeated by ``explode(sequence(1, n))``
    (no join, no n plan branches); ``distinct`` is partial-aggregated."""
    count = _count(n)
    if count == 1:  # a single SELECT: no UNION, so duplicates stay
        return select(df.withColumn(token, F.lit(1)))
    expanded = df.withColumn(token, F.explode(F.sequence(F.lit(1), F.lit(count))))
    return select(expanded).distinct()


def _count(n: int | str) -> int:
    try:
        return max(int(n), 1)
    except (TypeError, ValueError) as e:
        raise ValueError(f"iteration count is not a number: {n!r}") from e


def iterate_sql(spark, sql: str, n: int | str, token: str = "#{iterate}",
                args: dict | None = None) -> DataFrame:
    """O19 when the token names a table (or otherwise cannot be a column):
    the SELECT text is repeated for i = 1..n with the token replaced and the
    copies are glued with ``UNION`` (distinct), as the reference does. Each
    copy is its own plan branch, so prefer ``iterate_union`` whenever the
    token is a value, and ``iterate_paths`` where the tables are folders. Over
    SQL_COPIES copies are run so many at a time, each lot's distinct rows
    written, and the lots read in one scan. n < 1 counts as 1; a non-number is
    an error."""
    count = _count(n)

    def copies(first: int, last: int) -> DataFrame:
        return spark.sql(" UNION ".join(f"({sql.replace(token, str(i))})" for i in range(first, last + 1)), args=args)

    if count <= SQL_COPIES:
        return copies(1, count)
    root = scratch_path(spark, "iterate")
    lots = range(1, count + 1, SQL_COPIES)
    for first in lots:
        copies(first, min(first + SQL_COPIES - 1, count)).write.parquet(f"{root}/{first}")
    return spark.read.parquet(*[f"{root}/{first}" for first in lots]).distinct()


def iterate_paths(spark, path: str, n: int | str, select: Callable[[DataFrame], DataFrame], token: str = "#{iterate}",
                  iteration: str = "i", fmt: str = "parquet", schema=None) -> DataFrame:
    """O19 over many tables that are folders or files: ``path`` names table i
    through ``token``. One scan of all n paths, in which column ``iteration`` is
    read off each file's path; ``select`` is run over it, and the rows of all
    iterations are UNIONed (distinct; one iteration is the plain SELECT). A table
    that is missing is an error."""
    count = _count(n)
    before, found, after = path.rpartition(token)
    if not found or token in before:
        raise ValueError(f"{path!r} must hold {token!r} once")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load([path.replace(token, str(i)) for i in range(1, count + 1)])
    # the path's own segment, and the one before it, around the number
    lead = "/".join(before.split("/")[-2:])
    where = re.escape(lead) + r"([0-9]+)" + re.escape(after.rstrip("/")) + r"(?:/|$)"
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    out = select(df.withColumn(iteration, F.regexp_extract(at, where, 1).cast("int")))
    return out if count == 1 else out.distinct()
