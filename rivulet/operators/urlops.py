"""URL query parameters over a table of URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions import urls as U
from rivulet.functions.text import col_of
from rivulet.operators.records import last_win, staged


def url_params(df: DataFrame, url: str, prefix: str = "", suffix: str = "", if_empty: str | None = None,
               out: str = "params", failed_col: str = "url_failed") -> DataFrame:
    """URL → map ``prefix+name+suffix`` → decoded value (a repeated
    name keeps its last value). No parameters and ``if_empty`` set → map
    ``{if_empty: "true"}``. A malformed URL (or a bad escape) is flagged in
    ``failed_col`` and gets a null map."""
    df = last_win(df)
    df, pairs = staged(df, "_pairs", U.url_pairs(url))
    m = U.last_wins_map(pairs, prefix, suffix)
    if if_empty:
        m = F.when(F.size(pairs) > 0, m).otherwise(F.create_map(F.lit(if_empty), F.lit("true")))
    failed = U.url_malformed(url) | F.exists(pairs, lambda p: p["key"].isNull() | p["value"].isNull())
    return df.withColumns({out: F.when(~failed, m), failed_col: failed}).drop("_pairs")


def url_param_rows(df: DataFrame, url: str, keep: Sequence[str]) -> DataFrame:
    """One row per parameter: ``keep`` columns, ``pos`` (from 1),
    ``key``, ``value`` (no ``=`` → ``""``)."""
    return (df.select(*keep, F.posexplode(U.url_pairs(url)).alias("_pos", "_p"))
            .select(*keep, (F.col("_pos") + 1).cast("long").alias("pos"),
                    F.col("_p.key").alias("key"), F.col("_p.value").alias("value")))


def url_param_multimap(df: DataFrame, url: str, out: str = "param_values") -> DataFrame:
    """Map name → all its values in order (per row, no shuffle)."""
    df, pairs = staged(df, "_pairs", U.url_pairs(url))
    return df.withColumn(out, F.when(pairs.isNotNull(), U.multimap(pairs))).drop("_pairs")


def url_param_first(df: DataFrame, url: str, key: str | Sequence[str], out: str | None = None) -> DataFrame:
    """The first value of ``key`` (or of each of several keys, one
    column each, from one parse of the URL), else null."""
    keys = [key] if isinstance(key, str) else list(key)
    if len(keys) == 1:
        return df.withColumn(out or keys[0], U.first_value(U.url_pairs(url), keys[0]))
    df, pairs = staged(df, "_pairs", U.url_pairs(url))
    return df.withColumns({k: U.first_value(pairs, k) for k in keys}).drop("_pairs")


def build_query_string(df: DataFrame, pairs: str, out: str = "query_string") -> DataFrame:
    """Pairs → form-encoded query string; null key or value → null."""
    return df.withColumn(out, U.to_query_string(col_of(pairs)))


def _uses(df: DataFrame, url: str, keep: Sequence[str]) -> DataFrame:
    """A row per parameter: ``keep``, key, value, and whether it is the name's
    first place in its row."""
    df, pairs = staged(df.select(*keep, url), "_pairs", U.url_pairs(url))
    names = F.transform(pairs, lambda p: p["key"])
    return df.select(*keep, names.alias("_names"), F.posexplode(pairs).alias("_pos", "_p")).select(
        *keep, F.col("_p.key").alias("key"), F.col("_p.value").alias("value"),
        (F.array_position("_names", F.col("_p.key")) == F.col("_pos") + 1).alias("_first"))


LG_K = 14           # of the sketches of distinct values: about 0.8 % of error (and next to none up to 2,000 values)
TOP_TRACKED = 1000  # values that a sketch of frequent values tracks


def url_param_sketches(df: DataFrame, url: str, part: str, lg_k: int = LG_K, tracked: int = TOP_TRACKED) -> DataFrame:
    """O32 in parts that are stored: per (part, parameter name) its occurrences
    and rows, a sketch of its distinct values (HyperLogLog) and one of its frequent
    values. A row of fixed size, however many URLs the part has; sketches of parts
    are merged by ``url_param_report``, so a report over many days reads no URL
    again and shuffles no value. A row of ``df`` belongs to one part."""
    return _uses(df, url, [part]).groupBy(part, "key").agg(
        F.count(F.lit(1)).alias("n_occurrences"), F.count_if("_first").alias("n_urls"),
        F.hll_sketch_agg("value", F.lit(lg_k)).alias("values_sketch"),
        F.expr(f"approx_top_k_accumulate(value, {int(tracked)})").alias("top_sketch"))


def url_param_report(sketches: DataFrame, k: int = 3, tracked: int = TOP_TRACKED) -> DataFrame:
    """O32 from stored parts: key, n_occurrences, n_urls (both exact), n_values
    (estimate) and top (the k most frequent values with their counts; exact while
    a name has at most ``tracked`` values)."""
    out = sketches.groupBy("key").agg(
        F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_urls").alias("n_urls"),
        F.hll_sketch_estimate(F.hll_union_agg("values_sketch")).alias("n_values"),
        F.expr(f"approx_top_k_combine(top_sketch, {int(tracked)})").alias("_top"))
    return out.withColumn("top", F.expr(f"approx_top_k_estimate(_top, {int(k)})")).drop("_top")


def url_param_stats(df: DataFrame, url: str, id_col: str, exact: bool = True) -> DataFrame:
    """Use of each parameter name over the table: occurrences, rows
    (URLs) using it, distinct values. A name's first place in its row counts
    the row, so only the values need a distinct. Partial aggregation map-side:
    a hot name costs one row per map task and value before the shuffle."""
    rows = _uses(df, url, [id_col])
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_occurrences"),
        F.count_if("_first").alias("n_urls"),
        distinct("value").alias("n_values"),
    )
