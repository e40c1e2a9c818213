"""Query-string Column builders.

A parsed query is an ``ARRAY<STRUCT<key STRING, value STRING>>`` in text
order. Everything is a higher-order function over that array, evaluated per
row inside whole-stage codegen: no shuffle is needed to group values by name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.functions.text import col_of


def raw_query(url: Column | str) -> Column:
    """The undecoded query part of a URL (null when absent or malformed)."""
    return F.try_parse_url(col_of(url), F.lit("QUERY"))


def url_malformed(url: Column | str) -> Column:
    """True when the text is not a URI (bad escape, illegal character...)."""
    u = col_of(url)
    # every URI has a path, if an empty one, or else (opaque) a scheme
    parts = [F.try_parse_url(u, F.lit(p)) for p in ("PATH", "PROTOCOL")]
    return u.isNotNull() & F.coalesce(*parts).isNull() & (u != F.lit(""))


def decode(c: Column) -> Column:
    """Form decoding: ``+`` is a space, ``%xx`` a UTF-8 byte; bad escape → null."""
    return F.try_url_decode(c)


def encode(c: Column) -> Column:
    """Form encoding: a space becomes ``+``."""
    return F.url_encode(c)


def query_pairs(qs: Column | str) -> Column:
    """Query string → ordered (key, value) pairs.

    A name without ``=`` has value ``""``; the value is everything after the
    first ``=``; empty pieces between ``&`` are skipped.
    """
    pieces = F.filter(F.split(col_of(qs), "&"), lambda p: p != F.lit(""))
    return F.transform(
        pieces,
        lambda p: F.struct(
            decode(F.substring_index(p, "=", 1)).alias("key"),
            F.when(F.instr(p, "=") > 0, decode(F.regexp_replace(p, "^[^=]*=", "")))
            .otherwise(F.lit("")).alias("value"),
        ),
    )


def url_pairs(url: Column | str) -> Column:
    """URL → ordered (key, value) pairs of its query (empty array if none)."""
    return F.coalesce(query_pairs(raw_query(url)), F.array().cast(
        "array<struct<key:string,value:string>>"))


def last_wins_map(pairs: Column, prefix: str = "", suffix: str = "") -> Column:
    """Pairs → map; a repeated name keeps its last value (``map_from_entries``
    under ``spark.sql.mapKeyDedupPolicy=LAST_WIN``, set by the operators);
    pairs with a null name are left out."""
    pairs = F.filter(pairs, lambda p: p["key"].isNotNull())
    if prefix or suffix:
        pairs = F.transform(pairs, lambda p: F.struct(F.concat(F.lit(prefix), p["key"], F.lit(suffix)).alias("key"),
                                                      p["value"].alias("value")))
    return F.map_from_entries(pairs)


def multimap(pairs: Column) -> Column:
    """Pairs → map name → all its values in order (a fold)."""
    start = F.create_map().cast("map<string,array<string>>")
    return F.aggregate(
        pairs, start,
        lambda acc, p: F.when(p["key"].isNull(), acc).otherwise(
            F.map_zip_with(acc, F.create_map(p["key"], F.array(p["value"])),
                           lambda k, a, b: F.concat(F.coalesce(a, F.array().cast("array<string>")),
                                                    F.coalesce(b, F.array().cast("array<string>"))))))


def first_value(pairs: Column, key: str) -> Column:
    """First value of a name, else null."""
    return F.get(F.filter(pairs, lambda p: p["key"] == F.lit(key)), 0)["value"]


def all_values(pairs: Column, key: str) -> Column:
    return F.transform(F.filter(pairs, lambda p: p["key"] == F.lit(key)), lambda p: p["value"])


def to_query_string(pairs: Column) -> Column:
    """Pairs → ``k=v&k2`` (form-encoded; an empty value prints the key
    alone); a null key or value makes the whole result null (rejected)."""
    text = F.array_join(
        F.transform(
            pairs,
            lambda p: F.concat(
                encode(p["key"]),
                F.when(p["value"] == F.lit(""), F.lit("")).otherwise(F.concat(F.lit("="), encode(p["value"]))),
            ),
        ),
        "&",
    )
    bad = F.exists(pairs, lambda p: p["key"].isNull() | p["value"].isNull())
    return F.when(~bad, text)
