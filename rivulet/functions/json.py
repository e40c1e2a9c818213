"""JSON Column builders."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import col_of


def row_json(df: DataFrame, cols: Iterable[str] | None = None, keep_nulls: bool = False) -> Column:
    """One JSON object per row; keys = column names, values = text.

    Null columns are left out (``to_json`` drops null fields); with
    ``keep_nulls`` they print as ``null``.
    """
    names = list(cols) if cols is not None else df.columns
    s = F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in names])
    if keep_nulls:
        return F.to_json(s, {"ignoreNullFields": "false"})
    return F.to_json(s)


def sorted_map(m: Column | str) -> Column:
    """Map with its entries in key order, so its JSON text is stable."""
    return F.map_from_entries(F.sort_array(F.map_entries(col_of(m))))


def map_json(m: Column | str, sort_keys: bool = True) -> Column:
    """Map → JSON object text (keys sorted unless told otherwise)."""
    return F.to_json(sorted_map(m) if sort_keys else col_of(m))


def is_json(c: Column | str) -> Column:
    """True when the text is one JSON element, of any size and with repeated
    names or not: it must be a single element of an array and the single
    member of an object (so brackets in the text cannot close the wrapping)."""
    c = col_of(c)
    in_array = F.json_array_length(F.concat(F.lit("["), c, F.lit("]"))) == 1
    in_object = F.size(F.json_object_keys(F.concat(F.lit('{"v":'), c, F.lit("}")))) == 1
    return F.coalesce(in_array & in_object, F.lit(False))


_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[{\]}:,]|[^\s"\[\]{}:,]+', re.S)


def member_text(text: str, name: str) -> str | None:
    """The text of a member's value in a JSON object, exactly as it stands there
    (numbers and escapes are not read); of repeated members the last one's.
    ``text`` must be a valid JSON object."""
    depth, key, start, end, found = 0, None, None, 0, None
    for m in _TOKEN.finditer(text):
        t = m.group()
        if depth == 1 and start is not None and t in ",}":
            if key == name:
                found = text[start:end]
            key = start = None
        elif depth == 1 and start is None and t == ":":
            start = -1
            continue
        elif depth == 1 and start is None and t[0] == '"':
            key = json.loads(t)
        if start == -1:
            start = m.start()
        end = m.end()
        depth += (t in "[{") - (t in "]}")
    return found


def json_member_text(c: Column | str, name: str) -> Column:
    """``member_text`` of a column of valid JSON objects (null stays null), in
    Arrow batches."""
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else member_text(x, name))

    return F.pandas_udf(cut, "string")(col_of(c))
