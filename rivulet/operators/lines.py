"""Text → one record per non-blank, trimmed line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import non_blank_trimmed_lines


def split_lines(df: DataFrame, id_col: str, content: str = "content", identifier: str = "hash",
                keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Lines split on ``\\r\\n``, ``\\r`` or ``\\n``; blank lines dropped
    *before* numbering and counting. Outputs: ``fragments`` (``id_col``,
    kept columns, ``fragment_identifier``, ``fragment_index`` from 1,
    ``fragment_count``, ``line``) and ``original`` (the input, untouched).

    ``identifier="hash"`` gives a repeatable id (SHA-256 of the record id);
    ``"uuid"`` a random one per record, as the reference does.
    """
    lines = non_blank_trimmed_lines(content)
    ident = (F.sha2(F.col(id_col).cast("string"), 256) if identifier == "hash"
             else F.expr("uuid()"))
    staged = df.select(id_col, *keep, ident.alias("fragment_identifier"), lines.alias("_lines"))
    frags = staged.select(
        id_col, *keep, "fragment_identifier",
        F.size("_lines").cast("long").alias("fragment_count"),
        F.posexplode("_lines").alias("_pos", "line"),
    ).select(id_col, *keep, "fragment_identifier", (F.col("_pos") + 1).cast("long").alias("fragment_index"),
             "fragment_count", "line")
    return {"fragments": frags, "original": df}
