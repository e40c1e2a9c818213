"""Text helpers as Column expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour:
#  - line breaks are "\r\n", "\r" or "\n" (a line reader's rule);
#  - trimming removes every character up to U+0020 at both ends (SQL trim
#    only removes spaces, so tabs and control characters need a pattern).
LINE_BREAK = r"\r\n|\r|\n"
TRIM_CHARS = "".join(chr(i) for i in range(0x21))   # U+0000 .. U+0020


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c: Column | str) -> Column:
    """Remove every character up to U+0020 from both ends (``btrim``)."""
    return F.btrim(col_of(c), F.lit(TRIM_CHARS))


def split_lines(c: Column | str) -> Column:
    """Text → array of lines (no terminator)."""
    return F.split(col_of(c), LINE_BREAK)


def non_blank_trimmed_lines(c: Column | str) -> Column:
    """Text → array of trimmed, non-blank lines, in order.

    ``split`` on the line breaks, ``btrim`` each line (it scans inwards from
    both ends only; a trim pattern would be tried at every character of long
    texts), then ``array_remove`` the empty ones.
    """
    return F.array_remove(F.transform(split_lines(c), java_trim), "")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(F.octet_length(col_of(c)) == 0, F.lit(True))
