from pyspark.sql import functions as F

from rivulet.functions.text import java_trim
from rivulet.operators.lines import split_lines


def java_lines(text):
    """Brute force: a line reader (\\n, \\r, \\r\\n), Java trim, blanks dropped."""
    if text is None:
        return []
    out, cur, i = [], [], 0
    while i < len(text):
        ch = text[i]
        if ch == "\r":
            out.append("".join(cur)); cur = []
            if i + 1 < len(text) and text[i + 1] == "\n":
                i += 1
        elif ch == "\n":
            out.append("".join(cur)); cur = []
        else:
            cur.append(ch)
        i += 1
    if cur:
        out.append("".join(cur))
    trimmed = [ln.strip("".join(chr(c) for c in range(0x21))) for ln in out]
    return [ln for ln in trimmed if ln != ""]


TEXTS = [
    (1, "a\nb\n"),
    (2, "first\r\nsecond\r\n\r\nthird"),
    (3, "only\rcarriage\rreturns"),
    (4, "   \n\t\t\n \t \n"),
    (5, "  padded line \t\n\tx y  "),
    (6, ""),
    (7, None),
    (8, "no final newline"),
    (9, "line sep \n\x01ctl\x02"),
]


def test_split_lines_matches_line_reader(spark):
    df = spark.createDataFrame(TEXTS, "record_id long, content string")
    out = split_lines(df, "record_id", "content")
    rows = out["fragments"].collect()
    got = {}
    for r in rows:
        got.setdefault(r.record_id, []).append((r.fragment_index, r.fragment_count, r.line))
    for rid, text in TEXTS:
        want = java_lines(text)
        have = sorted(got.get(rid, []))
        assert [ln for _, _, ln in have] == want, rid
        assert [i for i, _, _ in have] == list(range(1, len(want) + 1))
        assert all(c == len(want) for _, c, _ in have)
    assert out["original"].count() == len(TEXTS)


def test_identifier_is_one_per_record(spark):
    df = spark.createDataFrame([(1, "a\nb\nc")], "record_id long, content string")
    frags = split_lines(df, "record_id", "content")["fragments"]
    assert frags.select("fragment_identifier").distinct().count() == 1
    rnd = split_lines(df, "record_id", "content", identifier="uuid")["fragments"]
    assert rnd.select("fragment_identifier").distinct().count() == 1


def test_java_trim_keeps_inner_and_non_ascii_space(spark):
    df = spark.createDataFrame([("\t a b \x00",), (" x ",)], "s string")
    assert [r[0] for r in df.select(java_trim("s")).collect()] == ["a b", " x "]


def test_blank_only_content_gives_no_fragment(spark):
    df = spark.createDataFrame([(1, " \t \r\n \n")], "record_id long, content string")
    assert split_lines(df, "record_id", "content")["fragments"].count() == 0
    assert df.select(F.lit(1)).count() == 1
