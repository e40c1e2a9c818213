"""Spelling variants: words one edit apart, found in bit-sliced indexes.

Two words are near if one inserted, deleted or replaced code point makes them
equal. A word's form is its near word with most occurrences, if that has twice
the word's own at least; following forms to the end gives its root.

**Index.** 64 words make a lane: for every position and letter one 64-bit set
says which words of the lane have that letter there. A query word runs along its
letters and keeps three sets for the whole lane at once: words equal so far (Z),
equal but for one replaced letter (S), and, read one position further on, equal
but for one more letter in them (I). One step is

    I = (I | Z) & T[p + 1, c];  S = (S & T[p, c]) | (Z & ~T[p, c]);  Z = Z & T[p, c]

Deletions are the insertions of the other word. numpy runs a step for many pairs
of query and lane together.

**Partitioning.** Not every word meets every word: words of lengths m and m or
m + 1 that are near agree in the first or in the last half of the shorter one
(m letters, cut at m // 2), so a word is dealt to four buckets: by either half,
as the shorter or as the longer one. A bucket of over ``HOT`` words is cut again,
and again, by halves of what is still open; with one open letter it has at most
90 shorter and 8,100 longer words, so no bucket is unbounded and no pair is lost.
A pair that agrees in both halves counts in the left one's bucket only.

Counting is one aggregation with partial sums before the shuffle, so frequent
words are no hot key; what follows is as large as the vocabulary. Roots are found
by pointer doubling: n at least doubles from form to form, which bounds the
rounds by log2(log2(largest n)).

Null and empty texts have no words; a null id prints as empty text in the hashed
``<id>:<run>``; repeated rows count again; an empty table gives no rows; other
columns are not read. A run of any length is one word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rivulet.llm import staged
from rivulet.llm.blocks import release

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 5
MIN_COUNT = 3
TYPO_MODULUS = 97          # of the contract: a run whose hash it divides loses a letter
RATIO = 2                  # a form has so many times the occurrences
HOT = 4096                 # words of a bucket that is not cut again
CHUNK_ROWS = 30_000        # rows of whole buckets that are worked off together
INDEX_BYTES = 32 << 20     # of one dense index
PAIRS = 1 << 19            # query and lane pairs that run together
LETTERS = 91               # codes: 0 no letter, 1-26 a-z, 27-90 U+00C0-U+00FF

_CODE = np.zeros(256, np.uint8)
_CODE[97:123] = np.arange(1, 27)
_CODE[0xC0:0x100] = np.arange(27, 91)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, typos: int = TYPO_MODULUS) -> DataFrame:
    """(word, n): the distinct runs, those whose hash ``typos`` divides with one
    letter deleted, of ``min_letters`` letters and ``min_count`` occurrences."""
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(f"`{text_col}`", _UPPER, _LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
    hashed = runs.select("run", h.alias("h"), F.length("run").alias("len"))
    at = (F.col("h") % F.col("len")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("len")))
    word = F.when(F.col("h") % typos == 0, damaged).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


# ------------------------------------------------------------------ buckets

def _key() -> Column:
    """What a word shares with the others of its bucket: the letters before
    ``lo`` and the last ``m - hi``."""
    tail = F.col("m") - F.col("hi")
    return F.concat_ws(":", "m", "lo", "hi", F.concat(
        F.substring("word", F.lit(1), F.col("lo")), F.lit("|"),
        F.when(tail > 0, F.substring("word", F.length("word") - tail + 1, tail)).otherwise(F.lit(""))))


def _halved(rows: DataFrame) -> DataFrame:
    """Each (word, n, m, lo, hi) in the buckets of the two halves of [lo, hi)."""
    mid = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")
    spans = F.array(F.struct(mid.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), mid.alias("hi")))
    out = rows.select("word", "n", "m", F.explode(spans).alias("s")).where("s.lo < s.hi")
    return out.select("word", "n", "m", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")).withColumn("key", _key())


def buckets(vocabulary: DataFrame, hot: int = HOT, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, n, m, lo, hi, key): the words in every bucket that they are dealt
    to; none of over ``hot`` words unless one letter is open."""
    length = F.length("word")
    as_short_or_long = F.explode(F.array(length, length - 1))
    rows = (vocabulary.select("word", F.col("n").cast("long").alias("n"), as_short_or_long.alias("m"))
            .where(F.col("m") >= min_letters))
    rows = _halved(rows.select("word", "n", "m", F.lit(0).alias("lo"), F.col("m").alias("hi")))
    done = None
    while True:
        sizes = rows.where("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > hot)
        large = staged.stage(sizes.select("key", F.lit(True).alias("large")), "spelling_hot")[0]
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        # (an equality join of many rows with a key's one: a hot key is split)
        marked = rows.join(large, "key", "left")
        kept = marked.where("large is null").select(*rows.columns)
        done = kept if done is None else done.unionByName(kept)
        rows = staged.stage(_halved(marked.where("large").drop("key", "large")), "spelling_halves")[0]


# ------------------------------------------------------------------ lanes

def _near_pairs(codes: np.ndarray, longer: np.ndarray, hi: np.ndarray, bucket: np.ndarray, m: int) -> Iterator[tuple]:
    """(query rows, word rows) of near pairs among the rows of one m, sorted by
    bucket; queries are words of length m, words of length m or m + 1."""
    n = len(bucket)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    size = np.diff(np.append(first, n))
    inside = np.arange(n) - np.repeat(first, size)
    lanes_of = (size + 63) // 64
    lane0 = np.cumsum(lanes_of) - lanes_of
    lane = np.repeat(lane0, size) + inside // 64
    bit = np.left_shift(np.uint64(1), (inside % 64).astype(np.uint64))
    n_lanes = int(lanes_of.sum())
    lane_bucket = np.repeat(np.arange(len(first)), lanes_of)
    lane_row = first[lane_bucket] + (np.arange(n_lanes) - lane0[lane_bucket]) * 64
    long_bits, short_bits = np.zeros(n_lanes, np.uint64), np.zeros(n_lanes, np.uint64)
    np.bitwise_or.at(long_bits, lane[longer], bit[longer])
    np.bitwise_or.at(short_bits, lane[~longer], bit[~longer])
    queries = np.flatnonzero(~longer)
    # queries of a bucket stand together: a range per bucket
    q_upto = np.searchsorted(queries, np.append(first, n))
    step = max(1, INDEX_BYTES // ((m + 2) * LETTERS * 8))
    for a in range(0, n_lanes, step):
        b = min(a + step, n_lanes)
        index = np.zeros((b - a, m + 2, LETTERS), np.uint64)
        lo, up = np.searchsorted(lane, [a, b])
        for p in range(m + 1):
            np.bitwise_or.at(index, (lane[lo:up] - a, p, codes[lo:up, p]), bit[lo:up])
        starts, counts = q_upto[lane_bucket[a:b]], np.diff(q_upto)[lane_bucket[a:b]]
        ends = np.cumsum(counts)
        for c in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            pair = np.arange(c, min(c + PAIRS, int(ends[-1])))
            of = np.searchsorted(ends, pair, side="right")      # lane of the pair
            q = queries[starts[of] + pair - (ends[of] - counts[of])]
            yield from _run(index, of, q, a, codes, hi, m, long_bits, short_bits, lane_row)


def _run(index, of, q, a, codes, hi, m, long_bits, short_bits, lane_row):
    zero = long_bits[a + of] | short_bits[a + of]
    one = np.zeros(len(q), np.uint64)       # one replaced letter
    more = np.zeros(len(q), np.uint64)      # one letter more in the word
    both = np.zeros(len(q), np.uint64)      # equal up to hi: in the left half's bucket
    end = hi[q]
    for p in range(m):
        c = codes[q, p]
        both = np.where(end == p, zero, both)
        here, next_ = index[of, p, c], index[of, p + 1, c]
        more = (more | zero) & next_
        one = (one & here) | (zero & ~here)
        zero = zero & here
    found = ((one & short_bits[a + of]) | ((more | zero) & long_bits[a + of])) & ~both
    some = np.flatnonzero(found)
    if len(some):
        bits = np.unpackbits(found[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, j = np.nonzero(bits)
        yield q[some[i]], lane_row[a + of[some[i]]] + j


def _best(words: list[str], n: np.ndarray, source: np.ndarray, near: np.ndarray) -> pa.RecordBatch | None:
    """A row per word with near ones: how many, and the one with the largest n
    (ties: the smallest)."""
    if not len(source):
        return None
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[near], -n[near], source))
    source, near = source[order], near[order]
    head = np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1]]))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in source[head]]), pa.array(np.diff(np.append(head, len(source)))),
         pa.array([words[i] for i in near[head]]), pa.array(n[near[head]])], ["word", "n_near", "near", "near_n"])


def near_in_buckets(words: list[str], n: np.ndarray, m: np.ndarray, hi: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch | None:
    """``_best`` over whole buckets (rows sorted by bucket, of one m each)."""
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    sources, nears = [], []
    for value in np.unique(m):
        rows = np.flatnonzero(m == value)
        b, longer = bucket[rows], lengths[rows] > value
        # a bucket needs a shorter word and another one
        _, inverse, count = np.unique(b, return_inverse=True, return_counts=True)
        shorts = np.bincount(inverse, ~longer, len(count))
        keep = ((count > 1) & (shorts > 0))[inverse]
        rows, b, longer = rows[keep], b[keep], longer[keep]
        if not len(rows):
            continue
        width = int(value) + 1
        text = b"".join(words[i].encode("latin-1").ljust(width, b"\0") for i in rows)
        codes = _CODE[np.frombuffer(text, np.uint8).reshape(-1, width)]
        for q, w in _near_pairs(codes, longer, hi[rows], b, int(value)):
            sources.append(rows[q])
            nears.append(rows[w])
            back = longer[w]
            sources.append(rows[w[back]])
            nears.append(rows[q[back]])
    if not sources:
        return None
    return _best(words, n, np.concatenate(sources), np.concatenate(nears))


def _matched(batches):
    """Sorted (key, word, n, m, hi) to rows of ``_best``, whole buckets at once."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def work(table: pa.Table):
        key = table.column("key").combine_chunks().dictionary_encode() if table.num_rows else None
        if key is None:
            return None
        key = key.combine_chunks() if isinstance(key, pa.ChunkedArray) else key
        column = lambda c: table.column(c).to_numpy()
        return near_in_buckets(table.column("word").to_pylist(), column("n"), column("m"), column("hi"), key.indices.to_numpy())

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < CHUNK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        # the last bucket may go on in the next batch
        keys = table.column("key")
        last, cut = keys[rows - 1].as_py(), rows - 1
        while cut and keys[cut - 1].as_py() == last:
            cut -= 1
        if cut:
            out = work(table.slice(0, cut))
            if out is not None:
                yield out
        held, rows = table.slice(cut).to_batches(), rows - cut
    if held:
        out = work(pa.Table.from_batches(held))
        if out is not None:
            yield out
    release()


def near_words(vocabulary: DataFrame, hot: int = HOT, ratio: int = RATIO, min_letters: int = MIN_LETTERS) -> DataFrame:
    """(word, n, form, n_near, form_n) of every word of (word, n)."""
    dealt = buckets(vocabulary, hot, min_letters).select("key", "word", "n", "m", "hi")
    found = (dealt.repartition("key").sortWithinPartitions("key")
             .mapInArrow(_matched, "word string, n_near long, near string, near_n long"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best")
    per = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    joined = vocabulary.join(per, "word", "left")
    strong = -F.col("best.minus") >= ratio * F.col("n")
    return joined.select("word", "n", F.when(strong, F.col("best.near")).alias("form"),
                         F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(strong, -F.col("best.minus")).alias("form_n"))


def with_roots(forms: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``forms`` plus root, by pointer doubling over the words that have a form."""
    top = forms.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.floor(math.log(top, ratio)))   # forms that can follow each other
    at = staged.stage(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling_roots")[0]
    for i in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        changed = Observation(f"spelling_{i}")
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(ahead, "root", "left").observe(changed, F.count("next").alias("n"))
        at = staged.stage(moved.select("word", F.coalesce("next", "root").alias("root")), "spelling_roots")[0]
        if not changed.get["n"]:
            break
    return forms.join(at, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    vocabulary = staged.stage(word_counts(docs, id_col, text_col), "spelling_words")[0]
    return with_roots(staged.stage(near_words(vocabulary, hot), "spelling_forms")[0])
