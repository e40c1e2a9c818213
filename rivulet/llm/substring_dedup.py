"""Substring dedup over windows of words by super-k-mer partitioning.

A window is ``k`` consecutive words of one document. Its minimiser is the
smallest hash among its m-word grams, and consecutive windows with the same
minimiser form a super-k-mer: one packed string of their words that travels
to the minimiser's bucket. Equal windows have equal minimisers, so all their
occurrences meet in one part of one bucket (its parts are packed apart and
worked off one after another, so a task unpacks one at a time), where the windows are sorted by hash, compared
word for word, and all but the first occurrence (smallest document id, then
smallest start) are repeats.

What returns to the documents are the runs of first occurrences; every other
window is a repeat. That keeps the answer linear in the input however often a
passage occurs, since copies are merged before they travel: equal super-k-mers
of a block are sent once, with their first occurrence.

A minimiser that is frequent over the whole corpus (a common line in many
different surroundings) would fill one bucket. A first pass counts minimisers
in hashed cells; the windows of those that hold a share of a bucket travel
alone, each to the bucket of its own hash. Cells can only overrate, which moves
windows to other buckets but never changes the result.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import blocks as B

K = 20                        # words in a window
M = 3                         # words in a gram
BUCKET_BYTES = 40 << 20       # packed text that one bucket gets (compressed while it waits)
SUBS = 8                      # parts of a bucket, by minimiser too, that are worked off one after another
DOC_BUCKET_BYTES = 12 << 20   # text of the documents that are put together again at once
BLOCK_BYTES = 3 << 20         # text whose super-k-mers are merged and sent at once
COMPARED = 1 << 14            # windows that are compared word for word at once
LEVEL = 3                     # of zstd
LEAST_CELLS = 1 << 16         # counters of frequent minimisers; 16 a bucket if that is more
NULL_ID = -(1 << 63)          # a null id sorts before all others

GRAM_BASE = 0xA0761D6478BD642F
WINDOW_BASE = 0xE7037ED1A0B428DB


class Windows:
    """Words, windows and minimisers of a block of texts."""

    def __init__(self, texts: list[bytes], k: int, m: int):
        raw, first = B.joined(texts)
        space = B.SPACE[raw]
        keep = ~(space & np.concatenate([[True], space[:-1]]))  # one space between words
        self.buf = np.where(space, np.uint8(32), raw)[keep]
        place = np.zeros(len(first), np.int64)  # of each text's first byte among the kept ones
        if len(texts):
            np.cumsum(np.add.reduceat(keep, first[:-1], dtype=np.int64), out=place[1:])
        del raw, space, keep
        self.text = self.buf.tobytes()
        self.start, self.end = B.word_spans(self.buf)
        self.first_word = np.searchsorted(self.start, place)  # of each text
        self.hash = B.range_hashes(self.buf, B.BYTE_BASE, self.start, self.end)
        self.windows(k, m)

    def windows(self, k: int, m: int) -> None:
        n = len(self.start)
        grams = np.arange(max(0, n - m + 1))
        minima = B.sliding_min(B.range_hashes(self.hash, GRAM_BASE, grams, grams + m), k - m + 1) if n >= k else np.zeros(0, np.uint64)
        del grams
        doc = np.repeat(np.arange(len(self.first_word) - 1, dtype=np.int32), np.diff(self.first_word))
        at = np.flatnonzero(doc[: max(0, n - k + 1)] == doc[k - 1:]) if n >= k else np.zeros(0, np.int64)
        self.at = at                      # first words of the windows
        self.minimiser = minima[at]


def _hot_cells(docs: DataFrame, k: int, m: int, n_buckets: int) -> np.ndarray:
    """Which cells of minimisers hold more than a quarter of a bucket's share
    of all super-k-mers (some of half that share as well, none is missed).

    A task reports its cells with a quarter of that share of its own
    super-k-mers, so it sends a bounded number of rows; what it leaves out of
    a cell over all tasks is less than a quarter of the share.
    """
    n_cells = max(LEAST_CELLS, 1 << int(16 * n_buckets - 1).bit_length())
    share = 4 * n_buckets

    def count(batches):
        total = np.zeros(n_cells, np.int64)
        for batch in batches:
            texts = B.texts_of(batch.column(0))
            for a, b in B.text_blocks(texts):
                mini = _runs(Windows(texts[a:b], k, m))[2]
                total += np.bincount(_cell(mini, n_cells), minlength=n_cells)
        mine = int(total.sum())
        cells = np.flatnonzero(total * share * 4 > mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1)), pa.array(np.append(total[cells], mine))], ["cell", "n"])
        B.release()

    table = (docs.select("text").mapInArrow(count, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())  # n_cells + 1 rows at most
    cells, n = table["cell"].to_numpy(), table["n"].to_numpy()
    total = int(n[cells == -1].sum())
    hot = np.zeros(n_cells, bool)
    hot[cells[(cells >= 0) & (n > max(64, total // share // 2))]] = True
    return hot


def _cell(minimiser: np.ndarray, n_cells: int) -> np.ndarray:
    return (minimiser & np.uint64(n_cells - 1)).astype(np.int64)


def _runs(w: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: the first and the last window (their first words), and
    the minimiser."""
    if not len(w.at):
        return w.at, w.at, w.minimiser
    new = np.concatenate([[True], (w.minimiser[1:] != w.minimiser[:-1]) | (w.at[1:] != w.at[:-1] + 1)])
    a = np.flatnonzero(new)
    last = np.concatenate([a[1:] - 1, [len(w.at) - 1]])
    return w.at[a], w.at[last], w.minimiser[a]


def _packed(parts: list[bytes], *arrays: np.ndarray) -> bytes:
    """One compressed value of strings and columns of (sorted) numbers."""
    body = b"\n".join(parts)
    head = np.array([len(body), len(arrays[0]), len(arrays)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(
        head + body + b"".join(np.diff(x, prepend=x.dtype.type(0)).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
                               for x in arrays))


def _unpacked(value: bytes) -> tuple[bytes, list[np.ndarray]]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    size, n, k = np.frombuffer(raw, "<i8", 3)
    cols = np.frombuffer(raw, np.uint8, offset=24 + size).reshape(k, 8, n)
    return raw[24:24 + size], [np.cumsum(np.ascontiguousarray(c.T).view("<i8").ravel()) for c in cols]


def _send(batches, k: int, m: int, hot_cells: np.ndarray, n_buckets: int):
    """Super-k-mers of a partition, packed by bucket: (bucket, subs, packed), a
    packed value for each part of the bucket that has any."""
    def flush(texts, ids, ties):
        w = Windows(texts, k, m)
        first, last, mini = _runs(w)
        hot = hot_cells[_cell(mini, len(hot_cells))]
        cover = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(cover, first[hot], 1)
        np.add.at(cover, last[hot] + 1, -1)
        single = w.at[np.cumsum(cover)[w.at] > 0]  # all windows of the hot runs, one by one
        a = np.concatenate([first[~hot], single])
        z = np.concatenate([last[~hot], single])
        key = np.concatenate([mini[~hot], B.range_hashes(w.hash, WINDOW_BASE, single, single + k)])
        bucket = B.mix(key ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(n_buckets * SUBS)
        doc = np.searchsorted(w.first_word, a, side="right") - 1
        start = a - w.first_word[doc]
        order = np.lexsort((start, ties[doc], ids[doc], bucket))
        text = w.text
        lo, hi = w.start[a[order]].tolist(), w.end[z[order] + k - 1].tolist()
        bucket, doc, start = bucket[order], doc[order], start[order]
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            seen: dict[bytes, int] = {}
            for i in range(x, y):  # the first of equal strings is the earliest
                seen.setdefault(text[lo[i]:hi[i]], i)
            at = np.fromiter(seen.values(), np.int64, len(seen))
            yield int(bucket[x]), _packed(list(seen), ids[doc[at]], ties[doc[at]], start[at])

    def flushed(texts, ids, ties):
        rows: dict[int, tuple[list, list]] = {}
        for part, value in flush(texts, np.array(ids, np.int64), np.array(ties, np.int64)):
            subs, packed = rows.setdefault(part // SUBS, ([], []))
            subs.append(part % SUBS)
            packed.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(rows), pa.int64()), pa.array([r[0] for r in rows.values()], pa.list_(pa.int32())),
             pa.array([r[1] for r in rows.values()], pa.list_(pa.binary()))], ["bucket", "subs", "packed"])

    texts, ids, ties, size = [], [], [], 0
    for batch in batches:
        for i, tie, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), B.texts_of(batch.column(2)), strict=True):
            texts.append(t)
            ids.append(NULL_ID if i is None else i)
            ties.append(tie)
            size += len(t)
            if size >= BLOCK_BYTES:
                yield flushed(texts, ids, ties)
                texts, ids, ties, size = [], [], [], 0
    yield flushed(texts, ids, ties)
    B.release()


class _Packed(Windows):
    """Windows of unpacked super-k-mers (a newline ends each)."""

    def __init__(self, bodies: list[bytes], k: int, m: int):
        self.text = b"\n".join([*bodies, b""])
        self.buf = np.frombuffer(self.text, np.uint8)
        self.start, self.end = B.word_spans(self.buf)
        self.hash = B.range_hashes(self.buf, B.BYTE_BASE, self.start, self.end)
        self.first_word = np.searchsorted(self.start, np.concatenate([[0], np.flatnonzero(self.buf == 10) + 1]))
        n = len(self.start)
        item = np.repeat(np.arange(len(self.first_word) - 1, dtype=np.int32), np.diff(self.first_word))
        self.at = np.flatnonzero(item[: max(0, n - k + 1)] == item[k - 1:]) if n >= k else np.zeros(0, np.int64)
        self.item = item[self.at]
        self.window_hash = B.range_hashes(self.hash, WINDOW_BASE, self.at, self.at + k)


def _first_occurrences(packed: Iterable[bytes], k: int, m: int):
    """Runs of windows that occur for the first time: (id, tie, start, length)
    arrays, from all super-k-mers of one bucket."""
    seen: dict[bytes, int] = {}
    cols = [[], [], []]
    parts: list[bytes] = []
    for value in packed:  # (any iterable)
        body, got = _unpacked(value)
        parts += body.split(b"\n")
        for c, g in zip(cols, got, strict=True):
            c.append(g)
    ids, ties, starts = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
    order = np.lexsort((starts, ties, ids))  # so are the windows, since super-k-mers do not overlap
    for i in order.tolist():
        seen.setdefault(parts[i], i)
    at = np.fromiter(seen.values(), np.int64, len(seen))
    ids, ties, starts = ids[at], ties[at], starts[at]
    parts = list(seen)
    del seen, cols, order
    w = _Packed(parts, k, m)
    del parts
    hashes = w.window_hash
    if not len(hashes):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    rank = np.argsort(hashes, kind="stable")
    new = np.ones(len(hashes), bool)
    ranked = hashes[rank]
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    del ranked
    fresh = np.zeros(len(hashes), bool)
    fresh[rank[new]] = True
    later = np.flatnonzero(~new)
    leader = rank[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))[later]]  # the earliest of each hash
    others: dict[bytes, int] = {}
    for x in range(0, len(later), COMPARED):  # word for word; different words under one hash stay apart
        mine, lead = rank[later[x:x + COMPARED]], leader[x:x + COMPARED]
        text, spans = w.text, [a.tolist() for i in (mine, lead) for a in (w.start[w.at[i]], w.end[w.at[i] + k - 1])]
        for i, a, z, b, y in zip(mine.tolist(), *spans, strict=True):
            s = text[a:z]
            if s != text[b:y] and others.setdefault(s, i) == i:
                fresh[i] = True
    item, offset = w.item, w.at - w.first_word[w.item]
    got = np.flatnonzero(fresh)
    if not len(got):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    cut = np.concatenate([[True], (item[got][1:] != item[got][:-1]) | (offset[got][1:] != offset[got][:-1] + 1)])
    a = np.flatnonzero(cut)
    length = np.diff(np.concatenate([a, [len(got)]]))
    i = item[got[a]]
    return ids[i], ties[i], starts[i] + offset[got[a]], length


def _part(table: pa.Table, sub: int) -> Iterable[bytes]:
    """The packed values of one part of a bucket, one at a time (nothing of the
    other parts is copied)."""
    for subs, packed in zip(table["subs"].chunks, table["packed"].chunks, strict=True):
        values = packed.flatten()
        for i in np.flatnonzero(subs.flatten().to_numpy() == sub).tolist():
            yield values[i].as_py()


def _bucket_runs(table: pa.Table, k: int, m: int) -> tuple[np.ndarray, ...]:
    """The runs of first occurrences of all parts of a bucket."""
    parts = []
    for sub in range(SUBS):  # what a part unpacks to is gone before the next
        parts.append(_first_occurrences(_part(table, sub), k, m))
        B.release()
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _home(ids: np.ndarray, ties: np.ndarray, n: int) -> np.ndarray:
    """The bucket in which a document is put together again."""
    return (B.mix(ids.view(np.uint64) ^ B.mix(ties.view(np.uint64))) % np.uint64(n)).astype(np.int64)


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, m: int = M,
                   carry: tuple[str, ...] = (), as_is: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_text (the
    words that stay, joined by one space; with ``as_is`` the text itself, null
    too, where no word goes) and the ``carry`` columns, prefixed ``x_``.

    A word is removed when a window over it also starts earlier: in a smaller
    id, or earlier in the same document. Windows are judged on the input. Null
    and empty texts have no words; texts below ``k`` words lose none. A null
    id sorts before all others. Rows that repeat id and text are one document
    (both stay as they are, judged alike); rows that share an id only are
    ordered by a hash of the text. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"),
        F.col(text_col).alias("text"),
        *[F.col(f"`{c}`").alias(f"x_{c}") for c in carry])
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n_buckets = max(16, -(-size * 3 // BUCKET_BYTES))
    n_docs = max(16, -(-size // DOC_BUCKET_BYTES))
    shared = spark.sparkContext.broadcast(_hot_cells(rows, k, m, n_buckets))  # one byte a cell

    def send(batches):
        yield from _send(batches, k, m, shared.value, n_buckets)

    def first(table: pa.Table) -> pa.Table:
        found = _bucket_runs(table, k, m)
        home = _home(found[0], found[1], n_docs)
        order = np.lexsort((found[2], found[1], found[0], home))
        home, found = home[order], [x[order] for x in found]
        edges = np.flatnonzero(np.concatenate([[True], home[1:] != home[:-1], [True]])) if len(home) else [0]
        out = [(int(home[x]), _packed([], *[f[x:y] for f in found]))
               for x, y in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table({"home": pa.array([o[0] for o in out], pa.int64()), "runs": pa.array([o[1] for o in out], pa.binary())})

    runs = (
        rows.select("id", "tie", "text").mapInArrow(send, "bucket long, subs array<int>, packed array<binary>")
        .groupBy("bucket").applyInArrow(first, "home long, runs binary")
    )

    @F.arrow_udf("long")
    def home_of(ids: pa.Array, ties: pa.Array) -> pa.Array:
        return pa.array(_home(ids.fill_null(NULL_ID).to_numpy(zero_copy_only=False), ties.to_numpy(zero_copy_only=False), n_docs))

    @F.arrow_udf("binary")
    def packed_text(texts: pa.Array) -> pa.Array:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        return pa.array([None if t is None else pack(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())

    extra = [f for f in rows.schema.fields if f.name.startswith("x_")]
    schema = "id long, n_words long, n_removed long, kept_text string" + "".join(
        f", `{f.name}` {f.dataType.simpleString()}" for f in extra)

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = [_unpacked(v)[1] for v in right["runs"].to_pylist()]
        ids, ties, starts, length = ([np.concatenate(c) for c in zip(*cols, strict=True)] if cols
                                     else [np.zeros(0, np.int64)] * 4)
        order = np.lexsort((starts, ties, ids))
        ids, ties, starts, length = ids[order], ties[order], starts[order], length[order]
        want = left["id"].combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        lo, hi = np.searchsorted(ids, want), np.searchsorted(ids, want, side="right")
        n_words, n_removed, kept = [], [], []
        for i, (t, tie) in enumerate(zip(left["packed"].to_pylist(), left["tie"].to_pylist(), strict=True)):
            whole = None if t is None else zstandard.ZstdDecompressor().decompress(t)
            t = whole or b""
            own = ties[lo[i]:hi[i]] == tie
            spans = starts[lo[i]:hi[i]][own], length[lo[i]:hi[i]][own]
            words, stay = _stay(t, *spans, k)
            n_words.append(len(words))
            n_removed.append(len(words) - len(stay))
            if as_is and len(words) == len(stay):
                kept.append(whole)
            else:
                kept.append(b" ".join([t[x:y] for x, y in words[stay].tolist()]))
        out = pa.table([
            left["id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()), *[left[f.name] for f in extra],
        ], ["id", "n_words", "n_removed", "kept_text", *[f.name for f in extra]])
        del kept
        B.release()
        return out

    return (
        rows.withColumn("home", home_of("id", "tie")).withColumn("packed", packed_text("text")).drop("text").groupBy("home")
        .cogroup(runs.groupBy("home")).applyInArrow(put_together, schema)
        .withColumnRenamed("id", id_col)
    )


def _stay(text: bytes, starts: np.ndarray, lengths: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans of all words, and the words that stay: those under no window
    outside the runs of first occurrences."""
    a, z = B.word_spans(np.frombuffer(text, np.uint8))
    n = len(a)
    gone = np.zeros(n, bool)
    if n >= k:
        mark = np.zeros(n - k + 2, np.int64)
        np.add.at(mark, starts, 1)
        np.add.at(mark, starts + lengths, -1)
        at = np.flatnonzero(np.cumsum(mark[:-1]) == 0)
        cover = np.zeros(n + 1, np.int64)
        cover[at] += 1
        cover[at + k] -= 1
        gone = np.cumsum(cover[:-1]) > 0
    return np.stack([a, z], 1), np.flatnonzero(~gone)


def kept_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of ``documents``."""
    return repeated_words(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``documents`` without repeated passages: a text that lost words becomes
    its kept words joined by one space (n_chars follows); every other row is
    unchanged."""
    cols = docs.columns
    # a text travels once, packed, and comes back as it is or without its repeats
    found = repeated_words(docs, carry=tuple(c for c in cols if c != "text"), as_is=True)
    chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("x_n_chars"))
    new = {"text": F.col("kept_text"), "n_chars": chars}
    return found.select(*[new.get(c, F.col(f"x_{c}")).alias(c) for c in cols])

