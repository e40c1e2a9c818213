"""Document fingerprints: a digest of improbable features.

A feature is a window of 64 bytes. Windows are ranked by how rare their
entropy is: a first pass counts, over all documents, how often each entropy
value (in thousandths of the 6 bits that 64 bytes can reach) occurs; the rarer
the value, the lower the rank. Every run of 64 neighbouring windows votes for
its lowest-ranked one, and a window with enough votes is a selected feature.
Selected features are inserted into Bloom filters of 2048 bits, chained: a
filter that holds 160 features is followed by the next one.

Two digests are alike by the bits their filters share, normalised so that the
overlap expected by chance is 0 and full overlap is 1.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm import blocks as B

WINDOW = 64
VOTES = 16            # of 64 runs that see a window
BITS = 2048           # a filter's
FEATURES = 160        # that one filter holds
HASHES = 5
SCALE = 1000
FEATURE_BASE = 0xD6E8FEB86659FD93
BLOCK_BYTES = 1 << 18
RANGES = 3            # ranges of ids per task
NULL_ID = -(1 << 63)  # a null id is the smallest

_C = np.arange(WINDOW + 2, dtype=np.float64)
# c * log2(c), scaled to integers so that sums are exact
_CLOG = np.round(_C * np.log2(np.maximum(_C, 1)) * (1 << 20)).astype(np.int64)
_STEP = np.concatenate([[0], np.diff(_CLOG)])   # what the c-th equal byte adds


def entropies(buf: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that lie inside one text of a block: their first bytes and
    their entropies (0 to SCALE).

    ``first`` has the texts' first bytes and the total. The sum of c log c over
    a window's byte counts c is a difference of two prefix sums: what each
    byte adds on entering, by its count among the 63 bytes before it, and what
    it takes along on leaving, by its count among the 63 bytes after it.
    """
    n = len(buf)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[: max(0, n - WINDOW + 1)] == text[WINDOW - 1:]) if n >= WINDOW else np.zeros(0, np.int64)
    if not len(at):
        return at, np.zeros(0, np.int64)
    kind = np.int32 if n < 1 << 22 else np.int64
    order = np.argsort(buf, kind="stable").astype(kind)
    key = buf[order].astype(kind) * kind(n + 2 * WINDOW) + order   # sorted: by byte, then place
    i = np.arange(n)
    ahead, behind = np.empty(n, np.int32), np.empty(n, np.int32)
    behind[order] = i - np.searchsorted(key, key - kind(WINDOW - 1)) + 1
    ahead[order] = np.searchsorted(key, key + kind(WINDOW - 1), side="right") - i
    enter = np.concatenate([[0], np.cumsum(_STEP[behind])])
    leave = np.concatenate([[0], np.cumsum(_STEP[ahead])])
    # A window from a: all that entered up to its end, less all that had left
    # before its start. Both sums run over the whole block.
    total = enter[at + WINDOW] - leave[at]
    whole = 6.0 - total / ((1 << 20) * WINDOW)
    return at, np.clip(np.floor(whole * (SCALE / 6.0)), 0, SCALE).astype(np.int64)


def selected(buf: np.ndarray, first: np.ndarray, rank: np.ndarray, always: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of the selected features of a block of texts. A
    text below one window is one feature, all of it; an empty one has none.
    ``always``: a text without a window of VOTES votes has the one with the
    most (of equals the lowest rank, the leftmost)."""
    at, entropy = entropies(buf, first)
    text = np.searchsorted(first, at, side="right") - 1
    if len(at):
        # the lowest rank wins, the leftmost of equals; windows of other texts never
        place = (rank[entropy].astype(np.int64) << 40) | np.arange(len(at))
        best = B.sliding_min(place, WINDOW) if len(at) >= WINDOW else np.zeros(0, np.int64)
        inside = text[: len(best)] == text[len(text) - len(best):]
        votes = np.bincount(best[inside] & ((1 << 40) - 1), minlength=len(at))
        n = np.bincount(text, minlength=len(first) - 1)
        begin, n = (np.cumsum(n) - n)[n > 0], n[n > 0]
        most = np.maximum.reduceat(votes, begin)
        few = (most < VOTES) & (always | (n < WINDOW))  # less than 64 windows are one run of their own
        top = np.where(votes == np.repeat(most, n), place, np.iinfo(np.int64).max)
        votes[np.minimum.reduceat(top, begin)[few] & ((1 << 40) - 1)] = VOTES
        chosen = np.flatnonzero(votes >= VOTES)
    else:
        chosen = np.zeros(0, np.int64)
    short = np.flatnonzero((np.diff(first) < WINDOW) & (np.diff(first) > 0))
    starts = np.concatenate([at[chosen], first[short]])
    ends = np.concatenate([at[chosen] + WINDOW, first[short + 1]])
    owner = np.concatenate([text[chosen], short])
    order = np.argsort(starts, kind="stable")
    owner, starts, ends = owner[order], starts[order], ends[order]
    return owner, starts, B.range_hashes(buf, FEATURE_BASE, starts, ends)


def digest(hashes: np.ndarray) -> np.ndarray:
    """Chained filters (one row of bytes each) of a text's features in order.
    A feature that the running filter already holds is not inserted again."""
    _, seen = np.unique(hashes, return_index=True)
    h = hashes[np.sort(seen)]
    out = np.zeros((-(-len(h) // FEATURES), BITS), bool)
    for j in range(HASHES):
        out[np.arange(len(h)) // FEATURES, ((h >> np.uint64(11 * j)) % np.uint64(BITS)).astype(np.int64)] = True
    return np.packbits(out, axis=1)


def written(filters: np.ndarray) -> str:
    """A digest as text: the number of filters and their bytes."""
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def read(text: str) -> np.ndarray:
    n, _, body = text.partition(":")
    return np.frombuffer(base64.b64decode(body), np.uint8).reshape(int(n), BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 (no more in common than by chance) to 1: each filter of the shorter
    digest against its best counterpart, weighted by its bits. Two empty
    digests are alike, an empty one is like no other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(b) < len(a) or len(a) == len(b) and b.tobytes() < a.tobytes():
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(1, dtype=np.float64), np.bitwise_count(b).sum(1, dtype=np.float64)
    score = np.zeros(len(a))
    for i, row in enumerate(a):
        both = np.bitwise_count(row & b).sum(1, dtype=np.float64)
        least, chance = np.minimum(na[i], nb), na[i] * nb / BITS
        score[i] = np.clip((both - chance) / np.maximum(least - chance, 1e-9), 0, 1).max()
    return float((score * na).sum() / na.sum())


def entropy_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Rank of each entropy value (0: the rarest that occurs), from all
    windows of all documents. Values that say little (below a tenth of the
    scale: runs of one byte) come last."""

    def count(batches):
        total = np.zeros(SCALE + 1, np.int64)
        for batch in batches:
            texts = B.texts_of(batch.column(0))
            for a, b in B.text_blocks(texts, BLOCK_BYTES):
                total += np.bincount(entropies(*_ended(texts[a:b]))[1], minlength=SCALE + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SCALE + 1)), pa.array(total)], ["e", "n"])

    rows = docs.select(text_col).mapInArrow(count, "e long, n long").groupBy("e").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(SCALE + 1, np.int64)
    n[rows["e"].to_numpy()] = rows["n"].to_numpy()
    low = np.arange(SCALE + 1) < SCALE // 10
    rank = np.empty(SCALE + 1, np.int64)
    rank[np.lexsort((np.arange(SCALE + 1), n, low))] = np.arange(SCALE + 1)
    return rank


def fingerprints(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Digests of whole texts."""
    out = []
    for a, b in B.text_blocks(texts, BLOCK_BYTES):
        owner, _, hashes = selected(*_ended(texts[a:b]), rank, always=True)
        edge = np.searchsorted(owner, np.arange(b - a + 1))
        out += [digest(hashes[x:y]) for x, y in zip(edge[:-1], edge[1:], strict=True)]
    return out


def _ended(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=first[1:])
    return np.frombuffer(b"".join(texts), np.uint8), first


def with_next(docs: DataFrame, id_col: str, text_col: str, fn, schema: str) -> DataFrame:
    """Apply ``fn(batches)`` to batches of (id, text, next_id, next_text), the
    next document being the one of the next smaller id (after the smallest:
    the largest). Ids are dealt out in ranges; the first document of each
    range also goes to the range before it. Rows that repeat an id are ordered
    by their text; null ids come last."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = RANGES * tasks
    at = [i / parts for i in range(1, parts)]
    cuts = np.array(sorted(set(ids.select(F.percentile_approx("id", at, 10 * parts)).first()[0] or [])), np.int64)

    def range_of(column: pa.Array) -> np.ndarray:  # 0 has the largest ids
        found = len(cuts) - np.searchsorted(cuts, column.fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        return found

    @F.arrow_udf("int")
    def part_of(column: pa.Array) -> pa.Array:
        return pa.array(range_of(column), pa.int32())

    heads = np.full(len(cuts) + 1, NULL_ID)  # the largest id of each range in use
    before = np.full(len(cuts) + 1, -1)
    used = sorted((r["part"], r["id"]) for r in
                  ids.groupBy(part_of("id").alias("part")).agg(F.coalesce(F.max("id"), F.lit(NULL_ID)).alias("id")).collect())
    for i, (part, largest) in enumerate(used):
        heads[part], before[part] = largest, used[i - 1][0]  # before the first range: the last

    @F.arrow_udf("array<int>")
    def places(column: pa.Array) -> pa.Array:
        """Twice the row's range; for a range's first row also twice the
        range before it plus 1."""
        mine = range_of(column)
        head = column.fill_null(NULL_ID).to_numpy(zero_copy_only=False) == heads[mine]
        ends = np.concatenate([[0], np.cumsum(1 + head)])
        out = np.empty(ends[-1], np.int32)
        out[ends[:-1]] = 2 * mine
        out[ends[1:][head] - 1] = 2 * before[mine[head]] + 1
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))

    dealt = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
        .withColumn("go", F.explode(places("id")))
        .select(F.expr("go div 2").cast("int").alias("part"), (F.col("go") % 2).alias("tail"), "id", "t")
        .repartition(tasks, "part")
        .sortWithinPartitions("part", "tail", F.col("id").desc_nulls_last(), "t")
    )
    return dealt.mapInArrow(fn, schema)


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many of
    the next document's first ones, or all."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Whole texts, null is empty. Equal texts have equal fingerprints. Texts of
    less than 128 bytes have one feature, longer ones one at least; empty ones none (their digest is
    "0:", like each other's only). A single document is its own next one. An
    empty table gives an empty table.
    """
    B.small_batches(docs.sparkSession)
    rank = docs.sparkSession.sparkContext.broadcast(entropy_ranks(docs, text_col))  # SCALE + 1 numbers

    def work(batches):
        # Rows come in order; a row is answered when the next one is known.
        def answer(group):
            texts = [g[2] for g in group]
            edited = [edited_text(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
            marks = fingerprints([t.encode() for t in [*texts, *edited]], rank.value)
            plain, changed = marks[:len(texts)], marks[len(texts):]
            keep = [i for i in range(len(edited)) if group[i][1] == 0 and group[i][0] == group[i + 1][0]]
            return pa.RecordBatch.from_arrays([
                pa.array([group[i][3] for i in keep], pa.int64()),
                pa.array([len(texts[i]) for i in keep], pa.int64()),
                pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
                pa.array([written(plain[i]) for i in keep], pa.string()),
                pa.array([written(changed[i]) for i in keep], pa.string()),
                pa.array([likeness(plain[i], changed[i]) for i in keep], pa.float64()),
                pa.array([likeness(plain[i], plain[i + 1]) for i in keep], pa.float64()),
            ], ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        group, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(3), batch.column(2))], strict=True):
                group.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES and len(group) > 1:
                    yield answer(group)
                    group, size = group[-1:], len(group[-1][2])
        if len(group) > 1:
            yield answer(group)

    return with_next(
        docs, id_col, text_col, work,
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    ).withColumnRenamed("id", id_col)

