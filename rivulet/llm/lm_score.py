"""Language-model scoring with a log-frequency Bloom filter.

Counts of word pairs are quantised on a logarithmic scale, and a pair of level q
is in the filter q times: as (pair, 1) up to (pair, q). A count is read back by
probing for level 1, 2, ... until the first miss, so an error can only raise a
count, and the less likely the further. The filter is built in segments, one
per range of hashes. A segment never leaves the task that builds it: the pairs
of all blocks travel to their range, where they are probed, and their levels
travel back. Counts of single words travel as they are, the base needs them.

A word's probability interpolates the pair's frequency with the word's own:
L c(vw) / c(v) + (1 - L) (c(w) + 1) / (N + V + 1). The weight L depends on c(v)
(its power of CLASS_BASE) and is learnt by deleted interpolation: it makes the
training tokens, each taken out of the counts, likeliest.

Over all V words and an unknown one these probabilities add up to 1, but for
two errors with bounds. A level's width is 1 / FINE of its count (up to FINE
counts are exact), so the pairs of a context add up to c(v) within 1 / (2 FINE).
An unseen pair is taken for a seen one so rarely that a context has FALSE_HITS of
them on average: the first level is probed log2(V / FALSE_HITS) times, for an upper
bound of V, and the segments have room for that many probes.

Texts are turned once into blocks of word numbers with the block's own
vocabulary; only the vocabularies and distinct pairs of blocks and their levels
are shuffled, never a row per word.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import blocks as B
from rivulet.llm.staged import drop, stage

FINE = 64                  # counts up to here have a level each, larger ones a level per 1 / FINE
FALSE_HITS = 0.004         # unseen words that a context seems to have had after it, on average
PROBES = 10                # of the second and later levels
CLASS_BASE = 1.5           # of the classes of c(v) that have a weight each
GRID = (0.0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 0.95)  # weights to choose from
BLOCK_BYTES = 6 << 20      # text of a block
RANGE_BYTES = 24 << 20     # text whose counts one range of hashes holds
END = np.uint64(0x243F6A8885A308D3)   # the end token's hash
PAIR = np.uint64(0x9E6C63D0876A9A47)
LOW48 = np.uint64((1 << 48) - 1)


def in_training(id_col: str = "doc_id") -> Column:
    """Documents that the model learns from (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 != 2, F.lit(False))


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (words after lower-casing A-Z, then one end per
    text) and each text's first token."""
    raw, first = B.joined(texts)
    buf = B.FOLD[raw]
    start, end = B.word_spans(buf)
    words = B.range_hashes(buf, B.BYTE_BASE, start, end)
    edge = np.searchsorted(start, first)
    at = edge + np.arange(len(edge))          # one end token more before each later text
    out = np.full(at[-1], END, np.uint64)
    ends = np.zeros(at[-1], bool)
    ends[at[1:] - 1] = True
    out[~ends] = words
    return out, at


def pair_keys(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """48-bit keys of (token before, token); before a text stands the end."""
    before = np.concatenate([[END], tokens[:-1]])
    before[first[:-1]] = END
    return B.mix(before * PAIR + tokens) & LOW48


def _edges() -> np.ndarray:
    """The smallest count of each level."""
    edge = [1]
    while edge[-1] < 1 << 62:
        edge.append(edge[-1] + max(1, edge[-1] // FINE))
    return np.array(edge, np.int64)


EDGES = _edges()
# The count that a level stands for: the middle of those that it covers (level 0: none).
MIDDLE = np.concatenate([[0.0], (EDGES[:-1] - 1.0 + EDGES[1:]) / 2])


def levels(counts: np.ndarray) -> np.ndarray:
    """Levels of counts from 1 on."""
    return np.searchsorted(EDGES[:-1], counts, "right")


def classes(counts: np.ndarray) -> np.ndarray:
    """0 for a count of 0, else 1 + floor(log(count)), in CLASS_BASE."""
    got = 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(CLASS_BASE) + 1e-9).astype(np.int64)
    return np.where(np.asarray(counts) > 0, got, 0)


CLASSES = 128  # over the class of 2**62


def first_probes(words: int) -> int:
    """Probes of the first level for at most ``words`` distinct words."""
    return max(PROBES, math.ceil(math.log2(max(words, 1) / FALSE_HITS)))


def _pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 64-bit values and their counts, compressed by byte planes."""
    planes = [np.diff(x.astype(np.uint64), prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() if i == 0
              else x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for i, x in enumerate((values, counts))]
    return zstandard.ZstdCompressor(level=1).compress(np.int64(len(values)).tobytes() + b"".join(planes))


def _planes(values: np.ndarray, width: int) -> bytes:
    """Integers of ``width`` bytes, compressed by byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())


def _from_planes(parts: list[bytes], width: int) -> np.ndarray:
    """The integers of all parts, one part after another."""
    raw = [np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint8).reshape(width, -1).T for p in parts]
    return np.ascontiguousarray(np.concatenate(raw)).view(f"<u{width}").ravel().astype(np.int64)


def _unpack(value: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(value)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    v = np.frombuffer(raw, np.uint8, 8 * n, 8).reshape(8, n).T
    c = np.frombuffer(raw, np.uint8, 4 * n, 8 + 8 * n).reshape(4, n).T
    return (np.cumsum(np.ascontiguousarray(v).view("<u8").ravel(), dtype=np.uint64),
            np.ascontiguousarray(c).view("<u4").ravel().astype(np.int64))


def encoded_blocks(docs: DataFrame, id_col: str, text_col: str, train: Column) -> tuple[DataFrame, str]:
    """Blocks of documents as word numbers: block, ids, train, first (each
    document's first token), vocabulary (sorted hashes), words (compressed
    numbers), distinct (number of words), written to the shared folder; and the
    table's path."""

    def encode(batches):
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        size = 0

        def block():
            tokens, first = tokens_of([h[2] for h in held])
            vocabulary, words = np.unique(tokens, return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array([(part << 24) + number], pa.int64()), pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                pa.array([[h[1] for h in held]], pa.list_(pa.bool_())), pa.array([first], pa.list_(pa.int64())),
                pa.array([vocabulary.tobytes()], pa.binary()),
                pa.array([zstandard.ZstdCompressor(level=1).compress(
                    words.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())], pa.binary()), pa.array([len(vocabulary)], pa.int64())],
                ["block", "ids", "train", "first", "vocabulary", "words", "distinct"])

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), B.texts_of(batch.column(2)), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    return stage(
        docs.select(F.col(id_col).cast("long").alias("id"), train.alias("train"), F.col(text_col).alias("t"))
        .mapInArrow(encode, "block long, ids array<long>, train array<boolean>, first array<long>, vocabulary binary, words binary, distinct long"),
        "lm_blocks")


class Block:
    """One row of encoded_blocks()."""

    def __init__(self, ids, train, first, vocabulary, words):
        self.ids, self.train = ids, np.array(train, bool)
        self.first = np.array(first, np.int64)
        self.vocabulary = np.frombuffer(vocabulary, np.uint64)
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(words), np.uint8)
        self.words = np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()
        self.tokens = self.vocabulary[self.words]
        self.learnt = np.repeat(self.train, np.diff(self.first))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct pairs, and each token's place among them."""
        return np.unique(pair_keys(self.tokens, self.first), return_inverse=True)


def _counts(blocks: DataFrame, ranges: int, probes: int) -> tuple[DataFrame, str]:
    """Per range of hashes and block that has words or pairs in it: the exact
    training counts of the block's words in the range, and the levels that the
    range's segment of the filter gives its pairs (each in the order of the
    hashes). The first row of a range has its sums (tokens, distinct
    words). Also the staged table's path."""

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = Block(row["ids"], row["train"], row["first"], row["vocabulary"], row["words"])
                n = np.bincount(b.words[b.learnt], minlength=len(b.vocabulary))
                pairs, place = b.pairs()
                m = np.bincount(place[b.learnt], minlength=len(pairs))
                word_range = (b.vocabulary >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
                pair_range = (pairs >> np.uint64(16)) * np.uint64(ranges) >> np.uint64(32)
                we = np.searchsorted(word_range, np.arange(ranges + 1, dtype=np.uint64))
                pe = np.searchsorted(pair_range, np.arange(ranges + 1, dtype=np.uint64))
                out = [(r, row["block"], _pack(b.vocabulary[we[r]:we[r + 1]], n[we[r]:we[r + 1]]),
                        _pack(pairs[pe[r]:pe[r + 1]], m[pe[r]:pe[r + 1]])) for r in range(ranges)
                       if we[r] < we[r + 1] or pe[r] < pe[r + 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["range", "block", "words", "pairs"])

    def merge(table: pa.Table) -> pa.Table:
        words = [_unpack(v) for v in table["words"].to_pylist()]
        values, total = _summed(words)
        pairs = [_unpack(v) for v in table["pairs"].to_pylist()]
        keys, pair_total = _summed(pairs)
        learnt = pair_total > 0
        segment = Filter([build_segment(keys[learnt], pair_total[learnt], probes).tobytes()], probes)
        level = segment.levels(keys)
        out: list[list] = [[], []]
        for (v, _), (k, _) in zip(words, pairs, strict=True):
            out[0].append(_planes(total[np.searchsorted(values, v)], 8))
            out[1].append(_planes(level[np.searchsorted(keys, k)], 2))
        sums = [[int(x), *[0] * (len(words) - 1)] for x in (total.sum(), (total > 0).sum())]
        return pa.table([table["range"], table["block"], *[pa.array(o, pa.binary()) for o in out], *[pa.array(x, pa.int64()) for x in sums]],
                        ["range", "block", "exact", "pair_levels", "tokens", "distinct"])

    return stage(
        blocks.mapInArrow(send, "range int, block long, words binary, pairs binary").groupBy("range")
        .applyInArrow(merge, "range int, block long, exact binary, pair_levels binary, tokens long, distinct long"),
        "lm_counts")


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of all parts and the sums of their counts."""
    values, counts = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[new], np.add.reduceat(counts, new) if len(new) else counts


def _places(items: np.ndarray, level: int, size: int, probes: range):
    """Place of each (item, level) in a segment of ``size`` bits, probe by probe."""
    h = B.mix(items + np.uint64(level * 0x9FB21C651E98DF25 % (1 << 64)))
    step, h, low = h | np.uint64(1), h >> np.uint64(32), np.uint64(0xFFFFFFFF)
    for p in probes:
        yield ((h + np.uint64(p) * step & low) * np.uint64(size) >> np.uint64(32)).view(np.int64)


def build_segment(items: np.ndarray, counts: np.ndarray, probes: int) -> np.ndarray:
    """One range's segment of the filter, as bytes. Half of its bits get set:
    each probe of a member has 1 / log(2) bits."""
    level = levels(counts)
    inserts = len(items) * probes + int((level - 1).sum()) * PROBES
    size = math.ceil(inserts / math.log(2) / 8) + 8
    bits = np.zeros(size * 8, bool)
    order = np.argsort(-level, kind="stable")
    items, level = items[order], level[order]
    members = np.searchsorted(-level, -np.arange(1, int(level.max(initial=0)) + 1), "right")  # of each level
    for q, n in enumerate(members.tolist(), 1):
        for place in _places(items[:n], q, size * 8, range(probes if q == 1 else PROBES)):
            bits[place] = True
    return np.packbits(bits, bitorder="little")


class Filter:
    """Segments of the filter one after another; ``probes`` are those of the
    first level."""

    def __init__(self, segments: list[bytes], probes: int):
        self.data = b"".join(segments)
        self.start = np.cumsum([0, *map(len, segments)])
        self.ranges, self.probes = len(segments), probes
        self._array = None

    def counts(self, items: np.ndarray) -> np.ndarray:
        """Counts of 48-bit items."""
        return MIDDLE[self.levels(items)]

    def levels(self, items: np.ndarray) -> np.ndarray:
        """Levels of 48-bit items, probed one by one until a miss."""
        if self._array is None:
            self._array = np.frombuffer(self.data, np.uint8)
        where = (items >> np.uint64(16)) * np.uint64(self.ranges) >> np.uint64(32)
        level = np.zeros(len(items), np.int64)
        for r in range(self.ranges):
            bits, size = self._array[self.start[r]:self.start[r + 1]], int(self.start[r + 1] - self.start[r]) * 8
            live, q = np.flatnonzero(where == r), 1
            left = items[live]
            while len(live) and q < len(MIDDLE):
                # most items that are not there go after a few probes
                for probes in (range(3), range(3, self.probes if q == 1 else PROBES)):
                    hit = np.ones(len(live), np.uint8)
                    for at in _places(left, q, size, probes):
                        hit &= bits[at >> 3] >> (at & 7).astype(np.uint8)
                    hit = (hit & 1).view(bool)
                    if not hit.all():
                        live, left = live[hit], left[hit]
                level[live] = q
                q += 1
        return level


def probed_blocks(blocks: DataFrame, counts: DataFrame, n: int, v: int) -> tuple[DataFrame, str]:
    """Blocks without their words: ids, train, first, known and base (known
    tokens and base score of each document), every token's count and its pair's
    level; and the staged table's path."""

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("range")  # of the hashes, so the block's own order
        exact, pair = (_from_planes(right[c].to_pylist(), w) for c, w in (("exact", 8), ("pair_levels", 2)))
        row = left.to_pylist()[0]
        b = Block(row["ids"], row["train"], row["first"], row["vocabulary"], row["words"])
        _, place = b.pairs()
        count = exact[b.words]
        known = np.add.reduceat((count > 0).astype(np.int64), b.first[:-1])
        base = np.add.reduceat(np.log10((count + 1.0) / (n + v + 1.0)), b.first[:-1])
        types = (pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.binary(), pa.binary())
        out = (row["ids"], row["train"], row["first"], known, base, _planes(count, 8), _planes(pair[place], 2))
        return pa.table([pa.array([x], t) for x, t in zip(out, types, strict=True)], ["ids", "train", "first", "known", "base", "count", "pair"])

    return stage(
        blocks.groupBy("block").cogroup(counts.select("block", "range", "exact", "pair_levels").groupBy("block"))
        .applyInArrow(join, "ids array<long>, train array<boolean>, first array<long>, known array<long>, base array<double>, count binary, pair binary"),
        "lm_probed")


def before(count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Count of the token before each token; before a text stands the end,
    which is each text's last token."""
    got = np.concatenate([count[:1], count[:-1]])
    got[first[:-1]] = count[first[1] - 1]
    return got


def weights(probed: DataFrame, n: int, v: int) -> np.ndarray:
    """Weight of the pair estimate by class of the count before: the one of
    GRID under which the training tokens, each taken out of the counts, are
    likeliest. Counts of one class have the class's middle here."""
    edge = np.ceil(CLASS_BASE ** np.arange(0, CLASSES + 0.0) - 1e-9)
    middle = np.concatenate([[0.0], np.maximum(edge[:-1], (edge[:-1] + edge[1:] - 1) / 2)])

    def vote(batches):
        total = np.zeros((len(GRID), CLASSES))
        for batch in batches:
            for row in batch.to_pylist():
                count, pair = _from_planes([row["count"]], 8), _from_planes([row["pair"]], 2)
                first = np.array(row["first"], np.int64)
                learnt = np.repeat(np.array(row["train"], bool), np.diff(first))
                word = classes(count)
                # tokens with the same three classes have the same fit
                same = np.bincount(((before(word, first) << 16) + (word << 8) + classes(MIDDLE)[pair])[learnt])
                code = np.flatnonzero(same)
                context, word, pair = (np.maximum(middle[x] - 1, 0) for x in (code >> 16, code >> 8 & 255, code & 255))
                two, one = np.minimum(pair / np.maximum(context, 1), 1), (word + 1.0) / (n + v + 1.0)
                for i, share in enumerate(GRID):
                    total[i] += np.bincount(code >> 16, same[code] * np.log(share * two + (1 - share) * one), CLASSES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(CLASSES)), pa.array(list(total.T), pa.list_(pa.float64()))], ["class", "fit"])

    table = (probed.select("train", "first", "count", "pair").mapInArrow(vote, "class long, fit array<double>")
             .select("class", F.posexplode("fit").alias("i", "fit"))
             .groupBy("class", "i").agg(F.sum("fit").alias("fit")).toArrow())  # CLASSES x GRID rows
    fit = np.zeros((CLASSES, len(GRID)))
    fit[table["class"].to_numpy(), table["i"].to_numpy()] = table["fit"].to_numpy()
    return np.array(GRID)[fit.argmax(1)]


def probabilities(context: np.ndarray, word: np.ndarray, pair: np.ndarray, lam: np.ndarray, n: int, v: int) -> np.ndarray:
    """Probability of each word, from its count, its context's count and the
    level of the pair. A pair is not more frequent than its words; after a context
    that was never seen stands any word as often as anywhere."""
    share = np.where(context > 0, lam[classes(context)], 0.0)
    both = np.minimum(MIDDLE[pair], np.minimum(context, word))
    return share * both / np.maximum(context, 1) + (1 - share) * (word + 1.0) / (n + v + 1.0)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null and empty texts have the end token alone. A null id is held out.
    Without training rows all counts are 0. Rows that repeat are scored (and
    learnt from) one by one. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    ranges = max(8, -(-size // RANGE_BYTES))
    blocks, blocks_path = encoded_blocks(docs, id_col, text_col, in_training(id_col) if train is None else train)
    words = blocks.agg(F.sum("distinct")).first()[0] or 0  # words of several blocks count in each: an upper bound of V
    counts, counts_path = _counts(blocks, ranges, first_probes(words))
    sums = counts.agg(F.sum("tokens"), F.sum("distinct")).first()
    n, v = sums[0] or 0, sums[1] or 0
    probed, _ = probed_blocks(blocks, counts, n, v)
    drop(spark, [blocks_path, counts_path])
    lam = weights(probed, n, v)

    def score(batches):
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        for batch in batches:
            for row in batch.to_pylist():
                first = np.array(row["first"], np.int64)
                count, pair = _from_planes([row["count"]], 8), _from_planes([row["pair"]], 2)
                got = np.add.reduceat(np.log10(probabilities(before(count, first), count, pair, lam, n, v)), first[:-1])
                out = (row["ids"], [not t for t in row["train"]], np.diff(first), row["known"], row["base"], got)
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types, strict=True)],
                                                 ["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return (
        probed.mapInArrow(score, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
        .withColumn("train_tokens", F.lit(n).cast("long"))
        .withColumnRenamed("id", id_col)
    )
