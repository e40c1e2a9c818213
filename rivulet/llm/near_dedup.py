"""Near-dedup by ProbMinHash.

A document is the weighted set of its five-word shingles, a shingle's weight
being how often it occurs. Each shingle is a Poisson process whose rate is its
weight: its arrivals, and the register that each one falls into, depend on the
shingle's hash alone. A register of the signature keeps the shingle with the
earliest arrival, and the probability that two documents agree in a register
is their probability Jaccard similarity (plain Jaccard where weights are 1).
Arrivals later than the last register's are never drawn: generation stops at
a time that fills all registers, which takes about K log K arrivals however
long the text is.

Registers are banded; documents that agree in all registers of a band share a
bucket. In a round each member takes the two members of other classes whose
signatures agree with its own most, unless they estimate a similarity well
below the threshold, and the pairs taken are compared exactly (both shingle
multisets). A round at least halves the classes that are linked; pairs once
taken are not taken again. Members meet inside blocks of a bounded size, which
a large bucket is dealt into anew in each round.
Rounds that find no link are followed by a sweep, which takes every pair that
is left: a large bucket is dealt into groups for good, and by a fixed schedule
each two groups meet once. At the end two members of a bucket are in one class,
or have been compared, or are not plausible by their signatures.
Copies of one text are one document from the start.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm import blocks as B
from rivulet.llm.staged import drop, noted, stage

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 7        # a pair at 0.8 shares no band with probability (1 - 0.8 ** 7) ** 32 = 5e-4; at 0.85 4e-6
MARKS = 2       # registers are so many times what the bands take; the others serve the estimate alone
BLOCK_BYTES = 1 << 20
ROUNDS = 2      # at least
FIRST = 8       # the first round takes one bucket of so many
BLOCK = 512     # members of a bucket that meet in a round, about
PARTNERS = 2    # that a member takes in a block
STEPS = 8       # of the sweep's schedule in one round
WIDE = 32       # members from which a block is compared register by register
ROWS_PER_FILE = 50_000  # of the small tables of links and labels
NULL_NODES = 1 << 62
LEAST_SALTS = 64
ROWS_PER_SALT = 20_000
SHINGLE_BASE = 0x8EBC6AF09C88C6E3
_FOLD = bytes(B.FOLD)


def shingle_hashes(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a block of texts, and each one's text. A text
    of fewer words has one shingle, all of it; an empty one has none."""
    raw, first = B.joined(texts)
    buf = B.FOLD[raw]
    start, end = B.word_spans(buf)
    h = B.range_hashes(buf, B.BYTE_BASE, start, end)
    edge = np.searchsorted(start, first)
    text = np.repeat(np.arange(len(texts)), np.diff(edge))
    at = np.arange(len(h))
    stop = np.minimum(at + words, edge[1:][text])
    whole = (stop - at == words) | (at == edge[:-1][text])
    at, stop = at[whole], stop[whole]
    return B.range_hashes(h, SHINGLE_BASE, at, stop), text[whole]


def weighted(keys: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, text) pairs and how often each occurs."""
    both = B.mix(keys + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(both)
    both = both[order]
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    return keys[order[new]], text[order[new]], np.diff(np.append(new, len(both)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def signatures(keys: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, registers: int) -> np.ndarray:
    """ProbMinHash signatures (n_texts rows): the key of the first arrival in
    each register. All texts of a block go on together, arrival by arrival;
    rows of texts without shingles stay 0."""
    owner = np.zeros((n_texts, registers), np.uint64)
    total = np.bincount(text, weights, n_texts)
    todo = np.flatnonzero(total > 0)
    horizon = registers * (np.log(registers) + 3.0) / np.maximum(total, 1)
    while len(todo):
        mine = np.zeros(n_texts, bool)
        mine[todo] = True
        live = np.flatnonzero(mine[text])
        first = np.full(n_texts * registers, np.inf)
        who = np.zeros(n_texts * registers, np.uint64)
        time, j = np.zeros(len(live)), 0
        while len(live):
            j += 1
            draw = B.mix(keys[live] + np.uint64((j * 0x9E3779B97F4A7C15) % (1 << 64)))
            time = time - np.log(_uniform(draw)) / weights[live]
            early = time < horizon[text[live]]  # later arrivals cannot be the first anywhere
            live, time = live[early], time[early]
            slot = (B.mix(draw[early] ^ np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(registers)).astype(np.int64)
            slot += text[live] * registers
            np.minimum.at(first, slot, time)
            won = time == first[slot]
            who[slot[won]] = keys[live[won]]
        full = np.isfinite(first).reshape(n_texts, registers).all(1)
        done = todo[full[todo]]
        owner[done] = who.reshape(n_texts, registers)[done]
        todo = todo[~full[todo]]
        horizon = horizon * 2.0
    return owner


def band_keys(texts: list[bytes], words: int, bands: int, rows: int, marks: int = 1) -> tuple[list[np.ndarray], list[bytes]]:
    """For each text a key per band of its signature (none without words) and
    a byte of each register; there are ``marks`` times as many registers as
    the bands take."""
    registers = bands * rows * marks
    out: list[np.ndarray] = []
    codes: list[bytes] = []
    at = np.arange(bands) * rows
    for a, b in B.text_blocks(texts, BLOCK_BYTES):
        keys, text, weights = weighted(*shingle_hashes(texts[a:b], words))
        has = np.bincount(text, minlength=b - a) > 0
        sig = signatures(keys, text, weights, b - a, registers)
        start = (np.arange(b - a)[:, None] * registers + at).ravel()
        found = B.range_hashes(sig.ravel(), SHINGLE_BASE, start, start + rows).reshape(b - a, bands) + at.astype(np.uint64)
        out += [found[i].view(np.int64) if has[i] else np.zeros(0, np.int64) for i in range(b - a)]
        codes += [row.tobytes() for row in (B.mix(sig) & np.uint64(255)).astype(np.uint8)]
    return out, codes


def agreements(marks: np.ndarray) -> np.ndarray:
    """In how many registers each two rows agree."""
    n, registers = marks.shape
    if n < WIDE:
        return (marks[:, None] == marks[None]).sum(2, dtype=np.int32)
    out = np.zeros((n, n), np.int32)
    for x in np.ascontiguousarray(marks.T):
        out += x[:, None] == x
    return out


def partners(node: np.ndarray, label: np.ndarray, marks: np.ndarray, tried: list, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (taker, taken) of the pairs that the members of a block take:
    each its PARTNERS best ones of other classes that agree in ``least``
    registers or more (ties: the smaller node). A pair taken from both sides
    is there once; pairs of ``tried`` (a list of nodes per member, or None)
    are left out."""
    order = np.argsort(node)
    node, label, marks = node[order], label[order], marks[order]
    agree = agreements(marks)
    agree[label[:, None] == label] = -1
    for i, j in enumerate(order.tolist()):
        if tried[j] is not None:
            at = np.flatnonzero(np.isin(node, tried[j]))
            agree[i, at] = agree[at, i] = -1
    best = np.argsort(-agree, axis=1, kind="stable")[:, :PARTNERS]
    taker = np.repeat(np.arange(len(node)), best.shape[1])
    taken = best.ravel()
    good = agree[taker, taken] >= max(least, 0)
    taker, taken = taker[good], taken[good]
    _, one = np.unique(np.minimum(taker, taken) * len(node) + np.maximum(taker, taken), return_index=True)
    return order[taker[one]], order[taken[one]]


def _taken(blocks: DataFrame, threshold: float, registers: int) -> DataFrame:
    """(node, partner) of the pairs taken in blocks (column members: array of
    node, class, mark, tried). Pairs that agree in fewer registers than a
    similarity of ``threshold`` leaves out once in 30,000 are not taken."""
    least = registers * (threshold - 4 * (threshold * (1 - threshold) / registers) ** 0.5)

    def take(batches):
        for batch in batches:
            members = batch.column(0)
            flat, ends = members.flatten(), np.cumsum(members.value_lengths().to_numpy(zero_copy_only=False))
            node, label = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            marks = np.frombuffer(b"".join(flat.field(2).to_pylist()), np.uint8).reshape(-1, registers)
            tried, a = flat.field(3).to_pylist(), 0
            got = [np.zeros((2, 0), np.int64)]
            for z in ends.tolist():
                if (label[a:z] != label[a]).any():
                    x, y = partners(node[a:z], label[a:z], marks[a:z], tried[a:z], least)
                    got.append(np.stack([node[a + x], node[a + y]]))
                a = z
            pairs = np.concatenate(got, axis=1)  # a pair taken in several blocks of the batch is sent once
            pairs = pairs[:, np.unique(np.sort(pairs, axis=0), axis=1, return_index=True)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["node", "partner"])
        B.release()

    return blocks.select("members").mapInArrow(take, "node long, partner long")


def remaining(node: np.ndarray, label: np.ndarray, marks: np.ndarray, bands: np.ndarray, side: np.ndarray,
              tried: list, band: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs between the two groups of a meeting (side 0 and 1;
    2: one group with itself) that have different classes, agree in ``least``
    registers or more and are not in ``tried``. Pairs are taken in the first
    band that they share only, so a sweep takes none twice."""
    low, high = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    agree = np.zeros((len(low), len(high)), np.int32)
    for a, b in zip(np.ascontiguousarray(marks[low].T), np.ascontiguousarray(marks[high].T), strict=True):
        agree += a[:, None] == b
    good = (agree >= max(least, 0)) & (label[low][:, None] != label[high])
    good &= (side[low][:, None] != 2) | (node[low][:, None] < node[high])
    order = np.argsort(node)
    done = np.zeros((len(node), len(node)), bool)
    for i, others in enumerate(tried):
        if others is not None:
            at = np.minimum(np.searchsorted(node[order], others), len(node) - 1)
            done[i, order[at[node[order[at]] == others]]] = True
    good &= ~(done | done.T)[np.ix_(low, high)]
    x, y = np.nonzero(good)
    x, y = low[x], high[y]
    mine = np.zeros(len(x), bool)
    for a in range(0, len(x), 1 << 14):
        i, j = x[a:a + (1 << 14)], y[a:a + (1 << 14)]
        same = bands[i] == bands[j]
        mine[a:a + (1 << 14)] = same[np.arange(len(i)), same.argmax(1)] & (bands[i, same.argmax(1)] == band)
    return x[mine], y[mine]


def _remaining(meetings: DataFrame, threshold: float, registers: int) -> DataFrame:
    """(node, partner) of the pairs that meetings (band, members: array of
    node, class, mark, tried, bands, side) leave to take."""
    least = registers * (threshold - 4 * (threshold * (1 - threshold) / registers) ** 0.5)

    def take(batches):
        for batch in batches:
            members = batch.column(1)
            flat, ends = members.flatten(), np.cumsum(members.value_lengths().to_numpy(zero_copy_only=False))
            node, label, side = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1, 5))
            marks = np.frombuffer(b"".join(flat.field(2).to_pylist()), np.uint8).reshape(-1, registers)
            bands = flat.field(4).flatten().to_numpy(zero_copy_only=False).reshape(len(node), -1)
            tried, a = flat.field(3).to_pylist(), 0
            for band, z in zip(batch.column(0).to_pylist(), ends.tolist(), strict=True):
                if (label[a:z] != label[a]).any():
                    x, y = remaining(node[a:z], label[a:z], marks[a:z], bands[a:z], side[a:z], tried[a:z], band, least)
                    yield pa.RecordBatch.from_arrays([pa.array(node[a + x]), pa.array(node[a + y])], ["node", "partner"])
                a = z
        B.release()

    return meetings.select("band", "members").mapInArrow(take, "node long, partner long")


def _meetings(held: DataFrame, step: int) -> DataFrame:
    """Meetings of the sweep's steps from ``step`` on (STEPS of them). In step
    t of a bucket of g groups, group i meets group t - i (mod g): in steps 0 to
    g - 1 each two groups meet once, and each group meets itself once."""
    groups = F.ceil(F.col("n") / BLOCK)
    other = F.pmod(F.col("step") - F.col("group"), F.col("groups"))
    return (held.withColumn("groups", groups).where(F.col("groups") > step)
            .withColumn("group", F.pmod(F.xxhash64("node", "band"), F.col("groups")))
            .withColumn("step", F.explode(F.sequence(F.lit(step).cast("long"), F.least(F.lit(step + STEPS), F.col("groups")) - 1)))
            .withColumn("cell", F.least(F.col("group"), other))
            .withColumn("side", F.when(F.col("group") == other, 2).when(F.col("group") == F.col("cell"), 0).otherwise(1))
            .groupBy("band", "step", "cell")
            .agg(F.collect_list(F.struct("node", "class", "mark", "tried", "bands", "side")).alias("members")))  # about 2 BLOCK


def probability_jaccard(a: Counter, b: Counter) -> float:
    """Sum over common shingles d of 1 / sum over all e of
    max(a_e / a_d, b_e / b_d)."""
    common = a.keys() & b.keys()
    if not common:
        return 0.0
    if all(x == 1 for x in a.values()) and all(x == 1 for x in b.values()):
        return len(common) / (len(a) + len(b) - len(common))
    pairs = Counter((a.get(e, 0), b.get(e, 0)) for e in a.keys() | b.keys())
    total = 0.0
    for (x, y), n in pairs.items():
        if x and y:
            total += n / sum(c * max(p / x, q / y) for (p, q), c in pairs.items())
    return total


def shingles_of(text: bytes, words: int) -> Counter:
    """The shingles themselves, for exact comparison."""
    w = text.translate(_FOLD).split()
    if not w:
        return Counter()
    n = max(1, len(w) - words + 1)
    return Counter(tuple(w[i:i + words]) for i in range(n))


@lru_cache(maxsize=64)
def _cached(text: bytes, words: int) -> Counter:
    return shingles_of(text, words)


def materialize(df: DataFrame, name: str) -> DataFrame:
    return stage(df, name)[0]


def _salt(salts: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts))


def _one_per_key(rows: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` (any number per key, with a column salt) and
    ``one`` (one row per key): the single row goes to each salt first, so a
    key holding most of the rows is spread over all salts."""
    return rows.join(rows.select(key, "salt").distinct().join(one, key), [key, "salt"])


def _words_key(text: bytes) -> bytes:
    """128 bits of a text's words (A-Z lower-cased, joined by one space)."""
    return hashlib.md5(b" ".join(text.translate(_FOLD).split()), usedforsecurity=False).digest()


@F.arrow_udf(T.BinaryType())
def _key_column(texts: pa.Array) -> pa.Array:
    return pa.array([_words_key(t) for t in B.texts_of(texts)], pa.binary())


def _signed(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(id, key, bands, mark) of every row; texts stay where they are."""

    def sign(batches):
        for batch in batches:
            texts = B.texts_of(batch.column(1))
            keys = [_words_key(t) for t in texts]
            distinct = dict(zip(keys, texts, strict=True))  # copies in a batch are signed once
            signed = dict(zip(distinct, zip(*band_keys(list(distinct.values()), words, bands, rows, MARKS), strict=True), strict=True))
            out, marks = [signed[k][0] for k in keys], [signed[k][1] for k in keys]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(out, pa.list_(pa.int64())),
                 pa.array(marks, pa.binary())], ["id", "key", "bands", "mark"])
        B.release()

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
            .mapInArrow(sign, "id long, key binary, bands array<long>, mark binary"))


def _row_id() -> Column:
    """A row's id as text, for joins in which null equals null."""
    return F.coalesce(F.col("id").cast("string"), F.lit("null"))


def _documents_of(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """One row of ``docs`` for each (key, id) of ``wanted``, with its text and
    the ``carry`` columns (prefixed x_)."""
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        *[F.col(f"`{c}`").alias(f"x_{c}") for c in carry])
            .withColumn("key", _key_column("text")).withColumn("rid", _row_id()).drop("id"))
    one = Window.partitionBy("key", "rid").orderBy(F.xxhash64("text"))
    return (rows.join(wanted.withColumn("rid", _row_id()), ["key", "rid"])
            .withColumn("rn", F.row_number().over(one)).where("rn = 1").drop("rn", "rid"))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    # Both sides of each join are plain shuffles, so a centre with very many
    # partners is split by Spark's own skew handling.
    both = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))

    def compare(batches):
        for batch in batches:
            ok = [probability_jaccard(_cached(x, words), _cached(y, words)) >= threshold
                  for x, y in zip(B.texts_of(batch.column(2)), B.texts_of(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
        _cached.cache_clear()
        B.release()

    return both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, class): the smallest node that each node of ``edges`` (a, b) is
    linked with. Each round points every node at the smallest label around it
    and then at that label's own label, so the way a label has come doubles;
    rounds go on until no label changes (labels only fall, so their sum tells).

    The rounds walk over a thinner graph with the same components: each node
    linked with its smallest neighbour, and an edge between two such neighbours
    once, however many of their nodes are linked.
    """
    def both_ways(pairs: DataFrame) -> DataFrame:
        return pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))

    links = materialize(both_ways(edges.where("a != b")), f"{name}_edges")
    nearest = links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")).withColumnRenamed("a", "node")
    nearest = materialize(nearest, f"{name}_nearest")
    bridges = (links.where("a < b").join(nearest.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
               .join(nearest.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").where("x != y")
               .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    thin = bridges.unionByName(nearest.where("node != to").select(F.col("to").alias("a"), F.col("node").alias("b"))).distinct()
    links = materialize(both_ways(thin), f"{name}_links")
    files = 1 + links.count() // ROWS_PER_FILE

    def written(df: DataFrame, part: str) -> DataFrame:  # few links need few tasks and files
        return materialize(df.coalesce(files), f"{name}_{part}")

    label = links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("class")).withColumnRenamed("a", "node")
    label, total = written(label, "labels"), None
    while True:
        near = links.join(label.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "class")
        low = written(near.unionByName(label).groupBy("node").agg(F.min("class").alias("class")), "low")
        up = low.select(F.col("node").alias("class"), F.col("class").alias("up"))
        label = written(low.join(up, "class").select("node", F.col("up").alias("class")), "labels")
        now = label.agg(F.sum(F.col("class").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return label
        total = now


def _merged(label: DataFrame | None, nodes: DataFrame, found: DataFrame, files: int) -> DataFrame:
    """(node, class) after new links: components over the classes that the
    links join, which are far fewer than the nodes after the first round."""
    if label is None:
        known = components(found, "near")
        out = nodes.join(known, "node", "left").select("node", F.coalesce("class", F.col("node")).alias("class"))
    else:
        ends = (found.join(label.select(F.col("node").alias("a"), F.col("class").alias("ca")), "a")
                .join(label.select(F.col("node").alias("b"), F.col("class").alias("cb")), "b"))
        known = components(ends.where("ca != cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "near") \
            .select(F.col("node").alias("class"), F.col("class").alias("new"))
        out = label.join(known, "class", "left").select("node", F.coalesce("new", "class").alias("class"))
    return materialize(out.select("node", "class").repartition(files), "near_classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links (distinct other
    texts that this text was compared with and found similar to), kept, and
    text_key (128-bit key of the text's words).

    Words are split at ASCII white space and lower-cased in A-Z. A class is a
    set of texts linked by similarity (probability Jaccard of five-word
    shingles) of ``threshold`` or more (see above for the pairs compared); class_id is its smallest id. Null and
    empty texts have no shingles and are copies of each other. Texts that occur
    with null ids only are numbered from 2**62 on, so a null id never names a
    class that has another id. One row of a class is kept: its smallest id,
    once if that id repeats. An id with several texts can name several classes. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    B.small_batches(spark)
    with noted() as made:
        result, path = stage(_classes(docs, id_col, text_col, words, threshold, bands, rows), "near_result")
    drop(spark, [x for x in made if x != path])
    return result


def _classes(docs: DataFrame, id_col: str, text_col: str, words: int, threshold: float, bands: int, rows: int) -> DataFrame:
    """The result of near_duplicates, read from many staged tables."""
    salts = max(LEAST_SALTS, -(-docs.count() // ROWS_PER_SALT))
    # The row number is fixed once the table is written.
    signed = materialize(_signed(docs, id_col, text_col, words, bands, rows).withColumn("salt", _salt(salts, "id"))
                         .withColumn("uid", F.monotonically_increasing_id()), "near_rows")

    # Copies of one text: the smallest id stands for them, null comes last.
    # They have the same bands, so they are merged before the shuffle.
    reps = materialize(
        signed.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("rep"),
                                  F.first("bands").alias("bands"), F.first("mark").alias("mark"))
        .select("rep.id", "key", "rep.uid", F.col("rep.uid").alias("node"), "bands", "mark")  # an id can have several texts
        .withColumn("name", F.coalesce("id", F.lit(NULL_NODES) + F.pmod(F.xxhash64("key"), F.lit(NULL_NODES)))), "near_signatures")

    # The buckets of two texts or more that each text is in (BANDS at most).
    members = reps.select("node", F.explode("bands").alias("band"))
    shared = materialize(members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near_shared")
    nodes = materialize(members.join(shared, "band").groupBy("node")
                        .agg(F.collect_list(F.struct("band", "n")).alias("buckets"))
                        .join(reps.select("node", "mark", "bands"), "node"), "near_nodes")
    files = 1 + nodes.count() // ROWS_PER_FILE
    texts = materialize(
        _documents_of(docs, id_col, text_col, reps.select("id", "key", "node").join(nodes.select("node"), "node"), ()).select("node", "text"), "near_candidates")

    links = tried = label = None
    turn, step = 0, None  # step: of the sweep, when it has begun
    while True:
        if label is None:
            held = nodes.withColumn("class", F.col("node"))
        else:
            held = nodes.join(label, "node")
        if tried is None:
            held = held.withColumn("tried", F.lit(None).cast("array<long>"))
        else:  # a member takes at most BANDS * PARTNERS others a round
            held = held.join(tried.groupBy("node").agg(F.collect_list("partner").alias("tried")), "node", "left")
        if label is not None:
            held = materialize(held.repartition(files), "near_held")
        blocks = held.select("node", "class", "mark", "tried", "bands", F.inline("buckets"))
        if label is not None and step is not None:  # the sweep: buckets of one class are done with
            several = (held.select("class", F.inline("buckets")).groupBy("band")
                       .agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.max("n").alias("most")).where("lo != hi").select("band", "most"))
            several = materialize(several, "near_several")
            blocks = blocks.join(several, "band", "left_semi")
        if turn == 0:  # an eighth of the buckets joins most of a large family; later rounds take what is left in all
            blocks = blocks.where(F.pmod(F.xxhash64("band"), F.lit(FIRST)) == 0)
        if step is not None:
            most = (several.agg(F.max("most")) if label is not None else shared.agg(F.max("n"))).first()[0] or 0
            if most <= step * BLOCK:  # all groups of every bucket have met
                break
            pairs = (_remaining(_meetings(blocks, step), threshold, bands * rows * MARKS)
                     .select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")))
            found = materialize(_verified(materialize(pairs, "near_pairs"), texts, words, threshold), "near_links")
            step += STEPS
            if not found.isEmpty():
                links = found if links is None else links.unionByName(found)
                label = _merged(label, nodes, found, files)
            continue
        blocks = (blocks.groupBy("band", F.pmod(F.xxhash64("node", "band", F.lit(turn)), F.ceil(F.col("n") / BLOCK)).alias("block"))
                  .agg(F.collect_list(F.struct("node", "class", "mark", "tried")).alias("members"),  # about BLOCK
                       F.min("class").alias("lo"), F.max("class").alias("hi"))
                  .where("lo != hi"))  # a block of one class has no pair to take
        pairs = (_taken(blocks, threshold, bands * rows * MARKS)
                 .groupBy(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b"))
                 .agg(F.min_by("partner", "node").alias("partner"), F.min("node").alias("node")))
        if tried is not None:  # two members can take each other in different rounds
            pairs = pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "near_pairs")
        found = materialize(_verified(pairs, texts, words, threshold), "near_links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        turn += 1
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            label = _merged(label, nodes, found, files)
        elif turn >= ROUNDS:
            step = 0

    if links is None:
        classes = reps.select("key", "uid", "name", F.col("node").alias("class"), F.lit(0).cast("long").alias("n_links"))
    else:
        degree = (links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                  .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
                  .groupBy("node").agg(F.count_distinct("other").alias("n_links")))
        classes = (reps.join(label, "node", "left").join(degree, "node", "left")
                   .select("key", "uid", "name", F.coalesce("class", F.col("node")).alias("class"),
                           F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    smallest = classes.groupBy("class").agg(F.min(F.struct("name", "uid")).alias("first"))
    classes = _one_per_key(classes.withColumn("salt", _salt(salts, "uid")), smallest, "class").drop("salt")
    return (
        _one_per_key(signed.select("id", "key", "salt", F.col("uid").alias("row")), classes, "key")
        .select(F.col("id").alias(id_col), F.col("first.name").alias("class_id"), "n_links",
                (F.col("row") == F.col("first.uid")).alias("kept"), F.hex("key").alias("text_key"))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    cols = docs.columns
    stay = near_duplicates(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("id"), F.unhex("text_key").alias("key"))
    return _documents_of(docs, id_col, text_col, stay, tuple(cols)).select(*[F.col(f"x_{c}").alias(c) for c in cols])
