"""Toxicity by a small convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed embeddings of the word itself and of
its beginnings (three to six bytes), each under two hash functions, so that
inflected forms meet and a collision under one function is told apart by the
other. Filters of widths 1, 2 and 3 run over the word sequence; each filter's
maximum over the whole text goes into a logistic output. Texts are read whole.

The fit starts on a sample and then goes over every labelled row in Spark, once if they are many:
learners of some thousand rows each go on from the same model, and what they
changed is averaged, an embedding row over the learners that touched it. (If the
sample is all there is, it is the fit.)

The output is calibrated on a fifth of the training rows: per language, the
threshold with the best F1; over all, a shift of the logit that puts the best
common threshold at 0.3, the operating point. Language and labels choose
thresholds only; a score depends on the text alone.
"""

from __future__ import annotations

import copy
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm import blocks as B
from rivulet.llm import staged

HASH_ROWS = 1 << 16       # of each of the two embedding tables
DIM = 8                   # of an embedding
FILTERS = 8               # of each width
WIDTHS = (1, 2, 3)
PREFIXES = (3, 4, 5, 6)   # bytes
SAMPLE_ROWS = 1500        # rows of each class that the fit starts on, at most
SAMPLE_BYTES = 1 << 16    # longer texts are not in that sample (all rows are learnt from after it)
LEARNER_ROWS = 4096       # rows that a learner goes over, about
LEARNER_BYTES = 1 << 18   # of a step's texts (or one longer text)
FINE = 1 << 24            # changes are summed in whole steps of 1 / FINE, in any order the same
ID_BITS = 1 << 25         # of the set that texts without a label are told by before the join (4 MB)
BINS = 4096               # of scores, when thresholds are counted
EPOCHS = 6                # or as many as make STEPS, for small samples
STEPS = 600
BATCH = 32
RATE = 0.02
CUT = 0.3
SEED = 11
BLOCK_BYTES = 1 << 18

# Letters in lower case; bytes of other scripts as they are; all else separates.
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = True
_LETTER[0x80:] = True
PREFIX_BASE = 0xAEF17502108EF2D9


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block (one column for the word, one per
    beginning; a word too short for a beginning repeats the whole) and each
    text's first word."""
    raw, first = B.joined(texts)
    buf = B.FOLD[raw]
    start, end = B.spans(_LETTER[buf])
    cols = [B.range_hashes(buf, B.BYTE_BASE, start, end)]
    for i, p in enumerate(PREFIXES):
        cols.append(B.range_hashes(buf, PREFIX_BASE, start, np.minimum(start + p, end)) + np.uint64(i))
    return np.stack(cols, 1), np.searchsorted(start, first)


class Model:
    """Two embedding tables, filters per width, and the output's weights."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.tables = rng.normal(0, 0.1, (2, HASH_ROWS, DIM)).astype(np.float32)
        self.filters = {w: rng.normal(0, 0.4, (w, 2 * DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.out_bias = np.float32(-1.0)
        self.shift = 0.0
        self.thresholds: dict[str, float] = {}
        self.state: dict = {}
        self.steps = 0

    def parameters(self) -> np.ndarray:
        """All parameters in rows of DIM: the two tables, then the rest."""
        rest = [self.filters[w].ravel() for w in WIDTHS] + [self.bias[w] for w in WIDTHS] + [self.out, [self.out_bias]]
        rest = np.concatenate(rest).astype(np.float32)
        rest = np.append(rest, np.zeros(-len(rest) % DIM, np.float32))
        return np.concatenate([self.tables.reshape(-1, DIM), rest.reshape(-1, DIM)])

    def set_parameters(self, p: np.ndarray) -> None:
        n = 2 * HASH_ROWS
        self.tables = p[:n].reshape(2, HASH_ROWS, DIM).astype(np.float32)
        rest, at = p[n:].ravel().astype(np.float32), 0
        for part in (self.filters, self.bias):
            for w in WIDTHS:
                size = part[w].size
                part[w] = rest[at:at + size].reshape(part[w].shape)
                at += size
        self.out, self.out_bias = rest[at:at + len(self.out)], rest[at + len(self.out)]

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """Rows of the two tables for every key: (2, words, columns)."""
        a = (keys % np.uint64(HASH_ROWS)).astype(np.int32)
        b = (B.mix(keys) % np.uint64(HASH_ROWS)).astype(np.int32)
        return np.stack([a, b])

    def embed(self, rows: np.ndarray) -> np.ndarray:
        parts = []
        for table, r in zip(self.tables, rows, strict=True):
            total = table[r[:, 0]]
            for j in range(1, r.shape[1]):
                total = total + table[r[:, j]]
            parts.append(total)
        return np.concatenate(parts, 1)

    def features(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict]:
        """Maxima of all filters over each text's words (0 where a text is
        shorter than the filter), and where they were reached."""
        n_texts, n = len(first) - 1, len(x)
        text = np.repeat(np.arange(n_texts), np.diff(first))
        out, where = np.zeros((n_texts, len(WIDTHS) * FILTERS), np.float32), {}
        for k, w in enumerate(WIDTHS):
            if n < w:
                continue
            y = x[: n - w + 1] @ self.filters[w][0]
            for j in range(1, w):
                y += x[j: n - w + 1 + j] @ self.filters[w][j]
            valid = text[: n - w + 1] == text[w - 1:]
            at = np.flatnonzero(valid)
            owner = text[at]
            if not len(at):
                continue
            edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            y = y[at] if len(at) < len(y) else y
            top = np.maximum.reduceat(y, edge, axis=0)
            who = owner[edge]
            out[who, k * FILTERS:(k + 1) * FILTERS] = np.maximum(top + self.bias[w], 0)
            where[w] = (y, at, edge, who, top)
        return out, where

    def logits(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in B.text_blocks(texts, BLOCK_BYTES):
            keys, first = word_keys(texts[a:b])
            feats, _ = self.features(self.embed(self.rows(keys)), first)
            out[a:b] = feats @ self.out + self.out_bias
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.logits(texts) + self.shift)))

    def step(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, state: dict, t: int) -> None:
        """One Adam step (Adagrad for the embedding rows that were used)."""
        keys, first = word_keys(texts)
        rows = self.rows(keys)
        x = self.embed(rows)
        feats, where = self.features(x, first)
        p = 1.0 / (1.0 + np.exp(-(feats @ self.out + self.out_bias)))
        d = ((p - labels) * weights / len(texts)).astype(np.float32)
        grads = {"out": feats.T @ d, "out_bias": d.sum()}
        dx_at, dx = [], []
        for k, w in enumerate(WIDTHS):
            if w not in where:
                continue
            y, at, edge, who, top = where[w]
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            dy = (d[who, None] * self.out[cols]) * (feats[who, cols] > 0)   # (texts, filters)
            stop = np.append(edge[1:], len(y))
            best = np.stack([at[a + y[a:b].argmax(0)] for a, b in zip(edge, stop, strict=True)])
            gw = np.zeros_like(self.filters[w])
            for j in range(w):
                xs = x[best + j]                                           # (texts, filters, 2 DIM)
                gw[j] = np.einsum("tfe,tf->ef", xs, dy)
                dx_at.append((best + j).ravel())
                dx.append((dy[:, :, None] * self.filters[w][j].T[None]).reshape(-1, 2 * DIM))
            grads[f"f{w}"], grads[f"b{w}"] = gw, dy.sum(0)
        for name, g in grads.items():
            m, v = state.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
            m = 0.9 * m + 0.1 * g
            v = 0.999 * v + 0.001 * g * g
            state[name] = (m, v)
            delta = (RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
            if name == "out":
                self.out = self.out - delta
            elif name == "out_bias":
                self.out_bias = np.float32(self.out_bias - delta)
            elif name[0] == "f":
                self.filters[int(name[1:])] -= delta
            else:
                self.bias[int(name[1:])] -= delta
        if dx:
            at, g = np.concatenate(dx_at), np.concatenate(dx)
            for side in range(2):
                r = rows[side][at]                                          # (hits, columns)
                part = np.repeat(g[:, side * DIM:(side + 1) * DIM], r.shape[1], axis=0)
                used, place = np.unique(r.ravel(), return_inverse=True)
                total = np.zeros((len(used), DIM), np.float32)
                np.add.at(total, place, part)
                square = state.setdefault(f"e{side}", np.zeros((HASH_ROWS, DIM), np.float32))
                square[used] += total * total
                self.tables[side][used] -= 2 * RATE * total / (np.sqrt(square[used]) + 1e-6)


def _best_cut(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float] | None:
    """The threshold of best F1 (middle of the gap that it lies in) and that
    F1; None without rows of both classes."""
    if not len(labels) or labels.min() == labels.max():
        return None
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(labels[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + labels.sum())
    i = int(np.argmax(f1))
    low = s[i + 1] if i + 1 < len(s) else 0.0
    return float((s[i] + low) / 2), float(f1[i])


def train(rows: list[tuple[bytes, int, str]], seed: int = SEED, hold: bool = True) -> Model:
    """Fit on labelled (text, toxic, language) rows; a fifth of them
    calibrates (``hold``; else they are all fitted, and nothing is calibrated). Without rows of both classes the model scores by its initial
    bias alone, below the cut."""
    model = Model(seed)
    labels = np.array([r[1] for r in rows], np.float32)
    if not len(rows) or labels.min() == labels.max():
        model.out[:] = 0
        return model
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, fit = np.split(order, [len(rows) // 5 if hold else 0])
    share = np.clip(labels[fit].mean(), 0.01, 0.99)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    state, t = model.state, 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(len(fit), 1)))):
        for at in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            t += 1
            model.step([rows[i][0] for i in at], labels[at], weight[at], state, t)
    model.steps = t
    if not hold:
        return model
    found = model.scores([rows[i][0] for i in held])
    best = _best_cut(found, labels[held])
    if best:
        cut = np.clip(best[0], 0.02, 0.98)
        model.shift = float(np.log(CUT / (1 - CUT)) - np.log(cut / (1 - cut)))
    found = 1.0 / (1.0 + np.exp(-(np.log(found / (1 - found)) + model.shift)))
    langs = np.array([rows[i][2] for i in held])
    for lang in sorted(set(langs.tolist())):
        mine = _best_cut(found[langs == lang], labels[held][langs == lang])
        model.thresholds[lang] = float(np.clip(mine[0], CUT / 2, 0.9)) if mine else CUT
    return model


def training_sample(docs: DataFrame, labels: DataFrame, train_rows: Column) -> list[tuple[bytes, int, str]]:
    """At most SAMPLE_ROWS rows of each class, by a hash of the id, from the
    labelled documents that ``train_rows`` admits."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.where(F.octet_length(F.coalesce("text", F.lit(""))) <= SAMPLE_BYTES)
    # of the ids that have a document; their texts are looked up for those picked only
    ids = known.where(train_rows).join(short.select("doc_id"), "doc_id", "left_semi")
    picked = None
    for c in (0, 1):
        some = ids.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
        picked = some if picked is None else picked.unionByName(some)
    rows = short.select("doc_id", "text", "lang").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "lang", "toxic")
    got = []
    for c in (0, 1):
        got += (rows.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id", "text")
                .limit(SAMPLE_ROWS).select("text", "toxic", "lang").collect())
    return [((r[0] or "").encode(), int(r[1]), r[2] or "") for r in got]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with columns score (double), predicted (int: score >= 0.3) and
    toxic_by_lang (int: score >= the language's threshold, 0.3 for languages
    that training has not seen). Columns of these names are replaced. Null and
    empty texts are scored as empty."""
    B.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, about 4 MB

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(B.texts_of(texts)), pa.float64())

    cut = F.lit(CUT)
    if "lang" in docs.columns:
        for lang, value in model.thresholds.items():
            cut = F.when(F.col("lang") == lang, F.lit(value)).otherwise(cut)
    new = ("score", "predicted", "toxic_by_lang")
    return (
        docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], scored(F.col(text_col)).alias("score"))
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))
        .withColumn("toxic_by_lang", (F.col("score") >= cut).cast("int"))
    )


def calibrates() -> Column:
    """The fifth of the labelled rows that thresholds are counted on."""
    return F.pmod(F.xxhash64("doc_id", F.lit("calibrates")), F.lit(5)) == 0


def _candidates(docs: DataFrame, labels: DataFrame, train_rows: Column) -> tuple[DataFrame, DataFrame]:
    """The documents that may have a label which ``train_rows`` admits, and
    those labels, one for an id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(train_rows)
    # a bit per hashed id, of fixed size: most texts without a label stay where they are
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BITS))
    bucket, at = F.floor(bit / 32768), bit % 32768
    bits = known.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    some = (docs.select("doc_id", "text", "lang", bucket.alias("_bucket"), at.alias("_at")).join(F.broadcast(bits), "_bucket")
            .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_at % 8 as int))")) != 0))
    return some.select("doc_id", "text", "lang"), known


def labelled(docs: DataFrame, labels: DataFrame, train_rows: Column) -> DataFrame:
    """The labelled documents that ``train_rows`` admits, whole: doc_id, text,
    lang, toxic."""
    some, known = _candidates(docs, labels, train_rows)
    return some.join(known, "doc_id")


def dealt(docs: DataFrame, labels: DataFrame, train_rows: Column, learners: int) -> DataFrame:
    """``labelled``, dealt by id over learners (column ``learner``), of which each
    stands in one partition, in order. Labels meet their documents where both are
    dealt to, so a text is shuffled once."""
    some, known = _candidates(docs, labels, train_rows)
    both = (some.withColumn("toxic", F.lit(None).cast(known.schema["toxic"].dataType)).withColumn("_label", F.lit(False))
            .unionByName(known.withColumn("_label", F.lit(True)), allowMissingColumns=True)
            .withColumn("_hash", F.xxhash64("doc_id")).withColumn("learner", F.pmod("_hash", F.lit(learners)).cast("int"))
            .repartition(learners, "learner"))
    of_id = Window.partitionBy("learner", "_hash", "doc_id").orderBy("text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (both.withColumn("toxic", F.max("toxic").over(of_id)).where(~F.col("_label") & F.col("toxic").isNotNull())
            .sortWithinPartitions("learner", "_hash", "doc_id", "text").select("doc_id", "text", "lang", "toxic", "learner"))


def _steps(batches):
    """(learner, texts, labels) of BATCH rows or fewer, LEARNER_BYTES or one
    longer text, however the rows come in batches and files."""
    who, texts, labels, size = None, [], [], 0
    for batch in batches:
        got = zip(batch.column("learner").to_pylist(), B.texts_of(batch.column("text")), batch.column("toxic").to_pylist(), strict=True)
        for learner, text, toxic in got:
            if texts and (learner != who or len(texts) == BATCH or size + len(text) > LEARNER_BYTES):
                yield who, texts, np.array(labels)
                texts, labels, size = [], [], 0
            who = learner
            texts.append(text)
            labels.append(toxic)
            size += len(text) + 1
    if texts:
        yield who, texts, np.array(labels)


def learn(rows: DataFrame, model: Model, share: float) -> Model:
    """``model`` after one pass over all ``rows`` (learner, text, toxic), of which
    a learner's stand together and in order."""
    B.small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)   # fixed size, about 8 MB
    weight = np.array([0.5 / (1 - share), 0.5 / share], np.float32)

    def pass_over(batches):
        # of all learners of a task: whole steps, weighted by a learner's rows, and those rows
        total = np.zeros((len(shared.value.parameters()), DIM), np.int64)
        rows_of = np.zeros(len(total), np.int64)
        for _, steps in groupby(_steps(batches), key=lambda x: x[0]):
            mine, n = copy.deepcopy(shared.value), 0
            for _, texts, labels in steps:
                mine.steps += 1
                mine.step(texts, labels.astype(np.float32), weight[labels], mine.state, mine.steps)
                n += len(texts)
            change = np.rint((mine.parameters() - shared.value.parameters()).astype(np.float64) * FINE).astype(np.int64) * n
            total += change
            rows_of[change.any(1)] += n
        at = np.flatnonzero(rows_of)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(rows_of[at]), *[pa.array(total[at, j]) for j in range(DIM)]],
            ["at", "n", *[f"d{j}" for j in range(DIM)]])
        B.release()

    changes = rows.select("learner", "text", F.col("toxic").cast("int")).mapInArrow(
        pass_over, "at int, n long, " + ", ".join(f"d{j} long" for j in range(DIM)))
    # a row per parameter row at most: a model's size
    total = changes.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(f"d{j}").alias(f"d{j}") for j in range(DIM)]).toArrow()
    out = copy.deepcopy(model)
    p = out.parameters()
    at, n = total["at"].to_numpy(), total["n"].to_numpy()
    p[at] += (np.stack([total[f"d{j}"].to_numpy() for j in range(DIM)], 1) / n[:, None] / FINE).astype(np.float32)
    out.set_parameters(p)
    return out


def _logit(p):
    return np.log(p) - np.log(1 - p)


def calibrate(rows: DataFrame, model: Model) -> None:
    """Shift and thresholds of ``model`` from the scores of all ``rows``, counted
    in bins: a count per language and bin reaches the driver."""
    model.shift, model.thresholds = 0.0, {}
    one = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int")
    counts = (score(rows, model).groupBy(F.coalesce("lang", F.lit("")).alias("lang"), one.alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").cast("long").alias("hits")).collect())

    def best(of) -> float | None:
        n, hits = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for r in of:
            n[r["bin"]] += r["n"]
            hits[r["bin"]] += r["hits"]
        if not 0 < hits.sum() < n.sum():
            return None
        used = np.flatnonzero(n)[::-1]
        f1 = 2 * np.cumsum(hits[used]) / (np.cumsum(n[used]) + hits.sum())
        i = int(np.argmax(f1))
        # from the lower end of the last bin taken to the upper end of the next
        low = (used[i + 1] + 1) / BINS if i + 1 < len(used) else 0.0
        return float((used[i] / BINS + low) / 2)

    cut = best(counts)
    if cut is not None:
        model.shift = float(_logit(CUT) - _logit(np.clip(cut, 0.02, 0.98)))
    by_lang: dict[str, list] = {}
    for r in counts:
        by_lang.setdefault(r["lang"], []).append(r)
    for lang in sorted(by_lang):
        mine = best(by_lang[lang])
        if mine is not None:
            mine = 1 / (1 + np.exp(-(_logit(np.clip(mine, 1e-6, 1 - 1e-6)) + model.shift)))
        model.thresholds[lang] = float(np.clip(mine, CUT / 2, 0.9)) if mine is not None else CUT


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The model learnt from every labelled document that is not held out."""
    n = labelled(docs, labels, ~held_out()).count()   # (of ids, no text is read)
    rows, path = staged.stage(dealt(docs, labels, ~held_out(), max(1, -(-n // LEARNER_ROWS))), "toxicity_labelled")
    model = _fitted(rows, labels)
    staged.drop(docs.sparkSession, [path])
    model.state = {}   # (of the fit only)
    return model


def _fitted(rows: DataFrame, labels: DataFrame) -> Model:
    size = F.octet_length(F.coalesce("text", F.lit("")))
    n, hits, longest, most = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0)), F.max(size),
        F.greatest(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1))).first()
    if most <= SAMPLE_ROWS and (longest or 0) <= SAMPLE_BYTES or hits in (0, n):
        # the sample is every row, or there is nothing to tell apart
        return train(training_sample(rows, labels, ~held_out()))
    model = train(training_sample(rows, labels, ~held_out() & ~calibrates()), hold=False)
    fit = rows.where(~calibrates())
    for _ in range(max(1, 2 * SAMPLE_ROWS * EPOCHS // n)):   # few rows are gone over as often as the sample
        model = learn(fit, model, float(np.clip(hits / n, 0.01, 0.99)))
    calibrate(rows.where(calibrates()), model)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    out = score(docs, fitted(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted", "toxic_by_lang")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, unchanged."""
    return score(docs, fitted(docs, labels)).where("predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
