"""Chat formatting: transcripts to turns by a hidden Markov model.

A transcript is a run of text fragments in order. Each line that is not blank
is an observation: which speaker its marker names, whether a blank line stands
before it, how long it is and how it ends. Hidden states say who speaks and
whether the line begins a turn or goes on with it. Viterbi finds the most likely
states; lines of one turn, markers taken off, are then written in the canonical
form ``<|role|>`` + newline + text.

The probabilities are counted by ``fit`` over all labelled transcripts that it is
given (a Spark aggregate of at most some 600 counts) on top of ``PRIOR``, which
weighs as much as ``PRIOR_LINES`` lines a state and is the model where there are
no labels.

A transcript may hold any number of lines, so Viterbi does not run over it in
one piece. A block of fragments is summed up by a matrix: the best score from
each state before the block to each state at its end. The products of ``FAN``
matrices at a time (maximum and plus) make a tree, whose top is chained; going
down again, every block gets the states between which its own best path runs.
The paths are then found block by block, so no task holds a whole transcript.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rivulet.operators.sequences import next_ids
from rivulet.session import materialize

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)        # role r begins: 2 r; goes on: 2 r + 1
BLOCK_TURNS = 256              # fragments in a block
FAN = 1024                     # matrices in a product
PRIOR_LINES = 5.0              # lines that the prior counts for, a state
# Fixed words that name a speaker.
MARKERS = {
    "system": 0, "instructions": 0, "instruction": 0,
    "user": 1, "human": 1, "customer": 1, "question": 1, "q": 1, "prompter": 1,
    "assistant": 2, "ai": 2, "bot": 2, "answer": 2, "a": 2, "gpt": 2, "agent": 2,
}
# An optional frame (###, <|, [, **), a word, the frame's end, and a colon or a closed frame.
MARKER = re.compile(r"^\s*(?:(?:#{1,4}\s*|\*\*)?([A-Za-z]{1,12})(?:\*\*)?\s*:(?:\*\*)?|<\|([A-Za-z]{1,12})\|>|\[([A-Za-z]{1,12})\])\s*")
NAMES = len(ROLES) + 2          # no marker, an unknown word, one of the roles
LENGTHS = (40, 120)             # characters from which a line is middling, long
ENDS = 3                        # a question, a whole sentence, neither
SHAPES = (len(LENGTHS) + 1) * ENDS
SYMBOLS = NAMES * 2 * SHAPES    # marker, blank line before or not, length and end


def symbols(lines: list[tuple[str, bool]]) -> np.ndarray:
    """Observation of each (line, blank line before)."""
    out = np.empty(len(lines), np.int64)
    for i, (line, gap) in enumerate(lines):
        m = MARKER.match(line)
        word = next((g for g in m.groups() if g), "").lower() if m else None
        name = 0 if word is None else 2 + MARKERS[word] if word in MARKERS else 1
        length = sum(len(line) >= n for n in LENGTHS)
        last = line.rstrip()[-1:]
        end = 0 if last == "?" else 1 if last in (".", "!") else 2
        out[i] = (2 * name + gap) * SHAPES + ENDS * length + end
    return out


class Model(NamedTuple):
    """Log probabilities. ``first`` holds the scores of a first line's states:
    after each state, or at a transcript's start (row OPENING)."""
    first: np.ndarray
    emit: np.ndarray


OPENING = STATES


def _prior() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, transition and emission probabilities before any label is seen: a
    marker begins its role's turn, roles alternate, shapes tell nothing."""
    trans = np.full((STATES, STATES), 1e-9)
    start = np.full(STATES, 1e-9)
    emit = np.full((STATES, 2 * NAMES), 1e-6)
    for r in range(len(ROLES)):
        begin, go = 2 * r, 2 * r + 1
        start[begin] = (0.2, 0.6, 0.2)[r]
        for s in (begin, go):
            trans[s, go] = 0.6
            for q in range(len(ROLES)):
                trans[s, 2 * q] = 0.4 * (0.02 if q == r else 0.05 if q == 0 else 0.93 if r else 0.8 if q == 1 else 0.18)
        emit[begin, 2 * (2 + r)], emit[begin, 2 * (2 + r) + 1] = 0.45, 0.45
        emit[begin, 0], emit[begin, 1] = 0.001, 0.06
        emit[begin, 2], emit[begin, 3] = 0.005, 0.02
        emit[go, 0], emit[go, 1], emit[go, 2], emit[go, 3] = 0.9, 0.05, 0.02, 0.01
    emit = np.repeat(emit, SHAPES, axis=1) / SHAPES
    return start / start.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True)


def model_of(starts: np.ndarray, steps: np.ndarray, seen: np.ndarray) -> Model:
    """The model of these counts on top of the prior."""
    parts = [n + PRIOR_LINES * p for n, p in zip((starts, steps, seen), _prior(), strict=True)]
    start, trans, emit = (np.log(x / x.sum(-1, keepdims=True)) for x in parts)
    return Model(np.vstack([trans, start]), emit)


PRIOR = model_of(np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, SYMBOLS)))
START, TRANS, EMIT = PRIOR.first[OPENING], PRIOR.first[:STATES], PRIOR.emit


def block_matrix(obs: np.ndarray, model: Model = PRIOR) -> np.ndarray:
    """Best score from each state before the block (or the start) to each
    state at its end. A block has a line at least."""
    best = model.first + model.emit[None, :, obs[0]]
    for o in obs[1:]:
        best = (best[:, :, None] + model.first[None, :STATES]).max(1) + model.emit[None, :, o]
    return best


def path(obs: np.ndarray, entry: int, exit_: int, model: Model = PRIOR) -> np.ndarray:
    """Best states of a block's lines, from the state before it (or OPENING)
    to its last one. Of equal scores the lower state wins."""
    if not len(obs):
        return np.zeros(0, np.int64)
    score = model.first[entry] + model.emit[:, obs[0]]
    back = np.zeros((len(obs), STATES), np.int64)
    for i in range(1, len(obs)):
        step = score[:, None] + model.first[:STATES]
        back[i] = step.argmax(0)
        score = step.max(0) + model.emit[:, obs[i]]
    out = np.empty(len(obs), np.int64)
    out[-1] = exit_
    for i in range(len(obs) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def product(matrices: list[np.ndarray | None]) -> np.ndarray | None:
    """The matrix of blocks in order; None stands for no lines."""
    out = None
    for m in matrices:
        if m is not None:
            out = m if out is None else (out[:, :, None] + m[None, :STATES]).max(1)
    return out


def chain(matrices: list[np.ndarray | None], first: int = OPENING, last: int | None = None) -> list[tuple[int, int]]:
    """(entry, exit) states of blocks in order, from the state ``first`` before
    them to ``last`` (None: the best); None stands for a block without lines."""
    score, before = None, []
    for m in matrices:
        before.append(score)
        if m is not None:
            score = m[first] if score is None else (score[:, None] + m[:STATES]).max(0)
    state = last if last is not None else first if score is None else int(score.argmax())
    out = []
    for m, b in zip(reversed(matrices), reversed(before), strict=True):
        entry = state if m is None else first if b is None else int((b + m[:STATES, state]).argmax())
        out.append((entry, state))
        state = entry
    return out[::-1]


def lines_of(fragments: list[str]) -> list[tuple[str, bool]]:
    """Lines that are not blank, each with whether a blank line stands before
    it in its fragment."""
    out = []
    for text in fragments:
        gap = False
        for line in text.split("\n"):
            if line.strip():
                out.append((line, gap))
                gap = False
            else:
                gap = True
    return out


def render(lines: list[tuple[str, bool]], states: np.ndarray) -> tuple[str, list[str]]:
    """Canonical text of a block, and the roles of the turns that begin in it.
    Lines before its first beginning go on with the turn before the block."""
    out, roles = [], []
    for (line, _), s in zip(lines, states.tolist(), strict=True):
        role = ROLES[s // 2]
        if s % 2 == 0:
            roles.append(role)
            out.append(f"<|{role}|>")
            m = MARKER.match(line)
            if m and next((g for g in m.groups() if g), "").lower() in MARKERS:
                line = line[m.end():]
        if line.strip():
            out.append(line)
    return "\n".join(out), roles


def _runs(batches, same, answer, schema: pa.Schema):
    """Rows of sorted batches, gathered while their columns ``same`` are equal,
    then answered together by rows."""
    key, held = None, []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            k = tuple(row[c] for c in same)
            if held and k != key:
                out += answer(held)
                held = []
            key = k
            held.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist(answer(held), schema)


_TYPES = {"key": pa.string(), "block": pa.int64(), "matrix": pa.list_(pa.float64()), "entry": pa.int64(), "exit": pa.int64(),
          "n_lines": pa.int64(), "n_turns": pa.int64(), "roles": pa.list_(pa.string()), "text": pa.string(),
          "n_right": pa.int64(), "kind": pa.int64(), "i": pa.int64(), "j": pa.int64(), "n": pa.int64()}


def _apply(df: DataFrame, same: tuple[str, ...], answer, names: list[str], ddl: str, extra=()) -> DataFrame:
    schema = pa.schema([*extra, *[(c, _TYPES[c]) for c in names]])
    return df.mapInArrow(lambda batches: _runs(batches, same, answer, schema), ddl)


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *keys).sortWithinPartitions(*keys, *order)


def _blocked(fragments: DataFrame, key_col: str, order_col: str, text_col: str, role_col: str | None) -> DataFrame:
    """key (text), given, at, t, role of each fragment and the block that its
    position puts it in."""
    base = fragments.select(
        F.when(F.col(key_col).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(key_col).cast("string"))).alias("key"),
        F.col(key_col).alias("given"), F.coalesce(F.col(order_col).cast("long"), F.lit(-1)).alias("at"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
        (F.col(role_col) if role_col else F.lit(None)).cast("string").alias("role"))
    base = next_ids(base, "key", ["at", "t"], id_col="pos")
    return base.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK_TURNS).cast("long") - (F.col("at") < 0).cast("long"))


def _true_states(rows: list[dict]) -> list[int]:
    """State of each line that is not blank; -1 where the role is not one of ROLES."""
    out = []
    for r in rows:
        known = ROLES.index(r["role"]) if r["role"] in ROLES else None
        n = len(lines_of([r["t"]]))
        out += [-1] * n if known is None else [2 * known + (i > 0) for i in range(n)]
    return out


def fit(fragments: DataFrame, key_col: str, order_col: str, text_col: str, role_col: str) -> Model:
    """The model of labelled transcripts, of which each fragment is one turn of
    the role in ``role_col``.

    All lines are counted, those of a fragment without a known role (null
    included) excepted; steps between two lines are counted within blocks. An
    empty table gives ``PRIOR``; repeated rows count as often as they stand.
    """
    base = _blocked(fragments, key_col, order_col, text_col, role_col)

    def counted(rows):
        states, obs = _true_states(rows), symbols(lines_of([r["t"] for r in rows]))
        tally: dict[tuple[int, int, int], int] = {}
        before = OPENING if rows[0]["block"] == 0 else -1
        for s, o in zip(states, obs.tolist(), strict=True):
            if s >= 0:
                marks = [(2, s, o)] + ([(0, 0, s)] if before == OPENING else [(1, before, s)] if before >= 0 else [])
                for k in marks:
                    tally[k] = tally.get(k, 0) + 1
            before = s
        return [{"kind": k, "i": i, "j": j, "n": n} for (k, i, j), n in tally.items()]

    rows = _apply(_dealt(base.select("key", "block", "at", "t", "role"), ["key", "block"], ["at", "t", "role"]), ("key", "block"),
                  counted, ["kind", "i", "j", "n"], "kind long, i long, j long, n long")
    counts = (np.zeros((1, STATES)), np.zeros((STATES, STATES)), np.zeros((STATES, SYMBOLS)))
    for r in rows.groupBy("kind", "i", "j").agg(F.sum("n").alias("n")).collect():   # at most STATES * (1 + STATES + SYMBOLS)
        counts[r["kind"]][r["i"], r["j"]] = r["n"]
    return model_of(counts[0][0], counts[1], counts[2])


def parse_transcripts(fragments: DataFrame, key_col: str, order_col: str, text_col: str, model: Model = PRIOR,
                      role_col: str | None = None) -> DataFrame:
    """One row per block of a transcript: key, block, n_lines, n_turns (that
    begin in it), roles (of these), text (canonical). A transcript's blocks in
    order are its canonical form; one of up to 256 fragments is a single row.
    With ``role_col`` (the true role, which the parser does not see) n_right
    counts the lines whose role was found.

    Fragments are ordered by ``order_col`` (an integer; null comes first as
    -1, ties by text) and blocked by position; those before 0 share no block
    with the others. A null text has no line; null
    keys are one transcript. An empty table gives an empty table.
    """
    base = _blocked(fragments, key_col, order_col, text_col, role_col)

    def matrix_of(r):
        return None if r["matrix"] is None else np.array(r["matrix"]).reshape(STATES + 1, STATES)

    def summed(rows):
        obs = symbols(lines_of([r["t"] for r in rows]))
        return [{"key": rows[0]["key"], "block": rows[0]["block"],
                 "matrix": block_matrix(obs, model).ravel().tolist() if len(obs) else None}]

    def multiplied(rows):
        m = product([matrix_of(r) for r in rows])
        return [{"key": rows[0]["key"], "block": rows[0]["part"], "matrix": None if m is None else m.ravel().tolist()}]

    def chained(rows):
        ends = chain([matrix_of(r) for r in rows], rows[0].get("entry", OPENING), rows[0].get("exit"))
        return [{"key": r["key"], "block": r["block"], "entry": a, "exit": z} for r, (a, z) in zip(rows, ends, strict=True)]

    def written(rows):
        lines = lines_of([r["t"] for r in rows])
        states = path(symbols(lines), rows[0]["entry"], rows[0]["exit"], model)
        text, roles = render(lines, states)
        right = sum(t >= 0 and t // 2 == s // 2 for t, s in zip(_true_states(rows), states.tolist(), strict=True))
        return [{"given": rows[0]["given"], "block": rows[0]["block"], "n_lines": len(lines), "n_turns": len(roles),
                 "roles": roles, "text": text, "n_right": right}]

    part = F.floor(F.col("block") / FAN).cast("long").alias("part")   # blocks before 0 stay before 0
    sums, pairs = "key string, block long, matrix array<double>", "key string, block long, entry long, exit long"
    levels = [materialize(_apply(_dealt(base.select("key", "block", "at", "t"), ["key", "block"], ["at", "t"]), ("key", "block"),
                                 summed, ["key", "block", "matrix"], sums), "chat_blocks")]
    top = levels[0].agg(F.max("block")).first()[0] or 0
    while top >= FAN:
        parts = _dealt(levels[-1].select("*", part), ["key", "part"], ["block"])
        levels.append(materialize(_apply(parts, ("key", "part"), multiplied, ["key", "block", "matrix"], sums), "chat_blocks"))
        top //= FAN
    ends = _apply(_dealt(levels[-1], ["key"], ["block"]), ("key",), chained, ["key", "block", "entry", "exit"], pairs)
    for lower in reversed(levels[:-1]):
        upper = ends.withColumnRenamed("block", "part")
        ends = _apply(_dealt(lower.select("*", part).join(upper, ["key", "part"]), ["key", "part"], ["block"]), ("key", "part"),
                      chained, ["key", "block", "entry", "exit"], pairs)
    given = fragments.schema[key_col].dataType
    out = _apply(_dealt(base.join(ends, ["key", "block"]), ["key", "block"], ["at", "t", "role"]), ("key", "block"), written,
                 ["block", "n_lines", "n_turns", "roles", "text", "n_right"],
                 f"given {given.simpleString()}, block long, n_lines long, n_turns long, roles array<string>, text string, n_right long",
                 extra=[("given", to_arrow_type(given))])
    return (out if role_col else out.drop("n_right")).withColumnRenamed("given", key_col)


def transcripts(conversations: DataFrame, rough: bool = False) -> DataFrame:
    """Turns of ``conversations`` as fragments of raw transcripts (conv_id,
    turn, text, role). A conversation's style, by its id, is one of four ways to
    mark speakers; the text follows on the marker's line or on the next.

    ``rough`` transcripts are harder to read. By the checksum of ``conv_id:turn``
    a quarter of the turns has no marker, a quarter no blank line before it, and
    in a third all lines of the text are set apart by blank lines.
    """
    role, text = F.coalesce("role", F.lit("user")), F.coalesce("text", F.lit(""))
    said = F.when(role == "assistant", "AI").when(role == "user", "Human").otherwise("System")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    style = F.pmod(F.crc32(conv.cast("binary")), F.lit(4))
    h = F.crc32(F.concat(conv, F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(""))).cast("binary"))
    if rough:
        text = F.when(F.floor(h / 16) % 3 == 0, F.replace(text, F.lit("\n"), F.lit("\n\n"))).otherwise(text)
    marked = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": "), text))
        .when(style == 1, F.concat(F.lit("### "), said, F.lit(":\n"), text))
        .when(style == 2, F.concat(F.lit("<|"), role, F.lit("|>\n"), text))
        .otherwise(F.concat(F.lit("["), F.upper(role), F.lit("] "), text))
    )
    before = F.lit("\n")
    if rough:
        marked = F.when(h % 4 == 0, text).otherwise(marked)
        before = F.when(F.floor(h / 4) % 4 == 0, "").otherwise(before)
    return conversations.select("conv_id", "turn", F.concat(before, marked, F.lit("\n")).alias("text"), role.alias("role"))


def formatted(conversations: DataFrame) -> DataFrame:
    """Canonical form of every conversation, from its raw transcript, by the
    prior model."""
    return parse_transcripts(transcripts(conversations), "conv_id", "turn", "text")


def formatted_learnt(conversations: DataFrame) -> DataFrame:
    """Canonical form of every conversation from its rough transcript, by a model
    counted on those conversations whose crc32(conv_id as text) mod 4 is not 2.
    ``held_out`` tells the others; ``n_right`` counts lines with the right role."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    raw = transcripts(conversations, rough=True)
    model = fit(raw.where(~held_out), "conv_id", "turn", "text", "role")
    return parse_transcripts(raw, "conv_id", "turn", "text", model, "role").withColumn("held_out", held_out)
