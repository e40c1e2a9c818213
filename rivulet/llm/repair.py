"""Conversation structure repair by a generalised LR parser with repairs.

The roles of a conversation, by their initials, should be ``(s?(ua)+)?``: an
optional system turn, then user and assistant in pairs. ``lr_automaton`` makes
the LR(0) item sets of that grammar; the parser keeps a graph-structured stack,
whose nodes (a state and the node below it) are shared between all parses that
are still possible, and over it one front: for every stack top the cheapest
``(cost, audit)`` that leads there. A row may be kept (0) or reroled to user or
assistant (1), if the grammar can go on with it, or deleted (2); an empty user or
assistant turn may be inserted anywhere (5). Blank and repeated rows must be
deleted, truncated ones that stay cost 5 more. Parses that reach an equal stack
top are merged by the smallest (cost, audit). The grammar is left-recursive, so
only a few stacks exist.

**Scale.** Rows are numbered within their conversation by one range exchange
(``sequences.next_ids``) and parsed in blocks of ``BLOCK`` rows. A block that is not
a whole conversation is parsed from every stack top: the result, a table of
(top before, top after) -> (cost, audit), is associative, and the tables of a long
conversation are folded ``FAN`` at a time in as many rounds as its length needs.
So no task holds a conversation's rows, whichever share of all rows it has; only
its audit, one letter a row, is one value, as the result has it. Edits are joined
to the rows by (conversation, position).

The digest of a repaired conversation (``repaired_digests``) is one SHA-256 over its
lines in order, which no two tasks can share: its chunks of lines are joined
where they lie and pass one task as a sorted stream, a batch at a time.

A null role or text is one space (so: blank, or an initial of its own), an empty
role has no initial; a null id is a conversation like any other, null turns come
first, equal turns go by role and text; a repeated row is a duplicate; texts of
any length are hashed, never gathered; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm import staged
from rivulet.llm.blocks import small_batches
from rivulet.operators.sequences import next_ids

# (s?(ua)+)?, left-recursive
GRAMMAR = (("C", ()), ("C", ("B",)), ("B", ("u", "a")), ("B", ("s", "u", "a")), ("B", ("B", "u", "a")))
SYMBOLS = "sua"
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
BLOCK = 512       # rows that are parsed at once
FAN = 16          # tables that are folded at once
MAX_STACKS = 1000
SPACE = " \t\n\x0b\x0c\r"
# the rows' codes: initial (index in "sua", 3: another) * 3 + fault
CLEAN, SHORT, GONE = 0, 1, 2
TABLE = "array<struct<a:int,b:int,cost:long,audit:string>>"


# ------------------------------------------------------------------ grammar

def lr_automaton(grammar: Sequence[tuple[str, tuple[str, ...]]]) -> tuple[list[dict[str, int]], list[list[tuple[str, int]]]]:
    """LR(0) states of a grammar (its first left side is the start): for each
    state the states after a symbol, and the (left side, length) to reduce."""
    rules: dict[str, list[tuple[str, ...]]] = {}
    for left, right in grammar:
        rules.setdefault(left, []).append(right)

    def closed(items: set) -> frozenset:
        todo, out = list(items), set(items)
        while todo:
            _, right, dot = todo.pop()
            if dot < len(right):
                for more in rules.get(right[dot], ()):
                    item = (right[dot], more, 0)
                    if item not in out:
                        out.add(item)
                        todo.append(item)
        return frozenset(out)

    states = [closed({("", (grammar[0][0],), 0)})]
    number, goto, reduce = {states[0]: 0}, [], []
    for state in states:  # grows while it runs
        after: dict[str, set] = {}
        for left, right, dot in state:
            if dot < len(right):
                after.setdefault(right[dot], set()).add((left, right, dot + 1))
        row = {}
        for symbol in sorted(after):
            nxt = closed(after[symbol])
            if nxt not in number:
                number[nxt] = len(states)
                states.append(nxt)
            row[symbol] = number[nxt]
        goto.append(row)
        reduce.append(sorted((left, len(right)) for left, right, dot in state if dot == len(right)))
    return goto, reduce


@lru_cache(maxsize=4)
def stack_graph(grammar=GRAMMAR, symbols: str = SYMBOLS) -> tuple[list[list[list[int]]], list[bool]]:
    """The graph-structured stack as far as the grammar can build it. Node 0 is
    the start; for every node, the nodes after each symbol (all reductions done)
    and whether the input may end there."""
    goto, reduce = lr_automaton(grammar)

    def reduced(stacks: set) -> set:
        todo, out = list(stacks), set(stacks)
        while todo:
            stack = todo.pop()
            for left, n in reduce[stack[0]]:
                below = stack
                for _ in range(n):
                    below = below[1]
                if left in goto[below[0]]:
                    new = (goto[below[0]][left], below)
                    if new not in out:
                        out.add(new)
                        todo.append(new)
        return out

    live = lambda s: any(x in goto[s[0]] for x in symbols)
    start = (0, None)
    nodes, at, steps = [start], {start: 0}, []
    done = goto[0][grammar[0][0]]
    for node in nodes:  # grows while it runs
        row = []
        for symbol in symbols:
            shifted = {(goto[s[0]][symbol], s) for s in reduced({node}) if symbol in goto[s[0]]}
            targets = []
            for new in sorted(filter(live, reduced(shifted)), key=repr):
                if new not in at:
                    at[new] = len(nodes)
                    nodes.append(new)
                    if len(nodes) > MAX_STACKS:
                        raise ValueError("the grammar needs unbounded stacks; write it left-recursive")
                targets.append(at[new])
            row.append(targets)
        steps.append(row)
    return steps, [any(s[0] == done for s in reduced({n})) for n in nodes]


# ------------------------------------------------------------------ parser

Front = dict[int, tuple[int, str]]


def _offer(front: Front, top: int, cost: int, audit: str) -> bool:
    """Merge a parse into the front: equal tops keep the smallest (cost, audit)."""
    new = (cost, audit)
    if top not in front or new < front[top]:
        front[top] = new
        return True
    return False


def _inserted(front: Front, steps) -> Front:
    """The front and what insertions reach from it."""
    todo = list(front)
    while todo:
        top = todo.pop()
        cost, audit = front[top]
        for symbol in (1, 2):
            for nxt in steps[top][symbol]:
                if _offer(front, nxt, cost + INSERT, audit + "I"):
                    todo.append(nxt)
    return front


def parse(codes: Sequence[int], start: int = 0) -> Front:
    """The front after rows of the given codes, from the stack top ``start``."""
    steps, _ = stack_graph()
    front: Front = {start: (0, "")}
    for code in codes:
        initial, fault = divmod(code, 3)
        new: Front = {}
        for top, (cost, audit) in _inserted(front, steps).items():
            _offer(new, top, cost + DELETE, audit + "D")
            if fault == GONE:
                continue
            stays = cost + (TRUNCATED if fault == SHORT else 0)
            for symbol in range(3):
                if symbol == initial or symbol:
                    for nxt in steps[top][symbol]:
                        _offer(new, nxt, stays + (symbol != initial) * REROLE, audit + ("K" if symbol == initial else "R"))
        front = new
    return _inserted(front, steps)


def folded(tables: Sequence[Sequence[tuple[int, int, int, str]]]) -> list[tuple[int, int, int, str]]:
    """The table of consecutive blocks from theirs."""
    out = tables[0]
    for table in tables[1:]:
        onward: dict[int, list] = {}
        for a, b, cost, audit in table:
            onward.setdefault(a, []).append((b, cost, audit))
        best: dict[tuple[int, int], tuple[int, str]] = {}
        for a, mid, cost, audit in out:
            for b, more, rest in onward.get(mid, ()):
                key, total = (a, b), cost + more
                if key not in best or total < best[key][0] or total == best[key][0] and audit + rest < best[key][1]:
                    best[key] = (total, audit + rest)
        out = [(a, b, cost, audit) for (a, b), (cost, audit) in best.items()]
    return out


def cheapest(table: Sequence[tuple[int, int, int, str]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation's table."""
    _, ends = stack_graph()
    return min((cost, audit) for a, b, cost, audit in table if a == 0 and ends[b])


def edits(audit: str) -> Iterator[tuple[int, int | None, str, str | None]]:
    """(position in the result, row or None, edit, new role or None) of every
    turn that an audit leaves; both count from 1."""
    odd = (len(audit) - audit.count("D")) % 2
    row = out = 0
    for letter in audit:
        row += letter != "I"
        if letter == "D":
            continue
        out += 1
        role = None if letter == "K" else NAMES["u" if (out - odd) % 2 else "a"]
        yield out, None if letter == "I" else row, letter, role


def _illegal(codes: Sequence[int]) -> int:
    of = ["s", "u", "a", ""]
    initials = [of[c // 3] for c in codes]
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


# ------------------------------------------------------------------ Spark

def _table_array(tables: list) -> pa.Array:
    return pa.array([[dict(zip(("a", "b", "cost", "audit"), e)) for e in t] for t in tables],
                    pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))


def _parsed(batches):
    """(ck, block, codes) to (ck, block, table, first, last, illegal)."""
    n_tops = len(stack_graph()[0])
    for batch in batches:
        tables, first, last, illegal = [], [], [], []
        for block, codes in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist()):
            # block 0 begins at the start; any other from every top
            starts = [0] if block == 0 else range(n_tops)
            tables.append([(a, b, *x) for a in starts for b, x in parse(codes, a).items()])
            first.append(codes[0] // 3)
            last.append(codes[-1] // 3)
            illegal.append(_illegal(codes))
        yield pa.RecordBatch.from_arrays(
            [batch.column("ck"), batch.column("block"), _table_array(tables), pa.array(first, pa.int32()),
             pa.array(last, pa.int32()), pa.array(illegal, pa.int64())], ["ck", "block", "table", "first", "last", "illegal"])


def _folded(batches):
    """(ck, block, parts: tables in order) to one row like ``_parsed``'s."""
    for batch in batches:
        for i in range(batch.num_rows):
            parts = batch.column("parts")[i].as_py()
            tables = [[(e["a"], e["b"], e["cost"], e["audit"]) for e in p["table"]] for p in parts]
            border = sum(_illegal([3 * p["last"], 3 * q["first"]]) for p, q in zip(parts, parts[1:]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ck").slice(i, 1), batch.column("block").slice(i, 1), _table_array([folded(tables)]),
                 pa.array([parts[0]["first"]], pa.int32()), pa.array([parts[-1]["last"]], pa.int32()),
                 pa.array([sum(p["illegal"] for p in parts) + border], pa.int64())],
                ["ck", "block", "table", "first", "last", "illegal"])


def _solved(batches):
    for batch in batches:
        got = [cheapest([(e["a"], e["b"], e["cost"], e["audit"]) for e in t]) for t in batch.column("table").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("ck"), batch.column("illegal"), pa.array([c for c, _ in got], pa.int64()), pa.array([a for _, a in got], pa.string())],
            ["ck", "illegal", "cost", "audit"])


def _edited(batches):
    """(ck, audit) to a row per turn that stays, in batches of bounded size."""
    names = ["ck", "out", "pos", "edit", "new_role"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    rows: list[tuple] = []

    def made():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for ck, audit in zip(batch.column("ck").to_pylist(), batch.column("audit").to_pylist()):
            for e in edits(audit):
                rows.append((ck, *e))
                if len(rows) >= 10_000:
                    yield made()
                    rows.clear()
    if rows:
        yield made()


def _hashed(batches):
    """Sorted (ck, chunk, lines) to (ck, sha256 of all lines), as a stream."""
    now, digest = None, None
    for batch in batches:
        done = []
        for ck, lines in zip(batch.column("ck").to_pylist(), batch.column("lines")):
            if ck != now:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = ck, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(lines.as_buffer())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["ck", "repaired_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], ["ck", "repaired_sha256"])


def _ck(c: Column) -> Column:
    """A conversation's key as text; null is a key of its own."""
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), c.cast("string")))


def faults(rows: DataFrame) -> DataFrame:
    """(ck, turn, role, text) plus pos (from 1) and fault (blank, duplicate,
    truncated or null)."""
    numbered = next_ids(rows.select("ck", "turn", "role", "text"), "ck", ["turn", "role", "text"], id_col="pos")
    kept = F.rtrim(F.col("text"), F.lit(SPACE))
    seen = numbered.groupBy("ck", "role", F.sha2("text", 256).alias("h")).agg(F.min("pos").alias("pos"))
    # (by position, so a turn that fills a conversation is no hot key)
    marked = numbered.join(seen.select("ck", "pos", F.lit(True).alias("first")), ["ck", "pos"], "left")
    fault = (F.when(kept == "", "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.substring(kept, -1, 1).isin(".", "!", "?"), "truncated"))
    return marked.select("ck", "pos", "turn", "role", "text", fault.alias("fault"))


def repair(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, report). ``turns``: ck, out (1, 2, ...), pos (the row's place before,
    null for an inserted turn), edit (K, R or I), role, text. ``report``: per
    conversation ck, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    small_batches(turns.sparkSession)
    filled = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(_ck(F.col(f"`{key}`")).alias("ck"), F.col(f"`{order}`").alias("turn"), filled(role).alias("role"),
                        filled(text).alias("text"))
    marked, _ = staged.stage(faults(rows), "repair_rows")
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", 0).when(initial == "u", 3).when(initial == "a", 6).otherwise(9)
            + F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", SHORT).otherwise(CLEAN))
    of = lambda f: F.sum((F.coalesce(F.col("fault"), F.lit("")) == f).cast("long")).alias(f)
    blocks = (marked.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK)).groupBy("ck", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", code.cast("int").alias("code")))).getField("code").alias("codes")))
    schema = f"ck string, block long, table {TABLE}, first int, last int, illegal long"
    tables, _ = staged.stage(blocks.mapInArrow(_parsed, schema), "repair_tables")
    longest = tables.agg(F.max("block")).first()[0] or 0
    while longest:  # log(longest conversation) rounds
        whole = F.struct("block", "table", "first", "last", "illegal")
        groups = (tables.withColumn("node", F.floor(F.col("block") / FAN)).groupBy("ck", "node")
                  .agg(F.array_sort(F.collect_list(whole), lambda x, y: (x["block"] - y["block"]).cast("int")).alias("parts")))
        tables, _ = staged.stage(groups.select("ck", F.col("node").alias("block"), "parts").mapInArrow(_folded, schema), "repair_tables")
        longest //= FAN
    solved, _ = staged.stage(tables.select("ck", "illegal", "table").mapInArrow(
        _solved, "ck string, illegal long, cost long, audit string"), "repair_audits")
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = marked.groupBy("ck").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
    counts = marked.groupBy("ck").agg(of("blank"), of("duplicate"), of("truncated"))
    report = solved.join(gaps, "ck").join(counts, "ck").select(
        "ck", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edited, _ = staged.stage(solved.select("ck", "audit").mapInArrow(
        _edited, "ck string, out long, pos long, edit string, new_role string"), "repair_edits")
    stayed = edited.where("pos is not null").join(marked.select("ck", "pos", "role", "text"), ["ck", "pos"])
    stayed = stayed.select("ck", "out", "pos", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    added = edited.where("pos is null").select("ck", "out", "pos", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return stayed.unionByName(added), report


def damaged(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(key, order, role, text) after the contract's damage, by the checksum of
    ``key:order`` (nulls: one space) modulo 20."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    h = F.crc32(F.concat(name(key), F.lit(":"), name(order)).cast("binary")) % 20
    rows = turns.select(F.col(f"`{key}`").alias(key), F.col(f"`{order}`").alias(order), name(role).alias(role), name(text).alias(text),
                        h.alias("_h")).where("_h <> 0")
    new_text = F.when(F.col("_h") == 1, "").when(F.col("_h") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    new_role = F.when(F.col("_h") == 4, "user").otherwise(F.col(role))
    times = F.explode(F.when(F.col("_h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select(key, order, new_role.alias(role), new_text.alias(text), times.alias("_t")).drop("_t")


def repaired_digests(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
                     text: str = "text") -> DataFrame:
    """The damaged conversations' repair, a row per original id: key, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    fixed, report = repair(damaged(turns, key, order, role, text), key, order, role, text)
    line = F.concat("role", F.lit(":"), "text")
    chunks = fixed.groupBy("ck", F.floor((F.col("out") - 1) / BLOCK).alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("out", line.alias("line")))).getField("line"), "\n").alias("lines"))
    digests = (chunks.repartition("ck").sortWithinPartitions("ck", "chunk").select("ck", "lines")
               .mapInArrow(_hashed, "ck string, repaired_sha256 string"))
    ids = turns.select(F.col(f"`{key}`").alias(key)).distinct().withColumn("ck", _ck(F.col(key)))
    out = ids.join(report, "ck", "left").join(digests, "ck", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(key, *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
