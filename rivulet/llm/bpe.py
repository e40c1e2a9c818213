"""Byte-level BPE by a lazily determinised finite-state transducer.

The transducer reads one byte at a time. Its state holds every point from
which a token may still be running: the bytes read since, and the last token
before. A transition gives the token that ends the text up to its byte; tokens
are emitted where the paths of all running points have joined, since no later
byte can change them. A token can run for as many bytes as the longest one in
the vocabulary, so the lookahead is bounded and the states are finite. A
state's transitions are worked out the first time they are taken and looked up
from then on.

Which token ends a prefix is decided by one rule: a sequence of tokens is the
BPE encoding of its bytes exactly when each pair of neighbours is the encoding
of its own bytes, so the last token of a longer prefix is the one that ends it
and gets along with the last token before it.

Decoding is a stream as well: tokens' bytes go through a UTF-8 state machine
that holds back an unfinished character until its last byte has come.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from rivulet.llm.blocks import small_batches
from rivulet.llm.packing import rank_file

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MEMO_WORDS = 500_000     # words whose ids a worker remembers
MEMO_STEPS = 1_200_000   # transitions that it remembers
SETTLE = 4096            # bytes of one word after which settled tokens are emitted


def merge_bytes(word: bytes, ranks: dict[bytes, int], below: int = 1 << 60) -> list[int]:
    """BPE of one word by its definition: join the pair of lowest rank,
    leftmost first, until no pair is a token (of a rank under ``below``)."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        low, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if low >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """BPE of single words by lazily built transitions."""

    def __init__(self, ranks: dict[bytes, int], memo: int = MEMO_STEPS):
        self.ranks, self.limit = ranks, memo
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.length = {i: len(t) for t, i in ranks.items()}
        # The tokens as a tree of bytes: node and byte to the next node.
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]        # the token that ends in a node
        self.inner: set[int] = {0}
        for token, i in ranks.items():
            node = 0
            for byte in token:
                self.inner.add(node)
                key = node << 8 | byte
                node = self.child.get(key, -1)
                if node < 0:
                    node = self.child[key] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = i
        self.made_of: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all transitions (a bound on memory, not on texts)."""
        # A state: the points from which a token may be running, oldest first,
        # as (node of the bytes read since, last token before; -1 for none).
        # It is known by its table: byte to (next state's table, token).
        start = ((0, -1),)
        self.start: dict = {None: start}
        self.tables = {start: self.start}
        self.pairs: dict[int, bool] = {}
        self.taken = 0

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose join makes ``token``; None for a single byte
        (and for a token that no joins lead to)."""
        got = self.made_of.get(token, 0)
        if got == 0:
            parts = merge_bytes(self.bytes_of[token], self.ranks, token)
            got = self.made_of[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return got

    def neighbours(self, a: int, b: int) -> bool:
        """Whether BPE leaves ``a`` and ``b`` apart when they meet. Joins are
        undone from the latest on, on either side of the border; the two are
        torn apart by a join across it that comes before what was undone."""
        key = a << 20 | b
        got = self.pairs.get(key)
        if got is None:
            got = self.pairs[key] = self.apart(a, b)
        return got

    def apart(self, a: int, b: int) -> bool:
        now = 1 << 60   # joins from this rank on (left of the border: with it) are undone
        while True:
            across = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if across is not None and across < now:
                return False
            left, right = self.halves(a), self.halves(b)
            if left is None and right is None:
                return True
            # Equal ranks: the left one was joined first.
            if right is None or left is not None and a > b:
                now, a = a, left[1]
            else:
                now, b = b + 1, right[0]

    def step(self, table: dict, byte: int) -> tuple[dict, int]:
        """Work out one transition: the next state's table and the token that
        ends the text up to here."""
        running, here = [], -1
        for node, last in table[None]:
            node = self.child.get(node << 8 | byte, -1)
            if node < 0:
                continue
            token = self.ends[node]
            if here < 0 and token >= 0 and (last < 0 or self.neighbours(last, token)):
                here = token
            if node in self.inner:
                running.append((node, last))
        running.append((0, here))
        state = tuple(running)
        to = self.tables.get(state)
        if to is None:
            to = self.tables[state] = {None: state}
        got = table[byte] = (to, here)
        self.taken += 1
        return got

    def encode(self, word: bytes) -> list[int]:
        if self.taken > self.limit:
            self.reset()
        table, ending, out = self.start, [], []
        for a in range(0, len(word), SETTLE):
            for byte in word[a:a + SETTLE]:
                got = table.get(byte)
                if got is None:
                    got = self.step(table, byte)
                table, token = got
                ending.append(token)
            if a + SETTLE < len(word):  # emit what no later byte can change
                settled = self.settled(table[None], ending)
                out += self.path(ending[:settled])
                del ending[:settled]
        return out + self.path(ending) if out else self.path(ending)

    def path(self, ending: list[int]) -> list[int]:
        """The tokens of a text, from the token that ends each prefix."""
        out, i = [], len(ending)
        while i > 0:
            out.append(ending[i - 1])
            i -= self.length[ending[i - 1]]
        return out[::-1]

    def settled(self, state: tuple, ending: list[int]) -> int:
        """Bytes whose tokens no later byte can change: up to where the paths
        of all running points join."""
        at = [len(ending) - self.depth(node) for node, _ in state]
        while len(set(at)) > 1:
            far = max(at)
            back = far - self.length[ending[far - 1]]
            at = [back if x == far else x for x in at]
        return at[0]

    def depth(self, node: int) -> int:
        if not hasattr(self, "depths"):
            self.depths = {0: 0}
            for key, to in self.child.items():  # parents come first
                self.depths[to] = self.depths[key >> 8] + 1
        return self.depths[node]


class Codec:
    """Texts to ids and back, with a bounded memo of words."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.machine = Transducer(rank_file(path))
        self.find = regex.compile(pattern).findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self.table = [self.machine.bytes_of.get(i, b"") for i in range(max(self.machine.bytes_of) + 1)]

    def encode(self, text: str) -> list[int]:
        memo, out = self.memo, []
        for word in self.find(text):
            ids = memo.get(word)
            if ids is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                ids = memo[word] = tuple(self.machine.encode(word.encode()))
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


# Fixed values (UTF-8): what a leading byte says about the bytes after it.
_CONTINUED = [0] * 0xC2 + [1] * 30 + [2] * 16 + [3] * 5 + [0] * 11


class Utf8Stream:
    """Incremental UTF-8: bytes in, whole characters out; the bytes of an
    unfinished character wait for the next call. Malformed bytes become
    U+FFFD, as in ``bytes.decode(errors="replace")``."""

    def __init__(self):
        self.waiting = b""

    def feed(self, chunk: bytes) -> str:
        data = self.waiting + chunk
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):  # a character has 4 bytes at most
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                if _CONTINUED[lead] >= back and _starts_well(data[-back:]):
                    cut -= back
                break
        self.waiting = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")

    def close(self) -> str:
        rest, self.waiting = self.waiting, b""
        return rest.decode("utf-8", errors="replace")


def _starts_well(tail: bytes) -> bool:
    """Whether an unfinished tail can still become a character: the second
    byte of some leading bytes is limited (no overlong forms, surrogates or
    values above U+10FFFF)."""
    if len(tail) < 2:
        return True
    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(tail[0], (0x80, 0xBF))
    return low <= tail[1] <= high


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a rank file; its transitions outlive a task."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_column(text: Column, path: str = RANKS) -> Column:
    """Ids (array<int>) of a text column; null and empty texts give []."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        c, ids, ends = codec(path), [], [0]
        for t in texts.to_pylist():
            got = np.array(c.encode(t or ""), np.int32)
            ids.append(got)
            ends.append(ends[-1] + len(got))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    return encode(text)


def decode_column(ids: Column, path: str = RANKS) -> Column:
    """Text of a column of ids; null gives the empty text."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        c, out = codec(path), []
        flat, ends = rows.values.to_numpy(zero_copy_only=False), rows.offsets.to_numpy()
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            stream = Utf8Stream()
            parts = [stream.feed(c.decode(flat[i:min(i + 65536, b)].tolist())) for i in range(a, b, 65536)]
            out.append("".join([*parts, stream.close()]))
        return pa.array(out, pa.string())

    return decode(ids)


def round_trip(docs, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS):
    """Every document encoded and decoded: id, ids, decoded."""
    small_batches(docs.sparkSession)
    return (
        docs.select(id_col, encode_column(F.col(text_col), path).alias("ids"))
        .withColumn("decoded", decode_column(F.col("ids"), path))
    )


def bpe_digests(docs):
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one space) and
    decoded_sha256 (the decoded bytes)."""
    return round_trip(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
