"""Array helpers shared by the text operators: blocks of whole texts from Arrow
batches, words in a byte buffer, and rolling polynomial hashes.

All hashing is arithmetic modulo 2**64, so the same bytes give the same value
in every task, on every machine.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# [\x20\x09-\x0D]: the bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# A-Z to a-z, every other byte unchanged.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
BLOCK_BYTES = 1 << 20
STRETCH = 1 << 18

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i (mod 2**64) for i < n; the table grows by doubling."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        have = _tables[base] = (pair[0], pair[1])
    return have


def range_hashes(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[s:e] for every (s, e), from prefix sums; equal
    ranges have equal hashes wherever they stand. ``starts`` must ascend; long
    arrays are worked off in stretches, which bounds the memory."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = int(np.searchsorted(starts, lo + STRETCH)) if len(values) > STRETCH else len(starts)
        part = values[lo:ends[i:j].max()].astype(np.uint64) + np.uint64(1)
        up, down = _powers(base, len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a byte buffer."""
    return spans(~SPACE[buf])


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.empty(len(inside) + 1, bool)
    if len(inside):
        edge[0], edge[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    else:
        edge[0] = False
    at = np.flatnonzero(edge)
    return at[::2], at[1::2]


def small_batches(spark) -> None:
    """Arrow batches of a few MB, so that a Python worker's memory follows its
    blocks and not 10,000 rows of whole texts (a setting of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


_libc = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back to the system: a Python worker lives on after
    its task, and what it holds is missing to the executor's other work."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    release()  # of the batch before
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) that cover all texts, each of about ``limit`` bytes
    or one longer text."""
    a = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t) + 1
    if a < len(texts):
        yield a, len(texts)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each followed by a newline, and each text's
    first byte (and the total length at the end)."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=first[1:])
    return buf, first


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i:i+width] for every i, by doubling."""
    have, span = x, 1
    while span * 2 <= width:
        have, span = np.minimum(have[: len(have) - span], have[span:]), span * 2
    if span < width:
        rest = width - span
        have = np.minimum(have[: len(have) - rest], have[rest:])
    return have
