"""Sharding, exact dedup, packing, BPE and substring dedup against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm import bpe, exact_dedup, packing, sharding, substring_dedup

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# 1. sharding

def check_shards(df, n):
    rows = sharding.shard_documents(df, n).collect()
    given_rows = df.collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in given_rows)
    assert Counter(r.text_crc32 for r in rows) == Counter(zlib.crc32((r.text or "").encode()) for r in given_rows)
    slots = defaultdict(list)
    mix = defaultdict(Counter)
    for r in rows:
        slots[r.shard].append(r.slot)
        mix[r.source][r.shard] += 1
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    counts = [len(slots.get(i, [])) for i in range(n)]
    assert max(counts) - min(counts) <= 1
    assert {r.law for r in rows} <= {"rows"}
    return rows, mix


def test_shards_of_documents(docs):
    rows, mix = check_shards(docs, 8)
    for per_shard in mix.values():  # fractional ranks: a source is one row off its share at most, per end of a shard
        want = sum(per_shard.values()) / 8
        assert all(abs(per_shard[i] - want) < 2 for i in range(8))


def test_shards_of_odd_rows(odd, none):
    check_shards(odd, 3)
    check_shards(odd, 64)  # more shards than rows
    assert sharding.shard_documents(none).count() == 0


def test_shards_are_the_same_in_any_partitioning(docs):
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in sharding.shard_documents(df).collect())
    assert key(docs) == key(docs.repartition(7))


def test_shards_brute_force(docs):
    """Ranks and cuts by plain sorting."""
    rows = docs.select("doc_id", "source").collect()
    h = lambda i: int(hashlib.md5(f"17|{i}".encode()).hexdigest()[:15], 16)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append((h(r.doc_id) % 1024, h(r.doc_id), r.doc_id))
    line = []
    for s, items in by.items():
        for r, (_, _, i) in enumerate(sorted(items), 1):
            line.append(((2 * r - 1) * 4096 // (2 * len(items)), (2 * r - 1) / (2 * len(items)), "v" + s, r, i))
    want = {i: p * 8 // len(rows) for p, (*_, i) in enumerate(sorted(line))}
    assert {r.doc_id: r.shard for r in sharding.shard_documents(docs).collect()} == want


def test_shard_columns_of_the_input_do_not_clash(docs):
    extra = docs.select("doc_id", "source", F.lit("x").alias("shard"), F.lit(1).alias("h"), F.lit(2).alias("b"), F.lit(3).alias("s"), F.lit(4).alias("n"))
    out = sharding.interleave(extra, 4)
    assert out.columns == ["doc_id", "source", "h", "b", "s", "n", "shard", "slot"]
    assert out.where("h != 1 or b != 2 or s != 3 or n != 4").count() == 0


# 4. exact dedup

def brute_exact(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[fold(t)].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        stay = (max if largest else min)(known) if known else None
        out += [(i, stay, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_against_brute_force(odd, docs, largest, weak):
    """``weak``: a hash under which many texts collide."""
    hash128 = (lambda t: bytes([len(t) % 3]) * 16) if weak else exact_dedup.md5_128
    for df in (odd, docs):
        got = exact_dedup.exact_duplicates(df, keep="largest" if largest else "smallest", hash128=hash128).collect()
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == brute_exact(rows, largest)
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept) == {r.text_sha256 for r in got} and set(kept.values()) <= {1}
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_drop_keeps_columns(odd, none):
    out = exact_dedup.drop_exact_duplicates(odd, keep="smallest")
    assert out.columns == odd.columns
    assert out.count() == len({fold(r.text) for r in odd.collect()})
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    clash = odd.select("doc_id", "text", F.lit(1).alias("h"), F.lit(2).alias("salt"), F.lit(3).alias("id"), F.lit(4).alias("kept"))
    assert exact_dedup.drop_exact_duplicates(clash).where("h = 1 and salt = 2 and id = 3 and kept = 4").count() == out.count()


# 6. packing

def test_packing_against_the_tokenizers_library(odd, docs):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for df in (odd.withColumn("doc_id", F.monotonically_increasing_id()), docs):
        texts = {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
        pieces = packing.pack(df).collect()
        by_doc, by_seq = defaultdict(list), defaultdict(list)
        for p in pieces:
            ids = np.frombuffer(p.ids, "<u4").tolist()
            assert len(ids) == p.length
            by_doc[p.doc_id].append((p.start, ids, p.doc_tokens))
            by_seq[p.sequence_id].append((p.offset, p.length))
        assert set(by_doc) == set(texts)
        for i, parts in by_doc.items():
            whole = [x for _, ids, _ in sorted(parts) for x in ids]
            assert whole == [*tok.encode(texts[i], add_special_tokens=False).ids, 0]
            assert {n for *_, n in parts} == {len(whole)}
        assert sorted(by_seq) == list(range(len(by_seq)))
        for s, spans in by_seq.items():
            end = 0
            for offset, length in sorted(spans):
                assert offset == end
                end += length
            assert end == 1024 or s == max(by_seq)


def test_packing_of_nothing_and_repeats(odd, none):
    assert packing.pack(none).count() == 0
    assert packing.pack(odd).agg(F.sum("length")).first()[0] == packing.pack(odd).where("start = 0").agg(F.sum("doc_tokens")).first()[0]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_packing_encoder_is_the_json(text):
    got = packing._encoder(packing.TOKENIZER).encode(text, allowed_special="all")
    assert got == _json_tokenizer().encode(text, add_special_tokens=False).ids


_tok = []


def _json_tokenizer():
    if not _tok:
        _tok.append(Tokenizer.from_file(packing.TOKENIZER))
    return _tok[0]


# 9. byte-level BPE

def own():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=packing.rank_file(bpe.RANKS), special_tokens={})


ENCODING = own()


@given(st.one_of(st.text(max_size=80), st.text(alphabet="abcdeinorst '\n\té", max_size=80)))
@settings(max_examples=400, deadline=None)
def test_transducer_is_bpe(text):
    c = bpe.codec(bpe.RANKS)
    assert c.encode(text) == ENCODING.encode_ordinary(text)
    assert c.decode(c.encode(text)) == text.encode()


def test_transducer_over_toy_merges():
    """Small random vocabularies against the definition."""
    import random

    for seed in range(30):
        rng = random.Random(seed)
        tokens = [bytes([b]) for b in range(256)]
        pool = [b"a", b"b", b"c"]
        for _ in range(12):
            t = rng.choice(pool) + rng.choice(pool)
            ranks = {x: i for i, x in enumerate([*tokens, t])}
            if t not in tokens and bpe.merge_bytes(t, ranks) == [len(tokens)]:  # joins lead to every token
                tokens.append(t)
                pool.append(t)
        ranks = {t: i for i, t in enumerate(tokens)}
        m = bpe.Transducer(ranks)
        for _ in range(200):
            w = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 25)))
            assert list(m.encode(w)) == bpe.merge_bytes(w, ranks)


def test_bpe_of_documents(odd, docs):
    for df in (odd, docs):
        rows = bpe.round_trip(df.select("doc_id", "text")).collect()
        assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter(
            (r.doc_id, tuple(ENCODING.encode_ordinary(r.text or "")), r.text or "") for r in df.collect())
    want = ENCODING.encode_ordinary(docs.where("doc_id = 3").first().text)
    got = bpe.bpe_digests(docs).where("doc_id = 3").first()
    assert (got.n_tokens, got.ids_sha256) == (len(want), hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest())


def test_bpe_of_nothing(none):
    assert bpe.bpe_digests(none).count() == 0


@given(st.binary(max_size=40), st.lists(st.integers(0, 40), max_size=6))
@settings(max_examples=400, deadline=None)
def test_utf8_stream_in_any_cuts(data, cuts):
    s, out, at = bpe.Utf8Stream(), "", 0
    for c in sorted(cuts):
        out += s.feed(data[at:c])
        at = max(at, min(c, len(data)))
    assert out + s.feed(data[at:]) + s.close() == data.decode("utf-8", errors="replace")


# 7. substring dedup

def brute_substring(rows, k=20):
    """(id, text) rows: number of words, and kept words, by a table of windows."""
    docs = sorted({(-(1 << 63) if i is None else i, t or "") for i, t in rows})
    seen, out = set(), {}
    for i, t in docs:
        w = SPLIT.findall(t)
        gone = set()
        for a in range(len(w) - k + 1):
            key = tuple(w[a:a + k])
            if key in seen:
                gone.update(range(a, a + k))
            seen.add(key)
        out[i, t] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def check_substring(df, **kw):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute_substring(rows)
    got = substring_dedup.repeated_words(df, carry=("text",), **kw).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter(
        (i, *want[-(1 << 63) if i is None else i, t or ""]) for i, t in rows)


def test_substring_against_brute_force(docs, odd):
    check_substring(docs)
    # rows that share an id only are ordered by a hash; give these ids of their own
    check_substring(odd.where("doc_id is not null"))


def test_substring_with_frequent_minimisers(docs, monkeypatch):
    """Every minimiser is frequent: all windows travel alone."""
    monkeypatch.setattr(substring_dedup, "_hot_cells", lambda *a: np.ones(1 << 16, bool))
    check_substring(docs)


def test_substring_with_colliding_hashes(docs, monkeypatch):
    """Window hashes of two bits: windows are told apart by their words."""
    real = substring_dedup.B.range_hashes

    def weak(values, base, starts, ends):
        h = real(values, base, starts, ends)
        return h & np.uint64(3) if base == substring_dedup.WINDOW_BASE else h

    some = docs.limit(12).union(docs.limit(12).withColumn("doc_id", F.col("doc_id") + 1000)).collect()
    packed = []
    for r in some:
        w = substring_dedup.Windows([r.text.encode()], 20, 4)
        parts = [w.text[w.start[a]:w.end[a + 19]] for a in w.at]
        if parts:
            packed.append(substring_dedup._packed(parts, np.full(len(parts), r.doc_id), np.zeros(len(parts), np.int64), w.at))
    plain = substring_dedup._first_occurrences(packed, 20, 4)
    monkeypatch.setattr(substring_dedup.B, "range_hashes", weak)
    coarse = substring_dedup._first_occurrences(packed, 20, 4)
    flat = lambda x: sorted((i, s + j) for i, _, s, n in zip(*[c.tolist() for c in x], strict=True) for j in range(n))
    assert flat(plain) == flat(coarse)


def test_substring_text_travels_once(docs, odd):
    """Packed, and not as a carried column too; texts that lose no word come back as they are."""
    out = substring_dedup.drop_repeats(docs)
    assert "x_text" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = [(i, t) for i, t in enumerate(["", None, " a\tb ", "x\n\ny", "ä" * 50, " ".join(map(str, range(50))) + "  "])]
    few = docs.sparkSession.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    assert {(r.doc_id, r.text) for r in substring_dedup.drop_repeats(few).collect()} == set(rows)


def test_substring_memory_of_a_block_and_a_bucket():
    """What a worker holds at once, by the bytes of text that it works on."""
    rng = random.Random(8)
    lines = [" ".join(f"{rng.randrange(1 << 20):x}" for _ in range(60)) for _ in range(3000)]
    texts = ["\n".join(rng.sample(lines, 10)).encode() for _ in range(600)]
    size = sum(map(len, texts))

    def peak(fn) -> float:
        tracemalloc.start()
        try:
            fn()
            return tracemalloc.get_traced_memory()[1] / size
        finally:
            tracemalloc.stop()

    w = substring_dedup.Windows(texts[:2], 20, 3)  # (tables of powers are there)
    assert peak(lambda: substring_dedup.Windows(texts, 20, 3)) < 30
    n = np.arange(len(texts))
    packed = [substring_dedup._packed([t.replace(b"\n", b" ")], n[i:i + 1], 0 * n[:1], 0 * n[:1]) for i, t in enumerate(texts)]
    substring_dedup._first_occurrences(packed[:2], 20, 3)
    assert len(w.at) and peak(lambda: substring_dedup._first_occurrences(packed, 20, 3)) < 30


def test_substring_drop(odd, none):
    assert substring_dedup.drop_repeats(none).count() == 0
    out = substring_dedup.drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    same = {(r.doc_id, r.text) for r in odd.collect()} & {(r.doc_id, r.text) for r in out.collect()}
    assert {(5, None), (4, ""), (7, "word"), (None, None)} <= same
    clash = odd.select("doc_id", "text", F.lit(1).alias("home"), F.lit(2).alias("tie"), F.lit(3).alias("n_words"), F.lit(4).alias("n_chars"))
    assert substring_dedup.drop_repeats(clash).where("home = 1 and tie = 2 and n_words = 3").count() == odd.count()
