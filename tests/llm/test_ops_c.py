"""Spelling variants, license scans and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import license_scan, repair, spelling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


# 11. spelling variants

def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def near_of(words):
    """word -> near words, by the words without one letter (and with a gap)."""
    groups, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            groups[w[:i] + "\0" + w[i + 1:]].add(w)
            short = w[:i] + w[i + 1:]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for g in groups.values():
        for w in g:
            near[w] |= g - {w}
    return near


def brute_forms(rows, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            counts[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    words = {w: n for w, n in counts.items() if n >= min_count and len(w) >= 5}
    return forms_of(words)


def forms_of(words):
    near = near_of(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def tuples(df, names=("word", "form", "root", "n", "n_near", "form_n")):
    return [tuple(r[c] for c in names) for r in df.collect()]


def test_forms_of_documents(docs):
    same(tuples(spelling.spelling_forms(docs)), brute_forms([(r.doc_id, r.text) for r in docs.collect()]))


def test_forms_of_odd_rows(spark, odd, none):
    df = odd.withColumns({c: F.lit(1) for c in ("word", "n", "key", "m", "lo", "hi", "run", "root")})
    same(tuples(spelling.spelling_forms(df)), brute_forms([(r.doc_id, r.text) for r in odd.collect()]))
    assert spelling.spelling_forms(none).count() == 0
    assert spelling.spelling_forms(none).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def vocabulary(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_hot_buckets_are_cut_without_loss(spark):
    rng = random.Random(3)
    words = {"prefix" + "".join(rng.choice("abcÿ") for _ in range(rng.choice([5, 6, 7]))): rng.randrange(3, 4000) for _ in range(1500)}
    words |= {"x" * 40 + w: n for w, n in list(words.items())[:40]}
    v = vocabulary(spark, words)
    cut = spelling.buckets(v, hot=20)
    assert cut.where("hi - lo > 1").groupBy("key").count().agg(F.max("count")).first()[0] <= 20
    for hot in (20, 100_000):
        same(tuples(spelling.with_roots(spelling.near_words(v, hot))), forms_of(words))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abàÿ", min_size=5, max_size=8), min_size=2, max_size=150))
def test_bit_sliced_runs_find_near_words(words):
    words = sorted(words)
    rows = [(w, m) for m in {len(w) for w in words} for w in words if len(w) in (m, m + 1)]
    rows.sort(key=lambda r: r[1])
    m = np.array([r[1] for r in rows])
    out = spelling.near_in_buckets([r[0] for r in rows], np.ones(len(rows), np.int64), m, m, m)
    got = Counter()
    for r in out.to_pylist() if out else []:
        got[r["word"]] += r["n_near"]
    want = Counter({w: sum(one_edit(w, x) for x in words) for w in words})
    assert {w: n for w, n in got.items()} == {w: n for w, n in want.items() if n and m.max() >= len(w)}


# 12. license scans

def brute_licenses(texts, templates=license_scan.TEMPLATES, base=license_scan.BASE, threshold=0.8):
    parts = license_scan.pieces(templates, base, threshold)
    for text in texts:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        labels, based, places, score = set(), set(), [], 0.0
        for s in range(0, len(ws), 16):
            block = ws[s:s + 32]
            for p in parts:
                n = len(set(p["words"]) & set(block))
                if n < p["need"]:
                    continue
                if p["phrase"]:
                    at = [s + i for i in range(16) if block[i:i + len(p["phrase"])] == p["phrase"]]
                    if not at:
                        continue
                    places += at
                    based.add(p["label"])
                labels.add(p["label"])
                score = max(score, n / len(p["words"]))
        phrases = sum(ws[i:i + len(q.split())] == q.split() for q in base for i in range(len(ws)))
        assert phrases == len(places)
        yield (len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(based)), ",".join(sorted(labels)), score)


LICENSE = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def notice_rows():
    prose = [f"word{i}" for i in range(40)]
    rng = random.Random(5)
    texts = [None, "", " .,;- ", "CC-BY", "cc by cc by", "All Rights, Reserved. all rights reserved", "the " * 500, "É" * 3000 + " cc by",
             "general public licence", "license " * 300 + "general public license", "cc " * 70 + "by"]
    for group in license_scan.TEMPLATES.values():
        for t in group:
            ws = t.split()
            texts += [t, t.upper(), " ".join(reversed(ws)), " ".join(w for i, w in enumerate(ws) if i % 7), "\n".join(ws)]
            for at in (0, 14, 15, 16, 31, 33):
                texts.append(" ".join(prose[:at] + ws + prose[at:]))
            mixed = ws + rng.sample(prose, 12)
            rng.shuffle(mixed)
            texts.append(" ".join(mixed))
    return texts


def test_licenses_of_odd_texts(spark):
    texts = notice_rows()
    texts.append(" ".join(["word"] * 100_000 + ["all", "rights", "reserved"]))   # over 64 KB
    rows = [(i, t, 7, 8) for i, t in enumerate(texts)] + [(0, texts[4], 7, 8), (None, texts[4], 7, 8), (None, None, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, uid int, label int").withColumn("ws", F.lit(1)).repartition(4)
    got = [(r.doc_id, *[r[c] for c in LICENSE]) for r in license_scan.license_scan(df).collect()]
    same(got, [(r[0], *x) for r, x in zip(rows, brute_licenses(r[1] for r in rows))])


def test_licenses_of_documents(docs):
    rows = docs.collect()
    got = [(r.doc_id, *[r[c] for c in LICENSE]) for r in license_scan.license_scan(docs).collect()]
    same(got, [(r.doc_id, *x) for r, x in zip(rows, brute_licenses(r.text for r in rows))])


def test_licenses_of_nothing(none):
    assert license_scan.license_scan(none).count() == 0


def test_license_scan_is_native(docs):
    out = license_scan.license_scan(docs)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())


def test_a_phrase_may_not_be_longer_than_a_block(spark):
    with pytest.raises(ValueError):
        license_scan.pieces({}, {"w " * 18: "x"}, 0.8)


# 13. conversation repair

def brute_repair(rows):
    """Cheapest (cost, audit) by trying every edit of every row, with up to two
    insertions between rows. Rows: (initial, fault)."""
    good = re.compile(r"(s?(ua)+)?\Z")
    best = None
    inserts = ["", "u", "a", "ua", "au"]
    options = []
    for initial, fault in rows:
        own = [("", 2, "D")]
        if fault != "gone":
            more = 5 if fault == "short" else 0
            own += [(initial if initial in "sua" else "x", more, "K"), ("u", 1 + more, "R"), ("a", 1 + more, "R")]
        options.append(own)
    for choice in itertools.product(*options):
        for gap in itertools.product(inserts, repeat=len(rows) + 1):
            out = gap[0] + "".join(c[0] + g for c, g in zip(choice, gap[1:]))
            if good.match(out):
                cost = sum(c[1] for c in choice) + 5 * sum(map(len, gap))
                audit = "I" * len(gap[0]) + "".join(c[2] + "I" * len(g) for c, g in zip(choice, gap[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


KINDS = [("s", ""), ("u", ""), ("a", ""), ("t", ""), ("s", "short"), ("u", "short"), ("a", "short"), ("t", "short"), ("u", "gone"), ("s", "gone")]


def code(initial, fault):
    return "suat".index(initial) * 3 + {"": 0, "short": 1, "gone": 2}[fault]


@pytest.mark.parametrize("n", [0, 1, 2])
def test_parser_finds_the_cheapest_edits(n):
    for rows in itertools.product(KINDS, repeat=n):
        table = [(0, b, *x) for b, x in repair.parse([code(*r) for r in rows]).items()]
        assert repair.cheapest(table) == brute_repair(rows), rows


def test_parser_on_some_longer_ones():
    rng = random.Random(1)
    for _ in range(60):
        rows = [rng.choice(KINDS) for _ in range(3)]
        table = [(0, b, *x) for b, x in repair.parse([code(*r) for r in rows]).items()]
        assert repair.cheapest(table) == brute_repair(rows), rows


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 11), min_size=2, max_size=60), st.integers(1, 9))
def test_folded_blocks_are_the_whole(codes, size):
    n = len(repair.stack_graph()[0])
    tables = [[(a, b, *x) for a in range(n) for b, x in repair.parse(codes[i:i + size], a).items()] for i in range(0, len(codes), size)]
    whole = [(0, b, *x) for b, x in repair.parse(codes).items()]
    cut = len(tables) // 2
    left = repair.folded([repair.folded(tables[:cut]), repair.folded(tables[cut:])]) if cut else tables[0]
    assert repair.cheapest(repair.folded(tables)) == repair.cheapest(whole) == repair.cheapest(left)


def test_the_stack_graph_is_that_of_the_grammar():
    steps, ends = repair.stack_graph()
    assert len(steps) == 6
    for n in range(8):
        for word in itertools.product("sua", repeat=n):
            at = {0}
            for c in word:
                at = {j for i in at for j in steps[i]["sua".index(c)]}
            assert any(ends[i] for i in at) == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))
    with pytest.raises(ValueError):
        repair.stack_graph((("C", ()), ("C", ("u", "a", "C", "s"))))


def repaired(rows):
    """A conversation's report by the contract, from damaged (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds, faults = set(), [], Counter()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        kinds.append((role[:1] or "t", {"": "", "truncated": "short"}.get(fault, "gone")))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = repair.cheapest([(0, b, *x) for b, x in repair.parse([code(i if i in "sua" else "t", f) for i, f in kinds]).items()])
    out = len(audit) - audit.count("D")
    roles = (["s"] if out % 2 else []) + ["u", "a"] * (out // 2)
    lines, i, k = [], 0, 0
    for letter in audit:
        if letter != "D":
            role, text = {"u": "user", "a": "assistant", "s": "system"}[roles[k]], ""
            if letter != "I":
                text = rows[i][2]
                role = rows[i][1] if letter == "K" else role
            lines.append(f"{role}:{text}")
            k += 1
        i += letter != "I"
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_digests(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(name.encode()) % 20
        got = by[conv]
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        got += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return [(conv, *repaired(own)) for conv, own in by.items()]


DIGEST = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_repair_of_conversations(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/conversations.parquet")
    same(tuples(repair.repaired_digests(df), DIGEST), brute_digests([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]))


def odd_turns():
    rng = random.Random(8)
    said = ["Yes.", "no", "", None, " \t\n", "Why?  \n", "é" * 70_000 + "!", "a ", "x. ", "same."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, -5, 10**12]), rng.choice(["user", "assistant", "system", "tool", "", None, "System"]), rng.choice(said)))
    rows += rows[:20]                                                       # repeated rows
    rows += [(500, None, "user", f"t{i}.") for i in range(30)]             # only null turns
    rows += [(600, i, ["user", "assistant", "system"][rng.randrange(3)], "same." if i % 3 else f"t{i}" + "." * (i % 2)) for i in range(3000)]
    return rows


def test_repair_of_odd_turns(spark, monkeypatch):
    # blocks of 8, folded 4 at a time: the long conversation takes several rounds
    monkeypatch.setattr(repair, "BLOCK", 8)
    monkeypatch.setattr(repair, "FAN", 4)
    rows = odd_turns()
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "conv_id long, turn long, role string, text string, ck int, pos int, block int").repartition(6)
    same(tuples(repair.repaired_digests(df), DIGEST), brute_digests(rows))


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repaired_digests(df).count() == 0


def test_repaired_turns_are_well_formed(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/conversations.parquet")
    turns, report = repair.repair(repair.damaged(df))
    by = defaultdict(list)
    for r in turns.collect():
        by[r.ck].append((r.out, r.role))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == list(range(1, len(own) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role in own))
    assert report.count() == len({r.ck for r in report.collect()})
