"""Suffix orders against sorted(), removal against a table of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierline.llm import common, suffix_dedup, suffixes
from tierline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=5))
def test_suffix_orders(texts):
    texts = [[*t, 0] for t in texts]
    sizes = np.array([len(t) for t in texts])
    firsts = np.cumsum(sizes) - sizes
    got = suffixes.suffix_orders(np.array([c for t in texts for c in t]), firsts, sizes)
    for t, f in zip(texts, firsts.tolist(), strict=True):
        assert (got[f : f + len(t)] - f).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_groups_are_lyndon_prefixes():
    rng = random.Random(5)
    for _ in range(50):
        text = [rng.randint(1, 2) for _ in range(rng.randint(1, 25))] + [0]
        group, _ = suffixes.grouped(np.array(text), np.array([0]), np.array([len(text)]))

        def lyndon(i):
            ends = [j for j in range(i + 1, len(text) + 1) if all(text[i:j] < text[k:j] for k in range(i + 1, j))]
            return tuple(text[i : max(ends)])

        words = [lyndon(i) for i in range(len(text))]
        order = sorted(set(words))
        ranks = {g: k for k, g in enumerate(sorted(set(group.tolist())))}
        assert [order.index(w) for w in words] == [ranks[g] for g in group.tolist()]


def brute(rows, width):
    """(id, bytes, removed, spans, digest) of each row; documents in order of id, rows of one id have one text."""
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows if i is not None}):
        raw = t.encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            w = raw[p : p + width]
            if w in seen:
                gone[p : p + width] = b"\1" * width
            seen.add(w)
        out[i] = (raw, gone)
    done = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        gone = out[i][1] if i is not None else bytearray(len(raw))
        rest = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not h for g, h in zip(gone, b"\0" + bytes(gone), strict=False))
        done[i, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()] += 1
    return done


def report(spark, rows, width=suffix_dedup.WIDTH, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return Counter(map(tuple, suffix_dedup.report(df, width=width, **options).collect()))


def family(seed, copies, letters="ab c", length=120):
    """Edited copies of one text, repeats inside it, and texts of few letters."""
    rng = random.Random(seed)
    base = "".join(rng.choice(letters) for _ in range(length))
    rows = []
    for i in range(copies):
        t = list(base * rng.choice([1, 1, 2]))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice("xyzé")
        rows.append("".join(t)[rng.randint(0, 9) :])
    return rows + [rng.choice("ab") * rng.randint(0, 90) for i in range(6)]


@pytest.mark.parametrize(("width", "many", "part_rows"), [(10, 24, 20_000), (10, 2, 20_000), (13, 3, 2), (3, 2, 1), (100, 3, 20_000)])
def test_families(spark, monkeypatch, width, many, part_rows):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    texts = family(width, 25) + family(width + 1, 25, "abcdefgh ", 300)
    rows = list(zip(random.Random(1).sample(range(-(10**9), 10**9), len(texts)), texts, strict=True)) * 2
    assert report(spark, rows, width, part_rows=part_rows) == brute(rows, width)


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    seeds = suffix_dedup.Seeds([b"abc" * 100, b"", b"abcab" * 40], 10)
    assert seeds.size.sum() == 291 + 191  # each window has one seed
    rows = [(1, "one two three " * 40), (2, "zero one two three one"), (3, "three " * 50)]
    assert Counter(map(tuple, suffix_dedup.report(spark.createDataFrame(rows, "doc_id long, text string"), width=12).collect())) == brute(rows, 12)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = suffix_dedup.report(odd_docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows, 100)
    assert suffix_dedup.report(no_docs).count() == 0
    twice = [(1, "x" * 150), (1, "y" * 150 + "x" * 150), (None, "x" * 150), (2, "x" * 150)]
    found = {(r.doc_id, r.n_bytes): r.n_removed for r in suffix_dedup.report(spark.createDataFrame(twice, "doc_id long, text string")).collect()}
    assert found[2, 150] == 150
    null_id = [r for r in suffix_dedup.report(spark.createDataFrame(twice, "doc_id long, text string")).collect() if r.doc_id is None]
    assert len(null_id) == 1 and null_id[0].n_removed == 0
    spans = suffix_dedup.dedup(spark.createDataFrame([(5, "q" * 99 + "ab"), (6, "q" * 99 + "ac")], "doc_id long, text string"))
    assert {r.id: [tuple(s) for s in r.spans] for r in spans.collect()} == {5: [], 6: [(0, 100)]}


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter(map(tuple, QUERIES["op12_suffix_dedup"](spark, SF).collect()))
    assert got == brute(rows, 100) and any(n for _, _, n, _, _ in got)


def test_hot_passage_is_dealt_out(spark):
    """A passage in every text: no bucket gets more of it than tasks, and the result is whole."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    rows = [(i, "".join(rng.choice("ijklmnop ") for _ in range(60)) + passage + str(i) * 9) for i in range(120)]
    assert report(spark, rows, 40, part_rows=10) == brute(rows, 40)


def test_worker_gives_back_what_it_freed():
    def held():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) / 1024

    def task(batches):
        pieces = [bytes(1000) for _ in range(150_000)]
        kept.append(pieces[-1])  # above all that is freed
        yield len(pieces)

    kept, before = [], held()
    assert list(common.tidy(task)(iter(()))) == [150_000]
    assert held() < before + 60


def test_tally_in_parts():
    rng = np.random.default_rng(3)
    slots = 1 << 17
    own, want = suffix_dedup.Tally(), np.zeros(slots, np.int64)
    for n in (0, 1, 70_000, 1_000_000):
        slot = np.minimum(rng.integers(0, slots, n), rng.integers(0, slots, n))
        slot[: n // 10] = 5
        own.add(slot)
        want += np.bincount(slot, minlength=slots)
        own.merge()
    assert all(x.dtype == np.uint64 and x.ndim == 1 for x in own.own)  # eight bytes a slot
    got = np.zeros(slots, np.int64)
    for b in own.sent():
        part, at, n = (b.column(i)[0].as_py() for i in range(3))
        got[(part << 16) + np.frombuffer(at, np.uint16).astype(np.int64)] = np.frombuffer(n, np.uint16)
    assert np.array_equal(got, np.minimum(want, 0xFFFF))
