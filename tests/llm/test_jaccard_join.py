"""Near duplicates against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tierline.llm import common, jaccard_join
from tierline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lower)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_force(rows):
    """(id, n, component) by comparing all pairs that have a shingle in common."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    of = {}
    for i, s in sets.items():
        for t in s:
            of.setdefault(t, []).append(i)
    for a, s in sets.items():
        near = {b for t in s for b in of[t] if b > a}
        for b in near:
            both = len(s & sets[b])
            if 100 * both >= 75 * (len(s) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets.items())


def made(seed=0):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choices(words, k=60))
    texts = [" ".join(rnd.choices(words, k=rnd.choice((1, 3, 4, 5, 6, 9, 30, 120)))) for _ in range(150)]
    base = [" ".join(rnd.choices(words, k=90)) for _ in range(4)]
    for n in range(160):  # near copies about the threshold, edited in one to five places
        w = base[n % 4].split()
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts.append(" ".join(w).upper() if n % 7 == 0 else " ".join(w))
    texts += [passage + " " + " ".join(rnd.choices(words, k=rnd.choice((5, 15, 25, 80)))) for _ in range(60)]
    texts += [" ".join(rnd.choice(words) if rnd.random() < 0.02 else w for w in base[0].split()) for _ in range(60)]
    texts += [passage] * 30 + ["one", "one", "One", "", None, " \n", "a b c d", "A b\tc d", "a b c d e", "a b c d e f"]
    return list(enumerate(texts))


@pytest.mark.parametrize(("part_rows", "bucket_tokens"), [(500, 1_000_000), (7, 300)])
def test_all_pairs(spark, part_rows, bucket_tokens):
    rows = made()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, n string, component int")
    got = jaccard_join.link(df, part_rows=part_rows, bucket_tokens=bucket_tokens).collect()
    assert sorted(map(tuple, got)) == brute_force(rows)


def test_without_meeting(spark, monkeypatch):
    """What min-hash doesn't bring together is found through the matrix alone."""
    monkeypatch.setattr(jaccard_join, "meetings", lambda classes, *_: classes.selectExpr("id AS a", "id AS b", "n", "n AS m", "128 AS agree").where("false"))
    rows = made(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.link(df, part_rows=20).collect())) == brute_force(rows)


def test_word_hashes(monkeypatch):
    """Words are those of split(), equal words have equal hashes, long texts and long words too."""
    monkeypatch.setattr(jaccard_join, "PIECE", 64)
    jaccard_join.powers.cache_clear()
    rnd = random.Random(2)
    for _ in range(200):
        texts = ["".join(rnd.choice("aAbB é \t\n\x0b\x1c\xa0") for _ in range(rnd.choice([0, 1, 5, 40, 130, 600]))) for _ in range(rnd.randint(0, 8))]
        raw = [(t if rnd.random() < 0.9 else "X" * rnd.randint(60, 300)).encode() for t in texts]
        hashes, count = jaccard_join.words_of(raw)
        want = [r.lower().split() for r in raw]
        assert count.tolist() == [len(w) for w in want]
        seen = {}
        for w, h in zip([w for of in want for w in of], hashes.tolist(), strict=True):
            assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)
    jaccard_join.powers.cache_clear()


def test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = jaccard_join.near_duplicates(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect())) == brute_force([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])


def test_odd_rows(spark, odd_docs, no_docs):
    rows = {(r.doc_id, r.text) for r in odd_docs.collect() if r.doc_id is not None}
    assert sorted(map(tuple, jaccard_join.link(odd_docs).collect())) == brute_force(sorted(rows))
    assert jaccard_join.link(no_docs).count() == 0
    two = spark.createDataFrame([(1, "a b"), (1, "c d"), (2, "a b"), (3, "c d")], "doc_id long, text string")
    got = {r.id: r.component for r in jaccard_join.link(two).collect()}
    assert got[1] == 1 and sorted((got[2], got[3])) in ([1, 2], [1, 3])


def test_prefix_is_enough():
    """Two sets over the threshold share LEAST of their first n - ceil(t n) + LEAST tokens in any order, or all that the smaller needs."""
    rng = np.random.default_rng(0)
    least, tried = jaccard_join.LEAST, 0
    for _ in range(600):
        a = set(rng.choice(200, rng.integers(1, 60), replace=False).tolist())
        b = {x for x in a if rng.random() > 0.15} | set(rng.choice(200, rng.integers(1, 5)).tolist())
        if 100 * len(a & b) >= 75 * len(a | b):
            tried += 1
            first = [set(sorted(s)[: len(s) - -(-75 * len(s) // 100) + least]) for s in (a, b)]
            for s in (a, b):
                assert len(first[0] & first[1]) >= min(least, -(-75 * len(s) // 100))
    assert tried > 100


def test_family_below_the_threshold(spark, monkeypatch):
    """Edited copies that are alike by less than the threshold form few groups, so the matrix isn't a join of all with all."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = rnd.choices(words, k=400)
    rows = []
    for i in range(240):
        w = list(base)
        for _ in range(10):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(rnd.choices(words, k=60))) for i in range(60)]
    kept = {}
    real = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name: kept.setdefault(name, real(df, name)) if name in ("groups", "matrix", "asked") else real(df, name))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.link(df, part_rows=50).collect())) == brute_force(rows)
    family = kept["groups"].where("id < 1000")
    assert family.select("g").distinct().count() <= 24
    joined = kept["matrix"].groupBy("token").agg({"id": "count", "g": "approx_count_distinct"}).selectExpr("sum(`count(id)` * `approx_count_distinct(g)`) AS n").first().n
    pairs = kept["matrix"].groupBy("token").count().selectExpr("sum(count * count) AS n").first().n
    assert joined * 8 <= pairs


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (20, 21), *((i, i + 1) for i in range(100, 140)), *((50, i) for i in range(51, 80))]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 20: 20, 21: 20, **{i: 100 for i in range(100, 141)}, **{i: 50 for i in range(50, 80)}}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_of_a_run_have_a_bound():
    """A run of texts is as small as promised; texts that no one asked for aren't copied with their batch."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(64)), pa.array(["x y " * 25_000] * 64)], names=["id", "text"])
    assert max(sum(map(len, r.column(1).to_pylist())) for r in common.runs(batch, 1, jaccard_join.RUN)) <= jaccard_join.RUN + 100_000
