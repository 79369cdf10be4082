"""Vector search and vector near-dedup against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tierline.llm import ann_search, vector_dedup
from tierline.llm.vectors import cosine, unit

SF = "/root/testdata/sf0.01"


def clustered(seed=0, dim=16):
    """Random vectors, a large group of near copies, exact copies, and pairs about the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(500, dim))
    x[100:220] = x[100] + 0.02 * rng.normal(size=(120, dim))
    x[220:230] = x[5] * rng.uniform(0.5, 3, size=(10, 1))
    for i in range(230, 330):
        x[i] = x[i - 100] * 0 + x[(i * 7) % 90] + rng.uniform(0.05, 0.9) * rng.normal(size=dim)
    return np.round(x.astype(np.float32), 4).astype(float)


def frame(spark, x, extra=()):
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string")


def bad(dim):
    nan, inf = float("nan"), float("inf")
    return [(1000, None, 0, ""), (1001, [0.0] * dim, 0, ""), (1050, [nan] + [1.0] * (dim - 1), 0, ""), (1003, [inf] * dim, 0, ""), (1004, [None] + [1.0] * (dim - 1), 0, ""), (1005, [1.0], 0, ""), (1006, [], 0, ""), (None, [1.0] * dim, 0, "")]


def true_links(x, least):
    u = unit(x)
    return (u @ u.T >= least) & ~np.eye(len(x), dtype=bool)


def reachable(links):
    label = np.arange(len(links))
    while True:
        new = np.array([min(label[i], *label[links[i]]) if links[i].any() else label[i] for i in range(len(links))])
        if (new == label).all():
            return label
        label = new


def test_search_brute_force(spark):
    x = clustered()
    got = ann_search.search(frame(spark, x, bad(16)), F.col("id") % 50 == 0, list_rows=60).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(by) == list(range(0, 500, 50))
    hit = total = 0
    for q, rows in by.items():
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5]
        ids = [r[1] for r in rows]
        score = cosine(np.tile(x[q], (len(x), 1)), x)
        assert q not in ids and np.allclose([r[2] for r in rows], score[ids], rtol=0, atol=1e-12)
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        score[q] = -2
        best = sorted(range(len(x)), key=lambda i: (-score[i], i))[:5]
        hit += len(set(best) & set(ids))
        total += 5
    assert hit >= 0.9 * total


def test_search_recall_on_a_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    near = unit(x) @ unit(x).T
    np.fill_diagonal(near, -2)
    got = {(r.query_id, r.vec_id) for r in ann_search.search(df, F.col("id") % 50 == 0).collect()}
    want = {(int(ids[i]), int(ids[j])) for i in np.flatnonzero(ids % 50 == 0) for j in np.argsort(-near[i], kind="stable")[:5]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_search_few_rows(spark):
    x = clustered()[:4]
    got = ann_search.search(frame(spark, x, bad(16) + [(3, x[3].tolist(), 0, "again")]), F.col("id") % 50 == 0).collect()
    assert sorted(r.vec_id for r in got) == [1, 2, 3] and {r.query_id for r in got} == {0}
    for rows in ([], bad(16)[:2]):
        assert ann_search.search(frame(spark, [], rows), F.col("id") % 50 == 0).count() == 0


def test_adaptive_scan_keeps_what_is_near():
    rng = np.random.default_rng(1)
    q, x = unit(rng.normal(size=(20, 64))), unit(rng.normal(size=(400, 64)))
    d = ((q[:, None] - x[None]) ** 2).sum(-1)
    limit = np.sort(d, axis=1)[:, 9]
    a, b = ann_search.surviving(q, x, limit)
    assert (d[a, b] <= limit[a] + 1e-9).all()
    assert len(a) >= 0.95 * 200


def far_pairs(seed=4, n=1500, dim=64):
    """Random vectors of many dimensions, where lists and tests lose neighbours if nothing sees to it."""
    return np.random.default_rng(seed).normal(size=(n, dim))


def test_search_small_sample(spark):
    """The sample is 40 of 1500 rows, so lists, probes and tests must find the neighbours themselves."""
    x = far_pairs()
    got = {}
    for r in ann_search.search(frame(spark, x), F.col("id") % 30 == 0, sample_rows=40, recall=1.0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    near = unit(x) @ unit(x).T
    np.fill_diagonal(near, -2)
    assert sorted(got) == list(range(0, 1500, 30))
    for q, ids in got.items():  # all 50 queries are audited, so none may lack a neighbour
        assert set(ids) == set(np.argsort(-near[q], kind="stable")[:5].tolist())


def test_search_audits_the_finished_scan(spark, monkeypatch):
    """A scan that loses every other row while its tests are on is noticed and repeated."""
    real = ann_search.scan_list

    def lossy(index, q_ids, q, limit, ids, x):
        kept = ids % 2 >= (getattr(index, "doubt", 0) < 8)
        return real(index, q_ids, q, limit, ids[kept], x[kept])

    monkeypatch.setattr(ann_search, "scan_list", lossy)
    x = far_pairs(n=400)
    got = {(r.query_id, r.vec_id) for r in ann_search.search(frame(spark, x), F.col("id") % 20 == 0, sample_rows=40).collect()}
    near = unit(x) @ unit(x).T
    np.fill_diagonal(near, -2)
    want = {(q, int(j)) for q in range(0, 400, 20) for j in np.argsort(-near[q], kind="stable")[:5]}
    assert len(got) == len(want) and len(got & want) >= 0.95 * len(want)


def test_fit_loosens_tests_that_abandon_neighbours():
    x = far_pairs()
    index = ann_search.Index(unit(x[:30]), np.eye(64), np.arange(30), x[:30], 5, doubt=-3.0)
    near = unit(x[:20]) @ unit(x).T
    near[np.arange(20), np.arange(20)] = -2
    top = np.argsort(-near, axis=1)[:, :5]
    at = np.repeat(np.arange(20), 5)
    true = pd.DataFrame({"query": at, "vec_id": top.ravel(), "vector": list(x[top.ravel()]), "list": ann_search.nearest(unit(x[top.ravel()]), index.centres), "score": near[at, top.ravel()]})
    probes, doubt = ann_search.fitted(index, np.arange(20), x[:20], true, 0.9)
    turned, limit = unit(x), 2 - 2 * near[np.arange(20), top[:, 4]]
    a, b = ann_search.surviving(unit(x[:20]), turned, limit, doubt)
    kept = set(zip(a.tolist(), b.tolist(), strict=True))
    assert 1 <= probes <= 30 and sum((i, j) in kept for i, j in zip(at.tolist(), top.ravel().tolist(), strict=True)) >= 90


def test_scan_keeps_equal_rows():
    """Copies of a query are all at distance 0, whatever rounding makes of it; the smallest ids win."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        v = rng.normal(size=(1, 64))
        x = np.repeat(v, 50, axis=0)
        ids = rng.permutation(50) + 1
        turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
        a, _ = ann_search.surviving(unit(v) @ turn, unit(x) @ turn, np.zeros(1))
        assert len(a) == 50
        index = ann_search.Index(unit(v), turn, ids, x, 5)
        [(_, near, _)] = index.from_sample(np.array([0]), v)
        assert sorted(near) == [1, 2, 3, 4, 5]
        limit = np.array([2 - 2 * (1 + 2e-16)])
        got = next(ann_search.scan_list(index, np.array([0]), v, limit, ids, x))
        assert sorted(got.vec_id) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("part_rows", [4000, 40])
def test_dedup_brute_force(spark, part_rows):
    x = clustered()
    got = {r.id: r for r in vector_dedup.link(frame(spark, x, bad(16)), part_rows=part_rows).collect()}
    assert sorted(got) == [*range(500), 1000, 1001, 1003, 1004, 1005, 1006, 1050]
    links = true_links(x, 0.9)
    label = reachable(links)
    found = np.array([got[i].n_links for i in range(500)])
    assert (found <= links.sum(1)).all() and found.sum() >= 0.95 * links.sum()
    assert np.mean([got[i].component == label[i] for i in range(500)]) >= 0.98
    assert all(got[i].n_links == 0 and got[i].component == i for i in got if i >= 1000)


def test_dedup_columns_and_odd_tables(spark):
    x = clustered()[:3]
    df = frame(spark, x, [(2, x[2].tolist(), 0, "again"), (7, x[0].tolist(), 0, "copy")])
    got = vector_dedup.near_duplicates(df)
    assert dict(got.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    assert sorted(map(tuple, got.collect())) == [(0, 1, 0, True), (1, 0, 1, True), (2, 0, 2, True), (7, 1, 0, False)]
    assert vector_dedup.near_duplicates(df.where("false")).count() == 0
    assert sorted(map(tuple, vector_dedup.near_duplicates(frame(spark, [], bad(16)[:2])).collect())) == [(1000, 0, 1000, True), (1001, 0, 1001, True)]


def test_audit_sees_lost_pairs(spark):
    """Of 40 isolated pairs among 2000 vectors the graph has 4; the audit is not to take its leaders from those."""
    x = np.random.default_rng(6).normal(size=(2000, 64))
    x[1:80:2] = x[0:80:2] + 0.05 * np.random.default_rng(7).normal(size=(40, 64))
    nodes = frame(spark, x).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    edges = spark.createDataFrame([(2 * i, 2 * i + 1, 0.99) for i in range(4)], "u long, v long, s double")
    assert vector_dedup.audited(nodes, edges, 0.9, 256) < 0.3
    assert vector_dedup.audited(nodes, edges.limit(0), 0.9, 256) == 0
    assert vector_dedup.audited(nodes.where("id >= 80"), edges, 0.9, 256) == 1


def test_lists_saturated_at_the_end_are_finished(spark):
    """150 vectors near each other, and lists of 2 after a single round."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 32))
    x[:150] = x[0] + 0.3 * rng.normal(size=(150, 32))
    nodes = frame(spark, x).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    links = true_links(np.array(x, np.float32).astype(float), 0.85)
    got = vector_dedup.neighbour_graph(nodes, 0.85, 2, 1, 64, 0.95).select("u", "v").collect()
    got = {(min(r), max(r)) for r in got}
    want = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(links)), strict=True)}
    assert got <= want and len(got) >= 0.95 * len(want)


def test_balls_are_tight():
    x = clustered()
    of = vector_dedup.balls_of(np.arange(500), x, 0.97)
    assert (cosine(x, x[of]) >= 0.97 - 1e-12).all() and (of[of] == of).all() and (of <= np.arange(500)).all()
    assert len(np.unique(of[100:220])) < 20
