"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are scaled to length 1 (the nearest by distance are those of largest
cosine), and belong to the nearest of a few centroids, learned on a sample of
``sample_rows`` rows; every vector is in a list. A list's rows are rotated at
random and scanned in blocks of columns: after each block a hypothesis test on
the partial distance abandons the candidates that are too far with high
probability. What survives all blocks is scored exactly, in double precision,
on the original vectors. A query's first limit is its distance to the sample,
which gives no neighbours itself.

Probes and tests are set by measuring: ``audit_queries`` queries are compared
with every row, and lists are added and tests loosened until the scan keeps
enough of their true neighbours, at the tightest limits that it can meet. The
finished scan is audited on as many other queries; if it has less than
``recall`` of their neighbours, it is repeated with more probes and looser
tests, in the end with all lists and none, as are queries that have found too
few rows. Lists of many rows are scanned in parts.

Vectors that are null, zero or hold null or non-finite components take no part,
nor do rows with a null id or of another length than the most common one (ties:
the longest). Rows of one id count once, with their best score. Equal scores
rank by id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import stored
from tierline.llm.vectors import cosine, matrix, unit, usable

BLOCK = 16
DOUBT = 2.1  # standard errors of the test
SLACK = 1e-9  # rounding of squared distances and cosines


def centroids(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Spherical k-means over the rows of ``x``."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        of = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, of, x)
        norm = np.sqrt((total * total).sum(1, keepdims=True))
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T, axis=1) for i in range(0, len(x), 4096)])


def first_rows(near: np.ndarray, ids: np.ndarray, q: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact cosines of the ``k`` ids of ``x`` nearest to ``q`` (ties: by id); ``near``: their cosines but for rounding, -inf if out."""
    want = k
    while True:
        least = np.partition(near, max(0, len(near) - want))[max(0, len(near) - want)]
        some = np.flatnonzero((near >= least - SLACK) & np.isfinite(near))
        if want >= len(near) or len(np.unique(ids[some])) >= k:
            break
        want *= 2
    score = cosine(np.broadcast_to(q, (len(some), x.shape[1])), x[some])
    order = np.lexsort((ids[some], -score))
    order = order[np.sort(np.unique(ids[some][order], return_index=True)[1])][:k]
    return some[order], score[order]


def squared(score: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors by their cosines."""
    return np.maximum(0.0, 2 - 2 * score)


@dataclass
class Index:
    """What is the same for every task; its size has a bound (sample_rows rows, at most as many centroids)."""

    centres: np.ndarray
    rotation: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray
    k: int
    probes: int = 0
    doubt: float = DOUBT
    parts: np.ndarray | None = None

    def from_sample(self, ids: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its nearest rows of the sample, for a first limit: place, ids, exact cosines."""
        u = unit(self.sample)
        for i in range(0, len(ids), 256):
            near = unit(x[i : i + 256]) @ u.T
            near[ids[i : i + 256, None] == self.sample_ids[None, :]] = -np.inf
            for r in range(len(near)):
                top, score = first_rows(near[r], self.sample_ids, x[i + r], self.sample, self.k)
                yield i + r, self.sample_ids[top], score


def surviving(q: np.ndarray, x: np.ndarray, limit: np.ndarray, doubt: float = DOUBT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of rotated unit vectors that no test abandons; ``limit``: squared distance by query."""
    d = x.shape[1]
    near = slice(0, BLOCK)
    part = (q[:, near] ** 2).sum(1)[:, None] + (x[:, near] ** 2).sum(1)[None, :] - 2 * q[:, near] @ x[:, near].T
    seen = min(BLOCK, d)
    keep = part * (d / seen) <= limit[:, None] * (1 + doubt / np.sqrt(seen)) ** 2 + SLACK if seen < d else part <= limit[:, None] + SLACK
    a, b = np.nonzero(keep)
    so_far = part[a, b]
    while seen < d:
        step = slice(seen, seen + BLOCK)
        so_far = so_far + ((q[a, step] - x[b, step]) ** 2).sum(1)
        seen = min(seen + BLOCK, d)
        keep = so_far * (d / seen) <= limit[a] * (1 + doubt / np.sqrt(seen)) ** 2 + SLACK if seen < d else so_far <= limit[a] + SLACK
        a, b, so_far = a[keep], b[keep], so_far[keep]
    return a, b


def scan_list(index: Index, q_ids: np.ndarray, q: np.ndarray, limit: np.ndarray, ids: np.ndarray, x: np.ndarray) -> Iterator[pd.DataFrame]:
    """The nearest rows of one list (or part of one) for the queries that probe it."""
    turned = unit(x) @ index.rotation
    for i in range(0, len(q), 128):
        some, own, bound = q[i : i + 128], q_ids[i : i + 128], limit[i : i + 128].copy()
        asked = unit(some) @ index.rotation
        found = []
        for j in range(0, len(x), 2048):
            a, b = surviving(asked, turned[j : j + 2048], bound, index.doubt)
            b = b + j
            other = own[a] != ids[b]
            a, b = a[other], b[other]
            if not len(a):
                continue
            found.append(pd.DataFrame({"query_id": own[a], "vec_id": ids[b], "score": cosine(some[a], x[b]), "_q": a}))
            best = pd.concat(found).sort_values(["_q", "score", "vec_id"], ascending=[True, False, True], kind="stable")
            best = best.drop_duplicates(["_q", "vec_id"]).groupby("_q").head(index.k)
            found = [best]
            full = best.groupby("_q")["score"].agg(["size", "min"])
            full = full[full["size"] >= index.k]
            bound[full.index] = np.minimum(bound[full.index], squared(full["min"].to_numpy()))
        if found:
            yield found[0][["query_id", "vec_id", "score"]]


def search(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", sample_rows: int = 20_000, audit_queries: int = 64, recall: float = 0.95, list_rows: int = 20_000, max_lists: int = 4096, doubt: float = DOUBT) -> DataFrame:
    """For each row that ``is_query`` (an expression on ``id``) holds for, its ``k`` nearest other rows."""
    spark = df.sparkSession
    rows = usable(df, key, vector)
    n = rows.count()
    share = min(1.0, sample_rows / max(1, n))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample_rows).toArrow()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n:
        return empty
    if not len(drawn):
        drawn = rows.limit(sample_rows).toArrow()
    sample, ids = matrix(drawn["vector"]), drawn["id"].to_numpy()
    d = sample.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(5).normal(size=(d, d)))[0]
    index = Index(centroids(unit(sample), max(1, min(max_lists, int(n**0.5)))), rotation, ids, sample, k, doubt=doubt)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = nearest(unit(matrix(b.column(1))), index.centres) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of.astype(np.int32))], names=["id", "vector", "list"])

    listed = stored(rows.mapInArrow(assign, "id long, vector array<double>, list int"), "lists")
    size = np.zeros(len(index.centres), np.int64)
    for r in listed.groupBy("list").count().collect():  # a row for each list
        size[r["list"]] = r["count"]
    index.parts = np.maximum(1, -(-size // list_rows))

    asked = listed.where(is_query).select("id", "vector")
    index.probes, index.doubt = fitted(index, *drawn_queries(listed, asked, "fit", audit_queries, k), (1 + recall) / 2)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q_ids, q = b.column(0).to_numpy(), matrix(b.column(1)) if b.num_rows else np.zeros((0, d))
            limit = np.full(len(q), 4.0)
            for i, _, scores in index.from_sample(q_ids, q):
                if len(scores) >= k:
                    limit[i] = squared(np.sort(scores)[-k])
            order = np.argsort(-(unit(q) @ index.centres.T), axis=1, kind="stable")[:, : index.probes] if len(q) else np.zeros((0, 0), int)
            out = [(i, of, p) for i in range(len(q)) for of in order[i].tolist() for p in range(index.parts[of])]
            at = np.array([x[0] for x in out], np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(limit[at]), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.int32())],
                names=["id", "vector", "limit", "list", "part"],
            )

    def scan(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(left) or not len(right):
            return none
        found = scan_list(index, left["id"].to_numpy(), np.stack(left["vector"]), left["limit"].to_numpy(), right["id"].to_numpy(), np.stack(right["vector"]))
        return pd.concat([none, *found])

    def neighbours(of: DataFrame) -> DataFrame:
        probing = of.mapInArrow(probe, "id long, vector array<double>, limit double, list int, part int")
        hits = probing.groupBy("list", "part").cogroup(dealt.groupBy("list", "part")).applyInPandas(scan, "query_id long, vec_id long, score double")
        best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
        return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    of_part = F.element_at(F.array(*[F.lit(int(p)) for p in index.parts]), F.col("list") + 1)
    dealt = listed.withColumn("part", F.pmod(F.xxhash64("id"), of_part).cast("int"))
    q_ids, _, true = drawn_queries(listed, asked, "audit", audit_queries, k)
    while True:
        found = stored(neighbours(asked), "neighbours")
        all_lists, no_tests = index.probes >= len(index.centres), index.doubt >= d**0.5
        if all_lists and no_tests:
            return found
        if found_share(found, q_ids, true) >= recall:
            break
        index.probes, index.doubt = min(2 * index.probes, len(index.centres)), d**0.5 if all_lists else index.doubt + 1
    # queries with fewer neighbours than the table has for them are scanned whole
    index.probes, index.doubt = len(index.centres), d**0.5
    most = min(k, listed.select("id").distinct().count() - 1)
    full = stored(found.groupBy("query_id").count().where(F.col("count") >= most).select(F.col("query_id").alias("id")), "full")
    short = asked.join(full, "id", "left_anti")
    return found.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(neighbours(short)) if not short.isEmpty() else found


def brute_force(listed: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The true nearest rows of a few queries, with their lists and vectors."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, near = b.column(0).to_numpy(), unit(q) @ unit(matrix(b.column(1))).T
            near[q_ids[:, None] == ids[None, :]] = -np.inf
            x = matrix(b.column(1))
            top = [first_rows(near[i], ids, q[i], x, k) for i in range(len(q))]
            at, of = np.repeat(np.arange(len(q)), [len(t[0]) for t in top]), np.concatenate([t[0] for t in top])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(ids[of]), b.column(1).take(pa.array(of)), b.column(2).take(pa.array(of)), pa.array(np.concatenate([t[1] for t in top]))],
                names=["query", "vec_id", "vector", "list", "score"],
            )

    near = listed.mapInArrow(compare, "query long, vec_id long, vector array<double>, list int, score double")
    once = near.withColumn("again", F.row_number().over(Window.partitionBy("query", "vec_id").orderBy(F.desc("score"), "list"))).where("again = 1")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).drop("again", "rank").toPandas()


def drawn_queries(listed: DataFrame, asked: DataFrame, draw: str, count: int, k: int) -> tuple[np.ndarray, np.ndarray, pd.DataFrame]:
    """Some queries (ids, vectors) and their true neighbours; another ``draw`` gives others."""
    some = asked.orderBy(F.xxhash64(F.lit(draw), "id"), "id", "vector").dropDuplicates(["id"]).orderBy(F.xxhash64(F.lit(draw), "id"), "id").limit(count).toArrow()
    ids, q = some["id"].to_numpy(), matrix(some["vector"]) if len(some) else np.zeros((0, 1))
    return ids, q, brute_force(listed, ids, q, k) if len(some) else pd.DataFrame()


def fitted(index: Index, q_ids: np.ndarray, q: np.ndarray, true: pd.DataFrame, recall: float) -> tuple[int, float]:
    """Lists to probe, and standard errors of the tests, so that a scan at the tightest limits keeps the share ``recall`` of the true neighbours."""
    if not len(true):
        return 1, index.doubt
    lists = len(index.centres)
    turned, place = unit(q) @ index.rotation, np.argsort(np.argsort(-(unit(q) @ index.centres.T), axis=1, kind="stable"), axis=1)
    doubt = index.doubt
    while True:
        needed = []
        for i, of in true.groupby("query"):
            limit = squared(of["score"].min()) if len(of) >= index.k else 4.0
            _, kept = surviving(turned[i : i + 1], unit(np.stack(of["vector"])) @ index.rotation, np.array([limit]), doubt)
            at = place[i, of["list"].to_numpy()] + 1
            needed += np.where(np.isin(np.arange(len(of)), kept), at, lists + 1).tolist()
        probes = sorted(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]
        if probes <= lists:
            return int(probes), doubt
        doubt += 0.5


def found_share(found: DataFrame, q_ids: np.ndarray, true: pd.DataFrame) -> float:
    """Share of some queries' true neighbours that the finished scan has (a row as near as the last of them counts)."""
    if not len(true):
        return 1.0
    least = {int(q_ids[i]): of["score"].min() - SLACK for i, of in true.groupby("query")}
    got = found.where(F.col("query_id").isin(list(least))).toPandas()
    return float((got["score"] >= got["query_id"].map(least)).sum()) / len(true)
