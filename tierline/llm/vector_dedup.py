"""Near-duplicate embeddings by NN-descent.

Vectors that lie within a quarter of the threshold's angle of a leader form a
ball, so all pairs inside a ball are links without being listed. NN-descent
runs over the leaders: a first neighbour graph comes from buckets of random
hyperplanes and from random groups; each round joins the neighbours of a node
(and the nodes that it is a neighbour of) with each other, and keeps for each
node the best. A list is saturated if its last entry could still hold links;
it is enlarged then. Rounds go on while they find edges of links, and until an
audit finds ``recall``: leaders drawn from all alike are compared with all
leaders, and those that have links count, each by the share of them that the
graph has. An audit that fails adds new random candidates. What is left after
the last round is settled exactly: lists still saturated, or all leaders if the
audit still fails, are compared with all leaders in blocks.

Edges between balls are settled by angle: all pairs are links, or none, or the
members are compared exactly, in double precision.

Vectors that are null, zero, of another length than most, or hold null or
non-finite components link with nothing. Rows of one id are one vector, the
largest. Rows with a null id are left out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import stored
from tierline.llm.components import components
from tierline.llm.vectors import cosine, matrix, unit, usable

NODE = "id long, vector array<double>"


def hyperplane_buckets(rows: DataFrame, bits: int, seed: int) -> DataFrame:
    """``rows`` (id, vector, ...) with the bucket of their signs on random hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1)) if b.num_rows else np.zeros((0, 1))
            planes = np.random.default_rng(seed).normal(size=(x.shape[1], bits))
            sign = (x @ planes > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sign.astype(np.int64))], names=["id", "vector", "bucket"])

    return rows.select("id", "vector").mapInArrow(run, f"{NODE}, bucket long")


def in_parts(rows: DataFrame, by: list[str], part_rows: int) -> DataFrame:
    """``rows`` with a part number, so that no group of ``by`` and part is much over ``part_rows``."""
    parts = rows.groupBy(*by).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("_parts"))
    return rows.join(parts, by).withColumn("part", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int")).drop("_parts")


def balls_of(ids: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """For each vector the place of its leader: the first (by id) that is near enough, itself if none is."""
    order = np.argsort(ids, kind="stable")
    u, leaders, of = unit(x)[order], [], np.full(len(ids), -1)
    for i in range(0, len(u), 512):
        part = u[i : i + 512]
        if leaders:
            near = part @ u[leaders].T
            best = near.argmax(axis=1)
            has = near[np.arange(len(part)), best] >= least
            of[i : i + 512][has] = np.array(leaders)[best[has]]
        own = part @ part.T
        for k in np.flatnonzero(of[i : i + 512] < 0).tolist():
            if of[i + k] >= 0:
                continue
            leaders.append(i + k)
            joins = (own[k] >= least) & (of[i : i + 512] < 0)
            joins[:k] = False
            joins[k] = True
            of[i : i + 512][joins] = i + k
    back = np.empty(len(ids), np.int64)
    back[order] = order[of]
    return back


def first_graph(nodes: DataFrame, n: int, k: int, part_rows: int = 400, draw: int = 0) -> DataFrame:
    """Some near neighbours (u, v, s) of each node, and some random ones; another ``draw`` gives others."""
    bits = int(np.clip(np.ceil(np.log2(max(1, n) / 100)), 0, 40))
    tables = [hyperplane_buckets(nodes, bits, seed + 1000 * draw).withColumn("table", F.lit(seed)) for seed in (1, 2, 3)]
    many = max(1, n // part_rows)
    tables.append(nodes.select("id", "vector", F.pmod(F.xxhash64(F.lit(f"random{draw or ''}"), "id"), F.lit(many)).alias("bucket"), F.lit(0).alias("table")))
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)

    def best(part: pd.DataFrame) -> pd.DataFrame:
        ids, u = part["id"].to_numpy(), unit(np.stack(part["vector"]))
        near = u @ u.T
        np.fill_diagonal(near, -2)
        take = min(k if part["table"].iloc[0] else 2, len(ids) - 1)
        top = np.argpartition(-near, max(0, take - 1), axis=1)[:, :take] if take else np.zeros((len(ids), 0), int)
        at = np.repeat(np.arange(len(ids)), top.shape[1])
        return pd.DataFrame({"u": ids[at], "v": ids[top.ravel()], "s": near[at, top.ravel()]})

    found = in_parts(rows, ["table", "bucket"], part_rows).groupBy("table", "bucket", "part").applyInPandas(best, "u long, v long, s double")
    return best_of(found.withColumn("fresh", F.lit(True)), nodes.select("id", F.lit(k).alias("k")))


def best_of(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """The best of each node's edges (u, v, s, fresh), as many as its list holds."""
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    kept = once.join(sizes.withColumnRenamed("id", "u"), "u").withColumn("_rank", rank).where(F.col("_rank") <= F.col("k"))
    return kept.select("u", "v", "s", "fresh")


def with_draw(edges: DataFrame, sizes: DataFrame, turn: int) -> DataFrame:
    """``edges`` and whether this round uses them from their end too: of each node's, about as many as its list holds."""
    degree = edges.groupBy("v").agg(F.count("*").alias("_in")).join(sizes, F.col("v") == sizes.id).select("v", (F.col("k") / F.col("_in")).alias("_share"))
    draw = F.pmod(F.xxhash64("u", "v", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return edges.join(degree, "v").select("u", "v", "s", "fresh", (draw < F.col("_share")).alias("drawn"))


def descend(edges: DataFrame, nodes: DataFrame, sizes: DataFrame, n: int, turn: int, block_nodes: int = 1000) -> DataFrame:
    """One round: better neighbours (u, v, s) for nodes, found among neighbours of neighbours."""
    last = edges.groupBy("u").agg(F.min("s").alias("_last"), F.count("*").alias("_n"))
    limits = sizes.join(last, sizes.id == last.u, "left").select("id", F.when(F.col("_n") >= F.col("k"), F.col("_last")).otherwise(-2.0).alias("limit"))
    known = nodes.join(limits, "id")
    forward = edges.select(F.col("u").alias("centre"), F.col("v").alias("id"), "fresh")
    backward = with_draw(edges, sizes, turn).where("drawn").select(F.col("v").alias("centre"), F.col("u").alias("id"), "fresh")
    around = forward.union(backward).groupBy("centre", "id").agg(F.max("fresh").alias("fresh"))
    blocks = max(1, -(-n // block_nodes))
    rows = around.join(known, "id").withColumn("block", F.pmod(F.xxhash64("centre"), F.lit(blocks)))

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("centre", kind="stable")
        centre, ids = part["centre"].to_numpy(), part["id"].to_numpy()
        u, limit, fresh = unit(np.stack(part["vector"])), part["limit"].to_numpy(), part["fresh"].to_numpy(bool)
        cut = np.append(np.flatnonzero(np.diff(centre, prepend=centre[0] - 1)), len(centre))
        out = []
        for a, b in zip(cut, cut[1:], strict=False):
            if not fresh[a:b].any():
                continue
            near = u[a:b] @ u[a:b].T
            use = (near > limit[a:b, None]) & (fresh[a:b, None] | fresh[None, a:b])
            np.fill_diagonal(use, False)
            i, j = np.nonzero(use)
            if len(i):
                out.append((ids[a + i], ids[a + j], near[i, j]))
        if not out:
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64), "s": np.zeros(0)})
        made = pd.DataFrame({c: np.concatenate([o[k] for o in out]) for k, c in enumerate("uvs")})
        return made.drop_duplicates(["u", "v"])

    return rows.groupBy("block").applyInPandas(join, "u long, v long, s double")


def links_of(nodes: DataFrame, ids: np.ndarray, q: np.ndarray, least: float, block: int = 256) -> DataFrame:
    """All edges (u, v, s) of at least ``least`` from a few nodes (ids, unit vectors)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            other, x = b.column(0).to_numpy(), unit(matrix(b.column(1)))
            for a in range(0, len(q), block):
                near = q[a : a + block] @ x.T
                i, j = np.nonzero((near >= least) & (ids[a : a + block, None] != other[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a + i]), pa.array(other[j]), pa.array(near[i, j])], names=["u", "v", "s"])

    return nodes.select("id", "vector").mapInArrow(compare, "u long, v long, s double")


def exact_links(nodes: DataFrame, some: DataFrame, least: float, block_nodes: int = 8192) -> list[DataFrame]:
    """All edges of at least ``least`` from the nodes of ``some`` (id), found in blocks of them."""
    asked = nodes.join(some.select("id"), "id", "left_semi").select("id", "vector")
    blocks, made = -(-asked.count() // block_nodes), []
    for p in range(blocks):
        drawn = asked.where(F.pmod(F.xxhash64(F.lit("block"), "id"), F.lit(blocks)) == p).toArrow()
        if len(drawn):
            made.append(stored(links_of(nodes, drawn["id"].to_numpy(), unit(matrix(drawn["vector"])), least), "exact-links"))
    return made


def audited(nodes: DataFrame, edges: DataFrame, least: float, count: int, most: int = 16_384) -> float:
    """Share of its edges of at least ``least`` that the graph has (in either direction), on average over drawn nodes that have any.

    ``count`` nodes are drawn from all alike, and more, up to ``most``, while fewer than a quarter of ``count`` have edges.
    """
    both = edges.where(F.col("s") >= least - 1e-9).select("u", "v")
    both = both.union(both.select("v", "u")).distinct().withColumn("_found", F.lit(1))
    order, n = nodes.orderBy(F.xxhash64(F.lit("any"), "id"), "id"), nodes.count()
    while n:
        drawn = order.limit(count).toArrow()
        true = links_of(nodes, drawn["id"].to_numpy(), unit(matrix(drawn["vector"])), least)
        by = true.join(both, ["u", "v"], "left").groupBy("u").agg((F.count("_found") / F.count("*")).alias("share"))
        met, got = by.agg(F.count("*"), F.avg("share")).first()
        if count >= min(n, most) or met >= count // 4:
            return got if met else 1.0
        count = min(16 * count, most)
    return 1.0


def neighbour_graph(nodes: DataFrame, least: float, k: int, max_rounds: int, audit_nodes: int, recall: float) -> DataFrame:
    """Edges (u, v, s) of at least ``least`` between nodes, each in one direction or both."""
    n = nodes.count()
    sizes = nodes.select("id", F.lit(k).alias("k"))
    edges, links, passed, late = stored(first_graph(nodes, n, k), "graph"), -1, False, nodes.select("id").limit(0)
    for turn in range(max_rounds):
        better = descend(edges, nodes, sizes, n, turn)
        used = with_draw(edges, sizes, turn).withColumn("fresh", F.col("fresh") & ~F.col("drawn")).drop("drawn")
        held = edges.groupBy("u").agg(F.min("s").alias("_last"), F.count("*").alias("_n"))
        full = (F.col("_n") >= F.col("k")) & (F.col("_last") >= least)
        sizes = stored(sizes.join(held.withColumnRenamed("u", "id"), "id", "left").select("id", F.when(full, 2 * F.col("k")).otherwise(F.col("k")).alias("k"), F.coalesce(full, F.lit(False)).alias("saturated")), "list-sizes")
        late, sizes = sizes.where("saturated").select("id"), sizes.select("id", "k")
        saturated = not late.isEmpty()
        edges = stored(best_of(used.unionByName(better.withColumn("fresh", F.lit(True))), sizes), "graph")
        before, links = links, edges.where(F.col("s") >= least).count()
        if saturated or links != before:
            continue
        passed = audited(nodes, edges, least, audit_nodes) >= recall
        if passed:
            break
        edges = stored(best_of(edges.unionByName(first_graph(nodes, n, k, draw=turn + 1)), sizes), "graph")
        links = -1
    found = edges.where(F.col("s") >= least).select("u", "v", "s")
    if passed:
        return found
    held = edges.groupBy("u").agg(F.min("s").alias("_last"), F.count("*").alias("_n")).withColumnRenamed("u", "id")
    full = sizes.join(held, "id").where((F.col("_n") >= F.col("k")) & (F.col("_last") >= least)).select("id")
    for more in exact_links(nodes, late.union(full).distinct(), least):
        found = found.unionByName(more)
    if audited(nodes, found, least, audit_nodes) < recall:
        for more in exact_links(nodes, nodes, least):
            found = found.unionByName(more)
    return found


def link(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, k: int = 8, max_rounds: int = 12, audit_nodes: int = 256, recall: float = 0.95, part_rows: int = 4000) -> DataFrame:
    """(id, n_links, component) by vector: how many others it links with, and the smallest id that links lead to."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where("id IS NOT NULL")
    every = stored(rows.groupBy("id").agg(F.max("vector").alias("vector")), "vectors")
    theta = float(np.arccos(threshold))
    near = float(np.cos(theta / 4))
    fine = usable(every, "id", "vector")

    def ball(part: pd.DataFrame) -> pd.DataFrame:
        ids, x = part["id"].to_numpy(), np.stack(part["vector"])
        of = balls_of(ids, x, near)
        far = np.arccos(np.clip(cosine(x, x[of]), -1, 1))
        return pd.DataFrame({"id": ids, "vector": part["vector"], "ball": ids[of], "far": np.where(ids == ids[of], 0.0, far)})

    dealt = in_parts(hyperplane_buckets(fine, 10, 77), ["bucket"], part_rows)
    members = stored(dealt.groupBy("bucket", "part").applyInPandas(ball, f"{NODE}, ball long, far double"), "balls")
    balls = stored(members.groupBy("ball").agg(F.count("*").alias("size"), F.max("far").alias("radius")), "ball-sizes")
    nodes = stored(members.where("id = ball").select("id", "vector"), "leaders")
    reach = float(np.cos(min(np.pi, 1.5 * theta)))
    graph = neighbour_graph(nodes, reach - 1e-9, k, max_rounds, audit_nodes, recall)

    both = graph.select("u", "v").union(graph.select("v", "u")).distinct()
    of = lambda c: balls.select(F.col("ball").alias(c), F.col("size").alias(f"{c}_size"), F.col("radius").alias(f"{c}_radius"))
    vec = lambda c: nodes.select(F.col("id").alias(c), F.col("vector").alias(f"{c}_vector"))

    def angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = cosine(matrix(b.column(2)), matrix(b.column(3))) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(c)], names=["u", "v", "c"])

    exact = both.join(vec("u"), "u").join(vec("v"), "v").select("u", "v", "u_vector", "v_vector").mapInArrow(angles, "u long, v long, c double")
    spread = F.col("u_radius") + F.col("v_radius")
    angle = F.acos(F.least(F.lit(1.0), "c"))
    single = (F.col("u_size") == 1) & (F.col("v_size") == 1)
    verdict = (
        F.when(single, F.when(F.col("c") >= threshold, "all").otherwise("none"))
        .when(angle + spread <= theta - 1e-9, "all").when(angle - spread > theta + 1e-9, "none").otherwise("some")
    )
    settled = stored(exact.join(of("u"), "u").join(of("v"), "v").withColumn("verdict", verdict).select("u", "v", "v_size", "verdict"), "verdicts")

    # pairs of balls that overlap the threshold: the members of u against those of v, in parts of u
    unsure = settled.where("verdict = 'some'").select("u", "v")
    left = in_parts(members.join(unsure.select(F.col("u").alias("ball")).distinct(), "ball").select("id", "vector", F.col("ball").alias("u")), ["u"], part_rows)
    parts = left.select(F.col("u").alias("_u"), F.col("part").alias("_part")).distinct()
    right = unsure.join(members.select(F.col("ball").alias("v"), F.col("vector").alias("other")), "v").join(parts, F.col("u") == F.col("_u")).select("_u", "_part", "v", "other")

    def count(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        x, out = unit(np.stack(a["vector"])), []
        for v, some in b.groupby("v"):
            n = np.zeros(len(a), np.int64)
            for i in range(0, len(some), 2000):
                n += (x @ unit(np.stack(some["other"].iloc[i : i + 2000])).T >= threshold).sum(axis=1)
            out.append(pd.DataFrame({"id": a["id"].to_numpy(), "n": n, "v": v})[n > 0])
        return pd.concat(out)

    counted = left.groupBy("u", "part").cogroup(right.groupBy("_u", "_part")).applyInPandas(count, "id long, n long, v long")
    some = stored(counted, "member-links")

    whole = settled.where("verdict = 'all'")
    by_ball = whole.groupBy(F.col("u").alias("ball")).agg(F.sum("v_size").alias("_balls"))
    by_member = some.groupBy("id").agg(F.sum("n").alias("_members"))
    joined = whole.select(F.col("u").alias("a"), F.col("v").alias("b")).union(some.join(members.select("id", "ball"), "id").select(F.col("ball").alias("a"), F.col("v").alias("b")).distinct())
    named = components(joined).withColumnRenamed("node", "ball")
    linked = (
        members.select("id", "ball").join(balls.select("ball", "size"), "ball").join(by_ball, "ball", "left").join(named, "ball", "left").join(by_member, "id", "left")
        .select("id", (F.col("size") - 1 + F.coalesce("_balls", F.lit(0)) + F.coalesce("_members", F.lit(0))).alias("n_links"), F.coalesce("component", "ball").alias("component"))
    )
    return every.select("id").join(linked, "id", "left").select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    found = link(df, key, vector, threshold)
    return found.select(F.col("id").alias(key), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
