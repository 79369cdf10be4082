"""N-gram Jaccard join through a token-group matrix.

A document's set holds the hashes of its distinct runs of ``SHINGLE`` words.
Documents of one set are a class. Classes meet by min-hash and
are partitioned into groups of similar ones: each goes to the centre that most
others have met among those that its signature agrees with by half, or stays
alone. Those that look close enough are compared exactly at once, so most copies
are linked before the join. The token-group matrix has, for each token, the
groups whose union of tokens has it; it is kept for the rarest tokens only, for
they decide: if two sets reach the threshold, each has ``LEAST`` tokens in common with
the other among its rarest ``n - ceil(t n) + LEAST`` (fewer, if the sets are
that small). A class is a query against another group, if its own is the
smaller, if the matrix has the group's union share that many of these tokens with it, and
if it can reach the threshold with a set of a size that the group has. Members
of a group are queries against their own, but for the largest part of it that is linked
already. A group that is opened is still not compared with queries that have too
few tokens in its union; of the others, members already linked with the query
are passed over.

All bounds are exact, so only pairs that can't reach the threshold, or are
linked by others, aren't compared; meetings only decide how much is left to do.
A group is opened in parts of at most ``part_rows`` members and as many queries. How rare a
token is comes from a table of counters whose size has a bound; equal counts are
ordered by hash.

Documents without words have an empty set, link with nothing and are their own
component; so do null texts. Rows of one id are one document with the largest
of their sets by fingerprint. Rows with a null id are left out. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import runs, stored, tidy, tidy_group
from tierline.llm.components import components

SHINGLE = 5
MEETINGS = 3
CENTRES = 4
TURNS = 1
SIGNATURE = 64
LEAST = 4  # tokens in common that the matrix must show
ALIKE = 50  # percent of a signature that members of a group share with its centre
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)
LETTERS[65:91] = LETTERS[97:123]  # A-Z as a-z
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
FACTOR = 0xD1342543DE82EF95
PIECE = 1 << 18
RUN = 1 << 20  # bytes of texts whose sets are made at once


@functools.lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of FACTOR and of its inverse, modulo 2^64."""
    out = []
    for f in (FACTOR, pow(FACTOR, -1, 1 << 64)):
        steps = np.full(2 * PIECE, f, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of up to 2 PIECE bytes, and where each begins."""
    x = np.frombuffer(raw, np.uint8)
    blank = np.concatenate([[True], BLANK[x], [True]])
    turn = np.flatnonzero(blank[1:] != blank[:-1])
    begin, end = turn[::2], turn[1::2]
    up, down = powers()
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(LETTERS[x] * up[: len(x)], out=total[1:])
    h = (total[end] - total[begin]) * down[begin]  # where a word stands doesn't matter
    return mixed(h + (end - begin).astype(np.uint64) * ODD), begin


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one text after the other, and how many each has."""
    hashes, count, some, size = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64), [], 0

    def flush(first: int) -> None:
        h, begin = word_hashes(b" ".join(some))
        starts = np.cumsum([0, *(len(t) + 1 for t in some)])
        count[first : first + len(some)] = np.diff(np.searchsorted(begin, starts))
        hashes.append(h)

    for i, t in enumerate(texts):
        if len(t) >= PIECE:  # by itself, cut where words end; a longer word goes another way
            if some:
                flush(i - len(some))
            some, size, before = [], 0, sum(map(len, hashes))
            for piece in pieces(t):
                hashes.append(word_hashes(piece)[0] if len(piece) <= 2 * PIECE else mixed(np.array([xxhash.xxh3_64_intdigest(piece.lower())], np.uint64)))
            count[i] = sum(map(len, hashes)) - before
            continue
        some.append(t)
        size += len(t) + 1
        if size >= PIECE:
            flush(i + 1 - len(some))
            some, size = [], 0
    if some:
        flush(len(texts) - len(some))
    return np.concatenate(hashes), count


def pieces(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about PIECE bytes that end where words end; a word of more bytes is a part."""
    words, some, size = text.split(), [], 0
    for w in words:
        if len(w) > 2 * PIECE:
            if some:
                yield b" ".join(some)
            some, size = [], 0
            yield w
            continue
        if some and size + len(w) + 1 > 2 * PIECE:
            yield b" ".join(some)
            some, size = [], 0
        some.append(w)
        size += len(w) + 1
    if some:
        yield b" ".join(some)


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of SHINGLE words; of all words, if there are fewer."""
    h, size = words_of([(t or "").encode() for t in texts])
    width = np.minimum(SHINGLE, size)
    count = np.where(size > 0, size - width + 1, 0)
    begin = np.repeat(np.cumsum(size) - size - (np.cumsum(count) - count), count) + np.arange(count.sum())
    width = np.repeat(width, count)
    total = width.astype(np.uint64)
    for k in range(int(width.max(initial=0))):
        step = mixed(total * ODD + h[np.minimum(begin + k, len(h) - 1)])
        total = np.where(k < width, step, total)
    ends = np.cumsum(count)
    out = []
    for a, b in zip((ends - count).tolist(), ends.tolist(), strict=True):
        own = np.sort(total[a:b])
        out.append(own[np.append(True, own[1:] != own[:-1])] if len(own) else own)
    return out


class Counters:
    """Counters by slot, as many for any input; a task sends what it has in parts of 2^16."""

    schema = "part int, at binary, n binary"

    def __init__(self, slots: int):
        self.own = np.zeros(slots, np.uint32)

    def add(self, slots: np.ndarray) -> None:
        if len(slots):
            at, n = np.unique(slots, return_counts=True)
            self.own[at] += n.astype(np.uint32)

    def parts(self) -> Iterator[tuple[int, bytes, bytes]]:
        for p in range(-(-len(self.own) >> 16)):
            mine = self.own[p << 16 : (p + 1) << 16]
            at = np.flatnonzero(mine)
            if len(at):
                yield p, at.astype(np.uint16).tobytes(), mine[at].tobytes()

    @staticmethod
    def collected(sent: DataFrame, slots: int, level) -> np.ndarray:
        """One byte for each slot: ``level`` of the sum over tasks."""
        width = min(slots, 1 << 16)

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            out = np.zeros(width, np.int64)
            for at, n in zip(rows["at"], rows["n"], strict=True):
                out[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32)
            return pd.DataFrame({"part": [rows["part"].iloc[0]], "level": [level(out).astype(np.uint8).tobytes()]})

        table = np.zeros(slots, np.uint8)
        for r in sent.groupBy("part").applyInPandas(tidy_group(add), "part int, level binary").collect():
            table[r.part * width : (r.part + 1) * width] = np.frombuffer(r.level, np.uint8)
        return table


def power(n: float, low: int, high: int) -> int:
    return 1 << int(np.clip(np.ceil(np.log2(max(1.0, n))), low, high))


def slots_of(x: np.ndarray, slots: int) -> np.ndarray:
    return (x >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)


def described(docs: DataFrame, slots: int) -> DataFrame:
    """By document: size and fingerprint of its set, MEETINGS min-hashes, and a signature of SIGNATURE small ones.

    Rows without an id hold how often tokens of a slot occur, by task.
    """
    seeds = mixed(np.arange(1, SIGNATURE + MEETINGS + 1, dtype=np.uint64) * ODD) | np.uint64(1)
    kinds = [("id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("meet", pa.list_(pa.int64())), ("sign", pa.list_(pa.int16())), ("part", pa.int32()), ("at", pa.binary()), ("count", pa.binary())]

    def batch_of(**columns) -> pa.RecordBatch:
        rows = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in kinds], names=[c for c, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters(slots)
        for batch in batches:
            for some in runs(batch, 1, RUN):
                sets = shingles(some.column(1).to_pylist())
                counters.add(slots_of(np.concatenate(sets), slots))
                meet, sign = [], []
                for s in sets:
                    low = np.full(len(seeds), np.iinfo(np.uint64).max)
                    for i in range(0, len(s), 1024):
                        low = np.minimum(low, (seeds[:, None] * s[None, i : i + 1024]).min(axis=1))
                    meet.append(low[:MEETINGS].view(np.int64))
                    sign.append((mixed(low[MEETINGS:]) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16))
                prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield batch_of(id=some.column(0), n=[len(s) for s in sets], print=prints, meet=meet, sign=sign)
        for part, at, count in counters.parts():
            yield batch_of(part=[part], at=[at], count=[count])

    return docs.mapInArrow(tidy(run), "id long, n long, print binary, meet array<long>, sign array<short>, part int, at binary, count binary")


def meetings(classes: DataFrame, turn: int = 0) -> DataFrame:
    """(a, b, n, m, agree): each class b with up to CENTRES others a that have a min-hash in common, their sizes, and
    how many places of their signatures agree.

    Those met are the ones whose min-hashes most classes have, as the original of a
    family of edited copies does; they are the same for all classes that meet,
    and others in another turn.
    """
    keyed = classes.select("id", F.posexplode("meet").alias("_j", "_key"))
    crowd = keyed.groupBy("_j", "_key").agg(F.count("*").alias("_c")).where("_c > 1")
    keyed = keyed.join(crowd, ["_j", "_key"])
    shared = keyed.join(keyed.groupBy(F.col("id").alias("_id")).agg(F.sum("_c").alias("_known")), F.col("id") == F.col("_id"))
    order = [F.min(F.struct(-F.col("_known"), F.xxhash64("id", F.lit(turn * CENTRES + k)), F.col("id").alias("to")))["to"] for k in range(CENTRES)]
    centres = shared.groupBy("_j", "_key").agg(F.array_distinct(F.array(*order)).alias("_to"))
    pairs = keyed.join(centres, ["_j", "_key"]).select("id", F.explode("_to").alias("_to")).where("id <> _to").distinct()
    left = classes.select("id", "n", "sign")
    right = classes.select(F.col("id").alias("_to"), F.col("n").alias("_n"), F.col("sign").alias("_sign"))
    pairs = pairs.join(left, "id").join(right, "_to")
    close = (100 * F.least("n", "_n") >= ALIKE * F.greatest("n", "_n"))
    agree = agreement("sign", "_sign")
    return pairs.where(close).select(F.col("_to").alias("a"), F.col("id").alias("b"), F.col("_n").alias("n"), F.col("n").alias("m"), agree.alias("agree")).where(100 * F.col("agree") >= ALIKE * SIGNATURE)


def similar(classes: DataFrame, met: DataFrame) -> DataFrame:
    """(id, g): the group of each class, named by its centre: of those met and of itself the one that most have met."""
    crowd = met.groupBy("a").agg(F.count("*").alias("_c"))
    rank = F.struct(F.coalesce("_c", F.lit(0)), -F.col("_to"), F.col("_to").alias("to"))
    options = met.select(F.col("b").alias("id"), F.col("a").alias("_to")).union(classes.select("id", F.col("id").alias("_to")))
    return options.join(crowd, F.col("_to") == F.col("a"), "left").groupBy("id").agg(F.max(rank)["to"].alias("g"))


def compare(queries: list[tuple[int, np.ndarray]], members: list[tuple[int, np.ndarray]], threshold: int, known: dict[int, int]) -> list[tuple[int, int]]:
    """Links between queries and members that join what isn't joined yet; ``known``: group of an id before."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        x = known.get(x, x)
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    if not members:
        return []
    tokens = np.concatenate([s for _, s in members])
    size = np.array([len(s) for _, s in members])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(members)), size)[order]
    out = []
    for q, s in queries:
        lo, hi = np.searchsorted(tokens, s, "left"), np.searchsorted(tokens, s, "right")
        if 100 * np.count_nonzero(hi > lo) < threshold * len(s):  # too few tokens in the union of the group
            continue
        count = hi - lo
        at = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        both = np.bincount(owner[at], minlength=len(members))
        for m in np.flatnonzero(100 * both >= threshold * (len(s) + size - both)).tolist():
            x = members[m][0]
            if x != q and find(x) != find(q):
                parent[find(x)] = find(q)
                out.append((q, x))
    return out


def marked(ids: DataFrame) -> np.ndarray:
    """A bit for the hash of each id, at most 4 MB in all. It lets most texts that aren't wanted be passed over."""
    slots = power(16 * ids.count(), 16, 25)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(slots // 8, np.uint8)  # a bit each
        for batch in batches:
            at = np.unique(slots_of(batch.column(0).to_numpy().view(np.uint64), slots))
            np.bitwise_or.at(own, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
        for part in range(-(-slots >> 16)):
            at = np.flatnonzero(np.unpackbits(own[part << 13 : (part + 1) << 13]))
            if len(at):
                n = np.ones(len(at), np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at.astype(np.uint16).tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["part", "at", "n"])

    return np.packbits(Counters.collected(ids.select(F.xxhash64("id").alias("h")).mapInArrow(tidy(mark), Counters.schema), slots, lambda n: n > 0))


def asked_for(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """Rows whose id, hashed in the third column, has a mark."""
    at = slots_of(batch.column(2).to_numpy().view(np.uint64), 8 * len(bits))
    return batch.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, print, set) of the wanted ids and of few others."""
    shared = docs.sparkSession.sparkContext.broadcast(marked(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in map(asked_for, runs(batch, 1, RUN), itertools.repeat(shared.value)):
                sets = [s.tobytes() for s in shingles(some.column(1).to_pylist())]
                prints = [xxhash.xxh3_128_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], names=["id", "print", "set"])

    return docs.withColumn("h", F.xxhash64("id")).mapInArrow(tidy(run), "id long, print binary, set binary")


def opened(docs: DataFrame, classes: DataFrame, queries: DataFrame, members: DataFrame, threshold: int, part_rows: int) -> DataFrame:
    """Links (a, b) between the queries (g, id, own) of each group and its members (g, id, own); ``own``: group before.

    Queries and members go to the parts of the group, in which each gets its set by one join; no
    part has more than about ``part_rows`` of either.
    """
    members = stored(members.select("g", "id", "own"), "members")
    queries = stored(queries.select("g", "id", "own"), "queries")
    parts = members.groupBy("g").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    dealt = members.join(parts, "g").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("asks", F.lit(False))
    turns = queries.groupBy("g").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("turns"))
    # a part of the members meets a part of the queries in a task of their own
    dealt = dealt.join(turns, "g").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    asked = queries.join(turns, "g").withColumn("turn", F.pmod(F.xxhash64("id", F.lit(1)), F.col("turns")).cast("int"))
    asked = asked.join(parts, "g").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("asks", F.lit(True))
    columns = ["g", "part", "turn", "id", "own", "asks"]
    rows = dealt.select(*columns).union(asked.select(*columns)).join(classes.select("id", "print"), "id")
    wanted = members.select("id").union(queries.select("id")).distinct()
    sets = sets_of(docs, wanted)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates(["id", "asks"])  # rows of one id
        sets = [(i, np.frombuffer(s, np.uint64)) for i, s in zip(part["id"].tolist(), part["set"], strict=True)]
        asks = part["asks"].to_numpy(bool)
        known = dict(zip(part["id"].tolist(), part["own"].tolist(), strict=True))
        links = compare([x for x, a in zip(sets, asks, strict=True) if a], [x for x, a in zip(sets, asks, strict=True) if not a], threshold, known)
        return pd.DataFrame(np.array(links, np.int64).reshape(-1, 2), columns=["a", "b"])

    return rows.join(sets, ["id", "print"]).drop("print").groupBy("g", "part", "turn").applyInPandas(tidy_group(run), "a long, b long")


def rare_tokens(docs: DataFrame, classes: DataFrame, levels: np.ndarray, threshold: int, buckets: int) -> DataFrame:
    """(token, id): for a document of each class (and few others) its rarest tokens that decide, if another set has them among its own."""
    slots = len(levels)
    shared = docs.sparkSession.sparkContext.broadcast((levels, marked(classes)))  # at most 64 MB and 4 MB
    bounds = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in map(asked_for, runs(batch, 1, RUN), itertools.repeat(shared.value[1])):
                kept, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
                for i, s in enumerate(shingles(some.column(1).to_pylist())):
                    keep = len(s) - (threshold * len(s) + 99) // 100 + LEAST if len(s) else 0
                    rarity = (shared.value[0][slots_of(s, slots)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                    s = s[np.argsort(rarity, kind="stable")[:keep]]
                    kept.append(s)
                    owner.append(np.full(len(s), i, np.int32))
                ids = some.column(0).to_numpy()
                tokens, owners = np.concatenate(kept), np.concatenate(owner)
                order = np.argsort(tokens, kind="stable")
                tokens, owners = tokens[order], owners[order]
                cut = np.concatenate([[0], np.searchsorted(tokens, bounds), [len(tokens)]])
                for b in range(buckets):
                    part = slice(cut[b], cut[b + 1])
                    if part.stop > part.start:
                        who, at = np.unique(owners[part], return_inverse=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b], pa.int32()), pa.array([tokens[part].tobytes()], pa.binary()), pa.array([ids[who].astype(np.int64).tobytes()], pa.binary()), pa.array([at.astype(np.uint16 if len(who) < 1 << 16 else np.uint32).tobytes()], pa.binary())],
                            names=["bucket", "tokens", "ids", "at"],
                        )

    def shared_only(rows: pd.DataFrame) -> pd.DataFrame:
        tokens = [np.frombuffer(x, np.uint64) for x in rows["tokens"]]
        ids = [np.frombuffer(i, np.int64) for i in rows["ids"]]
        at = [np.frombuffer(a, np.uint16 if len(i) < 1 << 16 else np.uint32) for a, i in zip(rows["at"], ids, strict=True)]
        token, owner = np.concatenate(tokens), np.concatenate([i[a] for i, a in zip(ids, at, strict=True)])
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        same = token[1:] == token[:-1]
        many = np.append(same, False) | np.insert(same, 0, False) if len(token) else np.zeros(0, bool)
        return pd.DataFrame({"token": token[many].view(np.int64), "id": owner[many]})

    sent = docs.withColumn("h", F.xxhash64("id")).mapInArrow(tidy(run), "bucket int, tokens binary, ids binary, at binary")
    return sent.groupBy("bucket").applyInPandas(tidy_group(shared_only), "token long, id long")


def agreement(x, y):
    return F.size(F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda same: same))


def link(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 75, part_rows: int = 500, bucket_tokens: int = 1_000_000) -> DataFrame:
    """(id, n, component) by document: the size of its set, and the smallest id that links lead to."""
    docs = df.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = power(size / 200, 16, 26)
    told = stored(described(docs, slots), "sets")
    sets = told.where("id IS NOT NULL")
    by_id = sets.groupBy("id").agg(F.max_by(F.struct("n", "print", "meet", "sign"), F.struct("print", "n")).alias("_r")).select("id", "_r.*")
    linkable = by_id.where("n > 0")
    classes = stored(linkable.groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("meet").alias("meet"), F.first("sign").alias("sign")), "classes")

    near, of, met = None, classes.select(F.col("id").alias("node"), F.col("id").alias("component")), None
    for turn in range(TURNS):  # what the first turn leaves apart meets other centres in the next
        pairs = stored(meetings(classes, turn), "meetings")
        met = pairs if met is None else met.unionByName(pairs)
        alike = (100 * F.least("n", "m") >= threshold * F.greatest("n", "m")) & (100 * F.col("agree") >= (threshold - 10) * SIGNATURE)
        own = lambda c: of.select(F.col("node").alias(c), F.col("component").alias(f"own_{c}"))  # noqa: B023, E731
        pairs = pairs.where(alike).select("a", "b").join(own("a"), "a", "left").join(own("b"), "b", "left")
        pairs = pairs.withColumns({f"own_{c}": F.coalesce(f"own_{c}", c) for c in "ab"})
        pairs = stored(pairs.where("own_a <> own_b"), "pairs")
        asking = pairs.select(F.col("a").alias("g"), F.col("a").alias("id"), F.col("own_a").alias("own")).distinct()
        answering = pairs.select(F.col("a").alias("g"), F.col("b").alias("id"), F.col("own_b").alias("own"))
        found = stored(opened(docs, classes, asking, answering, threshold, part_rows), "links")
        near = found if near is None else near.unionByName(found)
        of = components(near)
    linked = of.withColumnRenamed("node", "id").withColumnRenamed("component", "own")
    grouped = similar(classes, met.select("a", "b").distinct())
    many = grouped.groupBy("g").agg(F.count("*").alias("m"))
    groups = classes.select("id", "n").join(grouped, "id").join(many, "g").join(linked, "id", "left")
    groups = stored(groups.select("id", "n", "g", "m", F.coalesce("own", "id").alias("own")), "groups")

    counted = told.where("part IS NOT NULL").select("part", "at", F.col("count").alias("n"))
    levels = Counters.collected(counted, slots, lambda n: np.minimum(255, np.ceil(np.log2(n + 1) * 8)))
    rare = rare_tokens(docs, classes, levels, threshold, max(1, -(-size // (24 * bucket_tokens))))
    entries = rare.join(groups, "id")  # one document of each class
    crossing = entries.groupBy("token").agg(F.min("g").alias("_lo"), F.max("g").alias("_hi")).where("_lo < _hi").select("token")
    entries = stored(entries.join(crossing, "token"), "matrix")
    matrix = entries.groupBy("token", F.col("g").alias("_g")).agg(F.min("n").alias("_low"), F.max("n").alias("_high"), F.first("m").alias("_m"))
    smaller = F.struct("m", "g") < F.struct("_m", "_g")
    can = (100 * F.col("n") >= threshold * F.col("_low")) & (100 * F.col("_high") >= threshold * F.col("n"))
    shares = entries.join(matrix, "token").where(smaller & can).groupBy("_g", "id", "own", "n").agg(F.count("*").alias("_shared"))
    least = F.least(F.lit(LEAST), F.ceil(F.col("n") * threshold / 100))
    across = shares.where(F.col("_shared") >= least).select(F.col("_g").alias("g"), "id", "own")
    # inside a group: what isn't linked with most of it
    parts = groups.where("m > 1").groupBy("g", "own").agg(F.count("*").alias("_c"))
    main = parts.groupBy("g").agg(F.max(F.struct("_c", "own"))["own"].alias("_main"))
    within = groups.where("m > 1").join(main, "g").where("own <> _main").select("g", "id", "own")
    asked = stored(across.unionByName(within), "asked")
    inside = groups.join(asked.select("g").distinct(), "g", "left_semi")
    final = components(near.unionByName(opened(docs, classes, asked, inside, threshold, part_rows)))

    named = classes.select("print", "id").join(final.withColumnRenamed("node", "id"), "id", "left").select("print", F.coalesce("component", "id").alias("component"))
    return by_id.select("id", "n", "print").join(named, "print", "left").select("id", "n", F.coalesce("component", "id").alias("component"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 75) -> DataFrame:
    return link(df, key, text, threshold).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
