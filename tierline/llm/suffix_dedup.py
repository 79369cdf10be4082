"""Removal of repeated passages with suffix orders.

A window is a string of ``width`` bytes inside one text; it is a repeat if an
equal one starts earlier (smaller id, or same text, earlier place). All bytes
that repeats cover are removed, whatever else is removed.

Every window has a seed: of its runs of ``seed_of(width)`` bytes the first whose
hash is smallest. Equal windows have equal seeds at equal places, so windows are
dealt out by seed, and all windows around one seed travel as one chunk of text.
Seeds that occur once need no company and stay where they are; a table of
counters of fixed size tells most of them. Equal chunks are one chunk, with the
earliest place, in the task that reads the text and again where they meet; the
others are repeats as a whole. The different chunks of a seed form a text whose
suffixes are put in order by linear grouping (``suffixes``); equal windows are
then next to each other, are compared byte by byte, and the earliest one stays.

Of texts that are equal as a whole only the first is searched (a table of marks
of fixed size lets most others be passed over; one that isn't is removed by its
windows). A seed whose chunks are more than ``part_rows`` is dealt out window by
window, so equal ones collapse again before and after the shuffle and no seed
fills a task. A group of many chunks inside a task is cut into smaller ones the same way.

Null and empty texts have nothing to remove. Rows of one id and text are the
same document and get the same result; of one id and different texts, the text with
the smaller hash comes first. Rows with a null id have no place in the order:
they keep everything and make nothing a repeat. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import runs, stored, tidy, tidy_group
from tierline.llm.suffixes import ragged, suffix_orders

WIDTH = 100
MANY = 24  # different chunks in one suffix order
CELL = 8  # windows of a chunk in a group that has more
PIECE = 1 << 17  # bytes whose hashes are made at once, so they stay in cache
PLACE = 40  # bits of a place in a text
MARKS = 1 << 26


def seed_of(width: int) -> int:
    return max(1, width // 3)


def hashes(x: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` bytes."""
    n = max(0, len(x) - k + 1)
    if k < 8:
        words, steps = x.astype(np.uint64), range(1, k)
    else:  # eight bytes from each place on
        words = np.ndarray((max(0, len(x) - 7),), "<u8", x.tobytes(), strides=(1,)).astype(np.uint64)
        steps = [*range(8, k - 8, 8), k - 8]
    words += np.uint64(1)
    words *= np.uint64(0x9E3779B97F4A7C15)
    words ^= words >> np.uint64(32)
    h = words[:n].copy()
    for i in steps:
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h += words[i : i + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


class Seeds:
    """Chunks of the texts of a run: ``size`` windows from ``start`` (of the run) on that have their seed at ``start + back``."""

    def __init__(self, texts: list[bytes], width: int):
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        length = np.array([len(t) for t in texts], np.int64)
        self.firsts = np.cumsum(length) - length
        k, n = seed_of(width), len(self.flat)
        begins = np.zeros(n + 1, np.int8)  # windows of a text begin here / don't any more
        fits = length >= width
        begins[self.firsts[fits]] += 1
        begins[(self.firsts + length)[fits] - width + 1] -= 1
        valid = np.cumsum(begins[:n], dtype=np.int8) > 0
        found = []
        for a in range(0, max(0, n - width + 1), PIECE):
            x = self.flat[a : a + PIECE + width - 1]
            key = hashes(x, k)
            low = (key & ~np.uint64(0xFFFFFF)) | np.arange(len(key), dtype=np.uint64)  # a smaller place wins a tie
            reach = 1
            while reach < width - k + 1:
                more = min(reach, width - k + 1 - reach)
                low = np.minimum(low[:-more], low[more:], out=low[:-more])
                reach += more
            seed = (low & np.uint64(0xFFFFFF)).astype(np.int64)
            ok = valid[a : a + len(seed)]
            change = np.flatnonzero(np.diff(np.where(ok, seed, -1), prepend=-1))
            size = np.diff(change, append=len(seed))
            change, size = change[ok[change]], size[ok[change]]
            found.append((change + a, size, seed[change] - change, key[seed[change]]))
        none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)]
        self.start, self.size, self.back, self.key = (np.concatenate(c) for c in zip(none, *found, strict=True))
        self.text = np.searchsorted(self.firsts + length, self.start, "right")


def slot_of(key: np.ndarray, slots: int) -> np.ndarray:
    mixed = key * np.uint64(0x9E3779B97F4A7C15)  # a seed's own hash is a small one
    return (mixed >> np.uint64(64 - (slots.bit_length() - 1))).astype(np.int64)


def told(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (7 - (slot & 7)) & 1).astype(bool)


def cuts(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The pieces of ``flat`` from each start on as byte strings."""
    ends = np.append(0, np.cumsum(size))
    out = np.empty(int(ends[-1]), np.uint8)
    for i in range(0, len(start), 2048):  # the numbers of the bytes take eight times as much
        out[ends[i] : ends[min(i + 2048, len(start))]] = flat[ragged(start[i : i + 2048], size[i : i + 2048])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(out)])


class Tally:
    """Occurrences by slot of a table of fixed size; a task sends those that it has, in parts of 2^16 slots."""

    schema = "part int, at binary, n binary"

    def __init__(self):
        self.own: list[np.ndarray] = []  # a slot's number and 16 bits for how often
        self.size = 0

    def add(self, slot: np.ndarray) -> None:
        slot, n = np.unique(slot, return_counts=True)
        self.own.append(slot.astype(np.uint64) << np.uint64(16) | np.minimum(n, 0xFFFF).astype(np.uint64))
        self.size += len(slot)
        if self.size > 1 << 21:
            self.merge()

    def merge(self) -> None:
        if len(self.own) > 1:
            own = np.concatenate(self.own)
            self.own = []
            own.sort()
            begin = np.flatnonzero(np.diff(own >> np.uint64(16), prepend=~np.uint64(0)))
            slot = own[begin] & ~np.uint64(0xFFFF)
            own &= np.uint64(0xFFFF)
            self.own = [slot | np.minimum(np.add.reduceat(own, begin), np.uint64(0xFFFF))] if len(own) else []
        self.size = 0  # counted anew from here

    def sent(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.own:
            slot, n = (self.own[0] >> np.uint64(16)).astype(np.int64), self.own[0].astype(np.uint16)
            part, at = slot >> 16, (slot & 0xFFFF).astype(np.uint16)
            begin = np.flatnonzero(np.diff(part, prepend=-1))
            for a, b in zip(begin.tolist(), np.append(begin[1:], len(part)).tolist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([part[a]], pa.int32()), pa.array([at[a:b].tobytes()], pa.binary()), pa.array([n[a:b].tobytes()], pa.binary())], names=["part", "at", "n"])

    @staticmethod
    def over(sent: DataFrame, slots: int, least: list[int]) -> list[np.ndarray]:
        """For each of ``least`` a bit per slot: whether it occurs that often."""
        width = min(slots, 1 << 16)

        def add(rows: pa.Table) -> pa.Table:
            total = np.zeros(width, np.int64)
            for at, n in zip(rows["at"].to_pylist(), rows["n"].to_pylist(), strict=True):
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint16)
            return pa.table({"part": rows["part"][:1], **{f"b{i}": [np.packbits(total >= x).tobytes()] for i, x in enumerate(least)}})

        out = [np.zeros(slots // 8, np.uint8) for _ in least]
        schema = "part int, " + ", ".join(f"b{i} binary" for i in range(len(least)))
        for r in sent.groupBy("part").applyInArrow(tidy_group(add), schema).collect():  # slots / 8 bytes for each, in all
            for i, bits in enumerate(out):
                bits[r.part * width // 8 : (r.part + 1) * width // 8] = np.frombuffer(r[f"b{i}"], np.uint8)
        return out


CHUNKS = "bucket int, key long, id long, tie long, off long, size int, back int, chunk binary"
NAMES = [c.split(" ")[0] for c in CHUNKS.split(", ")]


def batch_of(bucket, key, id_, tie, off, size, back, chunk) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip((bucket, key, id_, tie, off, size, back, chunk), kinds, strict=True)], names=NAMES)


def collapsed(key, id_, tie, off, size, back, chunks: pa.Array, width: int, buckets: int) -> pa.RecordBatch:
    """Rows of chunks, the earliest of equal ones only; the others are spans to remove (no chunk, ``size`` in bytes)."""
    span, keep = np.zeros(len(key), bool), np.ones(len(key), bool)
    order = np.lexsort((off, tie, id_, key))
    same = np.diff(key[order]) == 0
    first: dict = {}
    for i in order[np.append(same, False) | np.append(False, same)].tolist():  # of keys that occur more than once
        j = first.setdefault((key[i].item(), chunks[i].as_py()), i)
        if j != i:  # the same document again, or a repeat
            again = id_[i] == id_[j] and tie[i] == tie[j] and off[i] == off[j]
            keep[i], span[i] = not again, not again
    bucket = np.where(span, id_.view(np.uint64) % np.uint64(buckets), key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
    at = np.flatnonzero(keep)
    chunks = pc.if_else(pa.array(span), pa.scalar(None, pa.binary()), chunks).take(pa.array(at))
    return batch_of(bucket[at], key[at], id_[at], tie[at], off[at], np.where(span, size + width - 1, size)[at], back[at], chunks)


def searched(rows: DataFrame, reps, run) -> DataFrame:
    """``run`` over the batches of (id, tie, text) that may be first of their text."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own():
            for batch in batches:
                for some in runs(batch, 2, 2 << 20):  # a whole batch isn't copied
                    own_slot = slot_of(some.column(3).to_numpy().view(np.uint64), 8 * len(reps.value))
                    if len(some := some.filter(pa.array(told(reps.value, own_slot)))):
                        yield some

        yield from run(own())

    return rows.withColumn("_h", F.xxhash64("id", "tie")), tidy(chosen)


def removals(docs: DataFrame, reps, size: int, width: int, part_rows: int) -> tuple[DataFrame, list]:
    """Spans (id, tie, start, stop) of the texts (id, tie, text) that repeats cover, and what was broadcast for it."""
    sc = docs.sparkSession.sparkContext
    slots = 1 << int(np.clip(np.ceil(np.log2(max(1, size / 3))), 16, 28))
    buckets = max(1, size // (5 << 20))

    def count(batches):
        own = Tally()
        for some in batches:
            own.add(slot_of(Seeds([t.encode() for t in some.column(2).to_pylist()], width).key, slots))
        yield from own.sent()

    def cut(wanted: bool):
        def run(batches):
            for some in batches:
                s = Seeds([t.encode() for t in some.column(2).to_pylist()], width)
                slot = slot_of(s.key, slots)
                here = told(often.value[0], slot)
                at = np.flatnonzero(here & (told(often.value[1], slot) == wanted) if len(often.value) > 1 else here)
                if len(at):
                    chunks, text = cuts(s.flat, s.start[at], s.size[at] + width - 1), s.text[at]
                    id_, tie = some.column(0).to_numpy()[text], some.column(1).to_numpy()[text]
                    yield collapsed(s.key[at].view(np.int64), id_, tie, s.start[at] - s.firsts[text], s.size[at], s.back[at], chunks, width, buckets)

        return run

    rows, run = searched(docs, reps, count)
    bits = Tally.over(rows.mapInArrow(run, Tally.schema), slots, [2, part_rows + 1])
    many = bits[1].any()  # seeds that may fill a task
    often = sc.broadcast(bits if many else bits[:1])  # slots / 8 bytes each, 32 MB at most
    rows, run = searched(docs, reps, cut(False))
    chunks = rows.mapInArrow(run, CHUNKS)
    if many:  # cut finer until none does
        rows, run = searched(docs, reps, cut(True))
        full = rows.mapInArrow(run, CHUNKS)
        for cell in (CELL, 1, None):
            full = stored(full, "full")
            chunks = chunks.unionByName(full.where("chunk IS NULL"))
            full = full.where("chunk IS NOT NULL")
            if cell is None:  # equal windows only, as many as tasks
                chunks = chunks.unionByName(full)
                break
            hot = full.groupBy("key").count().where(F.col("count") > part_rows).select("key")
            chunks = chunks.unionByName(full.join(hot, "key", "left_anti").select(*NAMES))
            full = full.join(hot, "key", "left_semi").select(*NAMES).mapInArrow(tidy(lambda b, c=cell: cells(b, c, width, buckets)), CHUNKS)
    return chunks.groupBy("bucket").applyInArrow(tidy_group(lambda t: repeats(t, width)), "id long, tie long, start long, stop long"), [often]


def cells(batches: Iterator[pa.RecordBatch], cell: int, width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Chunks cut into parts of up to ``cell`` windows, dealt out by the bytes that the windows of a part have in common."""
    for batch in batches:
        for some in runs(batch, 7, 1 << 20):
            _, _, id_, tie, off, size, back, chunks = (some.column(i) for i in range(8))
            own = [(i, *part) for i, (n, m, c) in enumerate(zip(size.to_pylist(), back.to_pylist(), chunks.to_pylist(), strict=True)) for part in parted(n, m, c, cell, width)]
            of, a, n, m = (np.array([x[k] for x in own], np.int64) for k in (0, 2, 3, 4))
            key = np.array([xxhash.xxh3_64_intdigest(x[1]) for x in own], np.uint64).view(np.int64)
            chunk = pa.array([x[5] for x in own], pa.binary())
            yield collapsed(key, id_.to_numpy()[of], tie.to_numpy()[of], off.to_numpy()[of] + a, n, m, chunk, width, buckets)


def parted(size: int, back: int, chunk: bytes, cell: int, width: int) -> Iterator[tuple[bytes, int, int, int, bytes]]:
    """(what its windows share, first window, windows, place of the seed, bytes) of each part of a chunk:
    the windows whose seed is k * cell bytes or more in, but under (k + 1) * cell."""
    for k in range((back - size + 1) // cell, back // cell + 1):
        a, b = max(0, back - (k + 1) * cell + 1), min(size, back - k * cell + 1)
        core = chunk[back - k * cell : back - (k + 1) * cell + 1 + width]
        yield k.to_bytes(4, "little", signed=True) + core, a, b - a, back - a, chunk[a : b - 1 + width]


def united(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that overlap or touch as one."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.append(True, start[1:] > reach[:-1])) if len(start) else np.zeros(0, np.int64)
    return start[new], reach[np.append(new[1:], len(start)) - 1] if len(new) else reach


def repeats(table: pa.Table, width: int) -> pa.Table:
    """Spans that repeats cover among chunks that have met."""
    columns = {c: table[c].to_numpy() for c in ("key", "id", "tie", "off", "size", "back")}
    ids = np.stack([columns["id"], columns["tie"]], axis=1)
    texts, text = np.unique(ids, axis=0, return_inverse=True)  # in order of id and tie
    place = (text.ravel().astype(np.int64) << PLACE) + columns["off"]
    chunks = table["chunk"].to_pylist()
    groups, spans, ready = {}, Spans(), Ready(width)
    order = np.lexsort((place, columns["key"])).tolist()
    keys, sizes, backs, places = (x.tolist() for x in (columns["key"], columns["size"], columns["back"], place))
    for i in order:
        if chunks[i] is None:
            spans.add(places[i], places[i] + sizes[i])
        else:
            groups.setdefault(keys[i], []).append((places[i], sizes[i], backs[i], chunks[i]))
    del chunks, order, keys, sizes, backs, places
    while groups:
        divide(groups.popitem()[1], 0, width, ready, spans)
    for found in ready.end():
        spans.arrays.append((found, found + width))
    start, stop = spans.all()
    mask = (1 << PLACE) - 1
    own = texts[start >> PLACE] if len(start) else np.zeros((0, 2), np.int64)
    return pa.table({"id": own[:, 0], "tie": own[:, 1], "start": start & mask, "stop": (start & mask) + (stop - start)})


class Spans:
    """Ranges, put together from time to time."""

    def __init__(self):
        self.begin, self.end, self.arrays = [], [], []

    def add(self, begin: int, end: int) -> None:
        self.begin.append(begin)
        self.end.append(end)
        if len(self.begin) > 100_000:
            self.arrays = [self.all()]
            self.begin, self.end = [], []

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        own = [*self.arrays, (np.array(self.begin, np.int64), np.array(self.end, np.int64))]
        return united(*(np.concatenate([x[i] for x in own]) for i in (0, 1)))


class Ready:
    """Groups of chunks that wait for their suffix order; many are put in order at once."""

    def __init__(self, width: int, batch: int = 3 << 19):
        self.width, self.batch, self.groups, self.size, self.found = width, batch, [], 0, []

    def add(self, group: list[tuple[int, int, bytes]]) -> None:
        self.groups.append(group)
        self.size += sum(len(c) for *_, c in group)
        if self.size >= self.batch:
            self.run()

    def run(self) -> None:
        self.found.append(earlier(self.groups, self.width))
        self.groups, self.size = [], 0

    def end(self) -> list[np.ndarray]:
        if self.groups:
            self.run()
        return self.found


def divide(members: list[tuple[int, int, int, bytes]], cell: int, width: int, ready: Ready, spans: Spans) -> None:
    """Chunks (place, windows, place of the seed, bytes) of one seed, by place: equal ones become one, and
    if there are too many different ones, those of ``CELL`` windows (then of one) that share what these have in common."""
    different: dict[bytes, tuple[int, int, int, bytes]] = {}
    for m in members:
        if different.setdefault(m[3], m) is not m and different[m[3]][0] != m[0]:
            spans.add(m[0], m[0] + m[1] + width - 1)
    rest = list(different.values())
    if len(rest) < 2:
        return
    if len(rest) <= MANY:
        ready.add([(p, n, c) for p, n, _, c in rest])
        return
    cell = 1 if cell else CELL
    parts: dict = {}
    for p, n, back, c in rest:
        for core, a, m, at, part in parted(n, back, c, cell, width):
            parts.setdefault(core, []).append((p + a, m, at, part))
    for own in parts.values():
        if len(own) > 1:
            divide(own, cell, width, ready, spans)


def earlier(groups: list[list[tuple[int, int, bytes]]], width: int) -> np.ndarray:
    """Places of the windows for which their group has an equal one at a smaller place."""
    # a text for each group: its chunks, each followed by 1, and a 0; bytes count from 2 on
    many = np.array([len(g) for g in groups])
    place, count = (np.array([m[i] for g in groups for m in g], np.int64) for i in (0, 1))
    raw = np.frombuffer(b"".join(m[2] for g in groups for m in g), np.uint8)
    length = count + width - 1
    sizes = np.add.reduceat(length + 1, np.cumsum(many) - many) + 1
    firsts = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(groups)), many)
    begin = np.cumsum(length + 1) - (length + 1) + group
    symbols = np.ones(int(sizes.sum()), np.int16)
    symbols[firsts + sizes - 1] = 0
    symbols[ragged(begin, length)] = raw.astype(np.int16) + 2
    order = suffix_orders(symbols, firsts, sizes)
    where = np.full(len(symbols), -1, np.int64)  # of the windows
    where[ragged(begin, count)] = ragged(place, count)
    order = order[where[order] >= 0]
    text = np.repeat(np.arange(len(groups), dtype=np.int32), sizes)
    same = np.flatnonzero(text[order[1:]] == text[order[:-1]])
    plain = symbols.tobytes()
    words = np.ndarray((len(symbols) - 3,), "<u8", plain, strides=(2,)) if len(symbols) > 3 else None
    for step in [*range(0, width - 3, 4), *range(width - width % 4, width)]:
        a, b = order[same] + step, order[same + 1] + step
        same = same[words[a] == words[b]] if step % 4 == 0 and step + 4 <= width else same[symbols[a] == symbols[b]]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    starts = np.flatnonzero(new)
    own = where[order]
    least = np.repeat(np.minimum.reduceat(own, starts), np.diff(starts, append=len(order)))
    return np.sort(own[own > least])


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, part_rows: int = 200_000) -> DataFrame:
    """(id, text, spans) of every row: ``spans`` are the (start, stop) in bytes that are to go, in order, none touching another."""
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    long = (F.octet_length("text") >= width) & F.col("id").isNotNull()
    short = docs.where(~F.coalesce(long, F.lit(False))).select("id", "text", none.alias("spans"))
    docs = docs.where(long)
    known = stored(docs.select("id", "tie", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("sha")), "texts")
    total = known.agg(F.sum("n")).first()[0] or 0
    firsts = stored(known.groupBy("sha").agg(F.min(F.struct("id", "tie")).alias("_f")).select("sha", "_f.id", "_f.tie"), "firsts")
    reps = spark.sparkContext.broadcast(marked(firsts))
    spans, sent = removals(docs.select("id", "tie", "text"), reps, total, width, part_rows)
    spans = stored(spans, "spans")
    for b in (reps, *sent):
        b.destroy()
    copies = known.join(firsts.select("sha", F.col("id").alias("_first")), "sha").where(F.col("id") > F.col("_first"))
    spans = spans.unionByName(copies.select("id", "tie", F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")).distinct())
    touched = spark.sparkContext.broadcast(marked(spans.select("id", "tie")))
    lists = spans.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            given = batch.column(2)
            count = pc.fill_null(pc.list_value_length(given), 0).to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(len(given)), count) << PLACE
            start, stop = united(*(text + pc.struct_field(given.flatten(), f).to_numpy(zero_copy_only=False) for f in ("start", "stop")))
            ends = np.cumsum(np.bincount(start >> PLACE, minlength=len(given)))
            start, stop = start & (1 << PLACE) - 1, (start & (1 << PLACE) - 1) + (stop - start)
            own = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], fields=list(kind.value_type))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), own)], names=["id", "text", "spans"])

    def reached(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in runs(batch, 2):
                    slot = slot_of(some.column(3).to_numpy().view(np.uint64), MARKS)
                    yield some.filter(pa.array(told(touched.value, slot) == wanted))

        return docs.select("id", "tie", "text", F.xxhash64("id", "tie").alias("_h")).mapInArrow(tidy(run), "id long, tie long, text string, _h long")

    # most texts without a span needn't move
    cut = reached(True).join(lists, ["id", "tie"], "left").select("id", "text", "_spans").mapInArrow(tidy(unite), "id long, text string, spans array<struct<start:long,stop:long>>")
    return cut.unionByName(reached(False).select("id", "text", none.alias("spans"))).unionByName(short)


def marked(texts: DataFrame) -> np.ndarray:
    """A bit for the hash of each text (id, tie): MARKS / 8 bytes."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tally()
        for batch in batches:
            own.add(slot_of(batch.column(0).to_numpy().view(np.uint64), MARKS))
        yield from own.sent()

    return Tally.over(texts.select(F.xxhash64("id", "tie")).mapInArrow(tidy(mark), Tally.schema), MARKS, [1])[0]


def kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """What is left of a text's bytes."""
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def report(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, part_rows: int = 200_000) -> DataFrame:
    """Per document its bytes, what is removed, and a digest of the rest."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in runs(batch, 1):
                raw = [(t or "").encode() for t in some.column(1).to_pylist()]
                spans = [[(s["start"], s["stop"]) for s in g] for g in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                     pa.array([len(s) for s in spans], pa.int64()), pa.array([hashlib.sha256(kept(r, s)).hexdigest() for r, s in zip(raw, spans, strict=True)])],
                    names=names,
                )

    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return dedup(df, key, text, width, part_rows).mapInArrow(tidy(digest), f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
