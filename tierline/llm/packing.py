"""Best-fit packing by patterns of few documents and non-negative least squares.

Documents become ids (tokenizers library, word by word with a memory), end with
an end id, and only longer ones are cut at ``capacity``. Piece lengths, rounded
up to ``capacity / 256``, make a histogram of 256 bins at most. All patterns of
up to three bins that fill a sequence are enumerated; non-negative least squares
fits how often each is used to the histogram; the rounded counts are filled
first, and best fit on the bins packs what is left. This plan is as small for
any input; the pieces themselves stay distributed: they are numbered within
their bin, a number leads to a sequence and a slot, and offsets are running sums
within a sequence. A bin of more than ``rank_rows`` pieces is numbered in parts.

Every row gives its pieces: null and empty texts the end id alone, repeated rows
their own pieces. Equal rows may swap places. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import released, runs, slices, stored, tidy
from tierline.llm.vocabulary import ByWord, Vocabulary, load

BINS = 256
PARTS = 3

LINE = 64
RUN = 1 << 18  # bytes of texts that are encoded at once


def word_ends(v: Vocabulary) -> np.ndarray | None:
    """Whether an id ends its word; None if ids don't tell."""
    if not v.suffix:
        return None
    ends = dict.fromkeys(v.byte_ids.tolist(), False) | dict.fromkeys(v.last_ids.tolist(), True)
    for key, rank in sorted(v.rank.items(), key=lambda x: x[1]):
        right = ends.get(key % v.size)
        if right is None or ends.setdefault(v.made_list[rank], right) != right:
            return None
    return np.array([ends.get(i, False) for i in range(v.size)])


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> ByWord:
    """Ids by the tokenizers library, each word once as long as it is remembered."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    v, t = load(path), Tokenizer.from_file(path)
    t.normalizer = normalizers.Sequence([])  # the words are normal already
    word = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), word])
    last = word_ends(v)

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in t.encode_batch_fast(texts, add_special_tokens=False)]

    def make(words: list[str]) -> list[bytes]:
        if last is not None and words and not any("\n" in w for w in words):  # a line of words costs less than each by itself
            ids = np.concatenate(ids_of(["\n".join(words[i : i + LINE]) for i in range(0, len(words), LINE)]))
            ends = 4 * (np.flatnonzero(last[ids]) + 1)
            if len(ends) == len(words) and ends[-1] == 4 * len(ids):
                raw = ids.tobytes()
                return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        t.pre_tokenizer = word
        out = [x.tobytes() for x in ids_of(words)]
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), word])
        return out

    return ByWord(v, make, b"".join, lambda i: np.uint32(i).astype("<u4").tobytes(), limit=400_000)


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: key, piece, start, length and the checksum of its ids."""
    kind = df.schema[key].dataType
    schema = T.StructType([
        T.StructField(key, kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = library_encoder(path)
            for some in runs(batch, 1, RUN):
                row, start, length, crc = [], [], [], []
                for first, texts in slices(some.column(1).to_pylist()):
                    for i, parts in enumerate(e.of(texts), first):
                        ids = memoryview(b"".join([*parts, end]))
                        for a in range(0, len(ids), 4 * capacity):
                            cut = ids[a : a + 4 * capacity]
                            row.append(i)
                            start.append(a // 4)
                            length.append(len(cut) // 4)
                            crc.append(zlib.crc32(cut))
                begin = pa.array(start, pa.int64())
                piece = pa.array([a // capacity for a in start], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(row, pa.int64())), piece, begin, pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=schema.fieldNames(),
                )
                released(often=False)

    return df.select(key, text).mapInArrow(tidy(run), schema)


def patterns(present: np.ndarray, full: int) -> np.ndarray:
    """All sums of two or three of the present bins that make ``full``: rows of bins, 0 for none."""
    has = np.zeros(full + 1, bool)
    has[present] = True
    out = [(a, full - a, 0) for a in range(1, full // 2 + 1) if has[a] and has[full - a]]
    for a in range(1, full // PARTS + 1):
        if has[a]:
            out += [(a, b, full - a - b) for b in range(a, (full - a) // 2 + 1) if has[b] and has[full - a - b]]
    return np.array(out, np.int64).reshape(-1, PARTS)


def non_negative_fit(columns: np.ndarray, counts: np.ndarray, steps: int = 3000) -> np.ndarray:
    """Repeats x >= 0 of the patterns with least squared error against the counts (accelerated projected gradient)."""
    n, m = len(counts), len(columns)
    used = (columns > 0).astype(float)
    reach = np.bincount(columns.ravel(), weights=used.ravel(), minlength=n)
    rate = 1.0 / max(1.0, PARTS * float(reach.max(initial=1.0)))
    x = y = np.zeros(m)
    t = 1.0
    for _ in range(steps):
        miss = np.bincount(columns.ravel(), weights=(used * y[:, None]).ravel(), minlength=n) - counts
        miss[0] = 0
        following = np.maximum(0.0, y - rate * miss[columns].sum(1))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = following + (t - 1) / after * (following - x)
        if np.abs(following - x).max(initial=0.0) < 1e-4:
            return following
        x, t = following, after
    return x


def plan(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns (bins, at most ``len(counts) - 1`` together) and repeats that use up the counts."""
    left, full = counts.astype(np.int64).copy(), len(counts) - 1
    out: list[tuple[list[int], int]] = []
    if left[full]:
        out.append(([full], int(left[full])))
        left[full] = 0
    columns = patterns(np.flatnonzero(left), full)
    if len(columns):
        repeats = non_negative_fit(columns, left.astype(float))
        for i in np.argsort(-repeats, kind="stable").tolist():
            bins, often = np.unique(columns[i][columns[i] > 0], return_counts=True)
            n = min(int(round(repeats[i])), int((left[bins] // often).min()))
            if n > 0:
                left[bins] -= n * often
                out.append((sorted(columns[i][columns[i] > 0].tolist(), reverse=True), n))
    while left.any():
        bins, space, free = [], full, left.copy()
        while (fits := np.flatnonzero(free[: space + 1])).size:
            b = int(fits[-1])
            bins.append(b)
            free[b] -= 1
            space -= b
        kinds, often = np.unique(bins, return_counts=True)
        n = int((left[kinds] // often).min())
        left[kinds] -= n * often
        out.append((bins, n))
    return out


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 0, rank_rows: int = 200_000) -> DataFrame:
    """Pieces of all documents with the sequence that each belongs to and its offset there."""
    width = -(-capacity // BINS)
    full = capacity // width
    cut = stored(pieces(df, path, key, text, capacity, end_id), "pieces")
    room = F.when(F.col("length") > full * width, full).otherwise(F.ceil(F.col("length") / width)).cast("int")
    sized = cut.withColumn("_bin", room)
    counts = np.zeros(full + 1, np.int64)
    for b, n in sized.groupBy("_bin").count().collect():  # a row for each of 256 bins at most
        counts[b] = n
    chosen = plan(counts)

    # numbers of a bin's pieces in order -> sequence and slot; a few rows for each pattern
    bins = np.array([b for p, _ in chosen for b in p], np.int64)
    base = np.concatenate([[0], np.cumsum([n for _, n in chosen])]).astype(np.int64)
    first = np.array([base[i] for i, (p, _) in enumerate(chosen) for _ in p], np.int64)
    slot = np.array([s for p, _ in chosen for s in range(len(p))], np.int64)
    number = np.array([n for p, n in chosen for _ in p], np.int64)
    order = np.argsort(bins, kind="stable")
    bins, first, slot, number = bins[order], first[order], slot[order], number[order]
    begin = np.cumsum(number) - number  # over all bins
    bin_begin = np.concatenate([[0], np.cumsum(counts)])[:-1]

    parts = np.maximum(1, -(-counts // rank_rows))
    split = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("_bin") + 1)
    sized = sized.withColumn("_part", F.pmod(F.xxhash64(key, "piece", "length", "ids_crc32"), split))
    groups = sized.groupBy("_bin", "_part").count()
    before = groups.select("_bin", "_part", (F.sum("count").over(Window.partitionBy("_bin").orderBy("_part")) - F.col("count")).alias("_before"))
    within = Window.partitionBy("_bin", "_part").orderBy(F.col(key), F.col("piece"), F.col("length"), F.col("ids_crc32"))
    numbered = sized.join(before, ["_bin", "_part"]).withColumn("_at", F.col("_before") + F.row_number().over(within) - 1)
    names = [key, "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([*[cut.schema[n] for n in names], T.StructField("sequence_id", T.LongType()), T.StructField("_slot", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bin_begin[batch.column(5).to_numpy()] + batch.column(6).to_numpy()
            i = np.searchsorted(begin, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(first[i] + at - begin[i]), pa.array(slot[i])], names=schema.fieldNames()
            )

    placed = numbered.select(*names, "_bin", "_at").mapInArrow(place, schema)
    inside = Window.partitionBy("sequence_id").orderBy("_slot")
    return placed.select(*names, "sequence_id", (F.sum("length").over(inside) - F.col("length")).alias("offset"))
