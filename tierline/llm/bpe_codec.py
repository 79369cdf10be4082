"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree hold, for each symbol, the merge rank of the pair
that it begins (none: the largest value); an inner node holds the smaller of its
children. Leaves carry rank and place, so the root is the leftmost pair of
lowest rank. A merge changes three leaves and the nodes above them; the word is
done when the root says that no pair merges. Words of up to 64 symbols go
through one tree per row of a numpy array, longer ones through a tree each.

``encode`` and ``decode`` keep every row and column and append one. Null and
empty texts have no ids; null ids decode to the empty text. Equal texts get
equal ids. Special strings inside a text become their own id, as the library
does by default.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, slices
from tierline.llm.vocabulary import ByWord, Vocabulary, load

WIDEST = 64
NONE = np.int64(1) << 60


def merge_rows(v: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids after all merges, and which columns hold one, for words of up to ``symbols.shape[1]`` symbols.

    The width must be a power of two; column ``i`` of a row is symbol ``i``.
    """
    n, width = symbols.shape
    ids = np.concatenate([symbols, np.zeros((n, 1), np.int64)], axis=1)
    place = np.arange(width + 1)
    inside = place[None, :] < lengths[:, None]
    after = np.where(place[None, :] + 1 < lengths[:, None], place + 1, width)
    before = np.tile(place - 1, (n, 1))
    tree = np.full((n, 2 * width), NONE, np.int64)

    def leaf(rows, left, right):
        rank = v.ranks(ids[rows, left], ids[rows, right], NONE)
        return np.where((right < width) & (rank < NONE), rank * width + left, NONE)

    every = np.arange(n)
    for i in range(width - 1):
        tree[:, width + i] = leaf(every, np.full(n, i), after[:, i])
    for node in range(width - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
    levels = width.bit_length() - 1
    rows = every
    while True:
        root = tree[rows, 1]
        rows, root = rows[root < NONE], root[root < NONE]
        if not len(rows):
            return ids[:, :width], inside[:, :width]
        at = root % width
        gone = after[rows, at]
        right = after[rows, gone]
        ids[rows, at] = v.made[root // width]
        inside[rows, gone] = False
        after[rows, at] = right
        before[rows, right] = at
        left = before[rows, at]
        has_left = left >= 0
        left = np.where(has_left, left, at)
        changed = [gone, at, left]
        tree[rows, width + gone] = NONE
        tree[rows, width + at] = leaf(rows, at, right)
        tree[rows, width + left] = np.where(has_left, leaf(rows, left, at), tree[rows, width + at])
        nodes = [width + x for x in changed]
        for _ in range(levels):
            nodes = [x >> 1 for x in nodes]
            for x in nodes:
                tree[rows, x] = np.minimum(tree[rows, 2 * x], tree[rows, 2 * x + 1])


def merge_one(v: Vocabulary, symbols: np.ndarray) -> list[int]:
    """As ``merge_rows`` for one long word: time grows as symbols times their logarithm."""
    ids, n = symbols.tolist(), len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    none, size, rank, made = int(NONE), v.size, v.rank, v.made.tolist()
    after, before = [*range(1, n + 1)], [*range(-1, n - 1)]

    def leaf(i, j):
        r = rank.get(ids[i] * size + ids[j]) if j < n else None
        return none if r is None else r * width + i

    tree = [none] * width + [leaf(i, i + 1) for i in range(n)] + [none] * (width - n)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i, value):
        node = width + i
        tree[node] = value
        while node > 1:
            node >>= 1
            value = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == value:
                return
            tree[node] = value

    while tree[1] < none:
        r, at = divmod(tree[1], width)
        gone = after[at]
        right = after[at] = after[gone]
        ids[at], ids[gone] = made[r], -1
        if right < n:
            before[right] = at
        put(gone, none)
        put(at, leaf(at, right))
        if before[at] >= 0:
            put(before[at], leaf(before[at], at))
    return [i for i in ids if i >= 0]


def encode_words(v: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids of each word (none empty) as little-endian unsigned 32-bit integers."""
    out: list[bytes] = [b""] * len(words)
    symbols, ends = v.symbols(words)
    lengths = np.diff(ends, prepend=0)
    widths = np.left_shift(2, np.ceil(np.log2(np.maximum(lengths, 2))).astype(np.int64) - 1)
    for i in np.flatnonzero(widths > WIDEST).tolist():
        out[i] = np.array(merge_one(v, symbols[ends[i] - lengths[i] : ends[i]]), "<u4").tobytes()
    for width in np.unique(widths[widths <= WIDEST]).tolist():
        members = np.flatnonzero(widths == width)
        for k in range(0, len(members), 10_000):
            part = members[k : k + 10_000]
            column = np.arange(width)
            at = (ends[part] - lengths[part])[:, None] + column
            ids, inside = merge_rows(v, symbols[np.minimum(at, len(symbols) - 1)], lengths[part])
            stops = (np.cumsum(inside.sum(1)) * 4).tolist()
            flat = ids[inside].astype("<u4").tobytes()
            for i, a, b in zip(part.tolist(), [0, *stops[:-1]], stops, strict=True):
                out[i] = flat[a:b]
    return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByWord:
    """The encoder of a vocabulary file; one per worker process."""
    v = load(path)
    return ByWord(v, lambda words: encode_words(v, words), b"".join, lambda i: np.uint32(i).astype("<u4").tobytes())


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    e, out = encoder(path), []
    for _, run in slices(texts):
        out += [b"".join(parts) for parts in e.of(run)]
    return out


def decode_ids(ids: np.ndarray, v: Vocabulary) -> str:
    return b"".join(map(v.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", packed: bool = False) -> DataFrame:
    """``df`` with the ids of ``text``: an array of ints, or little-endian u32 bytes if ``packed``."""
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)

    def compute(column: pa.Array) -> list[pa.Array]:
        made = encode_texts(column.to_pylist(), path)
        if packed:
            return [pa.array(made, pa.binary())]
        ends = np.cumsum([0, *(len(b) // 4 for b in made)]).astype(np.int32)
        return [pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(made), "<i4"))]

    return append_columns(df, text, T.StructType([T.StructField(ids, kind)]), compute)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` (either form of ``encode``) stand for."""

    def compute(column: pa.Array) -> list[pa.Array]:
        v = load(path)
        if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
            rows = [np.array(x or [], np.int64) for x in column.to_pylist()]
        else:
            rows = [np.frombuffer(x.as_buffer(), "<u4") if x.is_valid else np.zeros(0, "<u4") for x in column]
        return [pa.array([decode_ids(x, v) for x in rows], pa.string())]

    return append_columns(df, ids, T.StructType([T.StructField(text, T.StringType())]), compute)


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode again, and reduce both to a digest per document."""
    coded = decode(encode(df.select(key, text), path, text, "ids", packed=True).drop(text), path)
    return coded.select(
        F.col(key),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
