"""Token counts by heap-and-linked-list byte-pair merging.

A word's symbols form a linked list; a heap holds its adjacent pairs by merge
rank and place. The lowest is popped again and again, out-of-date entries are
skipped, and each merge pushes the two pairs that it makes. A word has as many
tokens as symbols minus merges; no identifier is made.

``count_tokens`` keeps every row and column and appends ``n_tokens``; null and
empty texts have 0. A special string inside a text counts as one token.
"""

from __future__ import annotations

import functools
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, slices
from tierline.llm.vocabulary import ByWord, Vocabulary, load


def merges(v: Vocabulary, ids: list[int], ranks: list[int]) -> int:
    """The merges that a word goes through: its symbols, and the rank of the pair that each begins (none: -1).

    Both lists are used up. A heap entry holds rank and place in one number; it
    is out of date when the pair now at its place has another rank.
    """
    n, size, rank, made = len(ids), v.size, v.rank.get, v.made_list
    heap = [r * n + i for i, r in enumerate(ranks) if r >= 0]
    if not heap:
        return 0
    heapify(heap)
    after, before, done = [*range(1, n + 1)], [*range(-1, n - 1)], 0
    while heap:
        r, i = divmod(heappop(heap), n)
        if ranks[i] != r:
            continue
        new = ids[i] = made[r]
        gone = after[i]
        k = after[i] = after[gone]
        ranks[gone] = ranks[i] = -1
        done += 1
        if k < n:
            before[k] = i
            r = ranks[i] = rank(new * size + ids[k], -1)
            if r >= 0:
                heappush(heap, r * n + i)
        h = before[i]
        if h >= 0:
            r = ranks[h] = rank(ids[h] * size + new, -1)
            if r >= 0:
                heappush(heap, r * n + h)
    return done


@functools.lru_cache(maxsize=2)
def counter(path: str) -> ByWord:
    """The counter of a vocabulary file; one per worker process."""
    v = load(path)

    def make(words: list[str]) -> list[int]:
        if not words:
            return []
        symbols, ends = v.symbols(words)
        ranks = np.append(v.ranks(symbols[:-1], symbols[1:], -1), -1)
        ranks[ends - 1] = -1
        ids, pairs, stops = symbols.tolist(), ranks.tolist(), ends.tolist()
        return [b - a - merges(v, ids[a:b], pairs[a:b]) for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    return ByWord(v, make, sum, lambda _: 1)


def count_texts(texts: list[str | None], path: str) -> list[int]:
    c, out = counter(path), []
    for _, run in slices(texts):
        out += [sum(parts) for parts in c.of(run)]
    return out


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    return append_columns(
        df, text, T.StructType([T.StructField(out, T.LongType())]),
        lambda column: [pa.array(count_texts(column.to_pylist(), path), pa.int64())],
    )


def budget(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """Per document its bytes, its tokens and whether these are over ``limit``."""
    sized = df.select(key, text, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(sized, path, text).select(
        key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
