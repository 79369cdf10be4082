"""Language-model scores by a weighted backoff automaton.

The model has words and pairs of words of the training texts, smoothed by
absolute discounting: a state for every word seen as a context and one without
context; an arc for every pair, weighted with its interpolated probability; and
a failure arc from each word's state to the one without context, weighted with
what the discount frees. One left-to-right traversal per text follows an arc if
the state has it, else the failure arc and then the word's arc there, and adds
up log10 probabilities.

The model is never in one place. Texts are dealt into blocks of about
``block_bytes``; a block sends the words and pairs that it has (as sorted 64-bit
hashes, 48 bits within a context) with its training counts to buckets, each of
which holds a range of contexts; buckets add up over all blocks and answer with
totals in the same order; the block then has all arcs that its texts can meet.
Pairs after very common words (over 1 / ``HOT_SHARE`` of tokens, so at most that
many words) are dealt on by their second word, for no bucket to grow hot.

Null texts are empty; an empty text is its end token. Every row gives a row;
repeated rows score alike. With no training texts every token has log10(1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import slices, stored
from tierline.llm.jaccard_join import words_of

HOT_SHARE = 2000
SALTS = 32
END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))  # no word has a blank
ANSWERS = "block int, bucket int, word_total binary, context_total binary, context_kinds binary, pair_total binary, tokens long, kinds long, once long, twice long"
REQUESTS = "bucket int, block int, words binary, word_count binary, follow_size binary, follow binary, follow_count binary, hot binary"


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' tokens one after the other, and how many each has."""
    words, count = words_of([(t or "").encode() for t in texts])
    return np.insert(words, np.cumsum(count), END), count + 1


def hot_words(df: DataFrame, text: str) -> np.ndarray:
    """Words that are over 1 / HOT_SHARE of all tokens (as far as partitions see them as common)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        for batch in batches:
            for _, some in slices(batch.column(0).to_pylist(), 8_000_000):
                h, _ = tokens(some)
                n += len(h)
                u, c = np.unique(h, return_counts=True)
                common = c * HOT_SHARE >= len(h)
                words, at = np.unique(np.concatenate([words, u[common]]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([counts, c[common]])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([0, *words.view(np.int64).tolist()]), pa.array([n, *counts.tolist()]), pa.array([True] + [False] * len(words))], names=["word", "n", "total"])

    seen = df.select(text).mapInArrow(run, "word long, n long, total boolean").groupBy("total", "word").agg(F.sum("n").alias("n"))
    seen = stored(seen, "common-words")  # read twice
    limit = seen.where("total").agg(F.sum("n").alias("all"))
    hot = seen.where(~F.col("total")).join(limit).where(F.col("n") * HOT_SHARE >= F.col("all")).select("word")  # limit has one row
    return np.sort(np.array([r.word for r in hot.collect()], np.int64).view(np.uint64))


class Block:
    """Words and pairs of a block of texts, in the order in which buckets get and answer them."""

    def __init__(self, texts: list[str | None], buckets: int, hot: np.ndarray):
        self.stream, self.size = tokens(texts)
        self.words, at = np.unique(self.stream, return_inverse=True)
        self.at = at.astype(np.int64)
        n = len(self.words)
        last = np.cumsum(self.size) - 1
        inner = np.ones(len(self.at), bool)
        inner[last] = False  # the end begins no pair
        self.first = np.flatnonzero(inner)
        self.key = self.at[self.first] * n + self.at[self.first + 1]
        self.pairs = np.unique(self.key)
        context, word = np.divmod(self.pairs, max(1, n))
        self.bounds = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
        self.word_cut = np.concatenate([[0], np.searchsorted(self.words, self.bounds), [n]])
        place = np.minimum(np.searchsorted(hot, self.words), max(0, len(hot) - 1))
        is_hot = hot[place] == self.words if len(hot) else np.zeros(n, bool)
        cold = np.flatnonzero(~is_hot[context])
        self.cold_size = np.bincount(context[cold], minlength=n)
        self.cold_cut = np.searchsorted(context[cold], self.word_cut)
        # hot contexts: a group for each word of them here and each salt, empty ones too
        warm = np.flatnonzero(is_hot[context])
        salt = (self.words[word[warm]] % np.uint64(SALTS)).astype(np.int64)
        self.hot_words = np.flatnonzero(is_hot)
        groups = (place[self.hot_words][:, None] * SALTS + np.arange(SALTS)).ravel()
        goes = groups * 2_654_435_761 % (1 << 31) % buckets
        by_bucket = np.argsort(goes, kind="stable")
        self.groups, goes = groups[by_bucket], goes[by_bucket]
        self.group_cut = np.searchsorted(goes, np.arange(buckets + 1))
        rank = np.zeros(len(hot) * SALTS, np.int64)
        rank[self.groups] = np.arange(len(self.groups))
        of = rank[place[context[warm]] * SALTS + salt]
        by_group = np.argsort(of, kind="stable")
        warm, of = warm[by_group], of[by_group]
        self.group_size = np.bincount(of, minlength=len(self.groups))
        self.warm_cut = np.searchsorted(of, self.group_cut)
        self.cold, self.warm, self.word = cold, warm, word
        self.place = place

    def requests(self, train: np.ndarray, block: int) -> pd.DataFrame:
        """A row for each bucket: what the block asks, and its training counts."""
        n = len(self.words)
        trained = np.repeat(train, self.size)
        word_count = np.bincount(self.at[trained], minlength=n).astype(np.uint32)
        used, times = np.unique(self.key[trained[self.first]], return_counts=True)
        pair_count = np.zeros(len(self.pairs), np.uint32)
        pair_count[np.searchsorted(self.pairs, used)] = times
        second = (self.words[self.word] >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
        rows = []
        for p in range(len(self.word_cut) - 1):
            w, c = slice(*self.word_cut[p : p + 2]), self.cold[slice(*self.cold_cut[p : p + 2])]
            g, h = slice(*self.group_cut[p : p + 2]), self.warm[slice(*self.warm_cut[p : p + 2])]
            pairs = np.concatenate([c, h])
            sizes = np.concatenate([self.cold_size[w], self.group_size[g]]).astype(np.uint32)
            rows.append((p, block, self.words[w].tobytes(), word_count[w].tobytes(), sizes.tobytes(), second[pairs].tobytes(), pair_count[pairs].tobytes(), self.groups[g].astype(np.uint32).tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "block", "words", "word_count", "follow_size", "follow", "follow_count", "hot"])

    def filled(self, answers: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[str, int]]:
        """Totals of words, of contexts (tokens and kinds after them) and of pairs, and of all buckets."""
        n = len(self.words)
        words, pairs = np.zeros(n, np.int64), np.zeros(len(self.pairs), np.int64)
        context, kinds = np.zeros(n, np.int64), np.zeros(n, np.int64)
        of_hot = np.zeros(int(self.place.max(initial=0)) + 1, np.int64)
        of_hot[self.place[self.hot_words]] = self.hot_words
        for a in answers.itertuples():
            p = a.bucket
            w, g = slice(*self.word_cut[p : p + 2]), slice(*self.group_cut[p : p + 2])
            size = w.stop - w.start
            words[w] = unpacked(a.word_total, size)
            total, kind = (unpacked(x, size + g.stop - g.start) for x in (a.context_total, a.context_kinds))
            np.add.at(context, np.arange(w.start, w.stop), total[:size])
            np.add.at(kinds, np.arange(w.start, w.stop), kind[:size])
            back = of_hot[self.groups[g] // SALTS]
            np.add.at(context, back, total[size:])
            np.add.at(kinds, back, kind[size:])
            asked = np.concatenate([self.cold[slice(*self.cold_cut[p : p + 2])], self.warm[slice(*self.warm_cut[p : p + 2])]])
            pairs[asked] = unpacked(a.pair_total, len(asked))
        return words, context, kinds, pairs, {k: int(answers[k].sum()) for k in ("tokens", "kinds", "once", "twice")}


def packed(totals: np.ndarray) -> bytes:
    """Totals in four bytes each, or in eight if one doesn't fit."""
    return totals.astype(np.uint32 if totals.max(initial=0) < 1 << 32 else np.uint64).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint64 if len(raw) == 8 * n else np.uint32).astype(np.int64)


def answer(rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of a bucket over all blocks, and for each block those that it asked for."""
    words = [np.frombuffer(x, np.uint64) for x in rows["words"]]
    hot = [np.frombuffer(x, np.uint32) for x in rows["hot"]]
    sizes = [np.frombuffer(x, np.uint32) for x in rows["follow_size"]]
    follow = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in rows["follow"]]
    known, at = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate([np.frombuffer(x, np.uint32) for x in rows["word_count"]]), minlength=len(known)).astype(np.int64)
    groups, hot_at = np.unique(np.concatenate(hot), return_inverse=True)
    word_ends, hot_ends = np.cumsum([0, *map(len, words)]), np.cumsum([0, *map(len, hot)])
    contexts = [np.concatenate([at[word_ends[i] : word_ends[i + 1]], len(known) + hot_at[hot_ends[i] : hot_ends[i + 1]]]) for i in range(len(rows))]
    context = np.concatenate([np.repeat(c, s) for c, s in zip(contexts, sizes, strict=True)])
    flat = np.concatenate(follow)
    second = np.zeros((len(flat), 8), np.uint8)
    second[:, :6] = flat
    mixed = (context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (second.view(np.uint64).ravel() * np.uint64(0xC2B2AE3D27D4EB4F))
    _, first, pair_at = np.unique(mixed, return_index=True, return_inverse=True)
    pair_total = np.bincount(pair_at, weights=np.concatenate([np.frombuffer(x, np.uint32) for x in rows["follow_count"]]), minlength=len(first)).astype(np.int64)
    n = len(known) + len(groups)
    context_total = np.bincount(context[first], weights=pair_total, minlength=n).astype(np.int64)
    context_kinds = np.bincount(context[first], weights=pair_total > 0, minlength=n).astype(np.int64)
    scalars = (int(total.sum()), int((total > 0).sum()), int((pair_total == 1).sum()), int((pair_total == 2).sum()))
    ends = np.cumsum([0, *map(len, follow)])
    out = []
    for i, row in enumerate(rows.itertuples()):
        out.append((
            row.block, row.bucket, packed(total[at[word_ends[i] : word_ends[i + 1]]]), packed(context_total[contexts[i]]),
            packed(context_kinds[contexts[i]]), packed(pair_total[pair_at[ends[i] : ends[i + 1]]]), *scalars,
        ))
    return pd.DataFrame(out, columns=["block", "bucket", "word_total", "context_total", "context_kinds", "pair_total", "tokens", "kinds", "once", "twice"])


def traverse(block: Block, start: np.ndarray, fail: np.ndarray, arc_key: np.ndarray, arc: np.ndarray) -> np.ndarray:
    """Log probability of each text: all texts of the block step from token to token together.

    ``start``: the arcs of the state without context, by word. ``fail``: failure
    weights by word's state (NaN: no such state). ``arc_key``, ``arc``: the other arcs.
    """
    n, order = len(block.words), np.argsort(-block.size, kind="stable")
    begin, size = (np.cumsum(block.size) - block.size)[order], block.size[order]
    state, score = np.full(len(order), -1), np.zeros(len(order))
    for step in range(int(size.max(initial=0))):
        alive = int(np.searchsorted(-size, -step, side="left"))
        word, before = block.at[begin[:alive] + step], state[:alive]
        key = before * n + word
        i = np.minimum(np.searchsorted(arc_key, key), max(0, len(arc_key) - 1))
        has = (before >= 0) & (arc_key[i] == key) if len(arc_key) else np.zeros(alive, bool)
        back = np.where(before >= 0, fail[before], 0.0)
        score[:alive] += np.where(has, arc[i] if len(arc) else 0.0, back + start[word])
        state[:alive] = np.where(np.isnan(fail[word]), -1, word)
    out = np.zeros(len(order))
    out[order] = score
    return out


def score_block(texts: list[str | None], answers: pd.DataFrame, buckets: int, hot: np.ndarray) -> pd.DataFrame:
    block = Block(texts, buckets, hot)
    count, context, kinds, pairs, all_of = block.filled(answers)
    p = (count + 0.1) / (all_of["tokens"] + 0.1 * (all_of["kinds"] + 1))
    discount = all_of["once"] / max(1, all_of["once"] + 2 * all_of["twice"]) or 0.5
    with np.errstate(divide="ignore", invalid="ignore"):
        free = np.where(context > 0, discount * kinds / context, np.nan)
    real = np.flatnonzero(pairs > 0)
    before, word = np.divmod(block.pairs[real], max(1, len(block.words)))
    arc = np.log10((pairs[real] - discount) / context[before] + free[before] * p[word])
    base = np.log10(p)
    ends = np.cumsum(block.size)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[np.concatenate([[0], ends])])
    starts = ends - block.size
    return pd.DataFrame({
        "n_tokens": block.size, "n_known": sums((count > 0)[block.at].astype(np.int64)), "train_tokens": all_of["tokens"],
        "base_score": np.add.reduceat(base[block.at], starts) if len(starts) else np.zeros(0),
        "score": traverse(block, base, np.log10(free), block.pairs[real], arc),
    })


def score(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", block_bytes: int = 16 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Per row its key, whether it was held out, and the scores; learned from the rows that ``train`` holds for."""
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.coalesce(train, F.lit(True)).alias("_train"))
    total = rows.agg(F.sum(F.octet_length("_text") + 8)).first()[0] or 0
    blocks, buckets = max(1, -(-total // block_bytes)), max(1, -(-total // bucket_bytes))
    hot = hot_words(rows, "_text")
    dealt = rows.select(F.pmod(F.xxhash64("_key", "_text"), F.lit(blocks)).cast("int").alias("block"), "_key", "_text", "_train")

    def ask(part: pd.DataFrame) -> pd.DataFrame:
        block = Block(part["_text"].tolist(), buckets, hot)
        return block.requests(part["_train"].to_numpy(bool), int(part["block"].iloc[0]))

    made = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def finish(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = score_block(part["_text"].tolist(), answers, buckets, hot)
        out.insert(0, "held_out", ~part["_train"].to_numpy(bool))
        out.insert(0, key, part["_key"].to_numpy())
        return out

    asked = dealt.groupBy("block").applyInPandas(ask, REQUESTS)
    answers = asked.groupBy("bucket").applyInPandas(answer, ANSWERS)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, made)


def held_out_scores(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 10, held: int = 0) -> DataFrame:
    """Learn from all folds but one (by crc32 of the key), and score every document."""
    return score(df, F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds)) != held, key, text)
