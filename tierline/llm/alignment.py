"""Alignment of two tokenizers' tokens over the same text.

Side A is a byte-level vocabulary of the tokenizers library, side B a model of
the sentencepiece library, which puts a space before the text; A gets the same.
The strings of special tokens inside a text are plain text to both. A token's
bytes give it a range of the text; ranges of one side follow each other without
gaps. For a batch of texts, ``pandas.merge_asof`` (by document) finds the token
of the other side that covers each token's start, in both directions; the union
of both are the links: all pairs of an A and a B token whose ranges overlap.
Where an A and a B token end together, the tokens are cut into groups.

How many links of all texts have the ids of a pair is counted in two steps: a
block (a run of texts in a task) sends each of its pairs once, with its times;
then it gets back what these add up to. So no table of pairs is ever whole in
one place, and a frequent pair is one row for each block.

A text that is null or empty, or whose tokens' bytes aren't those of the text
with the space (a normalizer has changed it), has no tokens on either side and no
groups; such a row is kept, with zeros. Rows of one id are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tierline.llm.common import append_columns, runs, slices, stored
from tierline.llm.vocabulary import BYTE_LEVEL, load

SPACE = "▁"


def piece_bytes(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """What each piece stands for."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
    return out


#: Characters that all libraries put into the same class; a text with others is left to the slower one.
SETTLED = re.compile("[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f\u2010-\u2027\u2030-\u205e]*")


class Strings:
    """Byte strings by number; many are put together at once."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], np.int64)
        self.flat, self.begin = np.frombuffer(b"".join(strings), np.uint8), np.cumsum(self.size) - self.size

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        """The bytes of these strings, one after the other."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.begin[numbers] - (ends - size), size)]


@dataclass
class Aligned:
    """Tokens, links and groups of a run of texts, all texts one after the other.

    ``a``, ``b``: token ids; ``n_a``, ``n_b``, ``n_groups``, ``n_links``: by text;
    ``left``, ``right``: token numbers of the links, by text; ``items``: numbers in
    ``Pair.items`` that spell the groups.
    """

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    left: np.ndarray
    right: np.ndarray
    items: np.ndarray


class Pair:
    """The two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        vocabulary = load(a_path)
        self.a_bytes, self.b_bytes = Strings(vocabulary.token_bytes), Strings(piece_bytes(self.b))
        self.fast = None
        if not vocabulary.suffix and not vocabulary.lower and (np.diff(vocabulary.made) > 0).all():  # ids rise with merge ranks
            ranks = {x: i for i, x in enumerate(vocabulary.token_bytes) if i not in vocabulary.special.values()}
            self.fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        longest = max(len(self.a_bytes.size), len(self.b_bytes.size))
        self.items = Strings([f"{i}{end}".encode() for i in range(longest) for end in (",", "|", ";", "")])

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of A; texts of settled characters by the faster library, whose ids are the same there."""
        plain = [self.fast is not None and SETTLED.fullmatch(t) is not None for t in texts]
        rest = iter(self.a.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if p else next(rest).ids for t, p in zip(texts, plain, strict=True)]

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids on both sides of each text, none where the bytes are not those of the text."""
        out = []
        for _, some in slices(texts, 150_000):  # the libraries' own results are large
            spaced = [f" {t}" for t in some if t]
            sides = [[np.array(x, np.int32) for x in ids] for ids in (self.a_ids(spaced), self.b.encode([t for t in some if t], num_threads=1))]
            raw = [t.encode() for t in spaced]
            size = np.array([len(r) for r in raw], np.int64)
            same = np.ones(len(raw), bool)
            for ids, table in zip(sides, (self.a_bytes, self.b_bytes), strict=True):
                same &= np.array([table.size[x].sum() for x in ids], np.int64) == size
            left = np.flatnonzero(same)
            if len(left):  # as long as the text; now byte for byte
                given = np.frombuffer(b"".join(raw[i] for i in left.tolist()), np.uint8)
                starts = np.cumsum(size[left]) - size[left]
                for ids, table in zip(sides, (self.a_bytes, self.b_bytes), strict=True):
                    made = table.joined(np.concatenate([ids[i] for i in left.tolist()]))
                    same[left] &= np.logical_and.reduceat(made == given, starts)
            none = np.zeros(0, np.int32)
            own = iter([(a, b) if s else (none, none) for a, b, s in zip(*sides, same.tolist(), strict=True)])
            out += [next(own) if t else (none, none) for t in some]
        return out

    def align(self, texts: list[str | None]) -> Aligned:
        own = [*zip(*self.tokens(texts), strict=True)] or [(), ()]
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in own)
        a, b = (np.concatenate([np.zeros(0, np.int32), *side]) for side in own)
        texts_of = np.arange(len(texts))
        doc_a, doc_b = np.repeat(texts_of, n_a), np.repeat(texts_of, n_b)
        size_a, size_b = self.a_bytes.size[a], self.b_bytes.size[b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        side_a = pd.DataFrame({"at": end_a - size_a, "doc": doc_a, "a": np.arange(len(a))})
        side_b = pd.DataFrame({"at": end_b - size_b, "doc": doc_b, "b": np.arange(len(b))})
        from_a = pd.merge_asof(side_a, side_b, on="at", by="doc")
        from_b = pd.merge_asof(side_b, side_a, on="at", by="doc")
        begin_a = side_a["at"].to_numpy()
        new = begin_a[from_b["a"].to_numpy()] != from_b["at"].to_numpy()  # equal starts: found from A already
        left = np.concatenate([from_a["a"].to_numpy(), from_b["a"].to_numpy()[new]])
        right = np.concatenate([from_a["b"].to_numpy(), from_b["b"].to_numpy()[new]])
        order = np.argsort(doc_a[left], kind="stable")
        left, right = left[order], right[order]

        last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        in_a, in_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # group of a token
        groups = int(last_a.sum())
        upto_a, upto_b = np.cumsum(np.bincount(in_a, minlength=groups)), np.cumsum(np.bincount(in_b, minlength=groups))
        items = np.empty(len(a) + len(b), np.int64)
        items[np.arange(len(a)) + (upto_b[in_a] - np.bincount(in_b, minlength=groups)[in_a])] = a * 4 + last_a
        closes = np.where(last_b, 2, 0)
        closes[np.cumsum(n_b)[n_b > 0] - 1] = 3
        items[np.arange(len(b)) + upto_a[in_b]] = b * 4 + closes
        count = len(texts)
        return Aligned(a, b, n_a, n_b, np.bincount(doc_a[last_a], minlength=count), np.bincount(doc_a[left], minlength=count), left, right, items)

    def spelled(self, found: Aligned) -> list[bytes]:
        """The groups of each text: ids of A, a bar, ids of B; groups parted by semicolons."""
        flat = self.items.joined(found.items).tobytes()
        ends = np.cumsum(self.items.size[found.items])
        ends = np.append(0, ends)[np.cumsum(found.n_a + found.n_b)].tolist()
        return [flat[i:j] for i, j in zip([0, *ends], ends, strict=False)]


@functools.lru_cache(maxsize=2)
def pair(a_path: str, b_path: str) -> Pair:
    """The tokenizers of two files; one of each per worker process."""
    return Pair(a_path, b_path)


FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text", out: str = "groups") -> DataFrame:
    """``df`` with each text's counts of tokens, groups and links, and its groups spelled out."""
    outputs = T.StructType([*[T.StructField(f, T.LongType()) for f in FIGURES], T.StructField(out, T.StringType())])

    def compute(column: pa.Array) -> list[pa.Array]:
        p, figures, groups = pair(a_path, b_path), [[] for _ in FIGURES], []
        for _, run in slices(column.to_pylist()):
            found = p.align(run)
            for f, own in zip(FIGURES, figures, strict=True):
                own.append(getattr(found, f))
            groups += [s.decode() for s in p.spelled(found)]
        return [*[pa.array(np.concatenate(own or [np.zeros(0, np.int64)]), pa.int64()) for own in figures], pa.array(groups, pa.string())]

    return append_columns(df, text, outputs, compute)


def blocks(df: DataFrame, a_path: str, b_path: str, key: str, text: str) -> DataFrame:
    """One row per run of texts: its documents' figures, its distinct pairs of ids with
    their times, and for each link the number of its pair, in order of the documents."""
    lists = {"ids": pa.int64(), **dict.fromkeys(FIGURES, pa.int64()), "groups_sha256": pa.string()}
    schema = "block long, " + ", ".join(f"{c} array<{'string' if k == pa.string() else 'long'}>" for c, k in lists.items()) + ", pairs binary, times binary, links binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, packer = pair(a_path, b_path), zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in runs(batch, 1, 1 << 20):
                found = p.align(some.column(1).to_pylist())
                sha = [hashlib.sha256(s).hexdigest() if s else "" for s in p.spelled(found)]
                ids = found.a[found.left].astype(np.int64) * len(p.b_bytes.size) + found.b[found.right]
                own, pairs = pd.factorize(ids)
                times = np.bincount(own, minlength=len(pairs))
                often = np.argsort(-times, kind="stable")  # frequent pairs get small numbers, which pack well
                place = np.empty(len(often), np.uint32)
                place[often] = np.arange(len(often))
                links = np.ascontiguousarray(place[own].view(np.uint8).reshape(-1, 4).T).tobytes()
                values = {"ids": some.column(0).to_pylist(), **{f: getattr(found, f) for f in FIGURES}, "groups_sha256": sha}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *[pa.array([v], pa.list_(lists[c])) for c, v in values.items()],
                     *[pa.array([x], pa.binary()) for x in (pairs[often].tobytes(), times[often].astype(np.int64).tobytes(), packer.compress(links))]],
                    names=["block", *lists, "pairs", "times", "links"],
                )
                number += 1

    return df.select(F.col(key).cast("long").alias("ids"), F.col(text).alias("text")).mapInArrow(run, schema)


def opened(told: DataFrame) -> DataFrame:
    """(block, at, pair, times): the pairs of each block, ``at`` their numbers there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, times in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                n = len(pairs) // 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.frombuffer(pairs, np.int64)), pa.array(np.frombuffer(times, np.int64))],
                    names=["block", "at", "pair", "times"],
                )

    return told.select("block", "pairs", "times").mapInArrow(run, "block long, at int, pair long, times long")


def pair_counts(told: DataFrame, b_size: int) -> DataFrame:
    """(pair, a, b, n): how many links of all blocks have these ids."""
    counts = opened(told).groupBy("pair").agg(F.sum("times").alias("n"))
    return counts.select("pair", F.floor(F.col("pair") / b_size).alias("a"), (F.col("pair") % b_size).alias("b"), "n")


def report(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its counts, its groups' digest, and what its links' pairs count in all documents."""
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    told = stored(blocks(df, a_path, b_path, key, text), "blocks")
    counts = stored(pair_counts(told, b_size).drop("a"), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("_most"))  # a row for each id of B: as many as its vocabulary has
    known = counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))
    answers = opened(told).select("block", "at", "pair").join(known, "pair").select("block", "at", "n", "best")
    figures = ["ids", *FIGURES, "groups_sha256"]
    names = [key, *FIGURES, "n_best", "count_sum", "groups_sha256"]

    def run(docs: pa.Table, answer: pa.Table) -> pa.Table:
        out = []
        for d in docs.to_pylist():
            at = answer["at"].to_numpy()
            n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            n[at], best[at] = answer["n"].to_numpy(), answer["best"].to_numpy(zero_copy_only=False)
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(d["links"]), np.uint8).reshape(4, -1)
            own = np.ascontiguousarray(planes.T).view(np.uint32).ravel()
            ends = np.cumsum(np.array(d["n_links"], np.int64))
            totals = [np.diff(np.concatenate([[0], np.cumsum(x[own])])[np.concatenate([[0], ends])]) for x in (best, n)]
            columns = [d["ids"], *[d[f] for f in FIGURES], *totals, d["groups_sha256"]]
            out.append(pa.Table.from_arrays([pa.array(c, pa.string() if f == "groups_sha256" else pa.int64()) for f, c in zip(names, columns, strict=True)], names=names))
        return pa.concat_tables(out)

    schema = ", ".join(f"`{f}` {'string' if f == 'groups_sha256' else 'long'}" for f in names)
    left = told.select("block", *figures, "links").groupBy("block")
    return left.cogroup(answers.groupBy("block")).applyInArrow(run, schema)
