"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded
from what its words look like and how far they repeat; gated attention gives
every passage a weight, and the weighted mean of the encoded passages gives the
document's score. Encoder, attention and classifier are learned together from
document labels, by gradient descent on a sample of at most ``sample_docs``
labelled documents (the first by a hash of the key, drawn again for ties).

Every text is scored whole; null and empty texts are one empty passage, and get
a score like any other. Rows and columns are kept. Without labels of both kinds
all documents score the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, slices

PASSAGE = 64
SHAPES = 40
FLAGS = 17
WIDTH = FLAGS + SHAPES + 6
_RUN = regex.compile(r"(.)\1+")


def word_features(word: str) -> np.ndarray:
    """What a word looks like: flags, and one of SHAPES hashed shapes."""
    out = np.zeros(FLAGS + SHAPES, np.float32)
    core = word.strip(".,;:!?\"'()[]")
    tail = word[len(word.rstrip(".,;:!?*$%&#@|\"')")) :]
    letters = sum(map(str.isalpha, word))
    out[:FLAGS] = [
        core.isalpha() and core.islower(), core.istitle(), core.isupper() and len(core) > 1, any(map(str.isdigit, word)),
        letters == 0, len(tail) == 1, len(tail) > 1, tail[:1] in ".!?" and bool(tail), tail[:1] == ",",
        any(c in "*$%&#@|<>{}_~^=+\\/" for c in word), not word.isascii(), len(core) <= 2, 3 <= len(core) <= 6,
        7 <= len(core) <= 12, len(core) > 12, letters / len(word), bool(regex.search(r"(.)\1\1", word)),
    ]
    shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:40])
    out[FLAGS + sum(map(ord, _RUN.sub(r"\1\1", shape))) * 31 % SHAPES] = 1
    return out


TAIL = ".,;:!?*$%&#@|\"'"
_THREE = re.compile(r"(.)\1\1")


def look(word: str) -> tuple | str:
    """What decides a word's features: for letters of one case and a tail, no more than that; else the word."""
    core = word.rstrip(TAIL)
    case = "a" if core.islower() else "A" if core.isupper() else "Aa" if core.istitle() else ""
    if not case or not core.isalpha():
        return word
    return case, len(core), word.isascii(), word[len(core) :], bool(_THREE.search(word))


class Encoder:
    """Passage features of texts; words and looks met again are looked up."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.looks: dict[tuple | str, int] = {}
        self.look_of = np.zeros(self.limit, np.int32)  # by word
        self.rows = np.zeros((1024, FLAGS + SHAPES), np.float32)  # by look

    def learn(self, word: str) -> None:
        key = look(word)
        row = self.looks.get(key)
        if row is None:
            row = self.looks[key] = len(self.looks)
            if row == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[row] = word_features(word)
        if len(self.at) == len(self.look_of):
            self.look_of = np.concatenate([self.look_of, np.zeros_like(self.look_of)])
        self.look_of[len(self.at)] = row
        self.at[word] = len(self.at)

    def bags(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.at) > self.limit:
            self.forget()
        split, at = [t.split() for t in texts], self.at
        for words in split:
            for word in words:
                if word not in at:
                    self.learn(word)
        return [self.bag(np.fromiter(map(at.__getitem__, s), np.int64, len(s)), t.count("\n")) for s, t in zip(split, texts, strict=True)]

    def bag(self, ids: np.ndarray, lines: int) -> np.ndarray:
        """Rows of features, one for each passage."""
        n = len(ids)
        if not n:
            empty = np.zeros((1, WIDTH), np.float32)
            empty[0, -1] = 1
            return empty
        starts = np.arange(0, n, PASSAGE)
        size = np.diff(np.append(starts, n)).astype(np.float32)
        out = np.zeros((len(starts), WIDTH), np.float32)
        out[:, : FLAGS + SHAPES] = np.add.reduceat(self.rows[self.look_of[ids]], starts, axis=0) / size[:, None]
        again = np.zeros(n, np.float32)
        again[1:] = ids[1:] == ids[:-1]
        three = (ids * 1_000_003 + np.roll(ids, 1)) * 1_000_003 + np.roll(ids, 2)
        seen = np.ones(n, np.float32)
        seen[np.unique(three, return_index=True)[1]] = 0  # a run of three words that stood before
        first = np.zeros(n, np.float32)
        first[np.unique(ids + (np.arange(n) // PASSAGE << 40), return_index=True)[1]] = 1
        for k, x in enumerate((again, seen, first)):
            out[:, FLAGS + SHAPES + k] = np.add.reduceat(x, starts) / size
        out[:, -3] = lines / n
        out[:, -2] = size / PASSAGE
        return out


@dataclass
class Model:
    """Scale of the features, and the layers; ``prior`` alone if nothing could be learned."""

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    layers: dict[str, np.ndarray] | None = None

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.layers is None or not bags:
            return np.full(len(bags), self.prior)
        x, doc = joined(bags)
        logit = forward(self.layers, (x - self.centre) / self.scale, doc, len(bags))[0]
        return 1 / (1 + np.exp(-logit))


def joined(bags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(bags), np.repeat(np.arange(len(bags)), [len(b) for b in bags])


def by_doc(x: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Sums of the rows of each document (all have rows, in order)."""
    return np.add.reduceat(x, np.flatnonzero(np.diff(doc, prepend=-1)), axis=0)


def forward(p: dict[str, np.ndarray], x: np.ndarray, doc: np.ndarray, n: int):
    h = np.maximum(0, x @ p["encode"] + p["encode0"])
    tanh, gate = np.tanh(h @ p["attend"] + p["attend0"]), 1 / (1 + np.exp(-(h @ p["gate"] + p["gate0"])))
    e = (tanh * gate) @ p["weight"]
    e = np.exp(e - np.maximum.reduceat(e, np.flatnonzero(np.diff(doc, prepend=-1)))[doc])
    a = e / by_doc(e, doc)[doc]
    z = by_doc(a[:, None] * h, doc)
    return z @ p["class"] + p["class0"], h, tanh, gate, a, z


def gradient(p: dict[str, np.ndarray], x: np.ndarray, doc: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    logit, h, tanh, gate, a, z = forward(p, x, doc, len(y))
    d = (1 / (1 + np.exp(-logit)) - y) / len(y)
    dz = d[:, None] * p["class"][None, :]
    da = (dz[doc] * h).sum(1)
    de = a * (da - by_doc(a * da, doc)[doc])
    dg = de[:, None] * p["weight"][None, :]
    dtanh, dgate = dg * gate * (1 - tanh**2), dg * tanh * gate * (1 - gate)
    dh = (a[:, None] * dz[doc] + dtanh @ p["attend"].T + dgate @ p["gate"].T) * (h > 0)
    return {
        "encode": x.T @ dh, "encode0": dh.sum(0), "attend": h.T @ dtanh, "attend0": dtanh.sum(0), "gate": h.T @ dgate,
        "gate0": dgate.sum(0), "weight": (tanh * gate).T @ de, "class": z.T @ d, "class0": d.sum(),
    }


def learn(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 32, attention: int = 16, epochs: int = 30, batch: int = 128, rate: float = 0.005, decay: float = 1e-4, seed: int = 7) -> Model:
    """Adam over batches of documents, always in the same order for the same rows."""
    if len(bags) == 0 or labels.min() == labels.max():
        return Model(float(labels.mean()) if len(bags) else 0.5)
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    centre, scale = every.mean(0), every.std(0) + 1e-3
    bags = [(b - centre) / scale for b in bags]
    shapes = {"encode": (WIDTH, hidden), "encode0": (hidden,), "attend": (hidden, attention), "attend0": (attention,), "gate": (hidden, attention), "gate0": (attention,), "weight": (attention,), "class": (hidden,), "class0": ()}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if s and not k.endswith("0") else np.zeros(s) for k, s in shapes.items()}
    m, v, t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for i in range(0, len(order), batch):
            some = order[i : i + batch]
            g = gradient(p, *joined([bags[j] for j in some]), labels[some])
            t += 1
            for k in p:
                step = g[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * step
                v[k] = 0.999 * v[k] + 0.001 * step**2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Model(float(labels.mean()), centre, scale, p)


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample_docs: int = 3000) -> Model:
    """Learn from the documents of ``df`` that ``labels`` marks 0 or 1; if a document has both, it counts as 0."""
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_label"))
    drawn = marked.orderBy(F.xxhash64(F.lit("quality"), key), key).limit(sample_docs)
    rows = df.select(key, text).join(F.broadcast(drawn), key)  # sample_docs rows at most

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            bags = [b.astype(np.float32).tobytes() for _, run in slices(batch.column(1).to_pylist()) for b in encoder.bags(run)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary()), batch.column(2)], names=["key", "bag", "label"])

    made = rows.select(F.col(key).cast("string"), text, F.col("_label").cast("int")).mapInArrow(encode, "key string, bag binary, label int")
    found = sorted((r.key, bytes(r.bag), r.label) for r in made.dropDuplicates(["key"]).collect())
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH).astype(float) for _, b, _ in found]
    return learn(bags, np.array([x for _, _, x in found], float))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the quality score of ``text``, from 0 to 1."""
    encoders: list[Encoder] = []

    def compute(column: pa.Array) -> list[pa.Array]:
        if not encoders:
            encoders.append(Encoder())
        made = [model.scores(encoders[0].bags(run)) for _, run in slices(column.to_pylist())]
        return [pa.array(np.concatenate(made) if made else np.zeros(0), pa.float64())]

    return append_columns(df, text, T.StructType([T.StructField(out, T.DoubleType())]), compute)


def train_and_score(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 3, held: int = 1) -> DataFrame:
    """Learn from the labels of all folds but one (by crc32 of the key), and score every document."""
    out = F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds)) == held, F.lit(False))
    model = fit(df, labels.where(~out), key, text)
    scored = score(df.select(key, text, out.alias("held_out")), model, text).drop(text)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
