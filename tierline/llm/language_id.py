"""Language identification, word first.

A word known from training scores by its log frequency in each language; an
unseen word falls back to its longest character n-grams that training has, then
to shorter ones. A text's language is the one of largest sum over its words
(ties: the first by name); the score is the mean over words of the probability
that each gives this language.

The model is fitted on a sample of about ``sample_docs`` labelled documents
(drawn by a hash of their key) and holds at most ``max_words`` counts of words,
both dealt out evenly over the languages, so its size has a bound at any input; every text is scored whole.
Null texts and texts without a letter, and all texts if nothing was learned,
are ``und`` with score 0. Rows and columns are kept, repeated rows score alike.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, slices, stored

UNKNOWN = "und"
LETTERS = regex.compile(r"\p{L}+")


@dataclass
class Model:
    """Words and n-grams are numbers of the rows of ``logs``, their log frequencies by language."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    logs: np.ndarray
    longest: int

    def unseen(self, word: str) -> np.ndarray:
        """Log frequency by language of a word that training doesn't have: the mean of its longest known n-grams."""
        edged = f"^{word}$"
        for n in range(self.longest, 0, -1):
            found = [g for i in range(len(edged) - n + 1) if (g := self.grams.get(edged[i : i + n])) is not None]
            if found:
                return self.logs[found].sum(axis=0) / len(found)
        return np.zeros(len(self.languages))

    def rows(self, words: list[str]) -> np.ndarray:
        """Log frequency by language of each word."""
        at = np.array([self.words.get(w, -1) for w in words], np.int64)
        out = self.logs[at] if len(self.logs) else np.zeros((len(words), len(self.languages)))
        for i in np.flatnonzero(at < 0).tolist():
            out[i] = self.unseen(words[i])
        return out


def from_counts(rows: list[tuple[str, str, int]], longest: int = 4, smooth: float = 0.5) -> Model:
    """A model of (language, word, count) rows."""
    languages = sorted({r[0] for r in rows})
    at = {x: i for i, x in enumerate(languages)}
    words: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    grams: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros(len(languages))) for _ in range(longest)]
    for language, word, count in rows:
        words[word][at[language]] += count
        edged = f"^{word}$"
        for n, of in enumerate(grams, 1):
            for g in {edged[i : i + n] for i in range(len(edged) - n + 1)}:
                of[g][at[language]] += count

    def logs(of: dict[str, np.ndarray]) -> np.ndarray:
        counts = np.array(list(of.values()))
        return np.log((counts + smooth) / (counts.sum(axis=0) + smooth * len(of)))

    tables = [t for t in (words, *grams) if t]
    number = {k: i for i, k in enumerate(k for t in grams for k in t)}
    return Model(
        languages, {w: i for i, w in enumerate(words)}, {k: len(words) + i for k, i in number.items()},
        np.concatenate([logs(t) for t in tables]) if tables else np.zeros((0, len(languages))), longest,
    )


def shares(sizes: dict[str, int], total: int) -> dict[str, int]:
    """``total`` dealt out so that each gets what it has, or else as much as any other that gets less than it has."""
    out, left = {}, total
    for i, k in enumerate(sorted(sizes, key=lambda k: (sizes[k], k))):
        out[k] = min(sizes[k], left // (len(sizes) - i))
        left -= out[k]
    return out


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = 20_000, max_words: int = 150_000) -> Model:
    """Learn from the rows of ``df`` whose text and language are known.

    Documents and words are bounded by language, so a rare language is learned
    from as many as a common one, or from all it has.
    """
    rows = df.select(key, text, F.col(lang).cast("string").alias("language")).where(F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy("language").count().collect()}  # a row for each language
    if not sizes:
        return from_counts([])
    part = {k: n / sizes[k] for k, n in shares(sizes, sample_docs).items()}
    limit = F.create_map(*[F.lit(x) for k, p in part.items() for x in (k, int(p * (1 << 30)))])
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("language"), key), F.lit(1 << 30)) < limit[F.col("language")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[language].update(LETTERS.findall(body.lower()))
        flat = [(k, w, n) for k, c in seen.items() for w, n in c.items()]
        for i in range(0, len(flat), 100_000):
            part = flat[i : i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in part], pa.string()), pa.array([x[1] for x in part], pa.string()), pa.array([x[2] for x in part], pa.int64())],
                names=["language", "word", "n"],
            )

    counted = drawn.select("language", text).mapInArrow(count, "language string, word string, n long")
    counted = stored(counted.groupBy("language", "word").agg(F.sum("n").alias("n")), "words")
    most = shares({r[0]: r[1] for r in counted.groupBy("language").count().collect()}, max_words)
    kept = None
    for language, n in sorted(most.items()):
        own = counted.where(F.col("language") == F.lit(language)).orderBy(F.desc("n"), "word").limit(n)
        kept = own if kept is None else kept.unionByName(own)
    if kept is None:
        return from_counts([])
    found = kept.toArrow()
    return from_counts(list(zip(*(found[c].to_pylist() for c in ("language", "word", "n")), strict=True)))


class Scorer:
    """Scores texts by a model; words met again are looked up."""

    def __init__(self, model: Model, limit: int = 150_000):
        self.model, n = model, len(model.languages)
        self.rows = np.zeros((limit + 1, 2 * n + 1))  # by chunk: log frequencies, probabilities, words
        self.at: dict[str, int] = {}
        self.limit = limit

    def of_chunks(self, chunks: list[str]) -> np.ndarray:
        """Sums over each chunk's words of their log frequencies, probabilities, and 1."""
        words = [[c] if c.isalpha() else LETTERS.findall(c) for c in chunks]
        size = np.array([len(w) for w in words], np.int64)
        number: dict[str, int] = {}
        flat = np.array([number.setdefault(w, len(number)) for own in words for w in own], np.int64)
        n = len(self.model.languages)
        logs = self.model.rows(list(number))
        p = np.exp(logs - logs.max(axis=1, keepdims=True))
        rows = np.hstack([logs, p / p.sum(axis=1, keepdims=True), np.ones((len(logs), 1))])
        out = np.zeros((len(chunks), 2 * n + 1))
        some = np.flatnonzero(size)
        if len(some):
            out[some] = np.add.reduceat(rows[flat], (np.cumsum(size) - size)[some])
        return out

    def score(self, texts: list[str]) -> list[tuple[str, float]]:
        n = len(self.model.languages)
        if not n:
            return [(UNKNOWN, 0.0)] * len(texts)
        split = [t.lower().split() for t in texts]
        new = set().union(*split)
        if len(self.at) + len(new) > self.limit:
            self.at.clear()
        new = [c for c in new if c not in self.at]
        if len(self.at) + len(new) >= len(self.rows):  # one run of very many words
            self.rows = np.zeros((len(self.at) + len(new) + 1, 2 * n + 1))
        if new:
            first = len(self.at)
            self.rows[first : first + len(new)] = self.of_chunks(new)
            self.at.update(zip(new, range(first, first + len(new)), strict=True))
        out = []
        for chunks in split:
            total = self.rows[np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))].sum(0)
            if not total[-1]:
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmax(total[:n]))
            out.append((self.model.languages[best], float(min(1.0, total[n + best] / total[-1]))))
        return out


def identify(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language of ``text`` and its score."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # its size has a bound
    scorers: list[Scorer] = []

    def compute(column: pa.Array) -> list[pa.Array]:
        if not scorers:
            scorers.append(Scorer(shared.value))
        found = [x for _, run in slices(column.to_pylist()) for x in scorers[0].score(run)]
        return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

    fields = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    return append_columns(df, text, T.StructType(fields), compute)


def train_and_identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """Learn from all folds but one (by crc32 of the key), and score every document."""
    out = F.pmod(F.crc32(F.col(key).cast("string")), F.lit(folds)) == held
    model = fit(df.where(~F.coalesce(out, F.lit(False))), key, text, lang)
    return identify(df.select(key, text, F.coalesce(out, F.lit(False)).alias("held_out")), model, text).drop(text)
