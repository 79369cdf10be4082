"""Encoding, decoding, counting and packing against the libraries themselves."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tierline.llm import bpe_codec, packing, token_counts
from tierline.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY
from tierline.llm.vocabulary import ByWord, load

BYTES, WORDS = Tokenizer.from_file(BYTE_VOCABULARY), Tokenizer.from_file(WORD_VOCABULARY)


def library(t: Tokenizer, text: str | None) -> list[int]:
    return t.encode(text or "", add_special_tokens=False).ids


def test_ids_and_counts_are_the_librarys(odd_texts):
    made = [np.frombuffer(b, "<u4").tolist() for b in bpe_codec.encode_texts(odd_texts, BYTE_VOCABULARY)]
    assert made == [library(BYTES, t) for t in odd_texts]
    made = [np.frombuffer(b, "<u4").tolist() for b in bpe_codec.encode_texts(odd_texts, WORD_VOCABULARY)]
    assert made == [library(WORDS, t) for t in odd_texts]
    assert token_counts.count_texts(odd_texts, WORD_VOCABULARY) == [len(library(WORDS, t)) for t in odd_texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinorst  '\n.,1é"), st.characters(codec="utf-8")), max_size=60))
def test_any_text(text):
    ids = np.frombuffer(bpe_codec.encode_texts([text], BYTE_VOCABULARY)[0], "<u4")
    assert ids.tolist() == library(BYTES, text)
    assert bpe_codec.decode_ids(ids, load(BYTE_VOCABULARY)) == text
    assert token_counts.count_texts([text], WORD_VOCABULARY) == [len(library(WORDS, text))]


def test_every_code_point():
    """Letters and case newer than one library's tables are split as the vocabulary's library does
    (every code point of planes 0 to 3, every 16th of those above, which hold no letters yet)."""
    points = [chr(c) for c in [*range(1, 0x40000), *range(0x40000, 0x110000, 16)] if not 0xD800 <= c <= 0xDFFF]
    texts = [" ".join(f"·{c}a" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    for path, lib in ((BYTE_VOCABULARY, BYTES), (WORD_VOCABULARY, WORDS)):
        want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in bpe_codec.encode_texts(texts, path)] == want
    assert token_counts.count_texts(texts, WORD_VOCABULARY) == [len(w) for w in want]


def test_both_trees_merge_alike():
    v = load(BYTE_VOCABULARY)
    for word in ("unbelievable", "aaaaaaaaaaaaaaaa", "thththththin", "x"):
        symbols, ends = v.symbols([word])
        one = bpe_codec.merge_one(v, symbols) if len(word) > 1 else symbols.tolist()
        assert bpe_codec.encode_words(v, [word])[0] == np.array(one, "<u4").tobytes()


def test_encode_decode_frames(spark, odd_docs):
    for packed in (False, True):
        coded = bpe_codec.decode(bpe_codec.encode(odd_docs, BYTE_VOCABULARY, packed=packed), BYTE_VOCABULARY)
        assert coded.columns == ["doc_id", "text", "Score", "ids", "decoded"]
        rows = coded.collect()
        assert len(rows) == odd_docs.count()
        assert all(r.decoded == (r.text or "") for r in rows)
        if not packed:
            assert all(list(r.ids) == library(BYTES, r.text) for r in rows)
    null_ids = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bpe_codec.decode(null_ids, BYTE_VOCABULARY).first().decoded == ""


def test_digests(odd_docs, no_docs):
    got = bpe_codec.digests(odd_docs, BYTE_VOCABULARY)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    want = Counter()
    for r in odd_docs.collect():
        ids = np.array(library(BYTES, r.text), "<u4")
        text = BYTES.decode(ids.tolist(), skip_special_tokens=False)
        want[r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, got.collect())) == want
    assert bpe_codec.digests(no_docs, BYTE_VOCABULARY).count() == 0


def test_budget(odd_docs, no_docs):
    got = token_counts.budget(odd_docs, WORD_VOCABULARY)
    want = Counter()
    for r in odd_docs.collect():
        n = len(library(WORDS, r.text))
        want[r.doc_id, len((r.text or "").encode()), n, n > 2048] += 1
    assert Counter(map(tuple, got.collect())) == want
    assert token_counts.budget(no_docs, WORD_VOCABULARY).count() == 0


def check_packing(docs, packed, capacity=2048, end_id=0):
    """Pieces are the documents', each sequence is gapless and not too long; returns how many sequences."""
    want = Counter()
    for r in docs.collect():
        ids = np.array([*library(WORDS, r.text), end_id], "<u4")
        for i in range(0, len(ids), capacity):
            part = ids[i : i + capacity]
            want[r.doc_id, i // capacity, i, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans), sum(r.length for r in rows)


@pytest.mark.parametrize(("capacity", "rank_rows"), [(2048, 200_000), (100, 3), (256, 2)])
def test_pack(odd_docs, capacity, rank_rows):
    packed = packing.pack(odd_docs, WORD_VOCABULARY, capacity=capacity, rank_rows=rank_rows)
    sequences, tokens = check_packing(odd_docs, packed, capacity)
    assert sequences <= 1.15 * tokens / capacity + 2


def test_pack_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sequences, tokens = check_packing(docs, packing.pack(docs, WORD_VOCABULARY))
    assert sequences <= 1.03 * tokens / 2048 + 2


def test_pack_nothing(no_docs):
    assert packing.pack(no_docs, WORD_VOCABULARY).count() == 0


def test_a_batch_is_encoded_in_small_runs(monkeypatch):
    """A batch holds up to 10,000 rows; what a worker makes of it at once has a bound."""

    class Docs:
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    real, sizes = packing.library_encoder, []

    class Encoder:
        def of(self, texts):
            sizes.append(sum(map(len, texts)))
            return real(WORD_VOCABULARY).of(texts)

    monkeypatch.setattr(packing, "library_encoder", lambda _: Encoder())
    texts = [f"row {i} " + "of some words " * 150 for i in range(600)]
    texts[::50] = [None, ""] * 6
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    made = pa.Table.from_batches(packing.pieces(Docs(), WORD_VOCABULARY)(iter([batch])))
    assert sum(sizes) == sum(len(t or "") for t in texts) > 1_000_000 and max(sizes) < 300_000
    assert made["doc_id"].to_pylist() == list(range(600))
    crc = [zlib.crc32(np.array([*library(WORDS, t), 0], "<u4").tobytes()) for t in texts]
    assert made["ids_crc32"].to_pylist() == crc


def test_a_word_met_often_stays_in_memory():
    made = []

    def make(words):
        made.extend(words)
        return [len(w) for w in words]

    by_word = ByWord(load(WORD_VOCABULARY), make, sum, lambda _: 1, limit=200)
    letters = "abcdefghij"
    for i in range(100):
        new = ["x" + "".join(letters[int(d)] for d in f"{20 * i + k:05}") for k in range(20)]
        assert by_word.of(["often " + " ".join(new)]) == [[5] + [6] * 20]
    assert made.count("often") == 1
    assert len(by_word.chunks.now) + len(by_word.chunks.before) <= 250


def test_plan_uses_up_the_counts():
    rng = np.random.default_rng(3)
    for _ in range(5):
        counts = rng.poisson(rng.uniform(0, 40), 257)
        counts[0] = 0
        used = np.zeros(257, int)
        for bins, n in packing.plan(counts):
            assert sum(bins) <= 256 and n > 0
            for b in bins:
                used[b] += n
        assert (used == counts).all()


def test_words_by_line_are_those_by_themselves():
    """Ids of words that are encoded together, cut where an id ends its word."""
    vocabulary, library = load(WORD_VOCABULARY), Tokenizer.from_file(WORD_VOCABULARY)
    ends = packing.word_ends(vocabulary)
    assert ends[vocabulary.last_ids].all() and not ends[vocabulary.byte_ids].any()
    assert packing.word_ends(load(BYTE_VOCABULARY)) is None
    make = packing.library_encoder(WORD_VOCABULARY).make
    words = [f"{a}{b}" for a in ("the", "q", "zxq", "日本", "é", "</w>"[2:], "~~") for b in ("", "s", "ing", "xyzzy", "のの")] * 5
    words = [w for w in words if vocabulary.words_of(w) == [w]]
    assert len(words) > packing.LINE
    want = [np.array(library.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert make(words) == want and make([]) == []
    assert make([*words, "<|endoftext|>"])[: len(words)] == want  # it has no end
