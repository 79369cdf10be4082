"""Alignment against loops over the bytes of each text."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierline.llm import alignment
from tierline.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"
A = Tokenizer.from_file(BYTE_VOCABULARY)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def byte_of():
    """The byte that each character of a byte-level token stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


BYTE_OF = byte_of()


def ranges(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(text):
    """(A ranges, B ranges, groups as text, links) of one text, token by token."""
    if not text:
        return [], [], "", []
    a = [(i, bytes(BYTE_OF[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
        return [], [], "", []
    a, b = ranges(a), ranges(b)
    links = [(i, j) for i, p, q in a for j, r, s in b if p < s and r < q]
    cuts = sorted({q for _, _, q in a} & {s for _, _, s in b})
    groups = []
    for lo, hi in zip([0, *cuts[:-1]], cuts, strict=True):
        groups.append("|".join(",".join(str(i) for i, p, _ in side if lo <= p < hi) for side in (a, b)))
    return a, b, ";".join(groups), links


def digests(rows):
    """What the query returns for (doc_id, text) rows."""
    found = [(i, *plain(t)) for i, t in rows]
    times = Counter(link for *_, links in found for link in links)
    most = defaultdict(int)
    for (_, j), n in times.items():
        most[j] = max(most[j], n)
    return Counter(
        (i, len(a), len(b), groups.count(";") + bool(groups), len(links), sum(times[x] == most[x[1]] for x in links), sum(times[x] for x in links),
         hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for i, a, b, groups, links in found
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def short(texts):
    return [t if t is None or len(t) < 3000 else t[:1500] for t in texts]


def test_odd_texts(spark, odd_docs, odd_texts, no_docs):
    p = alignment.pair(BYTE_VOCABULARY, PIECE_MODEL)
    texts = [*short(odd_texts), "x▁y"]
    found = p.align(texts)
    want = [plain(t) for t in texts]
    assert p.spelled(found) == [g.encode() for _, _, g, _ in want]
    assert found.n_links.tolist() == [len(x) for *_, x in want]
    assert found.n_a[-1] == found.n_b[-1] == 0  # its bytes aren't those of the pieces
    rows = [(r.doc_id, t) for r, t in zip(odd_docs.collect(), short([r.text for r in odd_docs.collect()]), strict=True)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n_a string, groups int")
    got = alignment.report(df, BYTE_VOCABULARY, PIECE_MODEL)
    assert got.columns == COLUMNS and Counter(map(tuple, got.collect())) == digests(rows)
    assert alignment.report(no_docs, BYTE_VOCABULARY, PIECE_MODEL).count() == 0
    whole = alignment.align(df, BYTE_VOCABULARY, PIECE_MODEL)
    assert whole.columns == ["doc_id", "text", "n_a", "n_b", "n_groups", "n_links", "groups"]
    assert Counter((r.doc_id, r.groups) for r in whole.collect()) == Counter((i, plain(t)[2]) for i, t in rows)


def test_very_long_text():
    p = alignment.pair(BYTE_VOCABULARY, PIECE_MODEL)
    found = p.align(["word <|endoftext|> naïve " * 40_000])
    assert found.n_a[0] + found.n_b[0] - found.n_links[0] >= found.n_groups[0] > 0


def test_counts_cross_blocks(spark):
    rows = [(i, t) for i, t in enumerate(["the end of the", "of the end", "it's the end;", None, "", "the the the", "<s>x</s>", "<|endoftext|>"] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, alignment.report(df, BYTE_VOCABULARY, PIECE_MODEL).collect())) == digests(rows)


def test_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_alignment"](spark, SF)
    small = {i for i, t in rows if t is None or len(t) < 1500}
    got = {r.doc_id: tuple(r) for r in got.collect()}
    assert got.keys() == {i for i, _ in rows}
    for i, text in rows:  # the counts over all documents are tested above
        if i in small:
            a, b, groups, links = plain(text)
            assert got[i][1:5] == (len(a), len(b), groups.count(";") + bool(groups), len(links))
            assert got[i][7] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aeinorst  '\n.,1é▁"), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_any_texts(texts):
    p = alignment.pair(BYTE_VOCABULARY, PIECE_MODEL)
    found = p.align(texts)
    want = [plain(t) for t in texts]
    assert p.spelled(found) == [g.encode() for _, _, g, _ in want]
    ends = [0, *found.n_links.cumsum().tolist()]
    for k, (*_, links) in enumerate(want):
        own = slice(ends[k], ends[k + 1])
        assert sorted(zip(found.a[found.left[own]].tolist(), found.b[found.right[own]].tolist(), strict=True)) == sorted(links)


def test_every_settled_character():
    p = alignment.pair(BYTE_VOCABULARY, PIECE_MODEL)
    settled = [c for c in map(chr, range(0x3000)) if alignment.SETTLED.fullmatch(c)]
    assert p.fast is not None and len(settled) > 500
    for around in ("{}", "a{}", "1{}b", " {} x", "·{}'s", "\n {}{}"):
        texts = [" " + around.replace("{}", c) for c in settled]
        assert p.a_ids(texts) == [x.ids for x in A.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("text", ["a", " ", "  a", "\n", "é", "日", "<0x41>", "▁"])
def test_small_texts(text):
    p = alignment.pair(BYTE_VOCABULARY, PIECE_MODEL)
    assert p.spelled(p.align([text])) == [plain(text)[2].encode()]
