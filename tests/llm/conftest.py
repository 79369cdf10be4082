from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long and otherwise odd texts."""
    return [
        None, "", " \n\t ", "a", "it's  we'll\n\n\tx  ", "  lead", "trail  ", "<|endoftext|>x<|endoftext|><|startoftext|> y",
        "é" * 300, "a" * 5000, "x\x1cy \x1e z", "ΑΣ ΣΑΣ İstanbul ǅ J̌x", "日本語テキスト　全角", "😀😃 👩‍👩‍👧", "é ́x", "12345 67,8",
        "​﻿ a b c\u0085d", "ab" * 2000 + "c d" * 100, "I'M HE'LL DON'T 'S", "\x00\x01 a\x00", "!!!?? ... ***x***",
        "word " * 20_000, "same text", "same text",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts with clashing extra columns, a null key and repeated rows."""
    rows = [(i, t, "x", 1.5) for i, t in enumerate(odd_texts)] + [(None, "no key", None, None), (3, "a", "x", 1.5), (3, "a", "x", 1.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, Score double")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
