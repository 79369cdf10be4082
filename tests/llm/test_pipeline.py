"""Each stage of the pipeline against a plain version over its own input, and the whole of it."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from test_jaccard_join import brute_force
from test_tokens import check_packing
from tierline.llm import language_id, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_are_named_and_registered():
    assert [n for n, _ in P.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()
    ops = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].partition("_")[0]) for n in ops) == list(range(1, 14))


def test_quality_stage(spark, docs):
    got = P.quality_stage(spark, docs, SF)
    assert got.columns == docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    encoder = quality.Encoder()
    keep = [r for r in docs.collect() if model.scores(encoder.bags([r.text or ""]))[0] >= 0.5]
    assert rows(got) == Counter(map(tuple, keep)) and 0 < len(keep) < docs.count()


def test_language_stage(spark, docs):
    extra = spark.createDataFrame([(900001, "12 34 !?", "en", "x", 8), (900002, None, None, None, None)], docs.schema)
    everything = docs.unionByName(extra)
    got = P.language_stage(spark, everything, SF)
    assert got.columns == docs.columns
    model = language_id.fit(everything)
    scorer, least = language_id.Scorer(model), P.least_score(model.languages)
    assert least == 1 / len({r.lang for r in everything.collect() if r.lang and r.text})
    keep = [r for r in everything.collect() if scorer.score([r.text or ""])[0][0] != "und" and scorer.score([r.text or ""])[0][1] >= least]
    assert rows(got) == Counter(map(tuple, keep))
    assert len(keep) == docs.count()  # clean documents stay


def test_duplicates_stage(spark, docs):
    again = docs.limit(3)
    everything = docs.unionByName(again).unionByName(spark.createDataFrame([(None, "no key", "en", "x", 6)] * 2, docs.schema))
    got = P.duplicates_stage(spark, everything, SF)
    assert got.columns == docs.columns
    first = {i for i, _, c in brute_force([(r.doc_id, r.text) for r in docs.collect()]) if i == c}
    kept = Counter(r.doc_id for r in got.collect())
    assert kept.pop(None) == 2 and kept == Counter(dict.fromkeys(first, 1)) and len(first) < docs.count()


def test_odd_and_empty_documents_go_through(spark, odd_docs, no_docs):
    odd = odd_docs.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "Score AS _quality_score")
    for df in (odd, no_docs):
        for _, stage in P.STAGES[:-1]:
            assert stage(spark, df, SF).count() <= df.count()
        check_packing(df, P.packing_stage(spark, df, SF))


def test_run(spark):
    kept = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        kept = stage(spark, kept, SF)
    check_packing(kept, P.run(spark, SF))
