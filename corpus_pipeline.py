"""A training-corpus pipeline of the operators in ``tierline.llm``.

Each stage takes what its predecessor kept and returns the columns of
``documents``; the last one returns packed pieces. Documents with a null id
take part in every stage; as duplicates they can't be told apart, so all stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import jaccard_join, language_id, packing, quality
from tierline.llm.common import stored, table
from tierline.llm.queries import WORD_VOCABULARY


def least_score(languages: list[str]) -> float:
    """A text whose words speak less for its language than chance among the learned ones is rejected."""
    return 1 / max(1, len(languages))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from all labels, doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, out="_quality_score").where("_quality_score >= 0.5").select(*_names(docs))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned."""
    model = language_id.fit(docs)
    known = language_id.identify(docs, model, lang="_lang_found", score="_lang_score")
    enough = F.col("_lang_score") >= least_score(model.languages)
    return known.where((F.col("_lang_found") != language_id.UNKNOWN) & enough).select(*_names(docs))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates, and one row of each id."""
    found = jaccard_join.near_duplicates(docs)
    gone = found.where("doc_id <> component_id").select("doc_id")
    often = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    left = docs.join(gone, "doc_id", "left_anti")
    once = left.join(often, "doc_id", "left_anti")
    return once.unionByName(left.join(often, "doc_id", "left_semi").dropDuplicates(["doc_id"])).select(*_names(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [("quality", quality_stage), ("language", language_stage), ("near_duplicates", duplicates_stage), ("packing", packing_stage)]

#: No stage can be said in SQL; tests compare each with a brute-force version.
ORACLE_SQL = None


def _names(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
