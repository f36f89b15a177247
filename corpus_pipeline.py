"""A corpus pipeline over documents: language, exact and near duplicates, benchmark leaks, packing.

Each stage works on all that the one before it kept, and drops what its operator decides against.
Rows without a doc_id cannot be named by a decision and stay. Rows with the same doc_id share its
decisions. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import stored, table
from siftwell.llm.decontaminate import contaminated
from siftwell.llm.exact_dedup import exact_duplicates
from siftwell.llm.language import UNKNOWN, fit_language_model, predicted
from siftwell.llm.near_dedup import near_duplicates
from siftwell.llm.packing import packed

#: Documents whose language is less probable than this are rejected; the scores are calibrated, and four languages leave 0.25 to chance.
LEAST_SCORE = 0.4


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter, or of no language clearly, go."""
    known = predicted(docs, fit_language_model(docs), into="predicted language")
    answer = F.col("predicted language")
    return known.where((answer["lang"] != UNKNOWN) & (answer["score"] >= LEAST_SCORE)).select(docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return _without(docs, exact_duplicates(docs).where("not kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return _without(docs, near_duplicates(docs).where("not kept"))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into training windows."""
    return packed(docs)


STAGES = [
    ("language", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

#: Trained models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; every stage's output is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
