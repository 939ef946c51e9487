"""From raw documents to packed training bins, in five stages.

Each stage gets what its predecessor kept, with the columns of ``documents``, and gives
the same columns; the last gives the bins. ``run`` writes each result as Parquet and
reads it for the next stage. Null, empty and very long texts, ties, repeated rows, empty
tables and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm.best_fit_packing import pack_documents
from stowage.llm.prob_minhash import drop_near_duplicates
from stowage.llm.quality_crf import keep_good
from stowage.llm.shared import find_package, scratch_root, stored
from stowage.llm.source_mixing import repeat_texts
from stowage.llm.substring_dedup import remove_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model, fitted on ``labels``, calls good. The others go."""
    find_package(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    find_package(spark)
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without passages of 13 words or more that an earlier one holds."""
    find_package(spark)
    return _counted(remove_repeats(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, in part, once or twice."""
    return _counted(repeat_texts(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their bins of 2,048 words."""
    find_package(spark)
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing to target weights", mixing),
    ("best-fit packing", packing),
]

#: SQL cannot fit the line model; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = scratch_root(spark)
    for n, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"{scratch}/stage{n}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _counted(docs: DataFrame) -> DataFrame:
    """With ``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
