"""A corpus from raw documents: each stage keeps or changes all that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir). Each result is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
Every stage takes null and empty texts, repeated rows, empty tables and further columns (they are
carried along), as its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom.llm import langid, neardup, packing, pii, quality
from sigloom.llm.common import remainder, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose main language makes up half of them at least; the others go."""
    return langid.keep_identified(docs, langid.fit(docs, remainder(F.col("doc_id"), 4) != 2))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact_pii(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("quality", rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Tokenising, language mixtures and signatures can't be expressed in SQL; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
