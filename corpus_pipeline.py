"""A training-data pipeline over ``documents``: its stages, and one run of them all.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of ``documents``. Null and empty texts pass all stages (as texts of no words, they
are not toxic, link with nothing, and are not taken into the mix); empty tables give no
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import mixing, ngram_join, packing, pii, toxicity
from sedimenta.scratch import materialize


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars as its texts now are."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard of 0.8."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, plain or disguised, replaced by its kind."""
    return _counted(pii.redact_documents(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as their source's target takes them."""
    return _counted(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token pieces, each with its training sequence and place there."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_copies),
    ("pii", redact),
    ("mixing", mix),
    ("packing", pack),
]

#: Learned scores, near copies, disguised identifiers and packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
