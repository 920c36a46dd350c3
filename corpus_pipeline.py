"""A corpus pipeline: each stage works on what its predecessor kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns a DataFrame. All but the last return the columns of documents. No
SQL can express the language mixtures, so there is no ``ORACLE_SQL``; tests hold
the stages against brute force.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import bpe, decontamination, jaccard_join, language_mixture, pii
from lexiloom.llm.common import BATCH, table
from lexiloom.llm.queries import vocabulary_path
from lexiloom.sources.scratch import scratch_path

ORACLE_SQL = None


def _in_small_batches(stage):
    """The stage with Arrow batches that suit whole texts, also when its rows are written later."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, most in BATCH.items():
            spark.conf.set(name, str(most))
        return stage(spark, docs, sf_dir)

    return run


def _length(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


@_in_small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language learnt from their labels explains; those of no language go."""
    model = language_mixture.MixtureModel.fit(docs)
    found = language_mixture.with_language(docs, model, out="__language")
    return found.filter(language_mixture.accepted(F.col("__language"))).drop("__language")


@_in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id."""
    return jaccard_join.one_of_each(docs).select(docs.columns)


@_in_small_batches
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of the benchmark; documents mostly made of them go."""
    return _length(decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))).select(docs.columns)


@_in_small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with identifiers replaced by their kind."""
    return _length(docs.withColumn("text", pii.masked(F.col("text")))).select(docs.columns)


@_in_small_batches
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, hash of the ids and of the text decoded from them, per document."""
    return docs.select("doc_id", bpe.digests(F.col("text"), vocabulary_path()).alias("found")).select("doc_id", "found.*")


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal data", personal_data),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
