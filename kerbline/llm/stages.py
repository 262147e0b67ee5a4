"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns documents with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbline.llm import decontamination, lines, minhash, mixing, quality
from kerbline.llm.base import table


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first of each; every document stays."""
    own = docs.columns
    cut = lines.without_recurring(docs)
    return _recounted(cut.select(*[f"`{c}`" for c in own]))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component: five-word shingles, likeness 0.8."""
    return minhash.without_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: documents as often as their source's rate takes them, numbered by ``copy``."""
    return mixing.mixed_documents(docs)
