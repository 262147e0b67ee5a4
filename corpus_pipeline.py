"""Corpus pipeline over ``documents``: five stages, each an operator of the text package.

Every stage takes the documents that the stage before it kept, written as Parquet
and read again, and returns documents of the same columns; the last returns the
mixed corpus, with ``copy`` numbering the copies of a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbline.llm import stages
from kerbline.staging import stage

STAGES = [
    ("quality", stages.good_quality),
    ("line_dedup", stages.without_recurring_lines),
    ("near_dedup", stages.one_of_each_group),
    ("decontamination", stages.without_benchmark),
    ("mixing", stages.mixed),
]

# A fitted classifier stands between input and output: no SQL states the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
