"""Stage tables: results written once to shared storage and read back.

A stage table cuts lineage, survives the loss of executors, keeps parquet
statistics for pruning and gives the optimizer true sizes for join choice.
They live below ``spark.checkpoint.dir``, which the cluster names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def shared_dir(spark: SparkSession) -> str:
    """Folder for stage tables: the one the cluster names, else a folder of the warehouse, which all share too."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/stage").rstrip("/")


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kerbline/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*steps: Callable[[], T]) -> list[T]:
    """Results of steps that do not depend on each other, done at the same time.

    Most stage tables are small, so what takes time is planning them and waiting for their last tasks.
    """
    inherited = inheritable_thread_target(SparkSession.builder.getOrCreate())  # threads started here have no active session
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(inherited(step)) for step in steps]]


def staged(*tables: tuple[DataFrame, str]) -> list[DataFrame]:
    """Stage tables that do not depend on each other."""
    return together(*[lambda df=df, name=name: stage(df, name) for df, name in tables])


def new_folder(spark: SparkSession, name: str) -> str:
    """Unused path in the shared folder, for tables written by path."""
    return f"{shared_dir(spark)}/kerbline/{name}-{uuid.uuid4().hex[:12]}"


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that must not be broadcast.

    The optimizer sizes a pruned scan by the fixed widths of its columns and rows put on
    cells like the rows before, so it takes whole tables of lines for a few megabytes and
    would collect them on the driver.
    """
    return df.hint("merge")
