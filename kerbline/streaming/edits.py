"""The edit log as a file stream, applied in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

LOG_SCHEMA = "edit_id long, ts timestamp, user_id long, edit_type string, node_id long, seg_id long, col string, new_value string"


def edit_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Edits appended to a folder, however late; edits delivered twice are told apart by the reader of the sink."""
    return spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run(edits: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Apply what has arrived, batch by batch, then stop.  ``apply`` must be idempotent per batch id."""
    return (edits.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def store_batches(target: str) -> Callable[[DataFrame, int], None]:
    """Sink that keeps each batch in a folder of its own, so a replayed batch replaces itself."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
    return apply


def stored(spark: SparkSession, target: str) -> DataFrame:
    """Every edit once, as it was first delivered: by batch, then by its own values."""
    rows = spark.read.schema(LOG_SCHEMA + ", batch int").parquet(target)
    return rows.groupBy("edit_id").agg(F.min(F.struct("batch", *[c for c in rows.columns if c not in ("batch", "edit_id")])).alias("e")).select(
        "edit_id", *[f"e.{c}" for c in rows.columns if c != "edit_id"])
