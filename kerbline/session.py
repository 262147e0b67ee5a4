"""Session defaults for tests and benchmarks; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "16g", shuffle_partitions: int = 8,
                  checkpoint_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("kerbline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # geometry costs far more processor time per byte than the defaults assume,
        # so small inputs are spread over all cores instead of being merged
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "65536")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
