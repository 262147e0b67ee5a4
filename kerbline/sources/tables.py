"""Scans and sinks of street tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbline.functions import tags
from kerbline.sources import wkb

TILE_CELLS = 20  # sink tiles are 20 grid cells (10 km) wide

INVENTORY_SCHEMA = ("crexist string, longitude double, latitude double, xloc double, yloc double, locid long, "
                    "curbreturnloc string, positiononreturn string, conditionscore int")


def scan_edges(spark: SparkSession, path: str) -> DataFrame:
    """Street edges with the known tags; ids as long.  Only these columns are read."""
    df = spark.read.parquet(path)
    ids = [F.col(c).cast("long").alias(c) for c in ("edge_id", "u", "v")]
    return df.select(*ids, *[F.col(f"`{c}`") for c in ("name", "highway", "oneway", *tags.WAY_TAGS) if c in df.columns])


def scan_nodes(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    keep = ("highway", "crossing", "kerb", "tactile_paving", "traffic_calming")
    detail = [next((F.col(f"`{c}`").alias(n) for c in (f"crossing:{n}", n) if c in df.columns), None) for n in ("markings", "signals", "island", "continuous")]
    key = "osmid" if "osmid" in df.columns else "node_id"
    return df.select(F.col(key).cast("long").alias(key), "lon", "lat", *[c for c in keep if c in df.columns], *[c for c in detail if c is not None])


def scan_calming(spark: SparkSession, path: str) -> DataFrame:
    """Traffic-calming features, points only."""
    return spark.read.parquet(path).where("geom_type = 'Point'")


def scan_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Government ramp inventory (CSV with header): existing ramps only."""
    return spark.read.schema(INVENTORY_SCHEMA).option("header", True).csv(path).where("crexist = '1'")


def scan_network(spark: SparkSession, path: str) -> DataFrame:
    """Network table with binary geometry decoded to ``geometry`` (kind, parts)."""
    return wkb.decode(spark.read.parquet(path), "wkb", "geometry")


def write_network(segments: DataFrame, origin: DataFrame, path: str, region: str | None = None) -> None:
    """Segments with binary geometry, tiled and sorted by grid cell; the grid origin as a one-row table beside them.

    Rows are range-partitioned by cell and id, so a crowded cell spreads over
    several files and viewport reads prune by tile folder and row-group bounds.
    """
    s = wkb.encode(segments, "geom", "wkb").drop("geom", "utm")
    s = (s.withColumn("region", F.lit(region or "all"))
         .withColumn("tile", F.concat_ws("_", *[F.floor(F.col(c) / TILE_CELLS).cast("string") for c in ("cell_col", "cell_row")])))
    s = s.repartitionByRange("tile", "cell_col", "cell_row", "seg_id").sortWithinPartitions("tile", "cell_col", "cell_row", "seg_id")
    (s.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("region", "tile").parquet(f"{path}/segments"))
    (origin.withColumn("region", F.lit(region or "all")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("region").parquet(f"{path}/origin"))


def unfinished(regions: DataFrame, finished: DataFrame, skip_existing: bool = True) -> DataFrame:
    """Regions still to build."""
    return regions.join(finished, "region", "left_anti") if skip_existing else regions
