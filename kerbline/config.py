"""Build parameters and their layering (city over global over default)."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Params:
    default_maxspeed: int = 25
    default_lane_width: float = 3.0
    default_lanes: int = 2
    deflection_angle_threshold: float = 45.0
    default_bikeway_width: float = 1.5
    hull_merge_buffer_m: float = 10.0
    crosswalk_buffer_m: float = 3.0
    curb_ramp_snap_m: float = 1.0
    dem_resolution_m: float = 10.0
    slope_cap_pct: float = 40.0
    grid_cell_size: float = 500.0
    curb_ramp_match_radius_m: float = 5.0
    match_radius_m: float = 30.0
    parallel_deg: float = 45.0
    hull_ramp_max_m: float = 15.0
    utm_zone: int = 10


def default_rows(spark: SparkSession) -> DataFrame:
    """The numeric defaults as a (param, value) table; its size is the field count."""
    rows = [(f.name, float(f.default)) for f in fields(Params)]
    return spark.createDataFrame(rows, "param string, value double")


def layered(regions: DataFrame, defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """Resolve each (region, param): city override, else global override, else default.

    ``overrides`` has ``tier`` ('global' or 'city'), ``region`` (null for global),
    ``param``, ``value``.  A null value removes the override at that tier.
    """
    glob = (overrides.where("tier = 'global' AND value IS NOT NULL")
            .groupBy("param").agg(F.max("value").alias("global_value")))
    city = (overrides.where("tier = 'city' AND value IS NOT NULL")
            .groupBy("region", "param").agg(F.max("value").alias("city_value")))
    base = defaults.withColumnRenamed("value", "default_value").join(glob, "param", "left")
    names = [f.name for f in fields(Params)]
    per_region = regions.select("region", F.explode(F.array([F.lit(n) for n in names])).alias("param"))
    return (per_region.join(F.broadcast(base), "param")  # one row per Params field
            .join(city, ["region", "param"], "left")
            .select("region", "param",
                    F.coalesce("city_value", "global_value", "default_value").alias("value"),
                    F.when(F.col("city_value").isNotNull(), "city")
                    .when(F.col("global_value").isNotNull(), "global")
                    .otherwise("default").alias("tier")))
