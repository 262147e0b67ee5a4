"""Street centrelines: load, split, bearings, grid ids, intersections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.config import Params
from kerbline.functions import crs, geom as G
from kerbline.operators.ranking import lookup, numbered
from kerbline.staging import stage

# fixed values: highway classes that do not make a road junction
NON_ROAD = ("cycleway", "footway", "pedestrian", "path", "steps", "corridor", "bridleway")

PIECES_PER_EDGE = 4096  # a map way has at most 2000 vertices, so pieces fit below this


def attach_node_points(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Join start and end node coordinates (lon/lat and UTM) onto edges."""
    for end, prefix in (("u", "start"), ("v", "end")):
        pts = nodes.select(F.col("node_id").alias(end),
                           *[F.col(c).alias(f"{prefix}_{c}") for c in ("lon", "lat", "x", "y")])
        edges = edges.join(pts, end, "left")
    return edges


def lines_from_vertices(edges: DataFrame, vertices: DataFrame, zone: int = 10) -> DataFrame:
    """Edges with ``geom`` (lon/lat) and ``utm`` coordinate arrays from a long vertex table."""
    arrays = (vertices.groupBy("edge_id")
              .agg(F.array_sort(F.collect_list(F.struct("seq", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("v"))
              .select("edge_id", F.transform("v", lambda p: G.pt(p["x"], p["y"])).alias("geom")))
    return edges.join(arrays, "edge_id").withColumn("utm", crs.utm_line(F.col("geom"), zone))


def straight_lines(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with two-vertex geometry from their end nodes."""
    e = attach_node_points(edges, nodes).where("start_x IS NOT NULL AND end_x IS NOT NULL")
    c = F.col
    return (e.withColumn("geom", G.line_of(c("start_lon"), c("start_lat"), c("end_lon"), c("end_lat")))
            .withColumn("utm", G.line_of(c("start_x"), c("start_y"), c("end_x"), c("end_y")))
            .drop(*[f"{p}_{q}" for p in ("start", "end") for q in ("lon", "lat", "x", "y")]))


def split_deflections(lines: DataFrame, threshold_deg: float = 45.0) -> DataFrame:
    """Cut lines at sharp turns; unsplit lines pass through as piece 0.

    Inner joints get synthetic node ids, negative and unique over the network.
    """
    cuts = F.concat(F.array(F.lit(1)), G.deflections(F.col("utm"), threshold_deg), F.array(F.size("utm")))
    fits = F.when(F.size("_cuts") <= PIECES_PER_EDGE, F.size("_cuts") - 1).otherwise(F.raise_error(F.concat(
        F.lit(f"an edge is cut into {PIECES_PER_EDGE} pieces or more, which its ids do not hold: "), F.col("edge_id").cast("string"))))
    p = (lines.withColumn("_cuts", cuts).withColumn("_np", fits.cast("int"))
         .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_np") - 1))))
    lo = F.element_at("_cuts", F.col("piece") + 1)
    n = F.element_at("_cuts", F.col("piece") + 2) - lo + 1
    base = F.col("edge_id") * PIECES_PER_EDGE
    return (p.withColumn("seg_id", (base + F.col("piece")).cast("long"))
            .withColumn("start_node", F.when(F.col("piece") == 0, F.col("u"))
                        .otherwise(-(base + F.col("piece"))).cast("long"))
            .withColumn("end_node", F.when(F.col("piece") == F.col("_np") - 1, F.col("v"))
                        .otherwise(-(base + F.col("piece") + 1)).cast("long"))
            .withColumn("geom", F.slice("geom", lo, n)).withColumn("utm", F.slice("utm", lo, n))
            .drop("_cuts", "_np", "u", "v"))


def raw_bearings(segments: DataFrame) -> DataFrame:
    return segments.withColumn("bearing", G.bearing(F.col("utm")))


def normalise_bearing(segments: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Direction of each street: one-way kept or reversed, named streets by majority, others north.

    The majority per street name is a mergeable aggregate looked up again; it is
    not a window, because one street name may cover much of the table.
    """
    name = F.nullif(F.trim("name"), F.lit(""))
    b = F.col("bearing")
    reverse = F.when(b >= 180, b - 180).otherwise(b + 180)
    s = segments.withColumn("_fwd", F.coalesce(F.col("oneway").isin("yes", "true", "1"), F.lit(False)))
    s = s.withColumn("_rev", F.coalesce(F.col("oneway").isin("-1", "reverse"), F.lit(False)))
    s = s.withColumn("_vote", F.when(~F.col("_fwd") & ~F.col("_rev") & b.isNotNull(), name))
    votes = (s.where("_vote IS NOT NULL").groupBy("_vote")
             .agg(F.avg((b < 180).cast("double")).alias("_north"), F.count("*").alias("_rows")))
    kw = {} if hot_rows is None else {"hot_rows": hot_rows}
    s = lookup(s, votes, "_vote", "_rows", F.col("seg_id"), **kw)
    north = b < 180
    flip = F.when(F.col("_north").isNotNull(), (F.col("_north") >= 0.5) != north).otherwise(~north)
    out = F.when(b.isNull(), F.lit(0.0)).when(F.col("_fwd"), b).when(F.col("_rev"), reverse).when(flip, reverse).otherwise(b)
    return s.withColumn("normalized_bearing", out).drop("_fwd", "_rev", "_vote", "_north")


def intersection_nodes(edges: DataFrame) -> DataFrame:
    """Nodes with at least three distinct neighbours over road edges."""
    road = edges.where(~F.coalesce(F.lower("highway").isin(*NON_ROAD), F.lit(False)))
    both = road.select(F.col("u").alias("node_id"), F.col("v").alias("nb")).unionByName(
        road.select(F.col("v").alias("node_id"), F.col("u").alias("nb")))
    return (both.distinct().groupBy("node_id").agg(F.count("*").alias("n_neighbours"))
            .where("n_neighbours >= 3"))


def intersection_fallback(segments: DataFrame) -> DataFrame:
    """Nodes met by at least three segment ends, for tables without graph edges."""
    ends = segments.select(F.col("start_node").alias("node_id")).unionByName(
        segments.select(F.col("end_node").alias("node_id")))
    return ends.groupBy("node_id").agg(F.count("*").alias("n_ends")).where("n_ends >= 3")


def flag_intersections(segments: DataFrame, junctions: DataFrame) -> DataFrame:
    for end in ("start", "end"):
        flag = junctions.select(F.col("node_id").alias(f"{end}_node"), F.lit(True).alias(f"_{end}"))
        segments = (segments.join(flag, f"{end}_node", "left")
                    .withColumn(f"{end}_is_intersection", F.coalesce(f"_{end}", F.lit(False))).drop(f"_{end}"))
    return segments


def grid_origin(nodes: DataFrame, cell: float = 500.0) -> DataFrame:
    return nodes.agg(F.min("x").alias("origin_x"), F.min("y").alias("origin_y")).withColumn("cell_size", F.lit(float(cell)))


def grid_cells(segments: DataFrame, origin: DataFrame, cell: float = 500.0) -> DataFrame:
    """Grid column and row of the segment centroid, relative to the network origin (one row)."""
    c = G.centroid(F.col("utm"))
    return (segments.withColumn("_c", c)
            .withColumn("cell_col", F.floor((F.col("_c.x") - origin.select("origin_x").scalar()) / cell).cast("long"))
            .withColumn("cell_row", F.floor((F.col("_c.y") - origin.select("origin_y").scalar()) / cell).cast("long"))
            .drop("_c"))


def grid_ids(segments: DataFrame, origin: DataFrame, cell: float = 500.0, hot_rows: int | None = None) -> DataFrame:
    """Street id ``col_row_seq``: cell of the centroid and the position of the segment inside it."""
    kw = {} if hot_rows is None else {"hot_rows": hot_rows}
    # numbering reads its input several times; a stage table spares recomputing the geometry
    cells = stage(grid_cells(segments, origin, cell), "cells")
    s = numbered(cells, ["cell_col", "cell_row"], "seg_id", "cell_seq", **kw)
    return s.withColumn("grid_id", F.concat_ws("_", *[F.col(c).cast("string") for c in ("cell_col", "cell_row", "cell_seq")]))


def foundation(edges: DataFrame, lines: DataFrame, nodes: DataFrame, params: Params = Params()) -> DataFrame:
    """Split, oriented, identified segments with intersection flags."""
    s = split_deflections(lines, params.deflection_angle_threshold)
    s = normalise_bearing(raw_bearings(s))
    s = grid_ids(s, grid_origin(nodes, params.grid_cell_size), params.grid_cell_size)
    return flag_intersections(s, intersection_nodes(edges))


def is_in(col: Column, values) -> Column:
    return F.coalesce(F.lower(F.trim(col)).isin(*values), F.lit(False))
