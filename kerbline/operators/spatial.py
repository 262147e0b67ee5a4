"""Distance joins over grid cells.

Each side is put on grid cells, joined on the cell and tested exactly.  A query
point lies in one cell; targets are listed on every cell their padded box meets,
so a pair can meet only once per piece.  Exact copies of a target or of a query
place are folded to one representative first: stacked copies then cost one
comparison, and results are given back to every copy by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbline.functions import geom as G
from kerbline.staging import shuffled

DIST_DIGITS = 6  # ties closer than a micrometre go to the smaller id


def cell(c: Column, size: float) -> Column:
    return F.floor(c / size).cast("long")


def on_cells(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, pad: float, size: float) -> DataFrame:
    """One row per grid cell met by the padded box; adds ``cx`` and ``cy``."""
    return (df.withColumn("cx", F.explode(F.sequence(cell(F.least(x0, x1) - pad, size), cell(F.greatest(x0, x1) + pad, size))))
            .withColumn("cy", F.explode(F.sequence(cell(F.least(y0, y1) - pad, size), cell(F.greatest(y0, y1) + pad, size)))))


def _pieces_on_cells(lines: DataFrame, key: str, line: str, keep: list[str], pad: float, size: float) -> DataFrame:
    p = G.pieces(lines, line, [key, *keep], max_len=2 * size)
    return on_cells(p, F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"), pad, size)


def points_near_points(a: DataFrame, b: DataFrame, radius: float) -> DataFrame:
    """All (a_id, b_id, d) with d <= radius; inputs are (a_id, ax, ay) and (b_id, bx, by)."""
    left = a.withColumn("cx", cell(F.col("ax"), radius)).withColumn("cy", cell(F.col("ay"), radius))
    right = on_cells(b, F.col("bx"), F.col("by"), F.col("bx"), F.col("by"), radius, radius)
    d = G.dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return left.join(shuffled(right), ["cx", "cy"]).withColumn("d", d).where(F.col("d") <= radius).drop("cx", "cy")


def nearest_point(queries: DataFrame, targets: DataFrame, radius: float) -> DataFrame:
    """Nearest target of each query within ``radius``: (q_id, t_id, d); ties to the smaller id.

    Inputs are (q_id, qx, qy) and (t_id, tx, ty).
    """
    places = queries.select("qx", "qy").distinct()
    stacks = targets.groupBy("tx", "ty").agg(F.min("t_id").alias("t_id"))
    left = places.withColumn("cx", cell(F.col("qx"), radius)).withColumn("cy", cell(F.col("qy"), radius))
    right = on_cells(stacks, F.col("tx"), F.col("ty"), F.col("tx"), F.col("ty"), radius, radius)
    d = G.dist(F.col("qx"), F.col("qy"), F.col("tx"), F.col("ty"))
    best = (left.join(shuffled(right), ["cx", "cy"]).withColumn("d", d).where(F.col("d") <= radius)
            .groupBy("qx", "qy").agg(F.min(F.struct(F.round("d", DIST_DIGITS).alias("r"), "t_id", "d")).alias("m")))
    return queries.join(best, ["qx", "qy"]).select("q_id", F.col("m.t_id").alias("t_id"), F.col("m.d").alias("d"))


def _on_pieces(points: DataFrame, lines: DataFrame, radius: float, line: str) -> tuple[DataFrame, Column]:
    """Points (px, py) beside the line pieces of their cell, and the squared distance of the two."""
    size = max(radius, 1.0)
    left = points.withColumn("cx", cell(F.col("px"), size)).withColumn("cy", cell(F.col("py"), size))
    right = _pieces_on_cells(lines, "l_id", line, [], radius, size)
    t = G.param_on_segment(*[F.col(c) for c in ("px", "py", "ax", "ay", "bx", "by")])
    j = left.join(shuffled(right), ["cx", "cy"]).withColumn("t", t)
    j = j.withColumns({"_ex": F.col("ax") + F.col("t") * (F.col("bx") - F.col("ax")) - F.col("px"),
                       "_ey": F.col("ay") + F.col("t") * (F.col("by") - F.col("ay")) - F.col("py")})
    return j, F.col("_ex") * F.col("_ex") + F.col("_ey") * F.col("_ey")


def points_near_lines(points: DataFrame, lines: DataFrame, radius: float, line: str = "utm") -> DataFrame:
    """(p_id, l_id, d) for every line within ``radius`` of a point; d is the exact distance.

    Inputs are (p_id, px, py) and (l_id, <line>).
    """
    j, d2 = _on_pieces(points, lines, radius, line)
    return (j.groupBy("p_id", "l_id").agg(F.sqrt(F.min(d2)).alias("d"))).where(F.col("d") <= radius)


def nearest_line(points: DataFrame, lines: DataFrame, radius: float, line: str = "utm") -> DataFrame:
    """Nearest line of each point within ``radius``: (p_id, l_id, d).

    A place lies in one cell, so its least piece is found before anything is shuffled again.
    """
    stacks = lines.groupBy(line).agg(F.min("l_id").alias("l_id"))
    j, d2 = _on_pieces(points.select("px", "py").distinct(), stacks, radius, line)
    j = j.withColumn("d", F.sqrt(d2))
    near = F.when(F.col("d") <= radius, F.struct(F.round("d", DIST_DIGITS).alias("r"), "l_id", "d"))
    best = (j.groupBy("px", "py").agg(F.min(near).alias("m")).where("m IS NOT NULL")
            .select("px", "py", F.col("m.l_id").alias("l_id"), F.col("m.d").alias("d")))
    return points.join(best, ["px", "py"]).select("p_id", "l_id", "d")


def _segment_distance(j: DataFrame, p: list[Column], q: list[Column]) -> DataFrame:
    """Add ``d``, the distance of segments p and q, in short steps that each compute a value once."""
    det = G.cross(p[2] - p[0], p[3] - p[1], q[2] - q[0], q[3] - q[1])
    ends = ((p[0], p[1], q), (p[2], p[3], q), (q[0], q[1], p), (q[2], q[3], p))
    j = j.withColumns({"_det": F.nullif(det, F.lit(0.0)),
                       "_num_t": G.cross(q[0] - p[0], q[1] - p[1], q[2] - q[0], q[3] - q[1]),
                       "_num_u": G.cross(q[0] - p[0], q[1] - p[1], p[2] - p[0], p[3] - p[1]),
                       **{f"_t{i}": G.param_on_segment(x, y, *o) for i, (x, y, o) in enumerate(ends)}})
    j = j.withColumns({"_t": F.col("_num_t") / F.col("_det"), "_u": F.col("_num_u") / F.col("_det"),
                       **{f"_ex{i}": o[0] + F.col(f"_t{i}") * (o[2] - o[0]) - x for i, (x, y, o) in enumerate(ends)},
                       **{f"_ey{i}": o[1] + F.col(f"_t{i}") * (o[3] - o[1]) - y for i, (x, y, o) in enumerate(ends)}})
    d2 = F.least(*[F.col(f"_ex{i}") * F.col(f"_ex{i}") + F.col(f"_ey{i}") * F.col(f"_ey{i}") for i in range(4)])
    meets = (F.col("_t") >= 0) & (F.col("_t") <= 1) & (F.col("_u") >= 0) & (F.col("_u") <= 1)
    return j.withColumn("d", F.when(meets, F.lit(0.0)).otherwise(F.sqrt(d2)))


def lines_near_lines(a: DataFrame, b: DataFrame, radius: float, line: str = "utm",
                     keep_a: list[str] = [], keep_b: list[str] = []) -> DataFrame:
    """(a_id, b_id, d) for line pairs within ``radius``; inputs are (a_id, <line>), (b_id, <line>).

    ``keep_a`` and ``keep_b`` name small attributes to carry along, which saves
    joining them back to the pairs.
    """
    size = 2 * max(radius, 1.0)  # on wider cells a padded line is listed far fewer times
    cols = ("ax", "ay", "bx", "by")
    left = _pieces_on_cells(a, "a_id", line, keep_a, 0.0, size).drop("k", "m0", "m1")
    right = _pieces_on_cells(b, "b_id", line, keep_b, radius, size).drop("k", "m0", "m1")
    for c in cols:
        right = right.withColumnRenamed(c, "r" + c)
    j = left.join(shuffled(right), ["cx", "cy"])
    p = [F.col(c) for c in cols]
    q = [F.col("r" + c) for c in cols]
    # boxes further apart than the radius cannot match; this drops most candidates cheaply
    gap_x = F.greatest(F.least(q[0], q[2]) - F.greatest(p[0], p[2]), F.least(p[0], p[2]) - F.greatest(q[0], q[2]))
    gap_y = F.greatest(F.least(q[1], q[3]) - F.greatest(p[1], p[3]), F.least(p[1], p[3]) - F.greatest(q[1], q[3]))
    j = j.where((gap_x <= radius) & (gap_y <= radius))
    j = _segment_distance(j, p, q)
    carried = [*keep_a, *keep_b]
    # the radius test follows the aggregate: a filter on d would be pushed down as a copy of its whole expression
    return (j.groupBy("a_id", "b_id").agg(F.min("d").alias("d"), *[F.any_value(c).alias(c) for c in carried])
            .where(F.col("d") <= radius))
