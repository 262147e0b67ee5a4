"""Planar geometry as column expressions over ``ARRAY<STRUCT<x,y>>`` lines.

Short arrays are handled in place with higher-order functions; heavy joins work
on the long form produced by :func:`pieces`, whose arithmetic is code-generated.
"""

from __future__ import annotations

import math

import pandas as pd

from pyspark.sql import Column, DataFrame, functions as F

_MEASURED = "array<struct<ax:double,ay:double,bx:double,by:double,m0:double,m1:double>>"


def pt(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line_of(*xy: Column) -> Column:
    """Line from alternating x and y columns."""
    return F.array(*[pt(xy[i], xy[i + 1]) for i in range(0, len(xy), 2)])


def first_pt(line: Column) -> Column:
    return F.element_at(line, 1)


def last_pt(line: Column) -> Column:
    return F.element_at(line, -1)


def dist(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))


def cross(ax, ay, bx, by) -> Column:
    return ax * by - ay * bx


def segs(line: Column) -> Column:
    """Consecutive vertex pairs of a line with at least two vertices."""
    n = F.size(line)
    return F.zip_with(F.slice(line, 1, n - 1), F.slice(line, 2, n - 1), lambda a, b: F.struct(
        a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))


def seg_len(s: Column) -> Column:
    return dist(s["ax"], s["ay"], s["bx"], s["by"])


def length(line: Column) -> Column:
    return F.aggregate(segs(line), F.lit(0.0), lambda acc, s: acc + seg_len(s))


def measured(line: Column) -> Column:
    """Vertex pairs with the line measure at each end (m0, m1), in one pass."""
    zero = F.struct(F.lit(0.0).alias("m"), F.expr(f"CAST(array() AS {_MEASURED})").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        end = acc["m"] + seg_len(s)
        return F.struct(end.alias("m"), F.concat(acc["out"], F.array(F.struct(
            *[s[c].alias(c) for c in ("ax", "ay", "bx", "by")], acc["m"].alias("m0"), end.alias("m1")))).alias("out"))

    return F.aggregate(segs(line), zero, add, lambda acc: acc["out"])


def clamp01(t: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))


def param_on_segment(px, py, ax, ay, bx, by) -> Column:
    """Clamped parameter of the point of segment a-b nearest to p."""
    dx, dy = bx - ax, by - ay
    d2 = dx * dx + dy * dy
    return F.when(d2 > 0, clamp01(((px - ax) * dx + (py - ay) * dy) / d2)).otherwise(F.lit(0.0))


def point_segment_dist(px, py, ax, ay, bx, by) -> Column:
    t = param_on_segment(px, py, ax, ay, bx, by)
    return dist(px, py, ax + t * (bx - ax), ay + t * (by - ay))


def _let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def nearest(ms: Column, px: Column, py: Column) -> Column:
    """Nearest position on a measured line: struct(d, m, x, y, ax, ay, bx, by)."""
    withp = F.transform(ms, lambda s: F.struct(
        *[s[c].alias(c) for c in ("ax", "ay", "bx", "by", "m0", "m1")],
        param_on_segment(px, py, s["ax"], s["ay"], s["bx"], s["by"]).alias("t")))
    at = F.transform(withp, lambda s: F.struct(
        (s["m0"] + s["t"] * (s["m1"] - s["m0"])).alias("m"),
        (s["ax"] + s["t"] * (s["bx"] - s["ax"])).alias("x"), (s["ay"] + s["t"] * (s["by"] - s["ay"])).alias("y"),
        *[s[c].alias(c) for c in ("ax", "ay", "bx", "by")]))
    return F.array_min(F.transform(at, lambda s: F.struct(
        dist(px, py, s["x"], s["y"]).alias("d"), *[s[c].alias(c) for c in ("m", "x", "y", "ax", "ay", "bx", "by")])))


def _along(s: Column, m: Column) -> Column:
    f = (m - s["m0"]) / F.nullif(s["m1"] - s["m0"], F.lit(0.0))
    return pt(s["ax"] + F.coalesce(f, F.lit(0.0)) * (s["bx"] - s["ax"]), s["ay"] + F.coalesce(f, F.lit(0.0)) * (s["by"] - s["ay"]))


def interpolate(ms: Column, m: Column) -> Column:
    """Point at measure ``m`` of a measured line, clamped to its ends."""
    m = F.greatest(m, F.lit(0.0))
    inside = F.transform(F.slice(F.filter(ms, lambda s: s["m1"] >= m), 1, 1), lambda s: _along(s, m))
    return F.coalesce(F.try_element_at(inside, F.lit(1)), _let(F.element_at(ms, -1), lambda s: pt(s["bx"], s["by"])))


def substring(ms: Column, a: Column, b: Column) -> Column:
    """Part of a measured line between two measures; null when it would be a single point."""
    inner = F.transform(F.filter(ms, lambda s: (s["m1"] > a) & (s["m1"] < b)), lambda s: pt(s["bx"], s["by"]))
    return F.when(b > a, F.concat(F.array(interpolate(ms, a)), inner, F.array(interpolate(ms, b))))


def side_of(ms: Column, px: Column, py: Column) -> Column:
    """'left' or 'right' of a measured line at the position nearest to the point."""
    return _let(nearest(ms, px, py), lambda n: F.when(
        cross(n["bx"] - n["ax"], n["by"] - n["ay"], px - n["x"], py - n["y"]) > 0, "left").otherwise("right"))


def bearing_of(dx: Column, dy: Column) -> Column:
    """Clockwise degrees from north in [0, 360); null for a zero vector."""
    deg = F.degrees(F.atan2(dx, dy))
    return F.when((dx != 0) | (dy != 0), deg - 360 * F.floor(deg / 360))


def bearing(line: Column) -> Column:
    return bearing_of(last_pt(line)["x"] - first_pt(line)["x"], last_pt(line)["y"] - first_pt(line)["y"])


def axis_diff(a: Column, b: Column) -> Column:
    """Undirected angle between two bearings, 0 to 90 degrees."""
    d = F.abs((a - 180 * F.floor(a / 180)) - (b - 180 * F.floor(b / 180)))
    return F.when(d > 90, 180 - d).otherwise(d)


def deflections(line: Column, threshold_deg: float) -> Column:
    """One-based vertex positions where the line turns by more than the threshold."""
    def turn(i: Column) -> Column:
        p, q, r = F.element_at(line, i - 1), F.element_at(line, i), F.element_at(line, i + 1)
        ux, uy, vx, vy = q["x"] - p["x"], q["y"] - p["y"], r["x"] - q["x"], r["y"] - q["y"]
        lu, lv = F.sqrt(ux * ux + uy * uy), F.sqrt(vx * vx + vy * vy)
        # the turn exceeds the threshold when its cosine is below the threshold's cosine
        return (lu >= 1e-9) & (lv >= 1e-9) & (ux * vx + uy * vy < math.cos(math.radians(threshold_deg)) * lu * lv)
    n = F.size(line)
    return F.when(n >= 3, F.filter(F.sequence(F.lit(2), n - 1), turn)).otherwise(F.expr("CAST(array() AS array<int>)"))


def centroid(line: Column) -> Column:
    """Length-weighted centroid of a line."""
    zero = F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    acc = F.aggregate(segs(line), zero, lambda a, s: F.struct(
        (a["l"] + seg_len(s)).alias("l"),
        (a["x"] + seg_len(s) * (s["ax"] + s["bx"]) / 2).alias("x"),
        (a["y"] + seg_len(s) * (s["ay"] + s["by"]) / 2).alias("y")))
    return F.when(acc["l"] > 0, pt(acc["x"] / acc["l"], acc["y"] / acc["l"])).otherwise(first_pt(line))


def offset(line: Column, d: Column) -> Column:
    """Parallel line at signed distance ``d`` (left positive), mitred at vertices; repeated vertices count once.

    A line that is one point has no side and no parallel; a mitre at a full turn stays at its vertex.
    """
    line = distinct_vertices(line)
    normals = F.transform(segs(line), lambda s: pt(-(s["by"] - s["ay"]) / seg_len(s), (s["bx"] - s["ax"]) / seg_len(s)))
    before = F.concat(F.slice(normals, 1, 1), normals)
    after = F.concat(normals, F.slice(normals, -1, 1))
    mitre = F.zip_with(before, after, lambda p, q: F.struct(
        (p["x"] + q["x"]).alias("x"), (p["y"] + q["y"]).alias("y"), (1 + p["x"] * q["x"] + p["y"] * q["y"]).alias("w")))
    return F.zip_with(line, mitre, lambda v, m: pt(v["x"] + F.coalesce(d * m["x"] / F.nullif(m["w"], F.lit(0.0)), F.lit(0.0)),
                                                       v["y"] + F.coalesce(d * m["y"] / F.nullif(m["w"], F.lit(0.0)), F.lit(0.0))))


def distinct_vertices(line: Column) -> Column:
    """The line without vertices that repeat the one before them."""
    return F.filter(line, lambda v, i: (i == 0) | (v != F.get(line, i - 1)))


def mid_vertex(line: Column) -> Column:
    return F.element_at(line, F.floor(F.size(line) / 2).cast("int") + 1)


def extend(line: Column, p: Column, at_start: Column) -> Column:
    return F.when(at_start, F.concat(F.array(p), line)).otherwise(F.concat(line, F.array(p)))


def ring_edges(ring: Column) -> Column:
    """Edges of an open vertex ring, closing edge included."""
    return segs(F.concat(ring, F.slice(ring, 1, 1)))


def contains_point(ring: Column, px: Column, py: Column) -> Column:
    """Point in a counter-clockwise convex ring, boundary included."""
    return F.forall(ring_edges(ring), lambda e: cross(
        e["bx"] - e["ax"], e["by"] - e["ay"], px - e["ax"], py - e["ay"]) >= -1e-6)


def clip_span(s: Column, ring: Column) -> Column:
    """Parameter span (t0, t1) of segment ``s`` inside a counter-clockwise convex ring."""
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]

    def narrow(acc: Column, e: Column) -> Column:
        ex, ey = e["bx"] - e["ax"], e["by"] - e["ay"]
        num = cross(ex, ey, s["ax"] - e["ax"], s["ay"] - e["ay"])
        den = cross(ex, ey, dx, dy)
        t = -num / den
        return F.struct(
            F.when(den > 0, F.greatest(acc["t0"], t)).when((den == 0) & (num < 0), F.lit(2.0))
            .otherwise(acc["t0"]).alias("t0"),
            F.when(den < 0, F.least(acc["t1"], t)).otherwise(acc["t1"]).alias("t1"))

    return F.aggregate(ring_edges(ring), F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1")), narrow)


def frac_inside(line: Column, ring: Column) -> Column:
    """Share of a line's length inside a counter-clockwise convex ring."""
    spans = F.transform(segs(line), lambda s: F.struct(seg_len(s).alias("l"), clip_span(s, ring).alias("c")))
    inside = F.aggregate(spans, F.lit(0.0), lambda a, q: a + q["l"] * F.greatest(
        F.lit(0.0), q["c"]["t1"] - q["c"]["t0"]))
    return inside / F.nullif(length(line), F.lit(0.0))


def ring_centroid(ring: Column) -> Column:
    """Area centroid of a counter-clockwise ring, relative to its first vertex for precision."""
    o = first_pt(ring)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, e: Column) -> Column:
        ax, ay, bx, by = e["ax"] - o["x"], e["ay"] - o["y"], e["bx"] - o["x"], e["by"] - o["y"]
        c = cross(ax, ay, bx, by)
        return F.struct((acc["a"] + c).alias("a"), (acc["x"] + (ax + bx) * c).alias("x"),
                        (acc["y"] + (ay + by) * c).alias("y"))

    s = F.aggregate(ring_edges(ring), zero, add)
    return pt(o["x"] + s["x"] / (3 * s["a"]), o["y"] + s["y"] / (3 * s["a"]))


def bbox(line: Column) -> Column:
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
                    F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


# Lines whose directions differ by a smaller sine are parallel.  Where such lines meet is decided by the
# rounding of their coordinates: a nanometre there moves the crossing by more than a bend so small sets them apart.
PARALLEL_SINE = 1e-4


def not_parallel(det: Column, dax, day, dbx, dby) -> Column:
    """Do two directions with cross product ``det`` differ by more than ``PARALLEL_SINE``?"""
    return F.abs(det) > PARALLEL_SINE * F.sqrt((dax * dax + day * day) * (dbx * dbx + dby * dby))


def ray_ray(pax, pay, dax, day, pbx, pby, dbx, dby, max_dist: float = 30.0) -> Column:
    """Corner of two end rays: null when parallel, behind ray A, or too far from either end."""
    det = dbx * day - dax * dby
    t = (dby * (pax - pbx) - dbx * (pay - pby)) / F.nullif(det, F.lit(0.0))
    ix, iy = pax + t * dax, pay + t * day
    ok = (not_parallel(det, dax, day, dbx, dby) & (t >= 0) & (dist(pax, pay, ix, iy) <= max_dist)
          & (dist(pbx, pby, ix, iy) <= max_dist))
    return F.when(ok, pt(ix, iy))


def seg_cross(ax, ay, bx, by, cx, cy, dx, dy, slack: float = 0.0) -> Column:
    """Crossing point of segments a-b and c-d, null when they do not meet in one point.

    ``slack`` lengthens both segments by that share, for lines drawn to end exactly on another.
    """
    det = cross(bx - ax, by - ay, dx - cx, dy - cy)
    safe = F.nullif(det, F.lit(0.0))
    t = cross(cx - ax, cy - ay, dx - cx, dy - cy) / safe
    u = cross(cx - ax, cy - ay, bx - ax, by - ay) / safe
    lo, hi = -slack, 1.0 + slack
    return F.when((t >= lo) & (t <= hi) & (u >= lo) & (u <= hi), pt(ax + t * (bx - ax), ay + t * (by - ay)))


def line_cross(a: Column, b: Column) -> Column:
    """All crossing points of two short lines, in order along ``a``."""
    hits = F.flatten(F.transform(segs(a), lambda s: F.transform(segs(b), lambda q: seg_cross(
        s["ax"], s["ay"], s["bx"], s["by"], q["ax"], q["ay"], q["bx"], q["by"]))))
    return F.array_distinct(F.filter(hits, lambda p: p.isNotNull()))


def pieces(df: DataFrame, line: str, keep: list[str], max_len: float | None = None) -> DataFrame:
    """Long form of a line column: one row per vertex pair, cut to at most ``max_len``.

    Cutting long pairs keeps the number of grid cells of a piece small and fixed.
    """
    out = df.select(*keep, F.posexplode(measured(F.col(line))).alias("k", "s")).select(
        *keep, "k", "s.ax", "s.ay", "s.bx", "s.by", "s.m0", "s.m1")
    if max_len is None:
        return out
    parts = F.greatest(F.lit(1), F.ceil((F.col("m1") - F.col("m0")) / max_len).cast("int"))
    out = out.withColumn("_n", parts).withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    f0, f1 = (F.col("_i") - 1) / F.col("_n"), F.col("_i") / F.col("_n")
    return out.select(*keep, "k",
                      *[(F.col("a" + c) + f0 * (F.col("b" + c) - F.col("a" + c))).alias("a" + c) for c in "xy"],
                      *[(F.col("a" + c) + f1 * (F.col("b" + c) - F.col("a" + c))).alias("b" + c) for c in "xy"],
                      (F.col("m0") + f0 * (F.col("m1") - F.col("m0"))).alias("m0"),
                      (F.col("m0") + f1 * (F.col("m1") - F.col("m0"))).alias("m1"))


def insert_index(line: Column, px: Column, py: Column, closed: bool = False) -> Column:
    """Position (0-based splice index) after the edge nearest to the point."""
    edges = ring_edges(line) if closed else segs(line)
    d = F.transform(edges, lambda s, i: F.struct(
        F.round(point_segment_dist(px, py, s["ax"], s["ay"], s["bx"], s["by"]), 6).alias("d"), (i + 1).alias("i")))
    return F.array_min(d)["i"]


def insert_vertex(line: Column, index: Column, p: Column) -> Column:
    n = F.size(line)
    return F.concat(F.slice(line, F.lit(1), index), F.array(p), F.slice(line, index + 1, F.greatest(n - index, F.lit(0))))


def move_vertex(line: Column, index: Column, p: Column) -> Column:
    return F.transform(line, lambda q, i: F.when(i == index, p).otherwise(q))


def delete_vertex(line: Column, index: Column, least: int = 2) -> Column:
    """Remove a vertex unless the shape would fall below ``least`` vertices."""
    kept = F.filter(line, lambda q, i: i != index)
    return F.when(F.size(line) > least, kept).otherwise(line)


def vertices(df: DataFrame, line: str, keep: list[str]) -> DataFrame:
    """One row per vertex with its index and an endpoint flag."""
    v = df.select(*keep, F.size(line).alias("_n"), F.posexplode(line).alias("i", "p"))
    return v.select(*keep, "i", F.col("p.x").alias("x"), F.col("p.y").alias("y"),
                    F.col("i").isin(0) .__or__(F.col("i") == F.col("_n") - 1).cast("int").alias("endpoint"))


def buffer_flat(ax, ay, bx, by, half: float) -> Column:
    """Counter-clockwise rectangle around a segment, flat at both ends."""
    l = dist(ax, ay, bx, by)
    nx, ny = -(by - ay) / l * half, (bx - ax) / l * half
    return line_of(ax - nx, ay - ny, bx - nx, by - ny, bx + nx, by + ny, ax + nx, ay + ny)


def _merge(parts: pd.Series) -> pd.Series:
    def end(p) -> tuple[float, float]:
        return (p["x"], p["y"])

    def one(lines):
        chains = [list(p) for p in lines if len(p) > 1]
        i = 0
        while i < len(chains):
            for j in range(i + 1, len(chains)):
                a, b = chains[i], chains[j]
                if end(a[-1]) == end(b[0]):
                    chains[i] = a + b[1:]
                elif end(a[-1]) == end(b[-1]):
                    chains[i] = a + b[-2::-1]
                elif end(a[0]) == end(b[-1]):
                    chains[i] = b + a[1:]
                elif end(a[0]) == end(b[0]):
                    chains[i] = b[:0:-1] + a
                else:
                    continue
                del chains[j]
                break
            else:
                i += 1
        if not chains:
            return None
        return max(chains, key=lambda c: sum(math.dist(end(p), end(q)) for p, q in zip(c, c[1:])))

    return parts.map(lambda ls: None if ls is None else one(ls))


def merge_parts(parts: Column) -> Column:
    """Join the parts of a multi-line that share end points, else keep the longest chain."""
    return F.pandas_udf(_merge, "array<struct<x:double,y:double>>")(parts)


def _chain(points: Column) -> Column:
    """Half of a convex hull over points in sweep order.

    On a convex chain the vertices hidden by the next point form a suffix, so one
    filter replaces the usual popping loop.
    """
    empty = F.expr("CAST(array() AS array<struct<x:double,y:double>>)")

    def keep(acc: Column, p: Column):
        def visible(q: Column, i: Column) -> Column:
            a = F.element_at(acc, F.greatest(i, F.lit(1)))
            return (i == 0) | (cross(q["x"] - a["x"], q["y"] - a["y"], p["x"] - a["x"], p["y"] - a["y"]) > 0)
        return visible

    return F.aggregate(points, empty, lambda acc, p: F.concat(F.filter(acc, keep(acc, p)), F.array(p)))


def hull_ring(points: Column) -> Column:
    """Convex hull of a point array: counter-clockwise open ring from the least (x, y)."""
    p = F.array_sort(F.array_distinct(points))
    lower, upper = _chain(p), _chain(F.reverse(p))
    return F.concat(F.slice(lower, 1, F.greatest(F.size(lower) - 1, F.lit(0))), F.slice(upper, 1, F.greatest(F.size(upper) - 1, F.lit(0))))


def farthest_pair(points: Column) -> Column:
    """Two most distant points of a short array, as a line in (x, y) order."""
    pairs = F.flatten(F.transform(points, lambda a: F.transform(points, lambda b: F.struct(
        (-F.round(dist(a["x"], a["y"], b["x"], b["y"]), 6)).alias("d"), a.alias("a"), b.alias("b")))))
    return _let(F.array_min(F.filter(pairs, lambda q: q["a"] < q["b"])), lambda q: F.when(q["d"] < 0, F.array(q["a"], q["b"])))
