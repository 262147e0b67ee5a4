"""Intersections: sidewalk arms, curb ramps, hulls, merged hulls and crosswalk slots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.config import Params
from kerbline.functions import geom as G, tags
from kerbline.operators import spatial as SP
from kerbline.staging import shuffled, stage

PAIR_CELL_M = 10.0
HULL_GROUP = 64


POINT_DIGITS = 4  # ramp points are held to a tenth of a millimetre, so equal places compare equal
TOUCH_M = 1e-3  # ends of parallel lines this near touch; whether they overlap is decided by the rounding of their coordinates
EDGE_TOLERANCE_M = 1e-6  # a hull corner lies on the rim of its own slots and counts as inside


def _held(c: Column) -> Column:
    return F.round(c, POINT_DIGITS)


def _key(*parts: tuple[Column, int]) -> Column:
    """Sort key from integers of any sign, wide enough for every long.

    Non-negative numbers are padded to their width, which longer ones exceed with a
    leading mark; negative ones come first, the least foremost.
    """
    def one(c: Column, n: int) -> Column:
        text = c.cast("string")
        plain = F.when(F.length(text) <= n, F.lpad(text, n, "0")).otherwise(F.concat(F.lit("~"), F.lpad(text, 20, "0")))
        below = F.concat(F.lit("!"), F.lpad(c.cast("long").bitwiseXOR(F.lit(-(1 << 63))).cast("string"), 20, "0"))
        return F.when(c >= 0, plain).otherwise(below)

    return F.concat(*[one(c, n) for c, n in parts])


def sidewalk_lines(facilities: DataFrame, segments: DataFrame) -> DataFrame:
    """Sidewalk geometry with the facts of its street that junction work needs."""
    sw = facilities.where("facility = 'sidewalk' AND utm IS NOT NULL").select("seg_id", "side", "utm", "presence")
    a, b = G.first_pt(F.col("street")), G.last_pt(F.col("street"))
    st = segments.withColumnRenamed("utm", "street").select(
        "seg_id", "start_node", "end_node", "start_is_intersection", "end_is_intersection", "name", "highway", "grid_id",
        a.alias("start_pt"), b.alias("end_pt"))
    return sw.join(shuffled(st), "seg_id")


def endpoint_registry(sidewalks: DataFrame) -> DataFrame:
    """Sidewalk ends at intersection nodes: one row per (node, street, side, end)."""
    def arm(end: str, e: int) -> DataFrame:
        first, second = (F.element_at("utm", 1), F.element_at("utm", 2)) if end == "start" else (F.element_at("utm", -1), F.element_at("utm", -2))
        return sidewalks.where(f"{end}_is_intersection").select(
            F.col(f"{end}_node").alias("node_id"), F.col(f"{end}_pt.x").alias("nx"), F.col(f"{end}_pt.y").alias("ny"),
            "seg_id", "side", F.lit(end).alias("pos"), "name", "grid_id", first["x"].alias("px"), first["y"].alias("py"),
            (first["x"] - second["x"]).alias("dx"), (first["y"] - second["y"]).alias("dy"), "utm",
            _key((F.lit(e), 1), (F.col("seg_id"), 18), (F.when(F.col("side") == "left", 0).otherwise(1), 1)).alias("arm"))
    return arm("start", 0).unionByName(arm("end", 1))


def nearest_end_ramps(arms: DataFrame) -> DataFrame:
    """First ramp source: the sidewalk end nearer to the node."""
    a, b = G.first_pt(F.col("utm")), G.last_pt(F.col("utm"))
    near_a = G.dist(a["x"], a["y"], F.col("nx"), F.col("ny")) <= G.dist(b["x"], b["y"], F.col("nx"), F.col("ny"))
    p = F.when(near_a, a).otherwise(b)
    return arms.select("node_id", "nx", "ny", "seg_id", "side", "pos", "grid_id", _held(p["x"]).alias("x"), _held(p["y"]).alias("y"),
                       F.concat(F.lit("1"), "arm").alias("ord"))


def _straight_on(a: list[tuple[Column, Column]], b: list[tuple[Column, Column]]) -> Column:
    """Ends of segment a, as points, at which a parallel segment b goes on from it; one that runs along it does not."""
    def end(i: int, k: int) -> Column:
        (px, py), (fx, fy), (qx, qy), (gx, gy) = a[i], a[1 - i], b[k], b[1 - k]
        return F.when((G.dist(px, py, qx, qy) <= TOUCH_M) & ((fx - px) * (gx - qx) + (fy - py) * (gy - qy) < 0), G.pt(px, py))
    return F.array(*[end(i, k) for i in (0, 1) for k in (0, 1)])


def pair_crossings(arms: DataFrame, reach: float = 15.0) -> DataFrame:
    """Crossing points, within ``reach`` of the node, of two sidewalks meeting at it.

    Parallel pieces, such as those of a sidewalk that goes straight on, meet where they touch end to end.
    Only the pieces near the node are compared, on small cells, so a busy node
    compares neighbours rather than all pairs.
    """
    p = G.pieces(arms, "utm", ["node_id", "nx", "ny", "seg_id", "side", "pos", "grid_id", "arm"])
    lo, hi = -reach, reach
    p = p.where((F.least("ax", "bx") - F.col("nx") <= hi) & (F.greatest("ax", "bx") - F.col("nx") >= lo)
                & (F.least("ay", "by") - F.col("ny") <= hi) & (F.greatest("ay", "by") - F.col("ny") >= lo))
    # cells relative to the node, clamped to its surroundings
    def clip(c: str, n: str, side: float) -> Column:
        return F.greatest(F.lit(lo), F.least(F.lit(hi), F.col(c) - F.col(n)))
    cells = SP.on_cells(p, clip("ax", "nx", lo), clip("ay", "ny", lo), clip("bx", "nx", hi), clip("by", "ny", hi), TOUCH_M, PAIR_CELL_M)
    a = cells
    b = cells.select("node_id", "cx", "cy", *[F.col(c).alias("o_" + c) for c in ("seg_id", "side", "pos", "grid_id", "arm", "k", "ax", "ay", "bx", "by")])
    j = a.join(shuffled(b), ["node_id", "cx", "cy"]).where((F.col("arm") < F.col("o_arm")) & ~((F.col("seg_id") == F.col("o_seg_id")) & (F.col("side") == F.col("o_side"))))
    hit = G.seg_cross(*[F.col(c) for c in ("ax", "ay", "bx", "by", "o_ax", "o_ay", "o_bx", "o_by")])
    (pa, pb), (qa, qb) = [[(F.col(s + "x"), F.col(s + "y")) for s in (o + "a", o + "b")] for o in ("", "o_")]
    ways = (pb[0] - pa[0], pb[1] - pa[1], qb[0] - qa[0], qb[1] - qa[1])
    parallel = ~G.not_parallel(G.cross(*ways), *ways)
    # the first place is unfolded, not filtered: a filter on the point would be pushed into the join as many copies of its expression
    places = F.array_compact(F.concat(F.when(parallel, _straight_on([pa, pb], [qa, qb])).otherwise(F.array()), F.array(hit)))
    j = j.withColumn("p", F.explode(F.slice(places, 1, 1))).withColumns({"x": _held(F.col("p.x")), "y": _held(F.col("p.y"))})
    return (j.where(G.dist(F.col("x"), F.col("y"), F.col("nx"), F.col("ny")) <= reach)
            .select("node_id", "nx", "ny", "seg_id", "side", "pos", "grid_id", "arm", "o_seg_id", "o_side", "o_pos", "o_grid_id", "o_arm", "x", "y")
            .distinct())


def crossing_ramps(crossings: DataFrame) -> DataFrame:
    """Second ramp source: a crossing point serves both sidewalks."""
    o = F.concat(F.lit("2"), "arm", "o_arm", _key((F.round(F.col("x") * 1000).cast("long"), 12)))
    return crossings.select("node_id", "nx", "ny", "x", "y", F.explode(F.array(
        F.struct("seg_id", "side", "pos", "grid_id", F.concat(o, F.lit("0")).alias("ord")),
        F.struct(F.col("o_seg_id").alias("seg_id"), F.col("o_side").alias("side"), F.col("o_pos").alias("pos"),
                 F.col("o_grid_id").alias("grid_id"), F.concat(o, F.lit("1")).alias("ord")))).alias("s")).select(
        "node_id", "nx", "ny", "s.seg_id", "s.side", "s.pos", "s.grid_id", "x", "y", "s.ord")


def shared_nodes(segments: DataFrame, is_arm: Column) -> DataFrame:
    """Nodes, other than the junction itself, where two walking arms of a junction meet again."""
    s = segments.where(is_arm)
    def ends(this: str, far: str, e: int) -> DataFrame:
        pt = G.first_pt(F.col("utm")) if far == "start" else G.last_pt(F.col("utm"))
        me = G.first_pt(F.col("utm")) if this == "start" else G.last_pt(F.col("utm"))
        return s.where(f"{this}_is_intersection AND start_node <> end_node").select(
            F.col(f"{this}_node").alias("node_id"), F.col(f"{far}_node").alias("shared_id"), "seg_id", "grid_id",
            me["x"].alias("nx"), me["y"].alias("ny"), _held(pt["x"]).alias("x"), _held(pt["y"]).alias("y"),
            _key((F.lit(e), 1), (F.col("seg_id"), 18)).alias("arm"))
    both = ends("start", "end", 0).unionByName(ends("end", "start", 1))
    # two arms share the far node exactly when the (node, far node) group has two members
    g = both.groupBy("node_id", "shared_id").agg(
        F.count_distinct("seg_id").alias("n"), F.min_by(F.struct("seg_id", "grid_id", "nx", "ny", "x", "y", "arm"), "arm").alias("f"))
    return g.where("n >= 2").select("node_id", "shared_id", "f.*")


def shared_ramps(shared: DataFrame) -> DataFrame:
    """Third ramp source; the point is booked on the left start slot of its first arm."""
    return shared.select("node_id", "nx", "ny", "seg_id", F.lit("left").alias("side"), F.lit("start").alias("pos"), "grid_id",
                         "x", "y", F.concat(F.lit("3"), "arm", _key((F.abs("shared_id"), 18))).alias("ord"))


def presnap(ramps: DataFrame, snap_m: float = 1.0) -> DataFrame:
    """Ramp points of a node closer than ``snap_m`` move to their common middle.

    The outcome of handling pairs in order is that a point ends in the middle
    between itself and its last close partner, which is an aggregate.
    """
    places = ramps.groupBy("node_id", "x", "y").agg(F.max("ord").alias("last"))
    a = places.select("node_id", "x", "y", SP.cell(F.col("x"), snap_m).alias("cx"), SP.cell(F.col("y"), snap_m).alias("cy"))
    b = SP.on_cells(places.select("node_id", F.col("x").alias("ox"), F.col("y").alias("oy"), "last"),
                    F.col("ox"), F.col("oy"), F.col("ox"), F.col("oy"), snap_m, snap_m)
    d = G.dist(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
    near = (a.join(shuffled(b), ["node_id", "cx", "cy"]).withColumn("d", d).where((F.col("d") > 0) & (F.col("d") < snap_m))
            .groupBy("node_id", "x", "y").agg(F.max_by(F.struct("ox", "oy"), "last").alias("p")))
    j = ramps.join(near, ["node_id", "x", "y"], "left")
    return (j.withColumns({"sx": F.coalesce((F.col("x") + F.col("p.ox")) / 2, F.col("x")),
                           "sy": F.coalesce((F.col("y") + F.col("p.oy")) / 2, F.col("y"))}).drop("p"))


def ramp_points(arms: DataFrame, segments: DataFrame, params: Params = Params(), is_arm: Column | None = None) -> DataFrame:
    """All ramp points of junctions with at least two of them, after pre-snapping."""
    is_arm = tags.is_walk_arm(F.col("highway")) if is_arm is None else is_arm
    # counted, paired and read again below
    all_points = stage(nearest_end_ramps(arms).unionByName(crossing_ramps(pair_crossings(arms, params.hull_ramp_max_m)))
                       .unionByName(shared_ramps(shared_nodes(segments, is_arm))), "all-ramp-points")
    counts = all_points.groupBy("node_id").agg(F.count("*").alias("n_ramps")).where("n_ramps >= 2")
    return presnap(all_points.join(counts, "node_id"), params.curb_ramp_snap_m)


def assign_ramp_slots(points: DataFrame, taken: DataFrame | None = None, quality: str = "topology") -> DataFrame:
    """Up to three ramp slots per (street, side, end), in order, free slots only."""
    keys = ["seg_id", "side", "pos"]
    ranked = points.withColumn("rk", F.row_number().over(W.partitionBy(*keys).orderBy("ord"))).where("rk <= 3")
    if taken is None:
        out = ranked.withColumnRenamed("rk", "n")
    else:
        used = taken.groupBy(*keys).agg(F.collect_set("n").alias("used"))  # at most three values
        free = F.array_except(F.array(*[F.lit(i) for i in (1, 2, 3)]), F.coalesce("used", F.expr("CAST(array() AS array<int>)")))
        out = (ranked.join(used, keys, "left").withColumn("n", F.try_element_at(free, F.col("rk"))).where("n IS NOT NULL").drop("rk", "used"))
    ident = F.concat_ws("_", "grid_id", F.lit("CR"), "side", "pos", F.col("n").cast("string"))
    return out.withColumns({"ramp_id": ident, "quality": F.lit(quality)})


def curb_ramps(points: DataFrame) -> DataFrame:
    p = points.select("node_id", "seg_id", "side", "pos", "grid_id", F.col("sx").alias("x"), F.col("sy").alias("y"), "ord")
    return assign_ramp_slots(p).drop("ord", "grid_id")


def convex_hulls(points: DataFrame, key: str) -> DataFrame:
    """Hull per key of (key, x, y): partial hulls of bounded groups, then the hull of their corners.

    A key with n points is cut into about sqrt(n) groups, so no task folds a whole
    hot key; only hull corners reach the second step.
    """
    p = points.select(key, "x", "y").distinct()
    n = p.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > HULL_GROUP).select(
        key, F.ceil(F.sqrt("_n")).cast("int").alias("_parts"))  # at most rows / HULL_GROUP keys
    p = p.join(n, key, "left").withColumn(
        "_part", F.pmod(F.xxhash64("x", "y"), F.coalesce("_parts", F.lit(1))))
    corners = p.groupBy(key, "_part").agg(G.hull_ring(F.collect_list(F.struct("x", "y"))).alias("h"), F.count("*").alias("_c"),
                                          F.min(F.struct("x", "y")).alias("lo"), F.max(F.struct("x", "y")).alias("hi"))
    # flat or tiny groups keep their extreme points; a key that is flat as a whole is its own two extremes
    pts = F.when(F.size("h") >= 3, F.col("h")).otherwise(F.array("lo", "hi"))
    second = corners.groupBy(key).agg(F.flatten(F.collect_list(pts)).alias("pts"), F.sum("_c").alias("n_points"),
                                      F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    second = second.withColumn("ring", G.hull_ring(F.array_distinct("pts")))
    ends = F.array_distinct(F.array("lo", "hi"))
    return second.select(key, "n_points", F.when(F.size("ring") >= 3, F.array_distinct("pts")).otherwise(ends).alias("pts"), "ring")


TWO_POINT_HALF_WIDTH_M = 1.0


def build_hulls(points: DataFrame, reach: float = 15.0) -> DataFrame:
    """Intersection zones: hull of the ramp points near each node; two points give a thin rectangle."""
    near = points.where(G.dist(F.col("sx"), F.col("sy"), F.col("nx"), F.col("ny")) <= reach)
    h = convex_hulls(near.select("node_id", F.col("sx").alias("x"), F.col("sy").alias("y")), "node_id")
    a, b = F.element_at("pts", 1), F.element_at("pts", 2)
    thin = G.hull_ring(G.buffer_flat(a["x"], a["y"], b["x"], b["y"], TWO_POINT_HALF_WIDTH_M))
    ring = F.when(F.size("ring") >= 3, F.col("ring")).when(F.size("pts") == 2, thin)
    counts = points.groupBy("node_id").agg(F.any_value("n_ramps").alias("n_ramps"))
    # two places are enough for a ring; a filter on the ring itself would be pushed down as copies of its whole expression
    return h.where("n_points >= 2").withColumn("ring", ring).select("node_id", "ring").join(counts, "node_id")


def node_arms(segments: DataFrame) -> DataFrame:
    """(node_id, seg_id, arm): streets ending at each intersection node, starts before ends."""
    s = segments.where("start_is_intersection").select(F.col("start_node").alias("node_id"), "seg_id", _key((F.lit(0), 1), (F.col("seg_id"), 18)).alias("arm"))
    e = segments.where("end_is_intersection").select(F.col("end_node").alias("node_id"), "seg_id", _key((F.lit(1), 1), (F.col("seg_id"), 18)).alias("arm"))
    return s.unionByName(e)


def captive_sidewalks(sidewalks: DataFrame, hulls: DataFrame, threshold: float = 0.80, separate_only: bool = True) -> DataFrame:
    """Sidewalks with at least ``threshold`` of their length in a hull at either end; adds share and hull node."""
    sw = sidewalks.where(F.lower("presence") == "separate") if separate_only else sidewalks
    ends = sw.select("seg_id", "side", "utm", F.explode(F.array_distinct(F.array("start_node", "end_node"))).alias("node_id"))
    f = ends.join(hulls.select("node_id", "hull_id", "ring") if "hull_id" in hulls.columns else hulls.select("node_id", F.col("node_id").alias("hull_id"), "ring"), "node_id")
    f = f.withColumn("share", F.round(G.frac_inside(F.col("utm"), F.col("ring")), 9))
    best = f.groupBy("seg_id", "side").agg(F.max("share").alias("share"), F.min_by("hull_id", F.struct(-F.col("share"), "hull_id")).alias("hull_id"))
    return best.where(F.col("share") >= threshold)


def hull_pairs(hulls: DataFrame, buffer_m: float = 10.0) -> DataFrame:
    """(a, b, gap) for hulls whose buffers meet.  Hulls reach 15 m from their node, so none holds another at a distance."""
    closed = F.concat("ring", F.slice("ring", 1, 1))
    lines = hulls.select("node_id", closed.alias("ring"))
    near = SP.lines_near_lines(lines.select(F.col("node_id").alias("a_id"), "ring"), lines.select(F.col("node_id").alias("b_id"), "ring"),
                               2 * buffer_m, line="ring")
    return near.where("a_id < b_id").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.col("d").alias("gap"))


def connected_components(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, component): least id reachable over ``pairs`` (a, b).

    Each round takes the least label among neighbours, then jumps to the label of
    the label, which shortens long paths quickly; a label only ever falls, so the loop
    ends, when none changes.  Rounds are stage tables.
    """
    both = stage(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "pairs")
    touched = both.select(F.col("a").alias("id")).distinct()
    labels = stage(touched.withColumn("label", F.col("id")), "labels")
    while True:
        seen = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        hooked = (labels.join(seen.withColumnRenamed("a", "id"), "id")
                  .select("id", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        hooked = stage(hooked, "hooked")
        # label of the label, looked up once per distinct label; a label shared by very many ids is a
        # skewed side that the adaptive join splits, as the other side has one row for it
        hop = hooked.select(F.col("label").alias("l")).distinct().join(hooked.select(F.col("id").alias("l"), F.col("label").alias("up")), "l")
        jumped = hooked.join(hop, F.col("label") == F.col("l")).select("id", "old", F.least("label", "up").alias("label"))
        labels = stage(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            break
        labels = labels.drop("old")
    alone = ids.join(touched, "id", "left_anti").select("id", F.col("id").alias("component"))
    return labels.select("id", F.col("label").alias("component")).unionByName(alone)


def merge_hulls(hulls: DataFrame, components: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged hulls, members): hull of the union, summed ramps; members keep every node of a merged hull."""
    members = components.select(F.col("id").alias("node_id"), F.col("component").alias("hull_id"))
    j = hulls.join(members, "node_id")
    rings = convex_hulls(j.select("hull_id", F.explode("ring").alias("p")).select("hull_id", "p.x", "p.y"), "hull_id").select("hull_id", "ring")
    counts = j.groupBy("hull_id").agg(F.sum("n_ramps").alias("n_ramps"), F.count("*").alias("n_nodes"))
    return rings.join(counts, "hull_id"), members


def junction_zones(points: DataFrame, params: Params = Params(),
                   links: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node hulls, merged hulls, members) as stage tables; ``links`` of the hulls, (a, b), forces chosen ones together."""
    hulls = stage(build_hulls(points, params.hull_ramp_max_m), "node-hulls")
    pairs = hull_pairs(hulls, params.hull_merge_buffer_m).select("a", "b")
    if links is not None:
        pairs = pairs.unionByName(links(hulls).select("a", "b"))
    comps = connected_components(hulls.select(F.col("node_id").alias("id")), pairs)
    merged, members = merge_hulls(hulls, comps)
    return hulls, stage(merged, "hulls"), stage(members, "members")


def crosswalk_slots(hulls: DataFrame, half_width: float = 3.0, min_face: float = 0.5) -> DataFrame:
    """One rectangular slot per hull face of at least ``min_face`` metres, in face coordinates."""
    s = hulls.select("hull_id", F.posexplode(G.ring_edges(F.col("ring"))).alias("face", "e")).select("hull_id", "face", "e.*")
    s = s.withColumn("len", G.dist(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))).where(F.col("len") >= min_face)
    return s.select("hull_id", "face", "ax", "ay", "bx", "by", ((F.col("ax") + F.col("bx")) / 2).alias("mx"), ((F.col("ay") + F.col("by")) / 2).alias("my"),
                    ((F.col("bx") - F.col("ax")) / F.col("len")).alias("ux"), ((F.col("by") - F.col("ay")) / F.col("len")).alias("uy"),
                    (F.col("len") / 2).alias("hl"), F.lit(float(half_width)).alias("hw"))


def in_slot(x: Column, y: Column) -> Column:
    """Is a point inside the slot of the same row?"""
    u = (x - F.col("mx")) * F.col("ux") + (y - F.col("my")) * F.col("uy")
    v = (y - F.col("my")) * F.col("ux") - (x - F.col("mx")) * F.col("uy")
    return (F.abs(u) <= F.col("hl") + EDGE_TOLERANCE_M) & (F.abs(v) <= F.col("hw") + EDGE_TOLERANCE_M)


def slot_clip(df: DataFrame, ax: str = "sax", ay: str = "say", bx: str = "sbx", by: str = "sby") -> DataFrame:
    """Add (t0, t1), the span of a segment inside the slot of the same row (empty when t0 > t1)."""
    c = F.col
    df = df.withColumns({
        "_u": (c(ax) - c("mx")) * c("ux") + (c(ay) - c("my")) * c("uy"), "_v": (c(ay) - c("my")) * c("ux") - (c(ax) - c("mx")) * c("uy"),
        "_du": (c(bx) - c(ax)) * c("ux") + (c(by) - c(ay)) * c("uy"), "_dv": (c(by) - c(ay)) * c("ux") - (c(bx) - c(ax)) * c("uy")})

    def bounds(p: str, d: str, h: str) -> tuple[Column, Column]:
        a, b = (-c(h) - c(p)) / F.nullif(c(d), F.lit(0.0)), (c(h) - c(p)) / F.nullif(c(d), F.lit(0.0))
        out = F.abs(c(p)) > c(h)
        return (F.when(c(d) == 0, F.when(out, 2.0).otherwise(0.0)).otherwise(F.least(a, b)),
                F.when(c(d) == 0, F.when(out, -1.0).otherwise(1.0)).otherwise(F.greatest(a, b)))

    (u0, u1), (v0, v1) = bounds("_u", "_du", "hl"), bounds("_v", "_dv", "hw")
    return df.withColumns({"t0": F.greatest(F.lit(0.0), u0, v0), "t1": F.least(F.lit(1.0), u1, v1)}).drop("_u", "_v", "_du", "_dv")
