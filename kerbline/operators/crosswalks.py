"""Crosswalks: which street a slot crosses, the candidate cases, priority, attributes, clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.config import Params
from kerbline.functions import geom as G, tags
from kerbline.operators import intersections as IX, spatial as SP
from kerbline.staging import stage, staged

SLOT = ["hull_id", "face"]
FRAME = ["mx", "my", "ux", "uy", "hl", "hw"]
CASES = ("osm_a", "osm_b", "osm_c", "osm_d", "topo_a", "topo_b", "topo_c")
SHORT_M, ATTR_RADIUS_M = 33.0, 22.0
CELL_M = 20.0
BOX_SLACK_M = 1e-3  # boxes further apart than rounding hold no crossing


def hull_arms(arms: DataFrame, members: DataFrame) -> DataFrame:
    """(hull_id, seg_id, arm): streets of every member node, each once."""
    return arms.join(members, "node_id").groupBy("hull_id", "seg_id").agg(F.min("arm").alias("arm"))


def _near_slots(slots: DataFrame) -> DataFrame:
    """Slots on grid cells, for joins that do not go through the hull's arms."""
    r = F.col("hl") + F.col("hw")
    return SP.on_cells(slots, F.col("mx") - r, F.col("my") - r, F.col("mx") + r, F.col("my") + r, 0.0, CELL_M)


def _arm_pieces(arms: DataFrame, lines: DataFrame, hulls: DataFrame, line: str, keep: list[str], pad: float) -> DataFrame:
    """Vertex pairs of the arms' lines that come near their hull; the rest of a long street is dropped early."""
    b = G.bbox(F.col("ring"))
    h = hulls.select("hull_id", b.alias("b"))
    p = G.pieces(lines, line, ["seg_id", *keep])
    j = arms.join(p, "seg_id").join(h, "hull_id")
    near = ((F.least("ax", "bx") <= F.col("b.x1") + pad) & (F.greatest("ax", "bx") >= F.col("b.x0") - pad)
            & (F.least("ay", "by") <= F.col("b.y1") + pad) & (F.greatest("ay", "by") >= F.col("b.y0") - pad))
    out = j.where(near).drop("b")
    for c in ("ax", "ay", "bx", "by"):
        out = out.withColumnRenamed(c, "s" + c)
    return out


def crossed_street(slots: DataFrame, arms: DataFrame, segments: DataFrame, hulls: DataFrame, members: DataFrame) -> DataFrame:
    """Street crossed by each slot: first road arm meeting it, else first arm; with its end at the hull."""
    pieces = _arm_pieces(arms, segments, hulls, "utm", ["highway"], 6.0)
    j = IX.slot_clip(slots.join(pieces, "hull_id")).where("t0 <= t1")
    rank = F.struct((~tags.is_road(F.col("highway"))).alias("r"), "arm", "seg_id")
    best = j.groupBy(*SLOT).agg(F.min(rank).alias("m")).select(*SLOT, F.col("m.seg_id").alias("seg_id"))
    seg = best.join(segments.select("seg_id", "start_node", "end_node"), "seg_id")
    at = seg.join(members.select("hull_id", F.col("node_id").alias("start_node"), F.lit(True).alias("_s")), ["hull_id", "start_node"], "left").join(
        members.select("hull_id", F.col("node_id").alias("end_node"), F.lit(True).alias("_e")), ["hull_id", "end_node"], "left")
    pos = F.when(F.col("_s"), "start").when(F.col("_e"), "end").otherwise("start")
    return at.select(*SLOT, "seg_id", pos.alias("pos"))


def crossing_points(slots: DataFrame, crossings: DataFrame) -> DataFrame:
    """Crossing node inside each slot that lies nearest to the slot's middle."""
    p = crossings.select("osmid", F.col("x").alias("px"), F.col("y").alias("py"), SP.cell(F.col("x"), CELL_M).alias("cx"), SP.cell(F.col("y"), CELL_M).alias("cy"))
    j = _near_slots(slots).join(p, ["cx", "cy"]).where(IX.in_slot(F.col("px"), F.col("py")))
    d = F.round(G.dist(F.col("px"), F.col("py"), F.col("mx"), F.col("my")), 6)
    return j.groupBy(*SLOT).agg(F.min(F.struct(d.alias("d"), "osmid", "px", "py")).alias("m")).select(*SLOT, "m.osmid", "m.px", "m.py")


def ramps_in_slots(slots: DataFrame, arms: DataFrame, ramps: DataFrame) -> DataFrame:
    """Ramps of the hull's arms inside each slot, with their order (arm, side, end, number)."""
    side = F.when(F.col("side") == "left", 0).otherwise(1)
    pos = F.when(F.col("pos") == "start", 0).otherwise(1)
    r = arms.join(ramps.select("seg_id", "side", "pos", "n", F.col("x").alias("rx"), F.col("y").alias("ry")), "seg_id").select(
        "hull_id", "seg_id", "side", "pos", "n", "rx", "ry", F.concat("arm", side.cast("string"), pos.cast("string"), F.col("n").cast("string")).alias("ord"))
    return slots.join(r, "hull_id").where(IX.in_slot(F.col("rx"), F.col("ry"))).select(*SLOT, "seg_id", "side", "pos", "n", "rx", "ry", "ord")


def slot_footways(slots: DataFrame, footways: DataFrame) -> DataFrame:
    """Footways (fac_id, utm) short and wholly inside a slot, or at least 80 % inside."""
    p = G.pieces(footways, "utm", ["fac_id"], max_len=2 * CELL_M)
    for c in ("ax", "ay", "bx", "by"):
        p = p.withColumnRenamed(c, "s" + c)
    p = SP.on_cells(p, F.col("sax"), F.col("say"), F.col("sbx"), F.col("sby"), 0.0, CELL_M)
    # a slot and a piece can meet on several cells: keep the pair once before adding lengths
    j = IX.slot_clip(_near_slots(slots).join(p, ["cx", "cy"])).where("t0 <= t1").select(
        *SLOT, "fac_id", "m0", ((F.col("t1") - F.col("t0")) * (F.col("m1") - F.col("m0"))).alias("inside")).distinct()
    total = footways.select("fac_id", G.length(F.col("utm")).alias("length"))
    f = j.groupBy(*SLOT, "fac_id").agg(F.sum("inside").alias("inside")).join(total, "fac_id")
    f = f.withColumn("share", F.col("inside") / F.nullif(F.col("length"), F.lit(0.0)))
    return f.where((F.col("share") >= 0.8) | ((F.col("length") < SHORT_M) & (F.col("share") >= 1 - 1e-9))).select(*SLOT, "fac_id", "share")


def sidewalk_hits(points: DataFrame, crossed: DataFrame, segments: DataFrame, arms: DataFrame, sidewalks: DataFrame, hulls: DataFrame,
                  params: Params = Params()) -> DataFrame:
    """Rays both ways from a crossing point, square to the street, to the nearest sidewalk or the street width."""
    lanes = F.coalesce(tags.parse_lanes(F.col("lanes")), F.lit(params.default_lanes))
    width = F.coalesce(tags.parse_lane_width(F.col("lane_width")), F.lit(params.default_lane_width))
    s = segments.select("seg_id", F.radians(F.col("normalized_bearing") + 90.0).alias("o"), (lanes * width).cast("double").alias("reach"))
    q = points.join(crossed, SLOT).join(s, "seg_id").withColumn("dir", F.explode(F.array(F.lit(1), F.lit(-1))))
    q = q.select(*SLOT, "dir", "px", "py", (F.col("px") + F.sin("o") * F.col("dir") * F.col("reach")).alias("ex"),
                 (F.col("py") + F.cos("o") * F.col("dir") * F.col("reach")).alias("ey"))
    sw = _arm_pieces(arms, sidewalks.select("seg_id", "side", "utm"), hulls, "utm", ["side"], 60.0).withColumnRenamed("seg_id", "hit_seg").withColumnRenamed("side", "hit_side")
    p = G.seg_cross(*[F.col(c) for c in ("px", "py", "ex", "ey", "sax", "say", "sbx", "sby")], slack=1e-6)
    hits = q.join(sw.drop("arm", "k", "m0", "m1"), "hull_id").withColumn("p", p).where("p IS NOT NULL")
    d = F.round(G.dist(F.col("px"), F.col("py"), F.col("p.x"), F.col("p.y")), 6)
    best = hits.groupBy(*SLOT, "dir").agg(F.min(F.struct(d.alias("d"), "hit_seg", "hit_side", "p")).alias("m"))
    j = q.join(best, [*SLOT, "dir"], "left")
    return j.select(*SLOT, "dir", "px", "py", F.coalesce("m.p.x", "ex").alias("x"), F.coalesce("m.p.y", "ey").alias("y"),
                    F.col("m.hit_seg").alias("hit_seg"), F.col("m.hit_side").alias("hit_side"))


def farthest_pairs(points: DataFrame, x: str, y: str) -> DataFrame:
    """Two most distant points per slot: they are corners of the hull, so only corners are paired."""
    p = points.select(F.struct(*SLOT).alias("slot"), F.col(x).alias("x"), F.col(y).alias("y"))
    h = IX.convex_hulls(p, "slot")
    corners = F.when(F.size("ring") >= 3, F.col("ring")).otherwise(F.col("pts"))
    # a filter on the pair itself would be pushed down as a copy of the hull's whole expression; the aggregate keeps it above
    return h.groupBy("slot").agg(F.any_value(G.farthest_pair(corners)).alias("pair")).where("pair IS NOT NULL").select("slot.*", "pair")


def _case(df: DataFrame, source: str, line: Column) -> DataFrame:
    return df.select(*SLOT, F.lit(CASES.index(source)).alias("rank"), F.lit(source).alias("source"), line.alias("line"))


def case_osm_ab(points: DataFrame, in_slot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Crossing point with two or more ramps (A) or one ramp (B)."""
    r = in_slot.join(points, SLOT)
    counts = r.groupBy(*SLOT).agg(F.count("*").alias("n"), F.any_value("rx").alias("rx"), F.any_value("ry").alias("ry"),
                                  F.any_value("px").alias("px"), F.any_value("py").alias("py"))
    two = counts.where("n >= 2").join(farthest_pairs(r.select(*SLOT, "rx", "ry"), "rx", "ry"), SLOT)
    p = G.pt(F.col("px"), F.col("py"))
    a = _case(two, "osm_a", F.array(F.col("pair")[0], p, F.col("pair")[1]))
    one = counts.where("n = 1")
    b = _case(one, "osm_b", G.line_of(F.col("rx"), F.col("ry"), F.col("px"), F.col("py"), 2 * F.col("px") - F.col("rx"), 2 * F.col("py") - F.col("ry")))
    return a, b


def case_osm_c(hits: DataFrame, in_slot: DataFrame) -> DataFrame:
    """Crossing point without ramps: the two ray ends through the point."""
    free = hits.join(in_slot.select(*SLOT).distinct(), SLOT, "left_anti")
    g = free.groupBy(*SLOT).agg(F.min_by(F.struct("x", "y"), "dir").alias("neg"), F.max_by(F.struct("x", "y"), "dir").alias("pos"),
                                F.any_value("px").alias("px"), F.any_value("py").alias("py"))
    return _case(g, "osm_c", F.array("neg", G.pt(F.col("px"), F.col("py")), F.col("pos")))


def case_osm_d(in_slot: DataFrame, footways: DataFrame) -> DataFrame:
    """Footways inside the slot, chained in id order.  A slot is a few metres wide, so copies are folded first."""
    lines = in_slot.select(*SLOT, "fac_id").join(footways.select("fac_id", "utm"), "fac_id")
    lines = lines.groupBy(*SLOT, "utm").agg(F.min("fac_id").alias("fac_id"))
    g = lines.groupBy(*SLOT).agg(F.array_sort(F.collect_list(F.struct("fac_id", "utm"))).alias("l"))
    return _case(g, "osm_d", F.flatten(F.transform("l", lambda q: q["utm"])))


def case_topo_a(crossed: DataFrame, arms: DataFrame, sidewalks: DataFrame, segments: DataFrame) -> DataFrame:
    """First sidewalk of an arm (left sides first) that crosses the street of the slot.

    Slots of a hull that cross the same street are served together, and lines are compared
    only where their boxes meet.
    """
    street = crossed.select("hull_id", "seg_id").distinct().join(
        segments.select("seg_id", F.col("utm").alias("street"), G.bbox(F.col("utm")).alias("q")), "seg_id")
    side = F.when(F.col("side") == "left", 0).otherwise(1)
    sw = arms.join(sidewalks.select("seg_id", "side", "utm", G.bbox(F.col("utm")).alias("p")), "seg_id").select(
        "hull_id", "utm", "p", F.concat(side.cast("string"), "arm").alias("ord"))
    meet = ((F.col("p.x0") <= F.col("q.x1") + BOX_SLACK_M) & (F.col("q.x0") <= F.col("p.x1") + BOX_SLACK_M)
            & (F.col("p.y0") <= F.col("q.y1") + BOX_SLACK_M) & (F.col("q.y0") <= F.col("p.y1") + BOX_SLACK_M))
    j = street.join(sw, "hull_id").where(meet & (F.size(G.line_cross(F.col("utm"), F.col("street"))) > 0))
    first = j.groupBy("hull_id", "seg_id").agg(F.min_by("utm", "ord").alias("utm"))
    g = crossed.select(*SLOT, "seg_id").join(first, ["hull_id", "seg_id"])
    short = F.array(G.first_pt(F.col("utm")), G.last_pt(F.col("utm")))
    return _case(g, "topo_a", F.when(G.length(F.col("utm")) < SHORT_M, short).otherwise(F.col("utm")))


def case_topo_b(in_slot: DataFrame) -> DataFrame:
    """First two ramps in the slot."""
    two = in_slot.withColumn("rk", F.row_number().over(W.partitionBy(*SLOT).orderBy("ord"))).where("rk <= 2")
    g = two.groupBy(*SLOT).agg(F.count("*").alias("n"), F.min_by(G.pt(F.col("rx"), F.col("ry")), "rk").alias("a"), F.max_by(G.pt(F.col("rx"), F.col("ry")), "rk").alias("b"))
    return _case(g.where("n = 2"), "topo_b", F.array("a", "b"))


def sidewalk_ends_in_slots(slots: DataFrame, arms: DataFrame, sidewalks: DataFrame) -> DataFrame:
    ends = F.explode(F.array(G.first_pt(F.col("utm")), G.last_pt(F.col("utm")))).alias("p")
    e = arms.join(sidewalks.select("seg_id", "side", "utm"), "seg_id").select("hull_id", ends).select("hull_id", F.col("p.x").alias("ex"), F.col("p.y").alias("ey"))
    return slots.join(e, "hull_id").where(IX.in_slot(F.col("ex"), F.col("ey"))).select(*SLOT, "ex", "ey")


def case_topo_c(ends: DataFrame) -> DataFrame:
    """Farthest two sidewalk ends in the slot."""
    f = farthest_pairs(ends, "ex", "ey")
    return _case(f, "topo_c", F.col("pair"))


DRAWN = "manual"  # source of crosswalks drawn by hand


def choose(candidates: DataFrame, crossed: DataFrame) -> DataFrame:
    """First applicable case per slot; a street end is then filled by its first slot only."""
    per_slot = candidates.groupBy(*SLOT).agg(F.min_by(F.struct("source", "line"), "rank").alias("c"))
    j = per_slot.join(crossed, SLOT)
    first = F.min_by(F.struct("hull_id", "face", "c.source", "c.line"), F.struct("hull_id", "face")).alias("f")
    return j.groupBy("seg_id", "pos").agg(first).select("seg_id", "pos", "f.*")


def write(chosen: DataFrame, segments: DataFrame, facilities: DataFrame) -> DataFrame:
    """Crosswalk rows with id, source and the pair of sidewalks connected."""
    ids = facilities.where("facility = 'sidewalk'").groupBy("seg_id").agg(
        F.max(F.when(F.col("side") == "left", F.col("facility_grid_id"))).alias("left"),
        F.max(F.when(F.col("side") == "right", F.col("facility_grid_id"))).alias("right"))
    j = chosen.join(segments.select("seg_id", "grid_id"), "seg_id").join(ids, "seg_id", "left")
    return j.select("seg_id", "pos", "hull_id", "face", "source", F.col("line").alias("utm"), F.concat_ws("_", "grid_id", F.lit("XW"), "pos").alias("crosswalk_id"),
                    F.struct("left", "right").alias("grid_ids"))


def attributes(crosswalks: DataFrame, crossings: DataFrame, radius: float = ATTR_RADIUS_M) -> DataFrame:
    """Attributes of the crossing node within reach of a crosswalk that lies nearest to its centroid."""
    lines = crosswalks.select(F.concat_ws("/", F.col("seg_id").cast("string"), "pos").alias("l_id"), "utm")
    near = SP.points_near_lines(crossings.select(F.col("osmid").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py")), lines, radius)
    c = lines.select("l_id", G.centroid(F.col("utm")).alias("c"))
    j = near.join(c, "l_id").join(crossings.withColumnRenamed("osmid", "p_id"), "p_id")
    d = F.round(G.dist(F.col("x"), F.col("y"), F.col("c.x"), F.col("c.y")), 6)
    best = j.groupBy("l_id").agg(F.min(F.struct(d.alias("d"), "p_id", *tags.CROSSING_ATTRS)).alias("m"))
    k = F.split("l_id", "/")
    found = best.select(k[0].cast("long").alias("seg_id"), k[1].alias("pos"), F.col("m.p_id").alias("osmid"), *[F.col(f"m.{a}").alias(a) for a in tags.CROSSING_ATTRS])
    return crosswalks.join(found, ["seg_id", "pos"], "left")


def new_ramps(hits: DataFrame, chosen: DataFrame, segments: DataFrame, members: DataFrame, ramps: DataFrame) -> DataFrame:
    """Ramps where the rays of a chosen case C met sidewalks, in free slots."""
    used = chosen.where("source = 'osm_c'").select(*SLOT)
    h = hits.where("hit_seg IS NOT NULL").join(used, SLOT).join(segments.select(F.col("seg_id").alias("hit_seg"), "start_node", "grid_id"), "hit_seg")
    m = members.select("hull_id", F.col("node_id").alias("start_node"), F.lit(True).alias("_s"))
    h = h.join(m, ["hull_id", "start_node"], "left")
    rows = h.select(F.col("hit_seg").alias("seg_id"), F.col("hit_side").alias("side"), F.when(F.col("_s"), "start").otherwise("end").alias("pos"),
                    "grid_id", "x", "y", F.concat_ws("/", IX._key((F.col("hull_id"), 18)), IX._key((F.col("face"), 6)),
                                                     F.when(F.col("dir") == 1, "0").otherwise("1")).alias("ord"))
    return IX.assign_ramp_slots(rows, ramps, "osmpoint").drop("ord", "grid_id")


def clear_absorbed(rows: DataFrame, absorbed: DataFrame) -> DataFrame:
    """Drop ramps or sidewalks of segments, ``absorbed`` (seg_id), whose own footway a chain consumed."""
    return rows.join(absorbed.select("seg_id").distinct(), "seg_id", "left_anti")


def absorbed_segments(absorbed: DataFrame, footways: DataFrame, segments: DataFrame) -> DataFrame:
    """(seg_id) of the street edges that consumed footways are; a footway that is no street edge has a null ``edge_id``."""
    own = footways.where("edge_id IS NOT NULL").select("fac_id", "edge_id")
    return absorbed.select("fac_id").distinct().join(own, "fac_id").join(segments.select("edge_id", "seg_id"), "edge_id").select("seg_id")


def clear_stubs(sidewalks: DataFrame, ramps: DataFrame, node_hulls: DataFrame, threshold: float = 0.90) -> tuple[DataFrame, DataFrame]:
    """(kept sidewalks, kept ramps): stubs inside a hull go with their ramps; other ramps inside the best hull go."""
    share = stage(IX.captive_sidewalks(sidewalks, node_hulls, 1e-12, separate_only=False), "stub-share")
    stubs = share.where(F.col("share") >= threshold).select("seg_id", "side")
    rings = node_hulls.select("hull_id", "ring").groupBy("hull_id").agg(F.any_value("ring").alias("ring"))
    best = share.where(F.col("share") < threshold).select("seg_id", "side", "hull_id").join(rings, "hull_id")
    inside = ramps.join(best, ["seg_id", "side"]).where(G.contains_point(F.col("ring"), F.col("x"), F.col("y"))).select("seg_id", "side", "pos", "n")
    kept = ramps.join(stubs, ["seg_id", "side"], "left_anti").join(inside, ["seg_id", "side", "pos", "n"], "left_anti")
    return sidewalks.join(stubs, ["seg_id", "side"], "left_anti"), kept


def detect(slots: DataFrame, arms: DataFrame, segments: DataFrame, sidewalks: DataFrame, ramps: DataFrame, crossings: DataFrame,
           footways: DataFrame, hulls: DataFrame, members: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(chosen, rays, absorbed footways, crossed): the whole case analysis over all slots."""
    crossed = stage(crossed_street(slots, arms, segments, hulls, members), "crossed")
    live = stage(slots.join(crossed.select(*SLOT), SLOT, "left_semi"), "live-slots")
    points, in_slot, walks = staged((crossing_points(live, crossings), "slot-points"), (ramps_in_slots(live, arms, ramps), "slot-ramps"),
                                    (slot_footways(live, footways), "slot-footways"))
    hits = stage(sidewalk_hits(points, crossed, segments, arms, sidewalks, hulls, params), "slot-hits")
    a, b = case_osm_ab(points, in_slot)
    cases = (a.unionByName(b).unionByName(case_osm_c(hits, in_slot)).unionByName(case_osm_d(walks, footways))
             .unionByName(case_topo_a(crossed, arms, sidewalks, segments)).unionByName(case_topo_b(in_slot))
             .unionByName(case_topo_c(sidewalk_ends_in_slots(live, arms, sidewalks))))
    chosen = stage(choose(cases, crossed), "chosen-crosswalks")
    absorbed = walks.join(chosen.where("source = 'osm_d'").select(*SLOT), SLOT, "left_semi").select("fac_id").distinct()
    return chosen, hits, absorbed, crossed
