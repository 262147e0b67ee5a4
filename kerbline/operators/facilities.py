"""Sidewalks and bikeways: matching of separately mapped lines, slots, offsets, ids, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.config import Params
from kerbline.functions import geom as G, tags
from kerbline.operators.spatial import lines_near_lines
from kerbline.staging import shuffled, stage

DEDUP_BUFFER_M, DEDUP_COVERAGE = 1.0, 0.90
CAPACITY = {"sidewalk": 1, "bikeway": 2}
NAME_BONUS_M = 10.0


def facility_lines(lines: DataFrame) -> DataFrame:
    """Rows that are separately mapped facilities: (fac_id, kind, name, surface, bearing, utm, edge_id).

    ``edge_id`` names the street edge that a facility is itself, where the input has it.
    """
    none = F.lit(None).cast("string")
    bicycle = F.col("bicycle") if "bicycle" in lines.columns else none
    footway = F.col("footway") if "footway" in lines.columns else none
    surface = F.col("surface") if "surface" in lines.columns else none
    bike, foot = tags.is_cycleway(F.col("highway"), bicycle), tags.is_footway(F.col("highway"), bicycle)
    crossing = tags.is_crossing(F.col("highway"), footway)
    return (lines.withColumn("kind", F.when(bike, "bikeway").when(foot & ~crossing, "sidewalk")).where("kind IS NOT NULL")
            .select("fac_id", "kind", "name", surface.alias("surface"), G.bearing(F.col("utm")).alias("fac_bearing"), "utm",
                    (F.col("edge_id") if "edge_id" in lines.columns else F.lit(None)).cast("long").alias("edge_id")))


def candidates(facs: DataFrame, roads: DataFrame, params: Params = Params()) -> DataFrame:
    """Facility-road pairs within the match radius with name and direction agreement."""
    a = facs.select(F.col("fac_id").alias("a_id"), "kind", F.nullif(F.trim("name"), F.lit("")).alias("fac_name"), "fac_bearing", "utm")
    b = roads.select(F.col("seg_id").alias("b_id"), F.trim("name").alias("road_name"), "normalized_bearing", "utm")
    near = lines_near_lines(a, b, params.match_radius_m, keep_a=["kind", "fac_name", "fac_bearing"], keep_b=["road_name", "normalized_bearing"])
    return near.select(
        F.col("a_id").alias("fac_id"), F.col("b_id").alias("seg_id"), "kind", "d",
        F.coalesce(F.col("fac_name") == F.col("road_name"), F.lit(False)).alias("same_name"),
        (G.axis_diff(F.col("fac_bearing"), F.col("normalized_bearing")) <= params.parallel_deg).alias("parallel"))


def add_capsule_span(df: DataFrame, radius: float) -> DataFrame:
    """Add ``s``: the span (t0, t1) of segment a-b within ``radius`` of segment c-e, null when empty.

    The neighbourhood of a segment is convex, so the span is the hull of the spans
    inside its two end discs and its flat middle.  Expects ax..by and cx..ey; each
    step computes its values once.
    """
    c = F.col
    inf = float("inf")
    df = df.withColumns({"_dx": c("bx") - c("ax"), "_dy": c("by") - c("ay"), "_lx": c("ex") - c("cx"), "_ly": c("ey") - c("cy")})
    df = df.withColumns({"_dd": c("_dx") * c("_dx") + c("_dy") * c("_dy"), "_ll": F.sqrt(c("_lx") * c("_lx") + c("_ly") * c("_ly")),
                         **{f"_q{i}": (c("ax") - c(x)) * c("_dx") + (c("ay") - c(y)) * c("_dy") for i, (x, y) in enumerate((("cx", "cy"), ("ex", "ey")))},
                         **{f"_r{i}": (c("ax") - c(x)) * (c("ax") - c(x)) + (c("ay") - c(y)) * (c("ay") - c(y)) - radius * radius
                            for i, (x, y) in enumerate((("cx", "cy"), ("ex", "ey")))}})
    df = df.withColumns({"_ux": F.coalesce(c("_lx") / F.nullif(c("_ll"), F.lit(0.0)), F.lit(1.0)),
                         "_uy": F.coalesce(c("_ly") / F.nullif(c("_ll"), F.lit(0.0)), F.lit(0.0)),  # a point has any direction
                         
                         **{f"_h{i}": c(f"_q{i}") * c(f"_q{i}") - c("_dd") * c(f"_r{i}") for i in (0, 1)}})
    df = df.withColumns({"_pu": (c("ax") - c("cx")) * c("_ux") + (c("ay") - c("cy")) * c("_uy"), "_du": c("_dx") * c("_ux") + c("_dy") * c("_uy"),
                         "_pv": (c("ay") - c("cy")) * c("_ux") - (c("ax") - c("cx")) * c("_uy"), "_dv": c("_dy") * c("_ux") - c("_dx") * c("_uy"),
                         **{f"_w{i}": F.sqrt(F.greatest(c(f"_h{i}"), F.lit(0.0))) for i in (0, 1)}})

    def slab(p: str, d: str, lo: Column, hi: Column, first: bool) -> Column:
        flat, inside = F.abs(c(d)) < 1e-12, (c(p) >= lo) & (c(p) <= hi)
        a, b = (lo - c(p)) / F.nullif(c(d), F.lit(0.0)), (hi - c(p)) / F.nullif(c(d), F.lit(0.0))
        if first:
            return F.when(flat, F.when(inside, -inf).otherwise(inf)).otherwise(F.least(a, b))
        return F.when(flat, F.when(inside, inf).otherwise(-inf)).otherwise(F.greatest(a, b))

    zero, r = F.lit(0.0), F.lit(radius)
    df = df.withColumns({"_u0": slab("_pu", "_du", zero, c("_ll"), True), "_u1": slab("_pu", "_du", zero, c("_ll"), False),
                         "_v0": slab("_pv", "_dv", -r, r, True), "_v1": slab("_pv", "_dv", -r, r, False)})
    df = df.withColumns({"_m0": F.greatest("_u0", "_v0"), "_m1": F.least("_u1", "_v1")})
    spans = F.filter(F.array(*[F.when(c(f"_h{i}") >= 0, F.struct(((-c(f"_q{i}") - c(f"_w{i}")) / F.nullif(c("_dd"), F.lit(0.0))).alias("t0"),
                                                               ((-c(f"_q{i}") + c(f"_w{i}")) / F.nullif(c("_dd"), F.lit(0.0))).alias("t1"))) for i in (0, 1)],
                             F.when(c("_m0") <= c("_m1"), F.struct(c("_m0").alias("t0"), c("_m1").alias("t1")))), lambda x: x.isNotNull())
    df = df.withColumn("_spans", spans)
    df = df.withColumns({"_t0": F.greatest(zero, F.array_min(F.transform("_spans", lambda x: x["t0"]))),
                         "_t1": F.least(F.lit(1.0), F.array_max(F.transform("_spans", lambda x: x["t1"])))})
    # greatest and least skip nulls, so an empty list must be tested for
    out = F.when((F.size("_spans") > 0) & (c("_t0") < c("_t1")), F.struct(c("_t0").alias("t0"), c("_t1").alias("t1")))
    return df.withColumn("s", out)


def coverage(pairs: DataFrame, roads: DataFrame, facs: DataFrame, radius: float = DEDUP_BUFFER_M) -> DataFrame:
    """(fac_id, seg_id, share): share of each road's length within ``radius`` of the facility line."""
    r = G.pieces(roads.join(pairs.select("seg_id").distinct(), "seg_id", "left_semi"), "utm", ["seg_id"]).select(
        "seg_id", "k", "ax", "ay", "bx", "by", (F.col("m1") - F.col("m0")).alias("len"))
    f = G.pieces(facs.join(pairs.select("fac_id").distinct(), "fac_id", "left_semi"), "utm", ["fac_id"]).select(
        "fac_id", *[F.col(a).alias(b) for a, b in (("ax", "cx"), ("ay", "cy"), ("bx", "ex"), ("by", "ey"))])
    j = pairs.select("fac_id", "seg_id").join(shuffled(r), "seg_id").join(shuffled(f), "fac_id")
    per_piece = add_capsule_span(j, radius).groupBy("fac_id", "seg_id", "k").agg(
        F.any_value("len").alias("len"), F.array_sort(F.collect_list("s")).alias("spans"))
    zero = F.struct(F.lit(0.0).alias("end"), F.lit(0.0).alias("sum"))
    merged = F.aggregate("spans", zero, lambda a, s: F.struct(
        F.greatest(a["end"], s["t1"]).alias("end"),
        (a["sum"] + F.greatest(F.lit(0.0), s["t1"] - F.greatest(a["end"], s["t0"]))).alias("sum")))["sum"]
    return (per_piece.withColumn("c", merged * F.col("len")).groupBy("fac_id", "seg_id")
            .agg((F.sum("c") / F.sum("len")).alias("share")))


def coincident(cand: DataFrame, roads: DataFrame, facs: DataFrame) -> DataFrame:
    """Road rows that trace a footway almost wholly: mistagged copies of it."""
    close = cand.where((F.col("kind") == "sidewalk") & (F.col("d") <= DEDUP_BUFFER_M))
    return coverage(close, roads, facs).where(F.col("share") > DEDUP_COVERAGE).select("fac_id", "seg_id", "share")


def best_road(cand: DataFrame) -> DataFrame:
    """Road per facility: same name nearest first, else nearest roughly parallel."""
    ok = cand.where("same_name OR parallel")
    best = F.min(F.struct((~F.col("same_name")).alias("n"), F.round("d", 6).alias("r"), "seg_id")).alias("m")
    return ok.groupBy("fac_id", "kind").agg(best).select("fac_id", "kind", F.col("m.seg_id").alias("seg_id"))


def best_road_by_score(cand: DataFrame) -> DataFrame:
    """Second-round choice: distance less a bonus for the same name, roughly parallel only."""
    score = F.round(F.col("d") - F.when(F.col("same_name"), NAME_BONUS_M).otherwise(0.0), 6)
    best = F.min(F.struct(score.alias("r"), "seg_id")).alias("m")
    return cand.where("parallel").groupBy("fac_id", "kind").agg(best).select("fac_id", "kind", F.col("m.seg_id").alias("seg_id"))


def with_side(matches: DataFrame, roads: DataFrame, facs: DataFrame) -> DataFrame:
    """Side of the road on which the middle of the facility lies."""
    f = facs.select("fac_id", G.interpolate(G.measured(F.col("utm")), G.length(F.col("utm")) / 2).alias("mid"))
    j = matches.join(shuffled(roads.select("seg_id", "utm")), "seg_id").join(shuffled(f), "fac_id")
    side = G.side_of(G.measured(F.col("utm")), F.col("mid.x"), F.col("mid.y"))
    return j.withColumn("side", side).drop("utm", "mid")


def assign_slots(matches: DataFrame, taken: DataFrame | None = None) -> DataFrame:
    """Slots in facility order up to capacity per (road, side, kind), skipping taken slots.

    The choice of road does not depend on what is already placed, so ranking gives
    the same result as placing one by one.  The literal bound on the rank lets the
    optimizer cut each group before the shuffle.
    """
    keys = ["seg_id", "side", "kind"]
    ranked = matches.withColumn("rk", F.row_number().over(W.partitionBy(*keys).orderBy("fac_id"))).where(
        F.col("rk") <= max(CAPACITY.values()))
    if taken is None:
        return ranked.where(F.col("rk") <= F.when(F.col("kind") == "bikeway", 2).otherwise(1)).withColumnRenamed("rk", "slot")
    used = taken.groupBy(*keys).agg(F.array_sort(F.collect_set("slot")).alias("used"))
    free = F.array_except(F.when(F.col("kind") == "bikeway", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))),
                          F.coalesce("used", F.expr("CAST(array() AS array<int>)")))
    return (ranked.join(used, keys, "left").withColumn("slot", F.try_element_at(free, F.col("rk")))
            .where("slot IS NOT NULL").drop("rk", "used"))


def match_separate(facs: DataFrame, roads: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First matching round: (placements, duplicate roads with centreline, orphan duplicates).

    All duplicates are found before any redirection, so the result does not depend on order.
    """
    cand = stage(candidates(facs, roads, params), "candidates")  # read by each step below
    dup_pairs = stage(coincident(cand, roads, facs), "coincident")
    chosen = stage(best_road(cand.join(dup_pairs.select("fac_id", "seg_id"), ["fac_id", "seg_id"], "left_anti")), "chosen")
    dup_of = (dup_pairs.join(chosen.select("fac_id", F.col("seg_id").alias("center_id")), "fac_id", "left")
              .groupBy("seg_id").agg(F.min_by("center_id", F.struct(F.col("center_id").isNull(), F.col("fac_id"))).alias("center_id")))
    duplicates = dup_of.where("center_id IS NOT NULL AND center_id <> seg_id")
    orphans = dup_of.where("center_id IS NULL").select("seg_id")
    redirected = (chosen.join(duplicates, "seg_id", "left")
                  .withColumn("seg_id", F.coalesce("center_id", "seg_id")).drop("center_id"))
    return assign_slots(with_side(redirected, roads, facs)), duplicates, orphans


def match_leftovers(facs: DataFrame, roads: DataFrame, placed: DataFrame, taken: DataFrame,
                    params: Params = Params()) -> DataFrame:
    """Second matching round: facilities not yet placed, into slots without any geometry.

    ``taken`` lists occupied (seg_id, side, kind, slot), generated offsets included.
    """
    left = facs.join(placed.select("fac_id"), "fac_id", "left_anti")
    chosen = best_road_by_score(candidates(left, roads, params))
    return assign_slots(with_side(chosen, roads, left), taken)


ATTRS = ("presence", "surface", "condition", "width", "incline", "separator", "permitted")


def fill_from_duplicates(rows: DataFrame, duplicates: DataFrame, orphans: DataFrame) -> DataFrame:
    """Centreline slots take the first non-null value of their duplicates; duplicates are dropped."""
    keys = ["seg_id", "facility", "side", "slot"]
    given = rows.join(duplicates, "seg_id")
    fills = given.groupBy(F.col("center_id").alias("seg_id"), "facility", "side", "slot").agg(
        *[F.min_by(F.when(F.col(a).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col("seg_id"))).alias(f"_{a}") for a in ATTRS])
    gone = duplicates.select("seg_id").unionByName(orphans)
    return (rows.join(gone, "seg_id", "left_anti").join(fills, keys, "left")
            .withColumns({a: F.coalesce(a, f"_{a}") for a in ATTRS}).drop(*[f"_{a}" for a in ATTRS]))


def empty_slots(rows: DataFrame) -> DataFrame:
    """Facility rows with geometry columns still unset."""
    return rows.select("*", F.lit(None).cast("long").alias("fac_id"),
                       F.lit(None).cast("array<struct<x:double,y:double>>").alias("utm"),
                       F.lit(None).cast("string").alias("quality"), F.lit("no").alias("offset"))


def place(rows: DataFrame, placements: DataFrame, facs: DataFrame, fill: bool = False) -> DataFrame:
    """Put matched lines into their slots; with ``fill``, empty presence and surface are filled too."""
    p = placements.join(shuffled(facs.select("fac_id", F.col("utm").alias("_utm"), F.col("surface").alias("_surface"))), "fac_id").select(
        "seg_id", F.col("kind").alias("facility"), "side", "slot", F.col("fac_id").alias("_fac"), "_utm", "_surface")
    j = rows.join(p, ["seg_id", "facility", "side", "slot"], "left")
    hit = F.col("_fac").isNotNull()
    out = {"utm": F.coalesce("_utm", "utm"), "fac_id": F.coalesce("_fac", "fac_id"),
           "quality": F.when(hit, "separate").otherwise(F.col("quality")),
           "offset": F.when(hit, "no").otherwise(F.col("offset"))}
    if fill:
        out["presence"] = F.coalesce("presence", F.when(hit & (F.col("facility") == "sidewalk"), "separate"))
        out["surface"] = F.coalesce("surface", "_surface")
    return j.withColumns(out).drop("_fac", "_utm", "_surface")


def taken_slots(rows: DataFrame) -> DataFrame:
    return rows.where("utm IS NOT NULL").select("seg_id", "side", F.col("facility").alias("kind"), "slot")


def add_offsets(rows: DataFrame, segments: DataFrame, params: Params = Params()) -> DataFrame:
    """Offset geometry for present facilities without a line of their own."""
    street = segments.select(
        "seg_id", F.col("utm").alias("street"),
        (F.coalesce(tags.parse_lanes(F.col("lanes")), F.lit(params.default_lanes))
         * F.coalesce(tags.parse_lane_width(F.col("lane_width")), F.lit(params.default_lane_width)) / 2.0).alias("base"))
    slot1 = F.col("slot") == 1
    needs = slot1 & F.col("utm").isNull() & tags.needs_offset(F.col("presence"))
    side = W.partitionBy("seg_id", "side")  # three rows per side of a street
    bike = F.max(needs & (F.col("facility") == "bikeway")).over(side)
    r = rows.withColumn("_needs", needs).withColumn("_bike", bike).join(shuffled(street), "seg_id")
    d = F.col("base") + F.when((F.col("facility") == "sidewalk") & F.col("_bike"), params.default_bikeway_width).otherwise(0.0)
    d = F.when(F.col("side") == "left", d).otherwise(-d)
    made = F.col("_needs") & (G.length(F.col("street")) >= 1.0)
    return (r.withColumn("_made", made)
            .withColumn("utm", F.when(F.col("_made"), G.offset(F.col("street"), d)).otherwise(F.col("utm")))
            .withColumn("quality", F.when(F.col("_made"), "buffered").otherwise(F.col("quality")))
            .withColumn("offset", F.when(F.col("_made"), "yes").otherwise(F.col("offset")))
            .drop("_needs", "_bike", "_made", "street", "base"))


def add_ids(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Facility ids from the street grid id; bikeway grid ids are shared when either slot may exist."""
    r = rows.join(shuffled(segments.select("seg_id", "grid_id")), "seg_id")
    letter = F.when(F.col("side") == "left", "L").otherwise("R")
    suffix = F.when(F.col("facility") == "sidewalk", letter).otherwise(F.concat(letter, F.col("slot").cast("string")))
    own = ~tags.absent(F.col("presence"))
    either = F.max(own).over(W.partitionBy("seg_id", "side", "facility"))  # at most two rows
    full = F.concat("grid_id", suffix)
    return (r.withColumn("facility_id", F.when(own, full)).withColumn("facility_grid_id", F.when(either, full)).drop("grid_id"))


def facility_ends(rows: DataFrame, segments: DataFrame, crosswalks: DataFrame | None = None) -> DataFrame:
    """(fid, end, node_id) for every facility with an id; a crosswalk touches one node with both ends."""
    f = rows.where("facility_grid_id IS NOT NULL").select("seg_id", F.col("facility_grid_id").alias("fid"))
    j = f.join(segments.select("seg_id", "start_node", "end_node"), "seg_id")
    ends = F.explode(F.array(F.struct(F.lit("from").alias("end"), F.col("start_node").alias("node_id")),
                             F.struct(F.lit("to").alias("end"), F.col("end_node").alias("node_id")))).alias("e")
    out = j.select("fid", ends).select("fid", "e.end", "e.node_id")
    if crosswalks is not None:
        x = crosswalks.join(segments.select("seg_id", "start_node", "end_node"), "seg_id").select(
            F.col("crosswalk_id").alias("fid"), F.when(F.col("pos") == "start", F.col("start_node")).otherwise(F.col("end_node")).alias("node_id"))
        out = out.unionByName(x.select("fid", F.explode(F.array(F.lit("from"), F.lit("to"))).alias("end"), "node_id"))
    return out


def node_members(ends: DataFrame) -> DataFrame:
    """Sorted facility ids per node, one list each; ``facility_ends`` is the linear form for nodes of very many."""
    return ends.select("node_id", "fid").distinct().groupBy("node_id").agg(F.array_sort(F.collect_list("fid")).alias("ids"))


def neighbours(ends: DataFrame) -> DataFrame:
    """Other facilities at each end of a facility, as one sorted id list."""
    return ends.join(node_members(ends), "node_id").select("fid", "end", "node_id", F.array_remove("ids", F.col("fid")).alias("ids"))
