"""The whole build: inputs to network tables, and the wide one-row-per-segment view."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from kerbline import schema
from kerbline.config import Params
from kerbline.functions import tags
from kerbline.operators import (calming as CA, crosswalks as XW, elevation as EL, facilities as FA, intersections as IX,
                                network as N, ramps as R, snap)
from kerbline.plans.overrides import Overrides
from kerbline.staging import stage


@dataclass
class Inputs:
    edges: DataFrame
    lines: DataFrame            # edges with geom and utm
    nodes: DataFrame
    facility_lines: DataFrame   # separately mapped footways and cycleways
    crossings: DataFrame
    calming: DataFrame
    elevation: DataFrame
    inventory: DataFrame


@dataclass
class Network:
    segments: DataFrame
    facilities: DataFrame
    sidewalks: DataFrame
    ramps: DataFrame
    hulls: DataFrame
    members: DataFrame
    slots: DataFrame
    crosswalks: DataFrame
    calming: DataFrame
    facility_ends: DataFrame
    crossings: DataFrame
    footways: DataFrame
    overrides: Overrides | None = None


def street_facilities(segments: DataFrame, facs: DataFrame, params: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments without duplicates, facility slots, facilities left over)."""
    s = segments.withColumn("_rev", tags.reversed_flag(F.col("normalized_bearing"), F.col("bearing")))
    rows = tags.facility_rows(s, ["seg_id", "_rev"]).withColumn("side", tags.flip_side(F.col("side"), F.col("_rev"))).drop("_rev")
    roads = segments.where(tags.is_road(F.col("highway")))
    placed, duplicates, orphans = FA.match_separate(facs, roads, params)
    placed, duplicates, orphans = stage(placed, "placed"), stage(duplicates, "duplicates"), stage(orphans, "orphans")
    gone = duplicates.select("seg_id").unionByName(orphans)
    kept = segments.join(gone, "seg_id", "left_anti")
    rows = FA.place(FA.empty_slots(FA.fill_from_duplicates(rows, duplicates, orphans)), placed, facs)
    rows = stage(FA.add_offsets(rows, kept, params), "offsets")
    late = stage(FA.match_leftovers(facs, roads.join(gone, "seg_id", "left_anti"), placed, FA.taken_slots(rows), params), "late")
    left = facs.join(placed.select("fac_id").unionByName(late.select("fac_id")), "fac_id", "left_anti")
    return kept, FA.add_ids(FA.place(rows, late, facs, fill=True), kept), left


def junctions(segments: DataFrame, facilities: DataFrame, sidewalks: DataFrame, crossings: DataFrame, footways: DataFrame,
              params: Params = Params(), own: Overrides | None = None, nodes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Ramps, hulls, slots and crosswalks of all intersection nodes of ``segments``.

    ``own`` corrects them as they are made, hulls at ``nodes`` (node_id) or everywhere.
    """
    own = own or Overrides.none(segments.sparkSession)
    arms = stage(IX.endpoint_registry(sidewalks), "arms")
    points = stage(IX.ramp_points(arms, segments, params), "ramp-points")
    inferred = stage(IX.curb_ramps(points), "ramps")
    ramps = stage(own.enabled(inferred), "enabled-ramps")
    node_hulls, hulls, members = IX.junction_zones(points, params, own.hull_links)
    captive = IX.captive_sidewalks(sidewalks, node_hulls)
    walks = stage(sidewalks.join(captive.select("seg_id", "side"), ["seg_id", "side"], "left_anti"), "free-sidewalks")
    at = segments.select(F.explode(F.array("start_node", "end_node")).alias("node_id")) if nodes is None else nodes
    hulls, members = own.reshaped(hulls, members, at)
    slots = stage(IX.crosswalk_slots(hulls, params.crosswalk_buffer_m), "slots")
    hull_arms = stage(XW.hull_arms(IX.node_arms(segments), members), "hull-arms")
    chosen, hits, absorbed, _ = XW.detect(slots, hull_arms, segments, walks, ramps, crossings, footways, hulls, members, params)
    chosen = stage(own.chosen(chosen, segments), "final-crosswalks")
    crosswalks = stage(XW.attributes(XW.write(chosen, segments, facilities), crossings), "crosswalks")
    # a slot that is switched off is not filled again by a ray
    ramps = own.enabled(ramps.unionByName(XW.new_ramps(hits, chosen, segments, members, inferred), allowMissingColumns=True))
    by_node = members.join(hulls.select("hull_id", "ring"), "hull_id")
    gone = stage(XW.absorbed_segments(absorbed, footways, segments), "absorbed")
    walks, ramps = XW.clear_stubs(XW.clear_absorbed(walks, gone), XW.clear_absorbed(ramps, gone), by_node)
    return {"ramps": stage(ramps, "clean-ramps"), "hulls": hulls, "members": members, "slots": slots, "crosswalks": crosswalks,
            "sidewalks": stage(walks, "clean-sidewalks")}


def build(inputs: Inputs, params: Params = Params(), overrides: Overrides | None = None) -> Network:
    """All steps from edges to government ramps; stage tables separate the phases."""
    base = stage(N.foundation(inputs.edges, inputs.lines, inputs.nodes, params), "foundation")
    sloped = stage(EL.slopes(base.withColumnRenamed("incline", "incline_tag"), inputs.elevation, params)
                   .withColumnRenamed("incline", "street_incline").withColumnRenamed("incline_tag", "incline"), "sloped")
    calming = stage(CA.collect(inputs.calming, CA.match_to_vertices(inputs.calming, sloped), sloped), "calming")
    facs = stage(FA.facility_lines(inputs.facility_lines), "facility-lines")
    segments, facilities, left = street_facilities(sloped, facs, params)
    segments, facilities = stage(segments, "segments"), stage(facilities, "facilities")
    footways = stage(left.where("kind = 'sidewalk'").select("fac_id", "utm", "edge_id"), "footways")
    sidewalks = stage(snap.snap_endpoints(IX.sidewalk_lines(facilities, segments), segments), "snapped")
    j = junctions(segments, facilities, sidewalks, inputs.crossings, footways, params, overrides)
    roads = segments.where(tags.is_road(F.col("highway")))
    ramps = stage(R.enrich(j["ramps"], inputs.inventory, roads, params), "all-ramps")
    ends = stage(FA.facility_ends(facilities, segments, j["crosswalks"]), "facility-ends")
    return Network(segments=segments, facilities=facilities, sidewalks=j["sidewalks"], ramps=ramps, hulls=j["hulls"], members=j["members"],
                   slots=j["slots"], crosswalks=j["crosswalks"], calming=calming, facility_ends=ends, crossings=inputs.crossings, footways=footways, overrides=overrides)


def wide(net: Network) -> DataFrame:
    """The 272-column view: long tables are folded per segment first, so only narrow rows are shuffled.

    Geometry here is metric; a segment has six facility slots, twelve ramp slots
    and two crosswalks, so every fold is of bounded size.
    """
    def pivot(df: DataFrame, label, values: dict[str, str]) -> DataFrame:
        packed = F.map_from_entries(F.collect_list(F.struct(label.alias("k"), F.struct(*values).alias("v"))))
        return df.groupBy("seg_id").agg(packed.alias("m"))

    out = net.segments.select(
        "seg_id", F.col("edge_id").cast("string").alias("street_id"), F.col("grid_id").alias("street_grid_id"),
        F.col("start_node").alias("start_node_id"), F.col("start_is_intersection").alias("start_node_is_intersection_node"),
        F.col("end_node").alias("end_node_id"), F.col("end_is_intersection").alias("end_node_is_intersection_node"),
        "normalized_bearing", "name", "highway", tags.parse_maxspeed(F.col("maxspeed")).alias("maxspeed"), "oneway",
        tags.parse_lanes(F.col("lanes")).alias("lanes"), tags.parse_lane_width(F.col("lane_width")).alias("lane_width"),
        "street_incline", F.col("elev_start").alias("elev_start_m"), F.col("elev_end").alias("elev_end_m"), F.col("utm").alias("street_geometry"),
        *[(F.when(~F.col(f"{e}_point_cleared"), p) if f"{e}_point_cleared" in net.segments.columns else p).alias(f"{e}_node_geometry")
          for e, p in (("start", F.slice("utm", 1, 1)), ("end", F.slice("utm", -1, 1)))],
        *[c for t, c in (("surface", F.when(F.col("surface").isNotNull(), F.array("surface")).alias("surface")),
                         ("smoothness", F.col("smoothness").alias("street_condition"))) if t in net.segments.columns])

    # the street's own features: calming points in order, as JSON lists, one geometry vertex each
    c = net.calming.groupBy("seg_id").agg(F.array_sort(F.collect_list(F.struct("pos", "osmid", "feature_type", "x", "y", "proj_x", "proj_y"))).alias("c"))
    place = lambda x, y: F.transform("c", lambda v: F.struct(v[x].alias("x"), v[y].alias("y")))
    out = out.join(c, "seg_id", "left").withColumns({
        "street_feature_types": F.to_json("c.feature_type"), "public_data_id_street_feature": F.to_json(F.transform("c.osmid", lambda v: v.cast("string"))),
        "street_feature_geometry": place("x", "y"), "street_feature_geometry_projected": place("proj_x", "proj_y")}).drop("c")

    # what meets a facility or crosswalk at either end
    met = FA.neighbours(net.facility_ends).groupBy("fid").agg(
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("end") == "from", F.col("ids"))))).alias("from_segments"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("end") == "to", F.col("ids"))))).alias("to_segments"))

    # sidewalk lines after snapping and clean-up replace the raw ones
    clean = net.sidewalks.select("seg_id", "side", F.col("utm").alias("_u"))
    f = net.facilities.join(clean, ["seg_id", "side"], "left").withColumn(
        "utm", F.when(F.col("facility") == "sidewalk", F.col("_u")).otherwise(F.col("utm"))).drop("_u")
    f = f.join(met.withColumnRenamed("fid", "facility_grid_id"), "facility_grid_id", "left")
    name = F.when(F.col("facility") == "sidewalk", F.concat_ws("_", "facility", "side")).otherwise(
        F.concat_ws("_", "facility", "side", F.col("slot").cast("string")))
    f = pivot(f, name, {c: c for c in ("facility_id", "facility_grid_id", "presence", "surface", "condition", "quality", "width", "incline",
                                        "separator", "offset", "permitted", "utm", "from_segments", "to_segments")})
    ramp_fields = ("ramp_id", "locid", "returnloc", "returnposition", "condition_score", "quality", "x", "y")
    r = pivot(net.ramps, F.concat_ws("_", "side", "pos", F.col("n").cast("string")), {c: c for c in ramp_fields})
    x = net.crosswalks.join(met.withColumnRenamed("fid", "crosswalk_id"), "crosswalk_id", "left")
    x = pivot(x, F.col("pos"), {c: c for c in ("crosswalk_id", "grid_ids", "source", "utm", "from_segments", "to_segments", *tags.CROSSING_ATTRS)})
    out = (out.join(f.withColumnRenamed("m", "_f"), "seg_id", "left").join(r.withColumnRenamed("m", "_r"), "seg_id", "left")
           .join(x.withColumnRenamed("m", "_x"), "seg_id", "left"))

    cols: dict = {}
    one = lambda c: F.when(c.isNotNull(), F.array(c.cast("string")))
    for side in schema.SIDES:
        v = F.try_element_at("_f", F.lit(f"sidewalk_{side}"))
        p = f"sidewalk_{side}"
        cols.update({f"{p}_ID": v["facility_id"], f"{p}_grid_ID": v["facility_grid_id"], f"{p}_presence": v["presence"], f"{p}_surface": one(v["surface"]),
                     f"{p}_condition": v["condition"], f"{p}_quality": v["quality"], f"{p}_width": v["width"], f"{p}_incline": v["incline"],
                     f"{p}_seperator": v["separator"], f"{p}_offset": v["offset"], f"{p}_geometry": v["utm"],
                     f"{p}_from_segments": v["from_segments"], f"{p}_to_segments": v["to_segments"]})
        for n in schema.BIKE_SLOTS:
            v = F.try_element_at("_f", F.lit(f"bikeway_{side}_{n}"))
            p = f"bikeway_{side}_{n}"
            cols.update({f"{p}_id": v["facility_id"], f"{p}_grid_id": v["facility_grid_id"], f"{p}_type": one(v["presence"]), f"{p}_surface": one(v["surface"]),
                         f"{p}_condition": v["condition"], f"{p}_quality": v["quality"], f"{p}_permitted": one(v["permitted"]), f"{p}_width": v["width"],
                         f"{p}_incline": v["incline"], f"{p}_seperator": v["separator"], f"{p}_offset": v["offset"], f"{p}_geometry": v["utm"],
                         f"{p}_from_segments": v["from_segments"], f"{p}_to_segments": v["to_segments"]})
        for end in schema.ENDS:
            for n in schema.RAMP_SLOTS:
                v = F.try_element_at("_r", F.lit(f"{side}_{end}_{n}"))
                p = f"sidewalk_{side}_curbramp_{end}_{n}"
                cols.update({f"{p}_ID": v["ramp_id"], f"public_data_id_{p}": v["locid"].cast("string"), f"{p}_returnloc": v["returnloc"],
                             f"{p}_returnposition": v["returnposition"], f"{p}_condition_score": v["condition_score"].cast("string"),
                             f"{p}_quality": v["quality"],
                             f"{p}_geometry": F.when(v["x"].isNotNull(), F.array(F.struct(v["x"].alias("x"), v["y"].alias("y"))))})
    for end in schema.ENDS:
        v = F.try_element_at("_x", F.lit(end))
        p = f"crosswalk_{end}"
        cols.update({f"{p}_id": v["crosswalk_id"], f"{p}_grid_ids": F.to_json(v["grid_ids"]), f"{p}_source": v["source"], f"{p}_geometry": v["utm"],
                     f"{p}_from_segments": v["from_segments"], f"{p}_to_segments": v["to_segments"], **{f"{p}_{a}": v[a] for a in tags.CROSSING_ATTRS}})
    return schema.fill(out.select("*", *[c.alias(n) for n, c in cols.items()]).drop("_f", "_r", "_x"))


def replace_rows(old: DataFrame, new: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``old`` without the rows of ``keys``, plus ``new``."""
    return old.join(keys, on, "left_anti").unionByName(new, allowMissingColumns=True)


def recompute(net: Network, nodes: DataFrame, params: Params = Params(), from_snap: bool = False) -> Network:
    """Junction tables of the given nodes computed again from scratch, overrides included; all other rows stay."""
    nodes = stage(nodes.select("node_id").distinct(), "edited-nodes")
    # a merged hull is rebuilt as a whole
    hull_ids = net.members.join(nodes, "node_id", "left_semi").select("hull_id").distinct()
    nodes = stage(nodes.unionByName(net.members.join(hull_ids, "hull_id", "left_semi").select("node_id")).distinct(), "touched-nodes")
    ends = net.segments.select("seg_id", F.explode(F.array(F.struct(F.lit("start").alias("pos"), F.col("start_node").alias("node_id")),
                                                           F.struct(F.lit("end").alias("pos"), F.col("end_node").alias("node_id")))).alias("e")).select("seg_id", "e.*")
    touched = stage(ends.join(nodes, "node_id", "left_semi").select("seg_id", "pos"), "touched-ends")
    segs = touched.select("seg_id").distinct()
    part = net.segments.join(segs, "seg_id", "left_semi")
    # only the touched nodes count as intersections inside the patch
    for end in ("start", "end"):
        mine = nodes.select(F.col("node_id").alias(f"{end}_node"), F.lit(True).alias("_t"))
        part = part.join(mine, f"{end}_node", "left").withColumn(f"{end}_is_intersection", F.col(f"{end}_is_intersection") & F.coalesce("_t", F.lit(False))).drop("_t")
    part = stage(part, "patch")
    rows = net.facilities.join(segs, "seg_id", "left_semi")
    lines = IX.sidewalk_lines(rows, part)
    lines = stage(snap.snap_endpoints(lines, part) if from_snap else lines.drop("utm").join(net.sidewalks.select("seg_id", "side", "utm"), ["seg_id", "side"]), "patch-sidewalks")
    j = junctions(part, rows, lines, net.crossings, net.footways, params, net.overrides, nodes)
    manual = net.ramps.join(touched, ["seg_id", "pos"], "left_semi").where("quality NOT IN ('topology', 'osmpoint')")
    manual = manual if net.overrides is None else net.overrides.enabled(manual)
    fresh = j["ramps"].join(touched, ["seg_id", "pos"], "left_semi").join(manual.select("seg_id", "side", "pos", "n"), ["seg_id", "side", "pos", "n"], "left_anti")
    # sidewalk lines of the patch: where a street was looked at from one end only, lines that were cleared stay so
    whole = part.where("start_is_intersection AND end_is_intersection").select("seg_id").distinct()
    had = net.sidewalks.select("seg_id", "side").unionByName(lines.join(whole, "seg_id", "left_semi").select("seg_id", "side")).distinct()
    walks = j["sidewalks"].join(had, ["seg_id", "side"], "left_semi").select(*[c for c in net.sidewalks.columns if c in j["sidewalks"].columns])
    crosswalks = stage(replace_rows(net.crosswalks, j["crosswalks"].join(touched, ["seg_id", "pos"], "left_semi"), touched, ["seg_id", "pos"]), "new-crosswalks")
    return replace(
        net,
        sidewalks=stage(replace_rows(net.sidewalks, walks, segs, ["seg_id"]), "new-sidewalks"),
        facility_ends=stage(FA.facility_ends(net.facilities, net.segments, crosswalks), "new-facility-ends"),
        ramps=stage(replace_rows(net.ramps, fresh.unionByName(manual, allowMissingColumns=True), touched, ["seg_id", "pos"]), "new-ramps"),
        crosswalks=crosswalks,
        hulls=stage(replace_rows(net.hulls, j["hulls"], hull_ids, ["hull_id"]), "new-hulls"),
        members=stage(replace_rows(net.members, j["members"], nodes, ["node_id"]), "new-members"),
        slots=stage(replace_rows(net.slots, j["slots"], hull_ids, ["hull_id"]), "new-slots"))
