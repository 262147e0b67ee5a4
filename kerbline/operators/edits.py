"""Edit changesets applied to the network as joins and merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.functions import geom as G
from kerbline.operators import spatial as SP
from kerbline.operators.ranking import numbered
from kerbline.staging import stage, staged

ADD_RADIUS_M = 40.0
LINE = "array<struct<x:double,y:double>>"

# columns of an edit table; those that an edit does not use are null
EDIT_COLUMNS = {
    "edit_id": "long", "user_id": "long", "edit_type": "string", "node_id": "long", "seg_id": "long", "consumed_id": "long", "col": "string",
    "new_value": "string", "lon": "double", "lat": "double", "x": "double", "y": "double", "band": "array<long>", "side": "string", "pos": "string",
    "n": "int", "enabled": "boolean", "b_seg_id": "long", "b_side": "string", "b_pos": "string", "b_n": "int", "geom": LINE, "utm": LINE}


def edit_table(edits: DataFrame) -> DataFrame:
    """``edits`` with every column of an edit table, null where it has none; edits of no known user are one user's."""
    out = edits.select(*[(F.col(c) if c in edits.columns else F.lit(None)).cast(t).alias(c) for c, t in EDIT_COLUMNS.items()])
    return out.withColumn("user_id", F.coalesce("user_id", F.lit(0).cast("long")))


def segment_end_points(segments: DataFrame) -> DataFrame:
    """(seg_id, pos, node_id, x, y, lon, lat) for both ends of every segment."""
    def end(pos: str, node: str, u: Column, g: Column) -> DataFrame:
        return segments.select("seg_id", F.lit(pos).alias("pos"), F.col(node).alias("node_id"),
                               u["x"].alias("x"), u["y"].alias("y"), g["x"].alias("lon"), g["y"].alias("lat"))
    return end("start", "start_node", G.first_pt(F.col("utm")), G.first_pt(F.col("geom"))).unionByName(
        end("end", "end_node", G.last_pt(F.col("utm")), G.last_pt(F.col("geom"))))


def nearest_segment_end(points: DataFrame, segments: DataFrame, radius: float = ADD_RADIUS_M) -> DataFrame:
    """Nearest segment end of each added point: (edit_id, seg_id, pos, d); starts win ties."""
    ends = segment_end_points(segments).withColumn("t_id", F.col("seg_id") * 2 + (F.col("pos") == "end").cast("long"))
    best = SP.nearest_point(points.select(F.col("edit_id").alias("q_id"), F.col("x").alias("qx"), F.col("y").alias("qy")),
                            ends.select("t_id", F.col("x").alias("tx"), F.col("y").alias("ty")), radius)
    return best.select(F.col("q_id").alias("edit_id"), F.floor(F.col("t_id") / 2).cast("long").alias("seg_id"),
                       F.when(F.col("t_id") % 2 == 0, "start").otherwise("end").alias("pos"), "d")


def shared_endpoints(segments: DataFrame, eps: float = 1e-5) -> DataFrame:
    """Segment pairs with end points within ``eps`` degrees on both axes."""
    e = segment_end_points(segments)
    a = e.select(F.col("seg_id").alias("seg1"), F.col("node_id").alias("node1"), F.col("lon").alias("lon1"), F.col("lat").alias("lat1"),
                 SP.cell(F.col("lon"), eps).alias("cx"), SP.cell(F.col("lat"), eps).alias("cy"))
    b = SP.on_cells(e.select(F.col("seg_id").alias("seg2"), F.col("node_id").alias("node2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")),
                    F.col("lon2"), F.col("lat2"), F.col("lon2"), F.col("lat2"), eps, eps)
    j = a.join(b, ["cx", "cy"]).where((F.col("seg1") < F.col("seg2")) & (F.abs(F.col("lon1") - F.col("lon2")) < eps)
                                      & (F.abs(F.col("lat1") - F.col("lat2")) < eps))
    return j.select("seg1", "seg2", "node1", "node2")


# fixed values: edit type to the first stage it makes stale
STAGES = {"move_point": 0, "snap_point": 0, "merge_segments": 0, "split_segment": 0, "draw_segment": 0,
          "add_point": 1, "delete_point": 1, "add_polygon": 1, "delete_polygon": 1, "consolidate_hulls": 1,
          "toggle_curb_ramp": 2, "edit_polygon_face": 2, "draw_crosswalk": 3, "attr_edit": 99}
STAGE_ATTR_ONLY = 99
BLOCKED_COLUMNS = ("grid_id", "start_node", "end_node", "start_is_intersection", "end_is_intersection")
BLOCK = 65_536


def effective_edits(log: DataFrame, user: str = "user_id", order: str = "edit_id", undo: str = "undo", block: int = BLOCK) -> DataFrame:
    """The log without undone edits; an undo cancels its user's last live edit.

    With depth the number of live edits after each entry, an edit is live exactly
    when the depth never falls below its own afterwards.  Depth is a running sum
    held at zero, so it follows from running sums and minima.  These are taken in
    two levels, inside blocks of a user's log and over the blocks, so a user with
    most of the log is spread over many tasks.
    """
    step = F.when(F.col("edit_type") == undo, -1).otherwise(1)
    t = numbered(log, [user], order, "_pos").withColumn("_b", F.floor(F.col("_pos") / block).cast("long")).withColumn("_s", step)
    key = [user, "_b"]
    inside = W.partitionBy(*key).orderBy("_pos")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    over = W.partitionBy(user).orderBy("_b")  # one row per block
    before = over.rowsBetween(W.unboundedPreceding, -1)

    t = t.withColumn("_p", F.sum("_s").over(upto)).withColumn("_m", F.min("_p").over(upto))
    blocks = t.groupBy(*key).agg(F.sum("_s").alias("_t"), F.min("_m").alias("_bm"))
    blocks = blocks.withColumn("_o", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    blocks = blocks.withColumn("_pm", F.coalesce(F.min(F.col("_bm") + F.col("_o")).over(before), F.lit(0))).select(*key, "_o", "_pm")
    t = t.join(blocks, key)
    low = F.least(F.lit(0), F.col("_pm"), F.col("_m") + F.col("_o"))
    t = t.withColumn("_depth", F.col("_p") + F.col("_o") - low)

    later = t.groupBy(*key).agg(F.min("_depth").alias("_d"))
    later = later.withColumn("_after", F.min("_d").over(over.rowsBetween(1, W.unboundedFollowing))).select(*key, "_after")
    t = t.withColumn("_rest", F.min("_depth").over(inside.rowsBetween(1, W.unboundedFollowing))).join(later, key)
    falls = F.least(F.coalesce("_rest", F.col("_depth")), F.coalesce("_after", F.col("_depth"))) < F.col("_depth")
    return t.where((F.col("edit_type") != undo) & ~falls).select(*log.columns)


def latest_edits(edits: DataFrame, target: str) -> DataFrame:
    """Last value per (target, column)."""
    return edits.groupBy(target, "col").agg(F.max_by("new_value", "edit_id").alias("new_value"), F.max("edit_id").alias("edit_id"))


def edit_attributes(segments: DataFrame, edits: DataFrame) -> DataFrame:
    """Typed attribute updates by segment; id and geometry columns are refused, unreadable values leave the old one."""
    types = dict(segments.dtypes)
    names = [c for c in segments.columns if c not in BLOCKED_COLUMNS and c != "seg_id" and not types[c].startswith("array")]
    last = latest_edits(edits.where(F.col("col").isin(*names)), "seg_id")
    wide = last.groupBy("seg_id").agg(F.map_from_entries(F.collect_list(F.struct("col", "new_value"))).alias("_e"))  # at most one entry per column
    j = segments.join(wide, "seg_id", "left")
    out = {}
    for n in names:
        new = F.try_element_at("_e", F.lit(n))
        out[n] = F.when(F.coalesce(F.map_contains_key("_e", F.lit(n)), F.lit(False)),
                        F.when(new.isNull(), F.lit(None)).otherwise(F.coalesce(F.trim(new).try_cast(types[n]), F.col(n)))).otherwise(F.col(n))
    return j.withColumns(out).drop("_e")


def move_nodes(segments: DataFrame, moves: DataFrame) -> DataFrame:
    """Set node points and pull the attached line ends along; ``moves`` is (node_id, edit_id, lon, lat, x, y).

    With a column ``band`` (ids of segments) only the lines that it lists follow; null lists all.
    """
    band = F.col("band") if "band" in moves.columns else F.lit(None).cast("array<long>")
    last = moves.groupBy("node_id").agg(F.max_by(F.struct("lon", "lat", "x", "y", band.alias("band")), "edit_id").alias("p"))
    s = segments
    for end in ("start", "end"):
        s = s.join(last.select(F.col("node_id").alias(f"{end}_node"), F.col("p").alias(f"_{end}")), f"{end}_node", "left")
        follows = F.coalesce(F.array_contains(f"_{end}.band", F.col("seg_id")), F.lit(True))
        s = s.withColumn(f"_{end}", F.when(follows, F.col(f"_{end}")))
    for line, x, y in (("geom", "lon", "lat"), ("utm", "x", "y")):
        first = F.coalesce(F.when(F.col("_start").isNotNull(), G.pt(F.col(f"_start.{x}"), F.col(f"_start.{y}"))), G.first_pt(F.col(line)))
        end = F.coalesce(F.when(F.col("_end").isNotNull(), G.pt(F.col(f"_end.{x}"), F.col(f"_end.{y}"))), G.last_pt(F.col(line)))
        s = s.withColumn(line, F.concat(F.array(first), F.slice(line, F.lit(2), F.greatest(F.size(line) - 2, F.lit(0))), F.array(end)))
    return s.drop("_start", "_end")


def flag_added(segments: DataFrame, adds: DataFrame) -> DataFrame:
    """The segment end nearest to each added point becomes an intersection end."""
    hits = nearest_segment_end(adds, segments).groupBy("seg_id").agg(
        F.max(F.col("pos") == "start").alias("_s"), F.max(F.col("pos") == "end").alias("_e"))
    j = segments.join(hits, "seg_id", "left")
    return (j.withColumn("start_is_intersection", F.col("start_is_intersection") | F.coalesce("_s", F.lit(False)))
            .withColumn("end_is_intersection", F.col("end_is_intersection") | F.coalesce("_e", F.lit(False))).drop("_s", "_e"))


def toggle_ramps(ramps: DataFrame, inferred: DataFrame, toggles: DataFrame) -> DataFrame:
    """Last toggle per slot: disabled slots go, enabled ones come back from the inferred set."""
    keys = ["seg_id", "side", "pos", "n"]
    last = toggles.groupBy(*keys).agg(F.max_by("enabled", "edit_id").alias("enabled"))
    kept = ramps.join(last.where("NOT enabled").select(*keys), keys, "left_anti")
    back = inferred.join(last.where("enabled").select(*keys), keys, "left_semi").join(ramps.select(*keys), keys, "left_anti")
    return kept.unionByName(back, allowMissingColumns=True)


def unflag_nodes(segments: DataFrame, nodes: DataFrame, clear_points: bool) -> DataFrame:
    """Deleted points and hulls stop being intersections; a deleted point also loses its node geometry."""
    for end in ("start", "end"):
        gone = nodes.select(F.col("node_id").alias(f"{end}_node"), F.lit(True).alias("_gone")).distinct()
        segments = segments.join(gone, f"{end}_node", "left").withColumn(
            f"{end}_is_intersection", F.col(f"{end}_is_intersection") & F.col("_gone").isNull())
        if clear_points:
            before = F.coalesce(f"{end}_point_cleared", F.lit(False)) if f"{end}_point_cleared" in segments.columns else F.lit(False)
            segments = segments.withColumn(f"{end}_point_cleared", before | F.col("_gone").isNotNull())
        segments = segments.drop("_gone")
    return segments


def merge_requests(nodes: DataFrame, segments: DataFrame) -> DataFrame:
    """(seg_id, consumed_id, node_id): the two smallest segments at each node, each segment in one merge only."""
    at = segments.where("start_node <> end_node").select("seg_id", F.explode(F.array("start_node", "end_node")).alias("node_id")).join(nodes, "node_id", "left_semi")
    a = at.groupBy("node_id").agg(F.min("seg_id").alias("seg_id"))
    b = at.join(a.withColumnRenamed("seg_id", "_a"), "node_id").where("seg_id > _a").groupBy("node_id").agg(F.min("seg_id").alias("consumed_id"))
    m = a.join(b, "node_id")
    first = m.select("node_id", F.explode(F.array("seg_id", "consumed_id")).alias("s")).groupBy("s").agg(F.min("node_id").alias("first"))
    for c in ("seg_id", "consumed_id"):
        m = m.join(first.select(F.col("s").alias(c), F.col("first").alias(f"_{c}")), c).where(F.col(f"_{c}") == F.col("node_id")).drop(f"_{c}")
    return m.select("seg_id", "consumed_id", "node_id")


def merge_segments(segments: DataFrame, requests: DataFrame) -> DataFrame:
    """Join the consumed line to the survivor at the shared node; the survivor takes the far node, the consumed row goes."""
    c = segments.select(F.col("seg_id").alias("consumed_id"), F.col("start_node").alias("_cs"), F.col("end_node").alias("_ce"),
                        F.col("start_is_intersection").alias("_csi"), F.col("end_is_intersection").alias("_cei"),
                        F.col("utm").alias("_cu"), F.col("geom").alias("_cg"))
    m = requests.join(c, "consumed_id").withColumnRenamed("node_id", "_node")
    j = segments.join(m, "seg_id", "left")
    hit, at_end, c_start = F.col("_node").isNotNull(), F.col("end_node") == F.col("_node"), F.col("_cs") == F.col("_node")

    def tail(line: Column) -> Column:
        return F.slice(line, F.lit(2), F.size(line) - 1)

    def joined(s: str, k: str) -> Column:
        away = F.when(c_start, F.col(k)).otherwise(F.reverse(k))        # consumed line leaving the shared node
        into = F.reverse(away)                                          # consumed line arriving at it
        line = F.when(at_end, F.concat(F.col(s), tail(away))).otherwise(F.concat(into, tail(F.col(s))))
        return F.when(hit, line).otherwise(F.col(s))

    far, far_i = F.when(c_start, F.col("_ce")).otherwise(F.col("_cs")), F.when(c_start, F.col("_cei")).otherwise(F.col("_csi"))
    out = {"utm": joined("utm", "_cu"), "geom": joined("geom", "_cg"),
           "end_node": F.when(hit & at_end, far).otherwise(F.col("end_node")),
           "start_node": F.when(hit & ~at_end, far).otherwise(F.col("start_node")),
           "end_is_intersection": F.when(hit & at_end, far_i).otherwise(F.col("end_is_intersection")),
           "start_is_intersection": F.when(hit & ~at_end, far_i).otherwise(F.col("start_is_intersection"))}
    gone = requests.select(F.col("consumed_id").alias("seg_id"))
    return j.withColumns(out).select(*segments.columns).join(gone, "seg_id", "left_anti")


def merge_all(segments: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every requested merge, chains included: rounds of merges that share no segment, until no node has two left.

    A node is merged once.  Rounds are stage tables; a chain takes a round per link at
    most, as each round serves the least node of every cluster.
    """
    left = stage(nodes.select("node_id").distinct(), "merge-nodes")
    while True:
        requests = stage(merge_requests(left, segments), "merges")
        if requests.isEmpty():
            return segments
        segments = stage(merge_segments(segments, requests), "merged-segments")
        left = stage(left.join(requests.select("node_id"), "node_id", "left_anti"), "merge-nodes")


def merge_named(segments: DataFrame, requests: DataFrame) -> DataFrame:
    """Merges of named segments, (edit_id, seg_id, consumed_id, node_id), as if done one after the other.

    Requests that share no segment do not depend on each other, so each round serves those
    that come first for both of their segments; a chain takes a round per link.  A request
    whose segments are gone, or do not meet at its node, is passed over.  So is one that repeats
    another with nothing between them, and those of a consumed segment go with it: how often a
    merge is asked for does not add rounds.
    """
    left = requests.select("edit_id", "seg_id", "consumed_id", "node_id").where("seg_id <> consumed_id").distinct()
    left = stage(without_repeats(left), "named-merges")
    while not left.isEmpty():
        named = left.select("edit_id", F.explode(F.array("seg_id", "consumed_id")).alias("s")).groupBy("s").agg(F.min("edit_id").alias("first"))
        now = left
        for c in ("seg_id", "consumed_id"):
            now = now.join(named.select(F.col("s").alias(c), F.col("first").alias(f"_{c}")), c).where(F.col(f"_{c}") == F.col("edit_id")).drop(f"_{c}")
        now = stage(now.dropDuplicates(["edit_id"]), "merges-now")
        fit = now
        for c in ("seg_id", "consumed_id"):
            ends = segments.select(F.col("seg_id").alias(c), F.col("start_node").alias("_s"), F.col("end_node").alias("_e"))
            fit = fit.join(ends, c).where("(_s = node_id) <> (_e = node_id)").drop("_s", "_e")
        fit = stage(fit.drop("edit_id"), "fit-merges")
        left = left.join(now.select("edit_id"), "edit_id", "left_anti")
        for c in ("seg_id", "consumed_id"):
            left = left.join(fit.select(F.col("consumed_id").alias(c)), c, "left_anti")
        segments, left = staged((merge_segments(segments, fit), "merged-segments"), (left, "named-merges"))
    return segments


def without_repeats(requests: DataFrame) -> DataFrame:
    """Named merges without those for which the request before, at both of their segments, is the same merge.

    Nothing changes the segments in between: either the first consumed one of them, or both are as they were.
    """
    merge = F.struct("seg_id", "consumed_id", "node_id")
    at = requests.select("*", F.explode(F.array("seg_id", "consumed_id")).alias("_s"))
    before = F.lag(merge).over(W.partitionBy("_s").orderBy("edit_id", merge))
    again = at.withColumn("_again", F.coalesce(before == merge, F.lit(False)))
    return again.groupBy(*requests.columns).agg(F.min("_again").alias("_again")).where("NOT _again").select(*requests.columns)


def max_drawn_id(segments: DataFrame) -> DataFrame:
    """Largest number formed by the digits of a street id (one row)."""
    return segments.agg(F.max(F.regexp_replace("grid_id", "[^0-9]", "").try_cast("long")).alias("max_id"))


# Ids made by edits lie in ranges of their own: joints of split edges are no lower than -2**60,
# below them come nodes and segments of drawn lines, then those of cuts.
DRAWN_NODES = DRAWN_SEGMENTS = -(1 << 60)
SPLIT_NODES = SPLIT_SEGMENTS = -(1 << 61)


def draw_segments(segments: DataFrame, drawn: DataFrame, above: int | None = None) -> DataFrame:
    """Rows for drawn lines (edit_id, geom, utm): ids after the largest existing one, or after ``above``, two nodes of their own."""
    d = numbered(drawn.withColumn("_g", F.lit(0)), ["_g"], "edit_id", "_n").drop("_g")
    most = F.coalesce(max_drawn_id(segments).scalar(), F.lit(0)) if above is None else F.lit(above).cast("long")
    number = most + F.col("_n") + 1
    rows = d.withColumn("_id", number).select(
        (F.lit(DRAWN_SEGMENTS) - F.col("_id")).alias("seg_id"), F.concat(F.lit("drawn_"), F.col("_id").cast("string")).alias("grid_id"),
        (F.lit(DRAWN_NODES) - F.col("_id") * 2).alias("start_node"), (F.lit(DRAWN_NODES) - F.col("_id") * 2 - 1).alias("end_node"),
        F.lit("unclassified").alias("highway"), F.lit(False).alias("start_is_intersection"), F.lit(False).alias("end_is_intersection"), "geom", "utm")
    return segments.unionByName(rows, allowMissingColumns=True)


CUT_GAP_M = 0.01


def split_segments(segments: DataFrame, points: DataFrame, radius: float = ADD_RADIUS_M) -> DataFrame:
    """Cut the street nearest to each point at its projection: (seg_id, edit_id, part, start_node, end_node, m0, m1, utm).

    A street takes all its cuts, in the order they lie on it; of cuts at one place
    the first stands.  ``edit_id`` is the cut a piece begins with, for the first piece
    the one it ends with.
    """
    near = SP.nearest_line(points.select(F.col("edit_id").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py")),
                           segments.select(F.col("seg_id").alias("l_id"), "utm"), radius)
    cut = near.select(F.col("l_id").alias("seg_id"), F.col("p_id").alias("edit_id")).join(points.select("edit_id", "x", "y"), "edit_id")
    j = segments.select("seg_id", "utm").join(cut, "seg_id").withColumn("ms", G.measured(F.col("utm")))
    j = j.withColumn("m", G.nearest(F.col("ms"), F.col("x"), F.col("y"))["m"]).withColumn("len", F.element_at("ms", -1)["m1"])
    j = j.where((F.col("m") > CUT_GAP_M) & (F.col("m") < F.col("len") - CUT_GAP_M))
    cuts = j.groupBy("seg_id").agg(F.array_sort(F.collect_list(F.struct("m", "edit_id"))).alias("cuts"))  # the cuts of one street
    cuts = cuts.withColumn("cuts", F.filter("cuts", lambda c, i: (i == 0) | (c["m"] - F.get("cuts", i - 1)["m"] > CUT_GAP_M)))
    rows = segments.select("seg_id", "start_node", "end_node", "utm").join(cuts, "seg_id").withColumn("ms", G.measured(F.col("utm")))
    node = lambda e: F.lit(SPLIT_NODES) - e
    inner = F.transform("cuts", lambda c: F.struct(c["m"].alias("m"), node(c["edit_id"]).alias("node")))
    stops = F.concat(F.array(F.struct(F.lit(0.0).alias("m"), F.col("start_node").alias("node"))), inner,
                     F.array(F.struct(F.element_at("ms", -1)["m1"].alias("m"), F.col("end_node").alias("node"))))
    rows = rows.withColumn("stops", stops).withColumn("part", F.explode(F.sequence(F.lit(0), F.size("cuts"))))
    a, b = F.get("stops", F.col("part")), F.get("stops", F.col("part") + 1)
    return rows.select("seg_id", F.get("cuts", F.greatest(F.col("part") - 1, F.lit(0)))["edit_id"].alias("edit_id"), "part",
                       a["node"].alias("start_node"), b["node"].alias("end_node"), a["m"].alias("m0"), b["m"].alias("m1"), G.substring(F.col("ms"), a["m"], b["m"]).alias("utm"))


def edit_hulls(hulls: DataFrame, edited: DataFrame) -> DataFrame:
    """Replace hull rings by the last edited ring of their node; rings for other nodes are inserted."""
    last = edited.groupBy("node_id").agg(F.max_by("ring", "edit_id").alias("_ring"))
    j = hulls.join(last, "node_id", "full_outer")
    return j.withColumn("ring", F.coalesce("_ring", "ring")).withColumn("n_ramps", F.coalesce("n_ramps", F.lit(0).cast("long"))).drop("_ring")


def nearest_hulls(keys: DataFrame, hulls: DataFrame, radius: float = 250.0) -> DataFrame:
    """(key_id, node_id, d): hull with the nearest centroid, searching ever wider until every key is served."""
    c = G.ring_centroid(F.col("ring"))
    t = hulls.withColumn("_c", c).select(F.col("node_id").alias("t_id"), F.col("_c.x").alias("tx"), F.col("_c.y").alias("ty"))
    t = stage(t, "hull-centroids")
    rest = stage(keys.select(F.col("key_id").alias("q_id"), F.col("x").alias("qx"), F.col("y").alias("qy")), "keys")
    found = None
    if t.isEmpty():
        return rest.select(F.col("q_id").alias("key_id"), F.lit(None).cast("long").alias("node_id"), F.lit(None).cast("double").alias("d")).where("false")
    while True:
        hit = stage(SP.nearest_point(rest, t, radius), "nearest-hulls")
        found = hit if found is None else found.unionByName(hit)
        rest = stage(rest.join(hit.select("q_id"), "q_id", "left_anti"), "keys")
        if rest.isEmpty():
            return found.select(F.col("q_id").alias("key_id"), F.col("t_id").alias("node_id"), "d")
        radius *= 8


def merge_gap(picks: DataFrame, hulls: DataFrame) -> DataFrame:
    """(edit_id, max_gap, buffer_m) from the hulls picked by each consolidation edit (edit_id, node_id).

    A ring holds its first corner and lies in a circle round it, which bounds the gap of two
    hulls from both sides, whatever their shape.  Faces are measured only for pairs whose
    upper bound reaches the greatest lower bound of their edit.
    """
    c = F.col
    rings = hulls.where(F.size("ring") >= 1).select("node_id", "ring", G.first_pt(c("ring")).alias("_c"))
    reach = F.array_max(F.transform("ring", lambda p: G.dist(p["x"], p["y"], c("_c.x"), c("_c.y"))))
    p = picks.distinct().join(rings.withColumn("_r", reach), "node_id")
    one, two = (p.select("edit_id", c("node_id").alias(n), c("_c").alias(f"c{n}"), c("_r").alias(f"r{n}")) for n in "ab")
    apart = one.join(two, "edit_id").where("a < b").withColumn("_far", G.dist(c("ca.x"), c("ca.y"), c("cb.x"), c("cb.y")))
    apart = stage(apart.select("edit_id", "a", "b", "_far", F.greatest(c("_far") - c("ra") - c("rb"), F.lit(0.0)).alias("_least")), "hull-pairs")
    best = apart.groupBy("edit_id").agg((F.max("_least") - 1e-6).alias("_best"))
    pairs = apart.join(best, "edit_id").where("_far >= _best").select("edit_id", "a", "b")

    faces = G.pieces(hulls.select("node_id", F.concat("ring", F.slice("ring", 1, 1)).alias("ring")), "ring", ["node_id"])
    ends = ("ax", "ay", "bx", "by")
    j = (pairs.join(faces.select(c("node_id").alias("a"), *ends), "a")
         .join(faces.select(c("node_id").alias("b"), *[c(e).alias("r" + e) for e in ends]), "b"))
    gaps = SP._segment_distance(j, [c(e) for e in ends], [c("r" + e) for e in ends]).groupBy("edit_id", "a", "b").agg(F.min("d").alias("d"))
    return gaps.groupBy("edit_id").agg(F.max("d").alias("max_gap")).withColumn("buffer_m", c("max_gap") / 2 + 0.5)


def consolidate_links(picks: DataFrame) -> DataFrame:
    """Explicit merge links (a, b): every picked hull with the least one of its edit."""
    least = picks.groupBy("edit_id").agg(F.min("node_id").alias("a"))
    return picks.join(least, "edit_id").where("node_id > a").select("a", F.col("node_id").alias("b")).distinct()


def draw_crosswalks(requests: DataFrame, ramps: DataFrame) -> DataFrame:
    """Straight crosswalks between two ramp references, booked on the second ramp's end."""
    keys = ("seg_id", "side", "pos", "n")
    r = requests
    for p in ("a", "b"):
        r = r.join(ramps.select(*[F.col(k).alias(f"{p}_{k}") for k in keys], G.pt(F.col("x"), F.col("y")).alias(f"{p}_pt")), [f"{p}_{k}" for k in keys])
    return r.select("edit_id", F.col("b_seg_id").alias("seg_id"), F.col("b_pos").alias("pos"), F.array("a_pt", "b_pt").alias("line"), F.lit("manual").alias("type"))


def edit_bbox(edits: DataFrame) -> DataFrame:
    """Bounds of all edits that carry coordinates."""
    return edits.where("lon IS NOT NULL AND lat IS NOT NULL").agg(
        F.min("lon").alias("min_x"), F.min("lat").alias("min_y"), F.max("lon").alias("max_x"), F.max("lat").alias("max_y"))


def stage_of(edit_type: Column) -> Column:
    m = F.create_map(*[F.lit(v) for kv in STAGES.items() for v in kv])
    return F.coalesce(F.try_element_at(m, edit_type), F.lit(STAGE_ATTR_ONLY))


def dirty_stage(edits: DataFrame, by: list[str]) -> DataFrame:
    """First stage to recompute, from the live edits."""
    return edits.groupBy(*by).agg(F.min(stage_of(F.col("edit_type"))).alias("dirty_from_stage"))


def affected_segments(segments: DataFrame, nodes: DataFrame, named: DataFrame, dragged: DataFrame) -> DataFrame:
    """Segments to recompute: at an edited node, named by an edit, or sharing a node with a dragged segment."""
    ends = segments.select("seg_id", F.explode(F.array("start_node", "end_node")).alias("node_id"))
    second = ends.join(dragged.select("seg_id"), "seg_id", "left_semi").select("node_id")
    touched = nodes.select("node_id").unionByName(second).distinct()
    hit = ends.join(touched, "node_id", "left_semi").select("seg_id").unionByName(named.select("seg_id")).unionByName(dragged.select("seg_id")).distinct()
    return segments.join(hit, "seg_id", "left_semi")
