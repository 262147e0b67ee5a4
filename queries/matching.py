"""Queries on joins, windows and aggregates of the street table and its facilities."""

from __future__ import annotations

import re

from pyspark.sql import Window as W, functions as F

from kerbline.config import Params
from kerbline.functions import crs, geom as G, tags
from kerbline.operators import calming as CA, elevation as EL, facilities as FA, network as N, spatial as SP
from kerbline.staging import stage
from queries.geometry import probes
from queries.registry import City, query, rounded
from queries.sqltext import PARTS, axis_diff, bearing, cross, dist, haversine, meets, part, pseg, r, segseg, tparam

C = F.col


# -- network foundation --------------------------------------------------------

@query("join_node_geom", f"SELECT e.edge_id, {r('a.lon',7)} AS start_lon, {r('a.lat',7)} AS start_lat, {r('b.lon',7)} AS end_lon, {r('b.lat',7)} AS end_lat FROM fx_edges e LEFT JOIN fx_nodes a ON a.node_id = e.u LEFT JOIN fx_nodes b ON b.node_id = e.v")
def join_node_geom(c: City):
    e = N.attach_node_points(c.edges, c.nodes).select("edge_id", "start_lon", "start_lat", "end_lon", "end_lat")
    return rounded(e, start_lon=7, start_lat=7, end_lon=7, end_lat=7)


@query("join_edge_tags", "SELECT p.seg_id, e.sidewalk, e.cycleway, e.incline FROM o_pieces p LEFT JOIN fx_edges e ON e.edge_id = p.edge_id")
def join_edge_tags(c: City):
    return c.split.select("seg_id", "edge_id").join(c.edges.select("edge_id", "sidewalk", "cycleway", "incline"), "edge_id", "left").drop("edge_id")


@query("normalise_bearing", f"SELECT seg_id, {r('bearing',4)} AS bearing, {r('normalized_bearing',4)} AS normalized_bearing FROM o_split0")
def normalise_bearing(c: City):
    s = N.normalise_bearing(N.raw_bearings(N.split_deflections(c.lines)))
    return rounded(s.select("seg_id", "bearing", "normalized_bearing"), bearing=4, normalized_bearing=4)


@query("intersection_nodes", "SELECT node_id, n_neighbours FROM o_junctions")
def intersection_nodes(c: City):
    return N.intersection_nodes(c.edges)


@query("intersection_fallback", "SELECT node_id, count(*) AS n_ends FROM (SELECT start_node AS node_id FROM o_pieces UNION ALL SELECT end_node FROM o_pieces) GROUP BY node_id HAVING count(*) >= 3")
def intersection_fallback(c: City):
    return N.intersection_fallback(N.split_deflections(c.lines))


@query("grid_origin", f"SELECT {r('min(x)',4)} AS origin_x, {r('min(y)',4)} AS origin_y, 500.0e0 AS cell_size FROM o_nodes")
def grid_origin(c: City):
    return rounded(N.grid_origin(c.nodes), origin_x=4, origin_y=4)


@query("grid_ids", "SELECT seg_id, cell_col, cell_row, cell_seq, grid_id FROM o_split")
def grid_ids(c: City):
    s = N.split_deflections(c.lines)
    return N.grid_ids(s, N.grid_origin(c.nodes)).select("seg_id", "cell_col", "cell_row", "cell_seq", "grid_id")


@query("vertex_turns", f"SELECT edge_id, CAST(seq AS INTEGER) AS seq, {r('ux',3)} AS in_x, {r('uy',3)} AS in_y, {r('vx',3)} AS out_x, {r('vy',3)} AS out_y FROM (SELECT edge_id, seq, x - lag(x) OVER w AS ux, y - lag(y) OVER w AS uy, lead(x) OVER w - x AS vx, lead(y) OVER w - y AS vy FROM o_verts WINDOW w AS (PARTITION BY edge_id ORDER BY seq))")
def vertex_turns(c: City):
    v = crs.add_utm(c.fx["fx_vertices"])
    w = W.partitionBy("edge_id").orderBy("seq")  # an edge has at most 2000 vertices
    t = v.select("edge_id", "seq", (C("x") - F.lag("x").over(w)).alias("in_x"), (C("y") - F.lag("y").over(w)).alias("in_y"),
                 (F.lead("x").over(w) - C("x")).alias("out_x"), (F.lead("y").over(w) - C("y")).alias("out_y"))
    return rounded(t, in_x=3, in_y=3, out_x=3, out_y=3)


@query("cum_length", f"SELECT edge_id, k, {r('m1',3)} AS running FROM o_segs")
def cum_length(c: City):
    p = G.pieces(c.lines, "utm", ["edge_id"]).select("edge_id", "k", G.dist(C("ax"), C("ay"), C("bx"), C("by")).alias("len"))
    w = W.partitionBy("edge_id").orderBy("k").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rounded(p.select("edge_id", "k", F.sum("len").over(w).alias("running")), running=3)


@query("union_pieces", "SELECT seg_id, start_node, end_node FROM o_pieces UNION ALL SELECT -row_number() OVER (ORDER BY edit_id) AS seg_id, node_id, node_id + 1 FROM fx_changes WHERE edit_type = 'add_point'")
def union_pieces(c: City):
    from kerbline.operators.ranking import numbered
    drawn = numbered(c.changes.where("edit_type = 'add_point'").select("edit_id", "node_id", F.lit(0).alias("g")), ["g"], "edit_id", "n")
    rows = drawn.select((-(C("n") + 1)).alias("seg_id"), C("node_id").alias("start_node"), (C("node_id") + 1).alias("end_node"))
    return c.split.select("seg_id", "start_node", "end_node").unionByName(rows)


# -- calming -------------------------------------------------------------------

part("o_calm_match", f"""SELECT osmid, seg_id, d FROM (SELECT c.osmid, p.edge_id*4096 + p.piece AS seg_id, {dist('c.x','c.y','p.x','p.y')} AS d
FROM o_calming c JOIN o_piece_verts p ON p.x BETWEEN c.x - 5 AND c.x + 5 AND p.y BETWEEN c.y - 5 AND c.y + 5) WHERE d <= 5 QUALIFY row_number() OVER (PARTITION BY osmid ORDER BY round(d,6), seg_id) = 1""")


@query("join_calming_vertex", f"SELECT osmid, seg_id, {r('d',3)} AS d FROM o_calm_match")
def join_calming_vertex(c: City):
    return rounded(CA.match_to_vertices(c.calming, c.split), d=3)


part("o_piece_segs", """SELECT edge_id*4096 + piece AS seg_id, seq AS k, x AS ax, y AS ay, nx AS bx, ny AS by FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM o_piece_verts WINDOW w AS (PARTITION BY edge_id, piece ORDER BY seq)) WHERE nx IS NOT NULL""")


@query("calming_collect", f"""SELECT seg_id, osmid, pos, 'traffic_calming:' || traffic_calming AS feature_type, {r('px_',3)} AS proj_x, {r('py_',3)} AS proj_y FROM (
SELECT seg_id, osmid, traffic_calming, ax+t*(bx-ax) AS px_, ay+t*(by-ay) AS py_, {dist('x','y','ax+t*(bx-ax)','ay+t*(by-ay)')} AS d, k FROM (
 SELECT m.seg_id, c.osmid, c.traffic_calming, c.x, c.y, s.ax, s.ay, s.bx, s.by, s.k, {tparam('c.x','c.y','s.ax','s.ay','s.bx','s.by')} AS t FROM o_calm_match m JOIN o_calming c USING (osmid) JOIN o_piece_segs s ON s.seg_id = m.seg_id))
 JOIN (SELECT osmid, CAST(row_number() OVER (PARTITION BY seg_id ORDER BY osmid) - 1 AS BIGINT) AS pos FROM o_calm_match) USING (osmid)
 QUALIFY row_number() OVER (PARTITION BY osmid ORDER BY d, k) = 1""")
def calming_collect(c: City):
    rows = CA.collect(c.calming, CA.match_to_vertices(c.calming, c.split), c.split)
    return rounded(rows.select("seg_id", "osmid", "pos", "feature_type", "proj_x", "proj_y"), proj_x=3, proj_y=3)


# -- elevation -----------------------------------------------------------------

part("o_ends", """SELECT start_node AS node_id, 0 AS is_end, seg_id, lon0 AS lon, lat0 AS lat FROM o_split UNION ALL SELECT end_node, 1, seg_id, lon1, lat1 FROM o_split""")
part("o_elev_join", "SELECT s.seg_id, s.start_node, s.end_node, lon0, lat0, lon1, lat1, a.elev_m AS e0, b.elev_m AS e1 FROM o_split s LEFT JOIN fx_elev a ON a.node_id = s.start_node LEFT JOIN fx_elev b ON b.node_id = s.end_node")


@query("first_by_node", f"SELECT node_id, {r('lon',7)} AS lon, {r('lat',7)} AS lat FROM o_ends WHERE node_id > 0 QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY is_end, seg_id) = 1")
def first_by_node(c: City):
    return rounded(EL.first_by_node(c.split), lon=7, lat=7)


@query("join_elevation", f"SELECT seg_id, {r('e0',7)} AS elev_start, {r('e1',7)} AS elev_end, (start_node > 0 AND e0 IS NULL) OR (end_node > 0 AND e1 IS NULL) AS unsampled FROM o_elev_join")
def join_elevation(c: City):
    s = EL.join_elevation(c.split, c.elev)
    gone = ((C("start_node") > 0) & C("elev_start").isNull()) | ((C("end_node") > 0) & C("elev_end").isNull())
    return rounded(s.select("seg_id", "elev_start", "elev_end", gone.alias("unsampled")), elev_start=7, elev_end=7)


part("o_coord_elev", """SELECT kx, ky, arg_max(e, o) AS e FROM (SELECT round(lon0,3) AS kx, round(lat0,3) AS ky, e0 AS e, 0.0e0 + seg_id AS o FROM o_elev_join WHERE start_node > 0 AND e0 IS NOT NULL
 UNION ALL SELECT round(lon1,3), round(lat1,3), e1, 1.0e15 + seg_id FROM o_elev_join WHERE end_node > 0 AND e1 IS NOT NULL) GROUP BY kx, ky""")


@query("join_coord_elev", f"SELECT seg_id, {r('CASE WHEN start_node < 0 THEN coalesce(e0, a.e) ELSE e0 END',7)} AS elev_start, {r('CASE WHEN end_node < 0 THEN coalesce(e1, b.e) ELSE e1 END',7)} AS elev_end FROM o_elev_join j LEFT JOIN o_coord_elev a ON a.kx = round(lon0,3) AND a.ky = round(lat0,3) LEFT JOIN o_coord_elev b ON b.kx = round(lon1,3) AND b.ky = round(lat1,3)")
def join_coord_elev(c: City):
    s = EL.fill_by_coordinate(EL.join_elevation(c.split, c.elev), digits=3)
    return rounded(s.select("seg_id", "elev_start", "elev_end"), elev_start=7, elev_end=7)


def _slope_sql(dem: float, propagated: bool) -> str:
    part(f"o_slope{int(dem)}", f"""SELECT *, CASE WHEN abs(sl) <= 40 THEN sl END AS slope FROM (SELECT *, CASE WHEN len_m >= {dem!r} THEN (e1-e0)/len_m*100 END AS sl
 FROM (SELECT *, {haversine('lon0','lat0','lon1','lat1')} AS len_m FROM o_elev_join))""")
    part(f"o_nslope{int(dem)}", f"SELECT node_id, arg_min(slope, o) AS slope FROM (SELECT start_node AS node_id, slope, 0.0e0 + seg_id AS o FROM o_slope{int(dem)} WHERE slope IS NOT NULL UNION ALL SELECT end_node, slope, 1.0e15 + seg_id FROM o_slope{int(dem)} WHERE slope IS NOT NULL) GROUP BY node_id")
    return f"SELECT seg_id, {r('len_m',3)} AS length_m, {r(f'CASE WHEN s.slope IS NULL AND len_m < {dem!r} THEN coalesce(a.slope, b.slope) ELSE s.slope END',4)} AS incline FROM o_slope{int(dem)} s LEFT JOIN o_nslope{int(dem)} a ON a.node_id = start_node LEFT JOIN o_nslope{int(dem)} b ON b.node_id = end_node"


@query("slopes", _slope_sql(10.0, True))
def slopes(c: City):
    return rounded(EL.slopes(c.split, c.elev).select("seg_id", "length_m", "incline"), length_m=3, incline=4)


@query("propagate_slope", _slope_sql(110.0, True))
def propagate_slope(c: City):
    """With a coarse elevation model, split pieces are short and take their neighbours' slope."""
    p = Params(dem_resolution_m=110.0)
    s = EL.propagate_slopes(EL.raw_slopes(EL.join_elevation(c.split, c.elev), p), p)
    return rounded(s.select("seg_id", "length_m", "incline"), length_m=3, incline=4)


# -- facilities ----------------------------------------------------------------

part("o_facs", f"SELECT fac_id, CASE highway WHEN 'footway' THEN 'sidewalk' ELSE 'bikeway' END AS kind, name, x0, y0, x1, y1, {bearing('x1-x0','y1-y0')} AS fb FROM o_fac")
part("o_cand", f"""SELECT * FROM (SELECT f.fac_id, s.seg_id, f.kind, {segseg('f.','s.')} AS d, coalesce(nullif(trim(f.name),'') = trim(s.name), false) AS same_name, {axis_diff('f.fb','s.normalized_bearing')} <= 45 AS parallel
FROM o_facs f JOIN o_straight s ON least(s.x0,s.x1) <= greatest(f.x0,f.x1) + 30 AND greatest(s.x0,s.x1) >= least(f.x0,f.x1) - 30 AND least(s.y0,s.y1) <= greatest(f.y0,f.y1) + 30 AND greatest(s.y0,s.y1) >= least(f.y0,f.y1) - 30) WHERE d <= 30""")


def _sided(chosen: str) -> str:
    t = tparam("mx", "my", "x0", "y0", "x1", "y1")
    return f"""SELECT fac_id, kind, seg_id, CASE WHEN {cross('x1-x0','y1-y0','mx-(x0+t*(x1-x0))','my-(y0+t*(y1-y0))')} > 0 THEN 'left' ELSE 'right' END AS side FROM (SELECT *, {t} AS t FROM (
 SELECT m.fac_id, m.kind, m.seg_id, s.x0, s.y0, s.x1, s.y1, (f.x0+f.x1)/2 AS mx, (f.y0+f.y1)/2 AS my FROM {chosen} m JOIN o_straight s USING (seg_id) JOIN o_facs f ON f.fac_id = m.fac_id))"""


part("o_match1", "SELECT fac_id, kind, seg_id FROM o_cand WHERE same_name OR parallel QUALIFY row_number() OVER (PARTITION BY fac_id ORDER BY NOT same_name, round(d,6), seg_id) = 1")
part("o_match1s", _sided("o_match1"))
part("o_slot1", "SELECT *, CAST(rk AS INTEGER) AS slot FROM (SELECT *, row_number() OVER (PARTITION BY seg_id, side, kind ORDER BY fac_id) AS rk FROM o_match1s) WHERE rk <= CASE kind WHEN 'bikeway' THEN 2 ELSE 1 END")


@query("match_facilities", "SELECT fac_id, kind, seg_id, side FROM o_match1s")
def match_facilities(c: City):
    chosen = FA.best_road(FA.candidates(c.facs, c.roads))
    return FA.with_side(chosen, c.roads, c.facs).select("fac_id", "kind", "seg_id", "side")


@query("slot_assign_facility", "SELECT fac_id, kind, seg_id, side, slot FROM o_slot1")
def slot_assign_facility(c: City):
    return FA.match_separate(c.facs, c.roads)[0].select("fac_id", "kind", "seg_id", "side", "slot")


@query("detect_coincident")
def detect_coincident(c: City):
    """Footways drawn half a metre beside every fifth street, checked against all streets."""
    traced = (c.straight.where("edge_id % 5 = 0").select(C("edge_id").alias("fac_id"), F.lit("sidewalk").alias("kind"), "name",
              F.lit(None).cast("string").alias("surface"), "bearing", "utm")
              .select("fac_id", "kind", "name", "surface", C("bearing").alias("fac_bearing"), G.offset(C("utm"), F.lit(0.5)).alias("utm")))
    traced = stage(traced, "traced")  # read three times below
    return rounded(FA.coincident(FA.candidates(traced, c.roads), c.roads, traced), share=4)


part("o_dups", "SELECT b.seg_id, min(a.seg_id) AS center_id FROM o_straight a JOIN o_straight b ON a.start_node = b.end_node AND a.end_node = b.start_node AND a.seg_id < b.seg_id GROUP BY b.seg_id")
part("o_rows0", "SELECT r.seg_id, f.facility, CASE WHEN is_reversed THEN CASE f.side WHEN 'left' THEN 'right' ELSE 'left' END ELSE f.side END AS side, f.slot, f.presence, f.width, f.incline FROM o_fac_rows f JOIN o_reversed r USING (edge_id)")


def twin_duplicates(c: City):
    """Streets mapped twice between the same two nodes; the smaller id is the centreline."""
    a = c.straight.select(C("seg_id").alias("center_id"), C("start_node").alias("n1"), C("end_node").alias("n0"))
    b = c.straight.select("seg_id", C("start_node").alias("n0"), C("end_node").alias("n1"))
    return a.join(b, ["n0", "n1"]).where("center_id < seg_id").groupBy("seg_id").agg(F.min("center_id").alias("center_id"))


@query("fill_from_duplicates", """SELECT r.seg_id, r.facility, r.side, r.slot, coalesce(r.presence, d.presence) AS presence, coalesce(r.width, d.width) AS width, coalesce(r.incline, d.incline) AS incline
FROM o_rows0 r LEFT JOIN (SELECT center_id, facility, side, slot, arg_min(presence, r.seg_id) AS presence, arg_min(width, r.seg_id) AS width, arg_min(incline, r.seg_id) AS incline FROM o_rows0 r JOIN o_dups d ON d.seg_id = r.seg_id GROUP BY ALL) d
ON d.center_id = r.seg_id AND d.facility = r.facility AND d.side = r.side AND d.slot = r.slot WHERE r.seg_id NOT IN (SELECT seg_id FROM o_dups)""")
def fill_from_duplicates(c: City):
    none = c.straight.where("false").select("seg_id")
    return FA.fill_from_duplicates(c.tag_rows, twin_duplicates(c), none).select("seg_id", "facility", "side", "slot", "presence", "width", "incline")


@query("first_non_null", "SELECT center_id, facility, side, arg_min(presence, r.seg_id) AS presence, arg_min(width, r.seg_id) AS width FROM o_rows0 r JOIN o_dups d ON d.seg_id = r.seg_id GROUP BY ALL")
def first_non_null(c: City):
    j = c.tag_rows.join(twin_duplicates(c), "seg_id")
    def first(a: str):
        return F.min_by(F.when(C(a).isNotNull(), C(a)), F.when(C(a).isNotNull(), C("seg_id"))).alias(a)
    return j.groupBy("center_id", "facility", "side").agg(first("presence"), first("width"))


part("o_street", """SELECT seg_id, x0, y0, x1, y1, sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) AS len, coalesce(floor(TRY_CAST(lanes AS DOUBLE)), 2) * coalesce(TRY_CAST(lane_width AS DOUBLE), 3.0e0) / 2.0e0 AS base FROM o_straight""")
part("o_rows1", "SELECT r.*, s.fac_id, r.slot = 1 AND s.fac_id IS NULL AND coalesce(lower(trim(presence)) NOT IN ('no','none','nan',''), false) AS needs FROM o_rows0 r LEFT JOIN o_slot1 s ON s.seg_id = r.seg_id AND s.kind = r.facility AND s.side = r.side AND s.slot = r.slot")
part("o_offset", """SELECT *, ox0 IS NOT NULL OR fac_id IS NOT NULL AS has_geom FROM (SELECT o.*, CASE WHEN needs THEN t.x0 - (t.y1-t.y0)/len*d END AS ox0, CASE WHEN needs THEN t.y0 + (t.x1-t.x0)/len*d END AS oy0, CASE WHEN needs THEN t.x1 - (t.y1-t.y0)/len*d END AS ox1, CASE WHEN needs THEN t.y1 + (t.x1-t.x0)/len*d END AS oy1
FROM (SELECT r.*, CASE side WHEN 'left' THEN 1 ELSE -1 END * (base + CASE WHEN facility = 'sidewalk' AND bool_or(needs AND facility = 'bikeway') OVER (PARTITION BY r.seg_id, side) THEN 1.5e0 ELSE 0 END) AS d FROM o_rows1 r JOIN o_street s USING (seg_id)) o JOIN o_street t USING (seg_id))""")


@query("offset_facilities", f"SELECT seg_id, facility, side, slot, {r('ox0',3)} AS x0, {r('oy0',3)} AS y0, {r('ox1',3)} AS x1, {r('oy1',3)} AS y1 FROM o_offset WHERE needs")
def offset_facilities(c: City):
    rows = FA.place(FA.empty_slots(c.tag_rows), c.placed, c.facs)
    made = FA.add_offsets(rows, c.straight).where("quality = 'buffered'")
    a, b = G.first_pt(C("utm")), G.last_pt(C("utm"))
    return rounded(made.select("seg_id", "facility", "side", "slot", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")), x0=3, y0=3, x1=3, y1=3)


part("o_match2", "SELECT fac_id, kind, seg_id FROM (SELECT *, round(d - CASE WHEN same_name THEN 10.0e0 ELSE 0.0e0 END, 6) AS score FROM o_cand WHERE parallel AND fac_id NOT IN (SELECT fac_id FROM o_slot1)) QUALIFY row_number() OVER (PARTITION BY fac_id ORDER BY score, seg_id) = 1")
part("o_match2s", _sided("o_match2"))
part("o_free", "SELECT seg_id, side, facility AS kind, slot, row_number() OVER (PARTITION BY seg_id, side, facility ORDER BY slot) AS rk FROM o_offset WHERE NOT has_geom")
part("o_slot2", "SELECT m.fac_id, m.kind, m.seg_id, m.side, f.slot FROM (SELECT *, row_number() OVER (PARTITION BY seg_id, side, kind ORDER BY fac_id) AS rk FROM o_match2s) m JOIN o_free f USING (seg_id, side, kind, rk)")


@query("match_orphans", "SELECT fac_id, kind, seg_id, side, slot FROM o_slot2")
def match_orphans(c: City):
    return FA.match_leftovers(c.facs, c.roads, c.placed, FA.taken_slots(c.offset_rows)).select("fac_id", "kind", "seg_id", "side", "slot")


# the second round where the first has placed sidewalks only: every bikeway is left over
part("o_walk1", "SELECT * FROM o_slot1 WHERE kind = 'sidewalk'")
for _name in ("o_rows1", "o_offset", "o_match2", "o_match2s", "o_free", "o_slot2"):
    part(f"{_name}w", re.sub(r"\b(o_rows1|o_offset|o_match2|o_match2s|o_free)\b", r"\1w", PARTS[_name]).replace("o_slot1", "o_walk1"))


@query("match_late_bikeways", "SELECT fac_id, kind, seg_id, side, slot FROM o_slot2w")
def match_late_bikeways(c: City):
    """Bikeways mapped after the sidewalks were placed: all of them go through the second round."""
    placed = c.placed.where("kind = 'sidewalk'")
    rows = stage(FA.add_offsets(FA.place(FA.empty_slots(c.tag_rows), placed, c.facs), c.straight), "walk-offsets")
    return FA.match_leftovers(c.facs, c.roads, placed, FA.taken_slots(rows)).select("fac_id", "kind", "seg_id", "side", "slot")


part("o_rows2", """SELECT *, CASE WHEN facility = 'sidewalk' THEN l ELSE l || CAST(slot AS VARCHAR) END AS suffix, NOT coalesce(lower(trim(presence)) IN ('no','none'), false) AS own FROM (SELECT o.seg_id, o.facility, o.side, o.slot, coalesce(o.presence, CASE WHEN s.fac_id IS NOT NULL AND o.facility = 'sidewalk' THEN 'separate' END) AS presence, CASE o.side WHEN 'left' THEN 'L' ELSE 'R' END AS l
 FROM o_offset o LEFT JOIN o_slot2 s ON s.seg_id = o.seg_id AND s.kind = o.facility AND s.side = o.side AND s.slot = o.slot)""")
part("o_ids", "SELECT r.seg_id, facility, side, slot, CASE WHEN own THEN grid_id || suffix END AS facility_id, CASE WHEN bool_or(own) OVER (PARTITION BY r.seg_id, side, facility) THEN grid_id || suffix END AS facility_grid_id FROM o_rows2 r JOIN o_straight s USING (seg_id)")


@query("facility_ids", "SELECT * FROM o_ids")
def facility_ids(c: City):
    rows = FA.place(c.offset_rows, c.late, c.facs, fill=True)
    return FA.add_ids(rows, c.straight).select("seg_id", "facility", "side", "slot", "facility_id", "facility_grid_id")


part("o_fends", """SELECT facility_grid_id AS fid, 'from' AS "end", start_node AS node_id FROM o_ids JOIN o_straight USING (seg_id) WHERE facility_grid_id IS NOT NULL UNION ALL SELECT facility_grid_id, 'to', end_node FROM o_ids JOIN o_straight USING (seg_id) WHERE facility_grid_id IS NOT NULL""")


@query("neighbours", """SELECT e.fid, e."end", count(m.fid) AS n, coalesce(string_agg(m.fid, ',' ORDER BY m.fid), '') AS ids FROM o_fends e LEFT JOIN (SELECT DISTINCT node_id, fid FROM o_fends) m ON m.node_id = e.node_id AND m.fid <> e.fid GROUP BY e.fid, e."end" """)
def neighbours(c: City):
    n = FA.neighbours(FA.facility_ends(c.facilities, c.straight))
    return n.select("fid", "end", F.size("ids").cast("long").alias("n"), F.concat_ws(",", "ids").alias("ids"))


@query("sorted_neighbours", "SELECT node_id, string_agg(fid, ',' ORDER BY fid) AS ids FROM (SELECT DISTINCT node_id, fid FROM o_fends) GROUP BY node_id")
def sorted_neighbours(c: City):
    m = FA.node_members(FA.facility_ends(c.facilities, c.straight))
    return m.select("node_id", F.concat_ws(",", "ids").alias("ids"))


@query("set_minus", "SELECT fac_id FROM o_facs EXCEPT SELECT fac_id FROM o_slot1")
def set_minus(c: City):
    return c.facs.select("fac_id").join(c.placed.select("fac_id"), "fac_id", "left_anti")


@query("distinct_nodes", "SELECT node_id, min(seg_id) AS seg_id FROM (SELECT start_node AS node_id, seg_id FROM o_straight WHERE start_is_intersection UNION ALL SELECT end_node, seg_id FROM o_straight WHERE end_is_intersection) GROUP BY node_id")
def distinct_nodes(c: City):
    ends = c.straight.where("start_is_intersection").select(C("start_node").alias("node_id"), "seg_id").unionByName(
        c.straight.where("end_is_intersection").select(C("end_node").alias("node_id"), "seg_id"))
    return ends.groupBy("node_id").agg(F.min("seg_id").alias("seg_id"))


# -- spatial lookups -----------------------------------------------------------

part("o_qpts", "SELECT event_id AS q_id, -122.49e0 + 0.00131e0 * (event_id % 37) AS lon, 37.701e0 + 0.00077e0 * (event_id % 53) AS lat FROM events WHERE event_type = 'purchase'")


def query_points(c: City):
    e = c.spark.read.parquet(f"{c.sf_dir}/events.parquet").where("event_type = 'purchase'")
    p = e.select(C("event_id").cast("long").alias("q_id"), (-122.49 + 0.00131 * (C("event_id") % 37)).alias("lon"), (37.701 + 0.00077 * (C("event_id") % 53)).alias("lat"))
    return crs.add_utm(p)


part("o_qpts_utm", __import__("queries.sqltext", fromlist=["utm"]).utm("o_qpts"))


@query("snap_to_segment", f"""SELECT q_id, seg_id, {r('d',3)} AS d, {r('x',3)} AS x, {r('y',3)} AS y FROM (SELECT q_id, seg_id, x0+t*(x1-x0) AS x, y0+t*(y1-y0) AS y, {dist('qx','qy','x0+t*(x1-x0)','y0+t*(y1-y0)')} AS d FROM (
SELECT q.q_id, q.x AS qx, q.y AS qy, s.seg_id, s.x0, s.y0, s.x1, s.y1, {tparam('q.x','q.y','s.x0','s.y0','s.x1','s.y1')} AS t FROM o_qpts_utm q JOIN o_straight s ON least(s.x0,s.x1) <= q.x + 60 AND greatest(s.x0,s.x1) >= q.x - 60 AND least(s.y0,s.y1) <= q.y + 60 AND greatest(s.y0,s.y1) >= q.y - 60)) WHERE d <= 60
QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY round(d,6), seg_id) = 1""")
def snap_to_segment(c: City):
    q = query_points(c)
    best = SP.nearest_line(q.select(C("q_id").alias("p_id"), C("x").alias("px"), C("y").alias("py")), c.straight.select(C("seg_id").alias("l_id"), "utm"), 60.0)
    j = best.join(q.select(C("q_id").alias("p_id"), "x", "y"), "p_id").join(c.straight.select(C("seg_id").alias("l_id"), "utm"), "l_id")
    j = j.withColumn("n", G.nearest(G.measured(C("utm")), C("x"), C("y")))
    return rounded(j.select(C("p_id").alias("q_id"), C("l_id").alias("seg_id"), "d", C("n.x").alias("x"), C("n.y").alias("y")), d=3, x=3, y=3)


@query("nearby_segments", f"""SELECT q_id, seg_id, {r('d',3)} AS metres, rk FROM (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY round(d,6), seg_id) AS INTEGER) AS rk FROM (SELECT q.q_id, s.seg_id, {pseg('q.x','q.y','s.x0','s.y0','s.x1','s.y1')} AS d FROM o_qpts_utm q JOIN o_straight s
 ON least(s.x0,s.x1) <= q.x + 150 AND greatest(s.x0,s.x1) >= q.x - 150 AND least(s.y0,s.y1) <= q.y + 150 AND greatest(s.y0,s.y1) >= q.y - 150) WHERE d <= 150) WHERE rk <= 50""")
def nearby_segments(c: City):
    """The 50 nearest streets within 150 m of many query points."""
    q = query_points(c).select(C("q_id").alias("p_id"), C("x").alias("px"), C("y").alias("py"))
    near = SP.points_near_lines(q, c.straight.select(C("seg_id").alias("l_id"), "utm"), 150.0)
    rk = F.row_number().over(W.partitionBy("p_id").orderBy(F.round("d", 6), "l_id"))
    top = near.withColumn("rk", rk).where("rk <= 50")
    return rounded(top.select(C("p_id").alias("q_id"), C("l_id").alias("seg_id"), C("d").alias("metres"), "rk"), metres=3)


@query("nearest_endpoint", f"""SELECT edit_id, seg_id, pos, {r('d',3)} AS d FROM (SELECT c.edit_id, e.seg_id, e.pos, {dist('c.x','c.y','e.x','e.y')} AS d FROM o_changes c JOIN (SELECT seg_id, 'start' AS pos, x0 AS x, y0 AS y FROM o_straight UNION ALL SELECT seg_id, 'end', x1, y1 FROM o_straight) e
 ON e.x BETWEEN c.x - 40 AND c.x + 40 AND e.y BETWEEN c.y - 40 AND c.y + 40 WHERE c.edit_type = 'add_point') WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY edit_id ORDER BY round(d,6), seg_id, pos DESC) = 1""")
def nearest_endpoint(c: City):
    from kerbline.operators.edits import nearest_segment_end
    adds = c.changes.where("edit_type = 'add_point'").select("edit_id", "x", "y")
    return rounded(nearest_segment_end(adds, c.straight), d=3)


@query("shared_endpoint", """SELECT a.seg_id AS seg1, b.seg_id AS seg2, a.node_id AS node1, b.node_id AS node2 FROM (SELECT seg_id, start_node AS node_id, lon0 AS lon, lat0 AS lat FROM o_straight UNION ALL SELECT seg_id, end_node, lon1, lat1 FROM o_straight) a
JOIN (SELECT seg_id, start_node AS node_id, lon0 AS lon, lat0 AS lat FROM o_straight UNION ALL SELECT seg_id, end_node, lon1, lat1 FROM o_straight) b ON abs(a.lon-b.lon) < 1e-5 AND abs(a.lat-b.lat) < 1e-5 AND round(a.lon,3) = round(b.lon,3) AND a.seg_id < b.seg_id""")
def shared_endpoint(c: City):
    from kerbline.operators.edits import shared_endpoints
    return shared_endpoints(c.straight)


@query("bbox_filter", f"""SELECT seg_id FROM (SELECT seg_id, greatest(least((-122.48e0-lon0)/dx,(-122.47e0-lon0)/dx), least((37.70731e0-lat0)/dy,(37.72012e0-lat0)/dy), 0.0e0) AS lo, least(greatest((-122.48e0-lon0)/dx,(-122.47e0-lon0)/dx), greatest((37.70731e0-lat0)/dy,(37.72012e0-lat0)/dy), 1.0e0) AS hi FROM (SELECT seg_id, lon0, lat0, lon1-lon0 + 1e-15 AS dx, lat1-lat0 + 1e-15 AS dy FROM o_straight)) WHERE lo <= hi""")
def bbox_filter(c: City):
    from kerbline.operators.viewport import in_bbox
    return in_bbox(c.straight, -122.48, 37.70731, -122.47, 37.72012).select("seg_id")


@query("grid_stats", "SELECT count(DISTINCT (cy, cx)) AS total_cells, count(DISTINCT edge_id) AS total_segments FROM (SELECT edge_id, floor(lat/0.001e0) AS cy, floor(lon/0.001e0) AS cx FROM fx_vertices)")
def grid_stats(c: City):
    v = G.vertices(c.lines, "geom", ["edge_id"])
    cells = v.select("edge_id", SP.cell(C("x"), 0.001).alias("cx"), SP.cell(C("y"), 0.001).alias("cy"))
    return cells.agg(F.count_distinct("cx", "cy").alias("total_cells"), F.count_distinct("edge_id").alias("total_segments"))
