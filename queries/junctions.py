"""Queries on intersections and crosswalks of the straight network."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions import geom as G, tags
from kerbline.operators import crosswalks as XW, intersections as IX
from queries.registry import City, query, rounded
from queries.sqltext import cross, dist, meets, part, pseg, r, segseg, straight_on, xt

C = F.col

part("o_side", """
SELECT o.seg_id, o.side, o.presence, coalesce(f.x0, o.ox0) AS x0, coalesce(f.y0, o.oy0) AS y0, coalesce(f.x1, o.ox1) AS x1, coalesce(f.y1, o.oy1) AS y1
FROM o_offset o LEFT JOIN o_facs f ON f.fac_id = o.fac_id WHERE o.facility = 'sidewalk' AND o.has_geom
UNION ALL SELECT s.seg_id, s.side, coalesce(o.presence, 'separate'), f.x0, f.y0, f.x1, f.y1 FROM o_slot2 s JOIN o_facs f ON f.fac_id = s.fac_id JOIN o_offset o ON o.seg_id = s.seg_id AND o.facility = 'sidewalk' AND o.side = s.side WHERE s.kind = 'sidewalk'""")
part("o_arm", """
SELECT *, CAST(e AS VARCHAR) || lpad(CAST(seg_id AS VARCHAR), 18, '0') || CASE side WHEN 'left' THEN '0' ELSE '1' END AS arm FROM (
SELECT t.start_node AS node_id, t.x0 AS nx, t.y0 AS ny, s.seg_id, s.side, 'start' AS pos, 0 AS e, t.name, t.grid_id, s.x0 AS px, s.y0 AS py, s.x0-s.x1 AS dx, s.y0-s.y1 AS dy, s.x0, s.y0, s.x1, s.y1 FROM o_side s JOIN o_straight t USING (seg_id) WHERE t.start_is_intersection
UNION ALL SELECT t.end_node, t.x1, t.y1, s.seg_id, s.side, 'end', 1, t.name, t.grid_id, s.x1, s.y1, s.x1-s.x0, s.y1-s.y0, s.x0, s.y0, s.x1, s.y1 FROM o_side s JOIN o_straight t USING (seg_id) WHERE t.end_is_intersection)""")
part("o_r1", f"""SELECT node_id, nx, ny, seg_id, side, pos, grid_id, round(CASE WHEN n THEN x0 ELSE x1 END, 4) AS x, round(CASE WHEN n THEN y0 ELSE y1 END, 4) AS y, '1' || arm AS ord FROM (SELECT *, {dist('x0','y0','nx','ny')} <= {dist('x1','y1','nx','ny')} AS n FROM o_arm)""")
_t, _u = xt("a.", "b.")
part("o_xpair", f"""SELECT DISTINCT node_id, nx, ny, seg_id, side, pos, grid_id, arm, o_seg_id, o_side, o_pos, o_grid_id, o_arm, x, y FROM (SELECT *, round(CASE e WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x0+t*(x1-x0) END,4) AS x, round(CASE e WHEN 0 THEN y0 WHEN 1 THEN y1 ELSE y0+t*(y1-y0) END,4) AS y FROM (
SELECT a.* EXCLUDE (e), b.seg_id AS o_seg_id, b.side AS o_side, b.pos AS o_pos, b.grid_id AS o_grid_id, b.arm AS o_arm, {_t} AS t, {straight_on('a.','b.')} AS e FROM o_arm a JOIN o_arm b ON a.node_id = b.node_id AND a.arm < b.arm AND NOT (a.seg_id = b.seg_id AND a.side = b.side) WHERE {straight_on('a.','b.')} IS NOT NULL OR {meets('a.','b.')}))
WHERE {dist('x','y','nx','ny')} <= 15""")
part("o_r2", """SELECT node_id, nx, ny, seg_id, side, pos, grid_id, x, y, ord || '0' AS ord FROM (SELECT *, '2' || arm || o_arm || lpad(CAST(CAST(round(x*1000) AS BIGINT) AS VARCHAR), 12, '0') AS ord FROM o_xpair)
UNION ALL SELECT node_id, nx, ny, o_seg_id, o_side, o_pos, o_grid_id, x, y, '2' || arm || o_arm || lpad(CAST(CAST(round(x*1000) AS BIGINT) AS VARCHAR), 12, '0') || '1' FROM o_xpair""")
part("o_rall", "SELECT *, count(*) OVER (PARTITION BY node_id) AS n_ramps FROM (SELECT * FROM o_r1 UNION ALL SELECT * FROM o_r2) QUALIFY n_ramps >= 2")
part("o_places", "SELECT node_id, x, y, max(ord) AS last FROM o_rall GROUP BY node_id, x, y")
part("o_partner", f"""SELECT node_id, x, y, arg_max(ox, last) AS ox, arg_max(oy, last) AS oy FROM (SELECT a.node_id, a.x, a.y, b.x AS ox, b.y AS oy, b.last, {dist('a.x','a.y','b.x','b.y')} AS d FROM o_places a JOIN o_places b USING (node_id)) WHERE d > 0 AND d < 1 GROUP BY node_id, x, y""")
part("o_snap", "SELECT r.*, coalesce((r.x+p.ox)/2, r.x) AS sx, coalesce((r.y+p.oy)/2, r.y) AS sy FROM o_rall r LEFT JOIN o_partner p ON p.node_id = r.node_id AND p.x = r.x AND p.y = r.y")
part("o_ramps", "SELECT node_id, seg_id, side, pos, CAST(n AS INTEGER) AS n, sx AS x, sy AS y, grid_id || '_CR_' || side || '_' || pos || '_' || CAST(n AS VARCHAR) AS ramp_id FROM (SELECT *, row_number() OVER (PARTITION BY seg_id, side, pos ORDER BY ord) AS n FROM o_snap) WHERE n <= 3")
part("o_hpts", f"SELECT DISTINCT node_id, sx AS x, sy AS y FROM o_snap WHERE {dist('sx','sy','nx','ny')} <= 15")
part("o_hcount", "SELECT node_id, count(*) AS k FROM o_hpts GROUP BY node_id")
part("o_hside", f"""SELECT a.node_id, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by, c.x AS cx, c.y AS cy, {cross('b.x-a.x','b.y-a.y','c.x-a.x','c.y-a.y')} AS side
FROM o_hpts a JOIN o_hpts b ON a.node_id = b.node_id JOIN o_hpts c ON c.node_id = a.node_id JOIN o_hcount k ON k.node_id = a.node_id
WHERE k.k >= 3 AND (a.x <> b.x OR a.y <> b.y) AND (a.x <> c.x OR a.y <> c.y) AND (b.x <> c.x OR b.y <> c.y)""")
part("o_hedge", """SELECT node_id, ax, ay, bx, by FROM o_hside GROUP BY node_id, ax, ay, bx, by
HAVING bool_and(side > 0 OR (side = 0 AND (cx-ax)*(cx-bx)+(cy-ay)*(cy-by) < 0)) AND max(side) > 0""")
# flat points, two or more of them, have no face; their two extremes, by (x, y), give a thin rectangle
part("o_thin0", "SELECT node_id, min(x) AS ax, arg_min(y, struct_pack(x := x, y := y)) AS ay, max(x) AS bx, arg_max(y, struct_pack(x := x, y := y)) AS by FROM o_hpts WHERE node_id NOT IN (SELECT node_id FROM o_hedge) GROUP BY node_id HAVING count(*) >= 2")
part("o_thin", f"""SELECT node_id, list_value([ax-nx, ay-ny], [bx-nx, by-ny], [bx+nx, by+ny], [ax+nx, ay+ny]) AS p FROM (SELECT *, -(by-ay)/l AS nx, (bx-ax)/l AS ny FROM (SELECT *, {dist('ax','ay','bx','by')} AS l FROM o_thin0))""")
part("o_hfaces", """SELECT *, CAST(row_number() OVER (PARTITION BY node_id ORDER BY CASE WHEN k <= 0 THEN k + 2*pi() ELSE k END) - 1 AS INTEGER) AS face FROM (SELECT *, atan2(by-ay, bx-ax) + pi()/2 AS k FROM (
SELECT node_id, ax, ay, bx, by FROM o_hedge UNION ALL SELECT node_id, p[i][1], p[i][2], p[i % 4 + 1][1], p[i % 4 + 1][2] FROM o_thin CROSS JOIN (SELECT unnest([1,2,3,4]) AS i)))""")
part("o_nramps", "SELECT node_id, any_value(n_ramps) AS n_ramps FROM o_rall GROUP BY node_id")
part("o_slots", f"""SELECT node_id AS hull_id, face, ax, ay, bx, by, (ax+bx)/2 AS mx, (ay+by)/2 AS my, (bx-ax)/l AS ux, (by-ay)/l AS uy, l/2 AS hl, 3.0e0 AS hw FROM (SELECT *, {dist('ax','ay','bx','by')} AS l FROM o_hfaces) WHERE l >= 0.5""")


@query("endpoint_registry", f"SELECT node_id, seg_id, side, pos, {r('px',3)} AS px, {r('py',3)} AS py FROM o_arm")
def endpoint_registry(c: City):
    return rounded(IX.endpoint_registry(c.sidewalks).select("node_id", "seg_id", "side", "pos", "px", "py"), px=3, py=3)


@query("pair_crossings", f"SELECT node_id, seg_id, side, pos, o_seg_id, o_side, {r('x',4)} AS x, {r('y',4)} AS y FROM o_xpair")
def pair_crossings(c: City):
    return rounded(IX.pair_crossings(c.arms).select("node_id", "seg_id", "side", "pos", "o_seg_id", "o_side", "x", "y"), x=4, y=4)


@query("shared_nodes", """SELECT node_id, shared_id, arg_min(seg_id, arm) AS seg_id FROM (SELECT start_node AS node_id, end_node AS shared_id, seg_id, '0' || lpad(CAST(seg_id AS VARCHAR),18,'0') AS arm, highway FROM o_straight WHERE start_is_intersection
UNION ALL SELECT end_node, start_node, seg_id, '1' || lpad(CAST(seg_id AS VARCHAR),18,'0'), highway FROM o_straight WHERE end_is_intersection) WHERE highway IN ('residential','service') GROUP BY node_id, shared_id HAVING count(DISTINCT seg_id) >= 2""")
def shared_nodes(c: City):
    """Small streets stand in for walking arms, of which the lattice has none."""
    return IX.shared_nodes(c.straight, C("highway").isin("residential", "service")).select("node_id", "shared_id", "seg_id")


@query("set_intersect", """SELECT a.seg_id AS seg1, b.seg_id AS seg2, a.start_node AS node_id, a.end_node AS shared FROM o_straight a JOIN o_straight b ON a.start_node = b.end_node AND a.end_node = b.start_node AND a.seg_id <> b.seg_id""")
def set_intersect(c: City):
    """Nodes shared by two streets of a junction, without the junction itself."""
    def arm(n: str, here: str):
        return c.straight.select(C("seg_id").alias(f"seg{n}"), C(here).alias("node_id"), F.array("start_node", "end_node").alias(f"nodes{n}"))
    j = arm("1", "start_node").join(arm("2", "end_node"), "node_id").where("seg1 <> seg2")
    left = F.array_remove(F.array_intersect("nodes1", "nodes2"), C("node_id"))
    return j.withColumn("shared", F.explode(left)).select("seg1", "seg2", "node_id", "shared")


@query("presnap_pairs", f"SELECT node_id, seg_id, side, pos, ord, {r('sx',6)} AS x, {r('sy',6)} AS y FROM o_snap WHERE sx <> x OR sy <> y")
def presnap_pairs(c: City):
    p = c.ramp_points.drop("sx", "sy")
    s = IX.presnap(p).where("sx <> x OR sy <> y")
    return rounded(s.select("node_id", "seg_id", "side", "pos", "ord", C("sx").alias("x"), C("sy").alias("y")), x=6, y=6)


@query("slot_assign_ramp", "SELECT seg_id, side, pos, n, ramp_id FROM o_ramps")
def slot_assign_ramp(c: City):
    p = c.ramp_points.select("node_id", "seg_id", "side", "pos", "grid_id", C("sx").alias("x"), C("sy").alias("y"), "ord")
    return IX.assign_ramp_slots(p).select("seg_id", "side", "pos", "n", "ramp_id")


@query("curb_ramps", f"SELECT node_id, seg_id, side, pos, n, ramp_id, {r('x',6)} AS x, {r('y',6)} AS y FROM o_ramps")
def curb_ramps(c: City):
    ramps = IX.curb_ramps(IX.ramp_points(c.arms, c.straight))
    return rounded(ramps.select("node_id", "seg_id", "side", "pos", "n", "ramp_id", "x", "y"), x=6, y=6)


@query("g_convex_hull", f"SELECT node_id, face AS i, {r('ax',6)} AS x, {r('ay',6)} AS y FROM o_hfaces WHERE node_id IN (SELECT node_id FROM o_hedge)")
def g_convex_hull(c: City):
    pts = c.ramp_points.where(G.dist(C("sx"), C("sy"), C("nx"), C("ny")) <= 15).select("node_id", C("sx").alias("x"), C("sy").alias("y"))
    h = IX.convex_hulls(pts, "node_id").where(F.size("ring") >= 3)
    return rounded(h.select("node_id", F.posexplode("ring").alias("i", "p")).select("node_id", "i", "p.x", "p.y"), x=6, y=6)


@query("hull_build", f"SELECT f.node_id, any_value(n_ramps) AS n_ramps, count(*) AS n_corners, {r('sum(ax*by-bx*ay)/2',1)} AS area FROM (SELECT node_id, ax-fx AS ax, ay-fy AS ay, bx-fx AS bx, by-fy AS by FROM (SELECT *, first_value(ax) OVER (PARTITION BY node_id ORDER BY face) AS fx, first_value(ay) OVER (PARTITION BY node_id ORDER BY face) AS fy FROM o_hfaces)) f JOIN o_nramps n ON n.node_id = f.node_id GROUP BY f.node_id")
def hull_build(c: City):
    h = IX.build_hulls(c.ramp_points)
    o = G.first_pt(C("ring"))
    area = F.aggregate(G.ring_edges(C("ring")), F.lit(0.0), lambda a, e: a + G.cross(e["ax"] - o["x"], e["ay"] - o["y"], e["bx"] - o["x"], e["by"] - o["y"]) / 2)
    return rounded(h.select("node_id", "n_ramps", F.size("ring").cast("long").alias("n_corners"), area.alias("area")), area=1)


part("o_captive", f"""SELECT seg_id, side, node_id, greatest(0.0e0, least(1.0e0, coalesce(min(CASE WHEN den < 0 THEN t END), 1.0e0)) - greatest(0.0e0, coalesce(max(CASE WHEN den > 0 THEN t END), 0.0e0))) AS share FROM (SELECT *, -num/nullif(den,0.0e0) AS t FROM (
 SELECT s.seg_id, s.side, h.node_id, {cross('h.bx-h.ax','h.by-h.ay','s.x0-h.ax','s.y0-h.ay')} AS num, {cross('h.bx-h.ax','h.by-h.ay','s.x1-s.x0','s.y1-s.y0')} AS den
 FROM (SELECT s.*, t.start_node AS node_id FROM o_side s JOIN o_straight t USING (seg_id) UNION SELECT s.*, t.end_node FROM o_side s JOIN o_straight t USING (seg_id)) s JOIN o_hfaces h ON h.node_id = s.node_id)) GROUP BY seg_id, side, node_id""")


@query("hull_captive", f"SELECT seg_id, side, {r('max(c.share)',3)} AS share FROM o_captive c JOIN o_side s USING (seg_id, side) WHERE lower(s.presence) IN ('yes','left','separate') GROUP BY seg_id, side HAVING max(c.share) >= 0.03")
def hull_captive(c: City):
    """Threshold lowered to 3 %, since block-long sidewalks never lie inside a junction."""
    sw = c.sidewalks.where(C("presence").isin("yes", "left", "separate"))
    return rounded(IX.captive_sidewalks(sw, c.node_hulls, 0.03, separate_only=False).select("seg_id", "side", "share"), share=3)


part("o_hgap", f"""SELECT a, b, min(d) AS gap FROM (SELECT p.node_id AS a, q.node_id AS b, {segseg('p.','q.')} AS d FROM (SELECT node_id, ax AS x0, ay AS y0, bx AS x1, by AS y1 FROM o_hfaces) p JOIN (SELECT node_id, ax AS x0, ay AS y0, bx AS x1, by AS y1 FROM o_hfaces) q
 ON q.x0 BETWEEN p.x0 - 140 AND p.x0 + 140 AND q.y0 BETWEEN p.y0 - 140 AND p.y0 + 140 AND p.node_id < q.node_id) GROUP BY a, b HAVING min(d) <= 110""")
MERGE_M = 55.0  # blocks are 120 m, so junctions are joined only with a wide buffer


@query("hull_pairs", f"SELECT a, b, {r('gap',2)} AS gap FROM o_hgap")
def hull_pairs(c: City):
    return rounded(IX.hull_pairs(c.node_hulls, MERGE_M), gap=2)


part("o_comp", """SELECT id, min(label) AS component FROM (WITH RECURSIVE e AS (SELECT a, b FROM o_hgap UNION ALL SELECT b, a FROM o_hgap), reach(id, label) AS (SELECT DISTINCT node_id, node_id FROM o_hfaces UNION SELECT e.b, reach.label FROM reach JOIN e ON e.a = reach.id WHERE reach.label < e.b) SELECT * FROM reach) GROUP BY id""")


def wide_components(c: City):
    return IX.connected_components(c.node_hulls.select(C("node_id").alias("id")), IX.hull_pairs(c.node_hulls, MERGE_M))


@query("hull_components", "SELECT id, component FROM o_comp")
def hull_components(c: City):
    return wide_components(c)


@query("hull_merge", "SELECT component AS hull_id, CAST(sum(n_ramps) AS BIGINT) AS n_ramps, count(*) AS n_nodes FROM o_comp JOIN o_nramps ON node_id = id GROUP BY component")
def hull_merge(c: City):
    return IX.merge_hulls(c.node_hulls, wide_components(c))[0].select("hull_id", "n_ramps", "n_nodes")


@query("crosswalk_slots", f"SELECT hull_id, face, {r('mx',7)} AS mx, {r('my',7)} AS my, {r('ux',4)} AS ux, {r('uy',4)} AS uy, {r('hl',3)} AS hl, hw FROM o_slots")
def crosswalk_slots(c: City):
    s = IX.crosswalk_slots(c.merged[0])
    return rounded(s.select("hull_id", "face", "mx", "my", "ux", "uy", "hl", "hw"), mx=7, my=7, ux=4, uy=4, hl=3)


def _u(x, y):
    return f"(({x}-mx)*ux+({y}-my)*uy)"


def _v(x, y):
    return f"(({y}-my)*ux-({x}-mx)*uy)"


def _in(x, y):
    return f"abs({_u(x, y)}) <= hl + 1e-6 AND abs({_v(x, y)}) <= hw + 1e-6"


def _clip(columns: str, source: str) -> str:
    """Spans of segments (sx0..sy1) inside the slots joined to them."""
    def lo(p, d, h):
        return f"CASE WHEN {d} = 0 THEN CASE WHEN abs({p}) > {h} THEN 2.0e0 ELSE 0.0e0 END ELSE least((-{h}-{p})/{d}, ({h}-{p})/{d}) END"

    def hi(p, d, h):
        return f"CASE WHEN {d} = 0 THEN CASE WHEN abs({p}) > {h} THEN -1.0e0 ELSE 1.0e0 END ELSE greatest((-{h}-{p})/{d}, ({h}-{p})/{d}) END"
    return (f"SELECT *, greatest(0.0e0, {lo('pu','du','hl')}, {lo('pv','dv','hw')}) AS t0, least(1.0e0, {hi('pu','du','hl')}, {hi('pv','dv','hw')}) AS t1 FROM ("
            f"SELECT {columns}, {_u('sx0','sy0')} AS pu, {_v('sx0','sy0')} AS pv, (sx1-sx0)*ux+(sy1-sy0)*uy AS du, (sy1-sy0)*ux-(sx1-sx0)*uy AS dv, hl, hw FROM {source})")


part("o_harm", "SELECT start_node AS hull_id, seg_id, '0' || lpad(CAST(seg_id AS VARCHAR),18,'0') AS arm FROM o_straight WHERE start_is_intersection UNION ALL SELECT end_node, seg_id, '1' || lpad(CAST(seg_id AS VARCHAR),18,'0') FROM o_straight WHERE end_is_intersection")
part("o_crossed", f"""SELECT c.hull_id, c.face, c.seg_id, CASE WHEN t.start_node = c.hull_id THEN 'start' WHEN t.end_node = c.hull_id THEN 'end' ELSE 'start' END AS pos FROM (SELECT hull_id, face, seg_id FROM ({_clip('hull_id, face, seg_id, arm', '(SELECT s.*, a.seg_id, a.arm, t.x0 AS sx0, t.y0 AS sy0, t.x1 AS sx1, t.y1 AS sy1 FROM o_slots s JOIN o_harm a USING (hull_id) JOIN o_straight t ON t.seg_id = a.seg_id)')}) WHERE t0 <= t1
 QUALIFY row_number() OVER (PARTITION BY hull_id, face ORDER BY arm, seg_id) = 1) c JOIN o_straight t ON t.seg_id = c.seg_id""")


@query("slot_crossed_street", "SELECT * FROM o_crossed")
def slot_crossed_street(c: City):
    return XW.crossed_street(c.slots, c.hull_arms, c.straight, *c.merged)


part("o_live", "SELECT s.* FROM o_slots s WHERE EXISTS (SELECT 1 FROM o_crossed c WHERE c.hull_id = s.hull_id AND c.face = s.face)")
part("o_spt", f"""SELECT hull_id, face, osmid, px, py FROM (SELECT s.hull_id, s.face, x.osmid, x.x AS px, x.y AS py, {dist('x.x','x.y','mx','my')} AS d FROM o_live s JOIN o_crossings x ON x.x BETWEEN mx-30 AND mx+30 AND x.y BETWEEN my-30 AND my+30 WHERE {_in('x.x','x.y')}) QUALIFY row_number() OVER (PARTITION BY hull_id, face ORDER BY round(d,6), osmid) = 1""")
part("o_sramp", f"""SELECT s.hull_id, s.face, r.seg_id, r.side, r.pos, r.n, r.x AS rx, r.y AS ry, a.arm || CASE r.side WHEN 'left' THEN '0' ELSE '1' END || CASE r.pos WHEN 'start' THEN '0' ELSE '1' END || CAST(r.n AS VARCHAR) AS ord FROM o_live s JOIN o_harm a USING (hull_id) JOIN o_ramps r ON r.seg_id = a.seg_id WHERE {_in('r.x','r.y')}""")


@query("slot_crossing_points", "SELECT hull_id, face, osmid FROM o_spt")
def slot_crossing_points(c: City):
    return XW.crossing_points(c.live_slots, c.crossings).select("hull_id", "face", "osmid")


@query("slot_ramps", "SELECT hull_id, face, seg_id, side, pos, n FROM o_sramp")
def slot_ramps(c: City):
    return XW.ramps_in_slots(c.live_slots, c.hull_arms, c.ramps).select("hull_id", "face", "seg_id", "side", "pos", "n")


part("o_foot", """SELECT edge_id*2+k AS fac_id, x0+ux*5-uy*v0 AS x0, y0+uy*5+ux*v0 AS y0, x0+ux*5-uy*v1 AS x1, y0+uy*5+ux*v1 AS y1 FROM (SELECT edge_id, x0, y0, (x1-x0)/len AS ux, (y1-y0)/len AS uy FROM o_chord WHERE edge_id % 7 = 3) CROSS JOIN (VALUES (0,-1.5e0,0.0e0),(1,0.0e0,1.5e0)) t(k, v0, v1)""")
part("o_sfoot", f"""SELECT hull_id, face, fac_id, greatest(0.0e0, t1-t0) AS share FROM ({_clip('hull_id, face, fac_id', '(SELECT s.*, f.fac_id, f.x0 AS sx0, f.y0 AS sy0, f.x1 AS sx1, f.y1 AS sy1 FROM o_live s JOIN o_foot f ON f.x0 BETWEEN mx-40 AND mx+40 AND f.y0 BETWEEN my-40 AND my+40)')}) WHERE t1 - t0 >= 0.8""")


@query("slot_footways", f"SELECT hull_id, face, fac_id, {r('share',4)} AS share FROM o_sfoot")
def slot_footways(c: City):
    return rounded(XW.slot_footways(c.live_slots, c.footpaths), share=4)


_rt, _ru = xt("q.", "w.")
part("o_rays", "SELECT hull_id, face, dir, px AS x0, py AS y0, px + sin(o)*dir*reach AS x1, py + cos(o)*dir*reach AS y1 FROM (SELECT p.*, d.dir, radians(t.normalized_bearing + 90) AS o, coalesce(floor(TRY_CAST(t.lanes AS DOUBLE)),2)*coalesce(TRY_CAST(t.lane_width AS DOUBLE),3.0e0) AS reach FROM o_spt p JOIN o_crossed c USING (hull_id, face) JOIN o_straight t ON t.seg_id = c.seg_id CROSS JOIN (SELECT unnest([1,-1]) AS dir) d)")
part("o_rayhit", f"""SELECT hull_id, face, dir, seg_id AS hit_seg, side AS hit_side, hx, hy FROM (SELECT *, x0+t*(x1-x0) AS hx, y0+t*(y1-y0) AS hy FROM (SELECT q.*, w.seg_id, w.side, {_rt} AS t FROM o_rays q JOIN o_harm a USING (hull_id) JOIN o_side w ON w.seg_id = a.seg_id WHERE {meets('q.','w.', 1e-6)})) QUALIFY row_number() OVER (PARTITION BY hull_id, face, dir ORDER BY round({dist('x0','y0','hx','hy')},6), seg_id, side) = 1""")
part("o_hits", "SELECT q.hull_id, q.face, q.dir, q.x0 AS px, q.y0 AS py, coalesce(h.hx, q.x1) AS x, coalesce(h.hy, q.y1) AS y, h.hit_seg, h.hit_side FROM o_rays q LEFT JOIN o_rayhit h ON h.hull_id = q.hull_id AND h.face = q.face AND h.dir = q.dir")


@query("slot_sidewalk_hits", f"SELECT hull_id, face, CAST(dir AS INTEGER) AS dir, {r('x',3)} AS x, {r('y',3)} AS y, hit_seg, hit_side FROM o_hits")
def slot_sidewalk_hits(c: City):
    h = XW.sidewalk_hits(c.slot_points, c.crossed, c.straight, c.hull_arms, c.sidewalks, c.merged[0])
    return rounded(h.select("hull_id", "face", "dir", "x", "y", "hit_seg", "hit_side"), x=3, y=3)


def _far(source: str, x: str, y: str) -> str:
    return f"""SELECT hull_id, face, x0, y0, x1, y1 FROM (SELECT a.hull_id, a.face, a.{x} AS x0, a.{y} AS y0, b.{x} AS x1, b.{y} AS y1, {dist(f'a.{x}',f'a.{y}',f'b.{x}',f'b.{y}')} AS d FROM {source} a JOIN {source} b ON a.hull_id = b.hull_id AND a.face = b.face AND (a.{x} < b.{x} OR (a.{x} = b.{x} AND a.{y} < b.{y})))
 WHERE round(d,6) > 0 QUALIFY row_number() OVER (PARTITION BY hull_id, face ORDER BY round(d,6) DESC, x0, y0, x1, y1) = 1"""


part("o_far", _far("o_sramp", "rx", "ry"))


@query("farthest_pair", f"SELECT hull_id, face, {r('x0',6)} AS x0, {r('y0',6)} AS y0, {r('x1',6)} AS x1, {r('y1',6)} AS y1 FROM o_far")
def farthest_pair(c: City):
    f = XW.farthest_pairs(c.slot_ramps, "rx", "ry")
    a, b = F.element_at("pair", 1), F.element_at("pair", 2)
    return rounded(f.select("hull_id", "face", a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")), x0=6, y0=6, x1=6, y1=6)


def line_rows(df, keys):
    """Case lines as rows of vertices."""
    v = df.select(*keys, F.posexplode("line").alias("i", "p")).select(*keys, "i", "p.x", "p.y")
    return rounded(v, x=6, y=6)


def _verts(source: str, *xy: str) -> str:
    return " UNION ALL ".join(f"SELECT hull_id, face, CAST({i} AS INTEGER) AS i, {r(xy[2*i],6)} AS x, {r(xy[2*i+1],6)} AS y FROM {source}" for i in range(len(xy) // 2))


part("o_sn", "SELECT hull_id, face, count(*) AS n, any_value(rx) AS rx, any_value(ry) AS ry FROM o_sramp GROUP BY hull_id, face")
part("o_ca", "SELECT f.*, p.px, p.py FROM o_far f JOIN o_spt p USING (hull_id, face) JOIN o_sn n USING (hull_id, face) WHERE n.n >= 2")
part("o_cb", "SELECT n.*, p.px, p.py FROM o_sn n JOIN o_spt p USING (hull_id, face) WHERE n.n = 1")
part("o_cc", "SELECT a.hull_id, a.face, b.x AS x0, b.y AS y0, a.px, a.py, a.x AS x1, a.y AS y1 FROM o_hits a JOIN o_hits b ON a.hull_id = b.hull_id AND a.face = b.face AND a.dir = 1 AND b.dir = -1 WHERE NOT EXISTS (SELECT 1 FROM o_sramp s WHERE s.hull_id = a.hull_id AND s.face = a.face)")
part("o_cd", "SELECT hull_id, face, CAST(row_number() OVER (PARTITION BY hull_id, face ORDER BY fac_id, i) - 1 AS INTEGER) AS i, x, y FROM (SELECT s.hull_id, s.face, f.fac_id, 0 AS i, x0 AS x, y0 AS y FROM o_sfoot s JOIN o_foot f USING (fac_id) UNION ALL SELECT s.hull_id, s.face, f.fac_id, 1, x1, y1 FROM o_sfoot s JOIN o_foot f USING (fac_id))")
part("o_ta", f"""SELECT hull_id, face, sx0 AS x0, sy0 AS y0, sx1 AS x1, sy1 AS y1 FROM (SELECT c.hull_id, c.face, w.x0 AS sx0, w.y0 AS sy0, w.x1 AS sx1, w.y1 AS sy1, CASE w.side WHEN 'left' THEN '0' ELSE '1' END || a.arm AS ord FROM o_crossed c JOIN o_harm a USING (hull_id) JOIN o_side w ON w.seg_id = a.seg_id JOIN o_straight t ON t.seg_id = c.seg_id WHERE {meets('w.','t.')}) QUALIFY row_number() OVER (PARTITION BY hull_id, face ORDER BY ord) = 1""")
part("o_tb", "SELECT hull_id, face, max(CASE rk WHEN 1 THEN rx END) AS x0, max(CASE rk WHEN 1 THEN ry END) AS y0, max(CASE rk WHEN 2 THEN rx END) AS x1, max(CASE rk WHEN 2 THEN ry END) AS y1 FROM (SELECT *, row_number() OVER (PARTITION BY hull_id, face ORDER BY ord) AS rk FROM o_sramp) GROUP BY hull_id, face HAVING count(*) >= 2")
part("o_swend", f"SELECT DISTINCT s.hull_id, s.face, e.x, e.y FROM o_live s JOIN o_harm a USING (hull_id) JOIN (SELECT seg_id, x0 AS x, y0 AS y FROM o_side UNION ALL SELECT seg_id, x1, y1 FROM o_side) e ON e.seg_id = a.seg_id WHERE {_in('e.x','e.y')}")
part("o_tc", _far("o_swend", "x", "y"))


@query("xwalk_osm_a", _verts("o_ca", "x0", "y0", "px", "py", "x1", "y1"))
def xwalk_osm_a(c: City):
    return line_rows(XW.case_osm_ab(c.slot_points, c.slot_ramps)[0], XW.SLOT)


@query("xwalk_osm_b", _verts("o_cb", "rx", "ry", "px", "py", "2*px-rx", "2*py-ry"))
def xwalk_osm_b(c: City):
    return line_rows(XW.case_osm_ab(c.slot_points, c.slot_ramps)[1], XW.SLOT)


part("o_cc0", "SELECT a.hull_id, a.face, b.x AS x0, b.y AS y0, a.px, a.py, a.x AS x1, a.y AS y1 FROM o_hits a JOIN o_hits b ON a.hull_id = b.hull_id AND a.face = b.face AND a.dir = 1 AND b.dir = -1")


@query("xwalk_osm_c", _verts("o_cc0", "x0", "y0", "px", "py", "x1", "y1"))
def xwalk_osm_c(c: City):
    """All slots with a crossing point, as before any ramp is placed: the lattice has ramps at each of them."""
    return line_rows(XW.case_osm_c(c.slot_hits, c.slot_ramps.where("false")), XW.SLOT)


@query("xwalk_osm_d", f"SELECT hull_id, face, i, {r('x',6)} AS x, {r('y',6)} AS y FROM o_cd")
def xwalk_osm_d(c: City):
    return line_rows(XW.case_osm_d(XW.slot_footways(c.live_slots, c.footpaths), c.footpaths), XW.SLOT)


@query("xwalk_topo_a", _verts("o_ta", "x0", "y0", "x1", "y1"))
def xwalk_topo_a(c: City):
    return line_rows(XW.case_topo_a(c.crossed, c.hull_arms, c.sidewalks, c.straight), XW.SLOT)


@query("xwalk_topo_b", _verts("o_tb", "x0", "y0", "x1", "y1"))
def xwalk_topo_b(c: City):
    return line_rows(XW.case_topo_b(c.slot_ramps), XW.SLOT)


@query("xwalk_topo_c", _verts("o_tc", "x0", "y0", "x1", "y1"))
def xwalk_topo_c(c: City):
    return line_rows(XW.case_topo_c(XW.sidewalk_ends_in_slots(c.live_slots, c.hull_arms, c.sidewalks)), XW.SLOT)


part("o_cases", """SELECT hull_id, face, min(rank) AS rank FROM (SELECT hull_id, face, 0 AS rank FROM o_ca UNION ALL SELECT hull_id, face, 1 FROM o_cb UNION ALL SELECT hull_id, face, 2 FROM o_cc UNION ALL SELECT hull_id, face, 3 FROM o_cd
 UNION ALL SELECT hull_id, face, 4 FROM o_ta UNION ALL SELECT hull_id, face, 5 FROM o_tb UNION ALL SELECT hull_id, face, 6 FROM o_tc) GROUP BY hull_id, face""")
part("o_chosen", "SELECT c.seg_id, c.pos, hull_id, face, ['osm_a','osm_b','osm_c','osm_d','topo_a','topo_b','topo_c'][rank+1] AS source FROM o_cases JOIN o_crossed c USING (hull_id, face) QUALIFY row_number() OVER (PARTITION BY c.seg_id, c.pos ORDER BY hull_id, face) = 1")
part("o_xw", "SELECT x.*, t.grid_id || '_XW_' || pos AS crosswalk_id, l.facility_grid_id AS left_id, r.facility_grid_id AS right_id FROM o_chosen x JOIN o_straight t USING (seg_id) LEFT JOIN o_ids l ON l.seg_id = x.seg_id AND l.facility = 'sidewalk' AND l.side = 'left' LEFT JOIN o_ids r ON r.seg_id = x.seg_id AND r.facility = 'sidewalk' AND r.side = 'right'")


def all_cases(c: City):
    a, b = XW.case_osm_ab(c.slot_points, c.slot_ramps)
    return (a.unionByName(b).unionByName(XW.case_osm_c(c.slot_hits, c.slot_ramps))
            .unionByName(XW.case_osm_d(XW.slot_footways(c.live_slots, c.footpaths), c.footpaths))
            .unionByName(XW.case_topo_a(c.crossed, c.hull_arms, c.sidewalks, c.straight)).unionByName(XW.case_topo_b(c.slot_ramps))
            .unionByName(XW.case_topo_c(XW.sidewalk_ends_in_slots(c.live_slots, c.hull_arms, c.sidewalks))))


@query("case_priority", "SELECT hull_id, face, CAST(rank AS INTEGER) AS rank FROM o_cases")
def case_priority(c: City):
    return all_cases(c).groupBy(*XW.SLOT).agg(F.min("rank").alias("rank"))


@query("first_slot_wins", "SELECT seg_id, pos, hull_id, face, source FROM o_chosen")
def first_slot_wins(c: City):
    return XW.choose(all_cases(c), c.crossed).select("seg_id", "pos", "hull_id", "face", "source")


@query("crosswalk_write", "SELECT seg_id, pos, source, crosswalk_id, left_id, right_id FROM o_xw")
def crosswalk_write(c: City):
    w = XW.write(c.detected[0], c.straight, c.facilities)
    return w.select("seg_id", "pos", "source", "crosswalk_id", C("grid_ids.left").alias("left_id"), C("grid_ids.right").alias("right_id"))


part("o_xwline", """SELECT c.seg_id, c.pos, v.i, v.x, v.y FROM o_chosen c JOIN (
 SELECT hull_id, face, 0 AS rank, i, CASE i WHEN 0 THEN x0 WHEN 1 THEN px ELSE x1 END AS x, CASE i WHEN 0 THEN y0 WHEN 1 THEN py ELSE y1 END AS y FROM o_ca CROSS JOIN (SELECT unnest([0,1,2]) AS i)
 UNION ALL SELECT hull_id, face, 1, i, CASE i WHEN 0 THEN rx WHEN 1 THEN px ELSE 2*px-rx END, CASE i WHEN 0 THEN ry WHEN 1 THEN py ELSE 2*py-ry END FROM o_cb CROSS JOIN (SELECT unnest([0,1,2]) AS i)
 UNION ALL SELECT hull_id, face, 2, i, CASE i WHEN 0 THEN x0 WHEN 1 THEN px ELSE x1 END, CASE i WHEN 0 THEN y0 WHEN 1 THEN py ELSE y1 END FROM o_cc CROSS JOIN (SELECT unnest([0,1,2]) AS i)
 UNION ALL SELECT hull_id, face, 3, i, x, y FROM o_cd
 UNION ALL SELECT hull_id, face, 4, i, CASE i WHEN 0 THEN x0 ELSE x1 END, CASE i WHEN 0 THEN y0 ELSE y1 END FROM o_ta CROSS JOIN (SELECT unnest([0,1]) AS i)
 UNION ALL SELECT hull_id, face, 5, i, CASE i WHEN 0 THEN x0 ELSE x1 END, CASE i WHEN 0 THEN y0 ELSE y1 END FROM o_tb CROSS JOIN (SELECT unnest([0,1]) AS i)
 UNION ALL SELECT hull_id, face, 6, i, CASE i WHEN 0 THEN x0 ELSE x1 END, CASE i WHEN 0 THEN y0 ELSE y1 END FROM o_tc CROSS JOIN (SELECT unnest([0,1]) AS i)) v
 ON v.hull_id = c.hull_id AND v.face = c.face AND v.rank = list_position(['osm_a','osm_b','osm_c','osm_d','topo_a','topo_b','topo_c'], c.source) - 1""")
part("o_xwsegs", "SELECT * FROM (SELECT seg_id, pos, i, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by FROM o_xwline WINDOW w AS (PARTITION BY seg_id, pos ORDER BY i)) WHERE bx IS NOT NULL")
part("o_xwmid", f"SELECT seg_id, pos, CASE WHEN sum(l) > 0 THEN sum(l*(ax+bx)/2)/sum(l) ELSE arg_min(ax, i) END AS cx, CASE WHEN sum(l) > 0 THEN sum(l*(ay+by)/2)/sum(l) ELSE arg_min(ay, i) END AS cy FROM (SELECT *, {dist('ax','ay','bx','by')} AS l FROM o_xwsegs) GROUP BY seg_id, pos")
part("o_xwattr", f"""SELECT n.seg_id, n.pos, n.osmid FROM (SELECT s.seg_id, s.pos, x.osmid, x.x, x.y, min({pseg('x.x','x.y','s.ax','s.ay','s.bx','s.by')}) AS d FROM o_xwsegs s JOIN o_crossings x ON x.x BETWEEN least(ax,bx)-22 AND greatest(ax,bx)+22 AND x.y BETWEEN least(ay,by)-22 AND greatest(ay,by)+22 GROUP BY ALL HAVING d <= 22) n JOIN o_xwmid m USING (seg_id, pos)
 QUALIFY row_number() OVER (PARTITION BY n.seg_id, n.pos ORDER BY round({dist('n.x','n.y','m.cx','m.cy')},6), n.osmid) = 1""")


@query("crosswalk_attrs", "SELECT w.seg_id, w.pos, a.osmid, x.type, x.controlled, x.marked, x.markings, x.signals, x.kerb, x.tactile_paving FROM o_chosen w LEFT JOIN o_xwattr a USING (seg_id, pos) LEFT JOIN o_crossings x ON x.osmid = a.osmid")
def crosswalk_attrs(c: City):
    return XW.attributes(c.crosswalks, c.crossings).select("seg_id", "pos", "osmid", "type", "controlled", "marked", "markings", "signals", "kerb", "tactile_paving")


@query("clear_absorbed", "SELECT seg_id, side FROM o_side WHERE seg_id NOT IN (SELECT fac_id // 2 * 4096 FROM o_sfoot JOIN o_chosen c USING (hull_id, face) WHERE c.source = 'osm_d')")
def clear_absorbed(c: City):
    """Sidewalk rows of streets whose footpath was consumed by a chain crosswalk."""
    own = c.detected[2].select("fac_id", F.floor(C("fac_id") / 2).cast("long").alias("edge_id"))
    gone = XW.absorbed_segments(c.detected[2], own, c.straight)
    return XW.clear_absorbed(c.sidewalks.select("seg_id", "side"), gone)


part("o_share", "SELECT seg_id, side, round(share, 9) AS share, node_id FROM o_captive WHERE round(share, 9) >= 1e-12 QUALIFY row_number() OVER (PARTITION BY seg_id, side ORDER BY round(share,9) DESC, node_id) = 1")
part("o_inring", f"""SELECT r.seg_id, r.side, r.pos, r.n FROM o_ramps r JOIN o_share s USING (seg_id, side) JOIN o_hfaces h ON h.node_id = s.node_id WHERE s.share < 0.03 GROUP BY ALL HAVING bool_and({cross('h.bx-h.ax','h.by-h.ay','r.x-h.ax','r.y-h.ay')} >= -1e-6)""")


@query("clear_stubs", """SELECT 'ramp' AS kind, seg_id, side, pos, n FROM o_ramps r WHERE NOT EXISTS (SELECT 1 FROM o_share s WHERE s.seg_id = r.seg_id AND s.side = r.side AND s.share >= 0.03) AND NOT EXISTS (SELECT 1 FROM o_inring i WHERE i.seg_id = r.seg_id AND i.side = r.side AND i.pos = r.pos AND i.n = r.n)
UNION ALL SELECT 'sidewalk', seg_id, side, NULL, NULL FROM o_side w WHERE NOT EXISTS (SELECT 1 FROM o_share s WHERE s.seg_id = w.seg_id AND s.side = w.side AND s.share >= 0.03)""")
def clear_stubs(c: City):
    """Rows kept, with the stub share lowered to 3 % so that block-long sidewalks can be stubs."""
    hulls = c.node_hulls.withColumn("hull_id", C("node_id"))
    sw, ramps = XW.clear_stubs(c.sidewalks, c.ramps, hulls, 0.03)
    none = F.lit(None)
    return ramps.select(F.lit("ramp").alias("kind"), "seg_id", "side", "pos", "n").unionByName(
        sw.select(F.lit("sidewalk").alias("kind"), "seg_id", "side", none.cast("string").alias("pos"), none.cast("int").alias("n")))


# -- snapping --------------------------------------------------------------------

part("o_ang", "SELECT *, lead(k) OVER w AS nk, first_value(k) OVER w AS fk, row_number() OVER w AS pair, count(*) OVER (PARTITION BY node_id) AS n FROM (SELECT *, seg_id || '/' || side || '/' || pos AS k, round(CASE WHEN atan2(px-nx, py-ny) < 0 THEN atan2(px-nx, py-ny) + 2*pi() ELSE atan2(px-nx, py-ny) END, 6) AS angle FROM o_arm) WINDOW w AS (PARTITION BY node_id ORDER BY angle, arm)")


@query("angular_pairs", "SELECT node_id, k AS a, coalesce(nk, fk) AS b FROM o_ang WHERE n >= 2 AND split_part(k,'/',1) || split_part(k,'/',2) <> split_part(coalesce(nk,fk),'/',1) || split_part(coalesce(nk,fk),'/',2)")
def angular_pairs(c: City):
    from kerbline.operators import snap
    p = snap.angular_pairs(c.arms)
    def key(*cols):
        return F.concat_ws("/", C(cols[0]).cast("string"), *cols[1:])
    return p.select("node_id", key("seg_id", "side", "pos").alias("a"), key("b.seg_id", "b.side", "b.pos").alias("b"))


@query("snap_endpoints")
def snap_endpoints(c: City):
    from kerbline.operators import snap
    s = snap.snap_endpoints(c.sidewalks, c.straight)
    return rounded(s.select("seg_id", "side", F.size("utm").alias("n_vertices"), G.length(C("utm")).alias("length")), length=3)


# -- government ramps --------------------------------------------------------------

part("o_inv", "SELECT locid, x, y, curbreturnloc, conditionscore FROM o_gov WHERE crexist = '1' AND longitude IS NOT NULL AND latitude IS NOT NULL")
part("o_gmatch", f"""SELECT locid, seg_id, side, pos, n FROM (SELECT g.locid, p.seg_id, p.side, p.pos, p.n, {dist('g.x','g.y','p.x','p.y')} AS d FROM o_inv g JOIN o_ramps p ON p.x BETWEEN g.x-5 AND g.x+5 AND p.y BETWEEN g.y-5 AND g.y+5) WHERE d <= 5 QUALIFY row_number() OVER (PARTITION BY locid ORDER BY round(d,6), seg_id, side, pos, n) = 1""")


@query("gov_match_ramp", "SELECT seg_id, side, pos, n, max(locid) AS locid, arg_max(i.curbreturnloc, locid) AS returnloc, arg_max(i.conditionscore, locid) AS condition_score FROM o_gmatch JOIN o_inv i USING (locid) GROUP BY seg_id, side, pos, n")
def gov_match_ramp(c: City):
    from kerbline.operators import ramps as R
    points = R.resolve(c.fx["fx_gov_ramps"])
    done = R.overwrite(c.ramps, points, R.match_existing(points, c.ramps)).where("quality = 'government'")
    return done.select("seg_id", "side", "pos", "n", "locid", "returnloc", "condition_score")


part("o_groad", f"""SELECT locid, seg_id, x, y, {dist('x','y','x0','y0')} <= {dist('x','y','x1','y1')} AS at_start, {cross('x1-x0','y1-y0','x-(x0+t*(x1-x0))','y-(y0+t*(y1-y0))')} > 0 AS lft FROM (SELECT g.locid, g.x, g.y, s.seg_id, s.x0, s.y0, s.x1, s.y1, {__import__('queries.sqltext', fromlist=['tparam']).tparam('g.x','g.y','s.x0','s.y0','s.x1','s.y1')} AS t, {pseg('g.x','g.y','s.x0','s.y0','s.x1','s.y1')} AS d
 FROM o_inv g JOIN o_straight s ON least(s.x0,s.x1) <= g.x + 50 AND greatest(s.x0,s.x1) >= g.x - 50 AND least(s.y0,s.y1) <= g.y + 50 AND greatest(s.y0,s.y1) >= g.y - 50 WHERE g.locid NOT IN (SELECT locid FROM o_gmatch)) WHERE d <= 50 QUALIFY row_number() OVER (PARTITION BY locid ORDER BY round(d,6), seg_id) = 1""")
part("o_gwant", "SELECT *, row_number() OVER (PARTITION BY seg_id, side, pos ORDER BY locid) AS rk FROM (SELECT locid, seg_id, CASE WHEN lft THEN 'left' ELSE 'right' END AS side, CASE WHEN at_start THEN 'start' ELSE 'end' END AS pos FROM o_groad)")
part("o_gfree", "SELECT w.seg_id, w.side, w.pos, i.n, row_number() OVER (PARTITION BY w.seg_id, w.side, w.pos ORDER BY i.n) AS rk FROM (SELECT DISTINCT seg_id, side, pos FROM o_gwant) w CROSS JOIN (SELECT CAST(unnest([1,2,3]) AS INTEGER) AS n) i WHERE NOT EXISTS (SELECT 1 FROM o_ramps r WHERE r.seg_id = w.seg_id AND r.side = w.side AND r.pos = w.pos AND r.n = i.n)")


@query("gov_nearest_road", "SELECT w.locid, w.seg_id, w.side, w.pos, f.n, t.grid_id || '_CR_' || w.side || '_' || w.pos || '_' || CAST(f.n AS VARCHAR) AS ramp_id FROM o_gwant w JOIN o_gfree f USING (seg_id, side, pos, rk) JOIN o_straight t USING (seg_id)")
def gov_nearest_road(c: City):
    from kerbline.operators import ramps as R
    points = R.resolve(c.fx["fx_gov_ramps"])
    rest = points.join(R.match_existing(points, c.ramps).select("locid"), "locid", "left_anti")
    return R.place_unmatched(rest, c.roads, c.ramps).select("locid", "seg_id", "side", "pos", "n", "ramp_id")
