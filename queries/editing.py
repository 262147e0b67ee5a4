"""Edit queries: the change log applied to the straight network."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions import geom as G
from kerbline.operators import calming as CA, edits as ED, facilities as FA, intersections as IX
from kerbline.plans import changes, city as plan
from kerbline.staging import stage
from queries.registry import City, query, rounded
from queries.sqltext import cross, dist, part, pseg, r, segseg, tparam

C = F.col
VERTEX_APART_M = 1e-9  # a vertex nearer to the end of its line stands at that end


def of_type(c: City, *types: str):
    return c.changes.where(C("edit_type").isin(*types))


part("o_depth", """SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY edit_id ROWS UNBOUNDED PRECEDING)) AS depth FROM (SELECT *, sum(CASE WHEN edit_type = 'undo' THEN -1 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY edit_id ROWS UNBOUNDED PRECEDING) AS s FROM fx_changes)""")


@query("undo_compact", "SELECT edit_id, user_id, edit_type FROM (SELECT *, min(depth) OVER (PARTITION BY user_id ORDER BY edit_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM o_depth) WHERE edit_type <> 'undo' AND (later IS NULL OR later >= depth)")
def undo_compact(c: City):
    return ED.effective_edits(c.changes).select("edit_id", "user_id", "edit_type")


part("o_nodeseg", "SELECT start_node AS node_id, min(seg_id) AS seg_id FROM o_straight GROUP BY start_node")
part("o_attr", "SELECT c.edit_id, s.seg_id, c.col, c.new_value FROM fx_changes c JOIN o_nodeseg s USING (node_id) WHERE c.edit_type = 'attr_edit'")


def attr_edits(c: City):
    """Attribute edits booked on the first street leaving the named node."""
    first = c.straight.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id"))
    return of_type(c, "attr_edit").join(first, "node_id").select("edit_id", "seg_id", "col", "new_value")


@query("latest_edit", "SELECT seg_id, col, arg_max(new_value, edit_id) AS new_value, max(edit_id) AS edit_id FROM o_attr GROUP BY seg_id, col")
def latest_edit(c: City):
    return ED.latest_edits(attr_edits(c), "seg_id")


@query("edit_attr", """SELECT t.seg_id, coalesce(n.v, t.name) AS name, coalesce(l.v, t.lanes) AS lanes, coalesce(w.v, t.lane_width) AS lane_width FROM o_straight t
LEFT JOIN (SELECT seg_id, arg_max(new_value, edit_id) AS v FROM o_attr WHERE col = 'name' GROUP BY seg_id) n USING (seg_id) LEFT JOIN (SELECT seg_id, arg_max(new_value, edit_id) AS v FROM o_attr WHERE col = 'lanes' GROUP BY seg_id) l USING (seg_id)
LEFT JOIN (SELECT seg_id, arg_max(new_value, edit_id) AS v FROM o_attr WHERE col = 'lane_width' GROUP BY seg_id) w USING (seg_id)""")
def edit_attr(c: City):
    return ED.edit_attributes(c.straight, attr_edits(c)).select("seg_id", "name", "lanes", "lane_width")


part("o_moves", "SELECT node_id, arg_max(lon, edit_id) AS lon, arg_max(lat, edit_id) AS lat FROM o_changes WHERE edit_type = 'move_point' GROUP BY node_id")


@query("edit_move", f"SELECT seg_id, {r('coalesce(a.lon, lon0)',7)} AS lon0, {r('coalesce(a.lat, lat0)',7)} AS lat0, {r('coalesce(b.lon, lon1)',7)} AS lon1, {r('coalesce(b.lat, lat1)',7)} AS lat1 FROM o_straight LEFT JOIN o_moves a ON a.node_id = start_node LEFT JOIN o_moves b ON b.node_id = end_node")
def edit_move(c: City):
    s = ED.move_nodes(c.straight, of_type(c, "move_point"))
    a, b = G.first_pt(C("geom")), G.last_pt(C("geom"))
    return rounded(s.select("seg_id", a["x"].alias("lon0"), a["y"].alias("lat0"), b["x"].alias("lon1"), b["y"].alias("lat1")), lon0=7, lat0=7, lon1=7, lat1=7)


part("o_addhit", f"""SELECT seg_id, pos FROM (SELECT c.edit_id, e.seg_id, e.pos, {dist('c.x','c.y','e.x','e.y')} AS d FROM o_changes c JOIN (SELECT seg_id, 'start' AS pos, x0 AS x, y0 AS y FROM o_straight UNION ALL SELECT seg_id, 'end', x1, y1 FROM o_straight) e
 ON e.x BETWEEN c.x - 40 AND c.x + 40 AND e.y BETWEEN c.y - 40 AND c.y + 40 WHERE c.edit_type = 'add_point') WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY edit_id ORDER BY round(d,6), seg_id, pos DESC) = 1""")


@query("edit_add_node", "SELECT seg_id, start_is_intersection OR seg_id IN (SELECT seg_id FROM o_addhit WHERE pos = 'start') AS s, end_is_intersection OR seg_id IN (SELECT seg_id FROM o_addhit WHERE pos = 'end') AS e FROM o_straight")
def edit_add_node(c: City):
    s = ED.flag_added(c.straight, of_type(c, "add_point"))
    return s.select("seg_id", C("start_is_intersection").alias("s"), C("end_is_intersection").alias("e"))


part("o_toggle", "SELECT seg_id, CASE WHEN edit_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, 'start' AS pos, CAST(1 + edit_id % 3 AS INTEGER) AS n, arg_max(edit_type = 'add_point', edit_id) AS enabled FROM fx_changes JOIN o_nodeseg USING (node_id) WHERE edit_type IN ('delete_point','add_point') GROUP BY ALL")


@query("edit_toggle_ramp", "SELECT r.seg_id, r.side, r.pos, r.n, r.ramp_id FROM o_ramps r LEFT JOIN o_toggle t ON t.seg_id = r.seg_id AND t.side = r.side AND t.pos = r.pos AND t.n = r.n WHERE coalesce(t.enabled, true)")
def edit_toggle_ramp(c: City):
    first = c.straight.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id"))
    t = of_type(c, "delete_point", "add_point").join(first, "node_id").select(
        "edit_id", "seg_id", F.when(C("edit_id") % 2 == 0, "left").otherwise("right").alias("side"), F.lit("start").alias("pos"),
        (1 + C("edit_id") % 3).cast("int").alias("n"), (C("edit_type") == "add_point").alias("enabled"))
    return ED.toggle_ramps(c.ramps, c.ramps, t).select("seg_id", "side", "pos", "n", "ramp_id")


_DEL = "(SELECT node_id FROM fx_changes WHERE edit_type = 'delete_point')"


@query("edit_delete_point", f"SELECT seg_id, start_is_intersection AND start_node NOT IN {_DEL} AS s, end_is_intersection AND end_node NOT IN {_DEL} AS e, start_node IN {_DEL} AS sc, end_node IN {_DEL} AS ec FROM o_straight")
def edit_delete_point(c: City):
    s = ED.unflag_nodes(c.straight, of_type(c, "delete_point"), True)
    return s.select("seg_id", C("start_is_intersection").alias("s"), C("end_is_intersection").alias("e"), C("start_point_cleared").alias("sc"), C("end_point_cleared").alias("ec"))


@query("edit_delete_hull", f"SELECT seg_id, start_is_intersection AND start_node NOT IN {_DEL} AS s, end_is_intersection AND end_node NOT IN {_DEL} AS e FROM o_straight")
def edit_delete_hull(c: City):
    s = ED.unflag_nodes(c.straight, of_type(c, "delete_point"), False)
    return s.select("seg_id", C("start_is_intersection").alias("s"), C("end_is_intersection").alias("e"))


part("o_mreq", """SELECT m.* FROM o_mreq0 m JOIN (SELECT s, min(node_id) AS f FROM (SELECT a AS s, node_id FROM o_mreq0 UNION ALL SELECT b, node_id FROM o_mreq0) GROUP BY s) x ON x.s = m.a AND x.f = m.node_id JOIN (SELECT s, min(node_id) AS f FROM (SELECT a AS s, node_id FROM o_mreq0 UNION ALL SELECT b, node_id FROM o_mreq0) GROUP BY s) y ON y.s = m.b AND y.f = m.node_id""")
part("o_mreq0", f"SELECT node_id, list(seg_id ORDER BY seg_id)[1] AS a, list(seg_id ORDER BY seg_id)[2] AS b FROM (SELECT start_node AS node_id, seg_id FROM o_straight WHERE start_node <> end_node UNION ALL SELECT end_node, seg_id FROM o_straight WHERE start_node <> end_node) WHERE node_id IN {_DEL} GROUP BY node_id HAVING count(*) >= 2")


@query("edit_merge_segments", f"""SELECT t.seg_id, CASE WHEN m.a IS NOT NULL AND t.start_node = m.node_id AND t.end_node <> m.node_id THEN CASE WHEN c.start_node = m.node_id THEN c.end_node ELSE c.start_node END ELSE t.start_node END AS start_node,
 CASE WHEN m.a IS NOT NULL AND t.end_node = m.node_id THEN CASE WHEN c.start_node = m.node_id THEN c.end_node ELSE c.start_node END ELSE t.end_node END AS end_node,
 CAST(CASE WHEN m.a IS NULL THEN 2 ELSE 3 END AS INTEGER) AS n_vertices, {r("CASE WHEN m.a IS NULL THEN sqrt((t.x1-t.x0)*(t.x1-t.x0)+(t.y1-t.y0)*(t.y1-t.y0)) ELSE sqrt((t.x1-t.x0)*(t.x1-t.x0)+(t.y1-t.y0)*(t.y1-t.y0)) + sqrt((c.x1-c.x0)*(c.x1-c.x0)+(c.y1-c.y0)*(c.y1-c.y0)) END", 3)} AS length
FROM o_straight t LEFT JOIN o_mreq m ON m.a = t.seg_id LEFT JOIN o_straight c ON c.seg_id = m.b WHERE t.seg_id NOT IN (SELECT b FROM o_mreq)""")
def edit_merge_segments(c: City):
    req = ED.merge_requests(of_type(c, "delete_point").select("node_id").distinct(), c.straight)
    s = ED.merge_segments(c.straight, req)
    return rounded(s.select("seg_id", "start_node", "end_node", F.size("utm").alias("n_vertices"), G.length(C("utm")).alias("length")), length=3)


@query("max_drawn_id", "SELECT max(CAST(regexp_replace(grid_id, '[^0-9]', '', 'g') AS BIGINT)) AS max_id FROM o_straight")
def max_drawn_id(c: City):
    return ED.max_drawn_id(c.straight)


part("o_maxid", "SELECT max(CAST(regexp_replace(grid_id, '[^0-9]', '', 'g') AS BIGINT)) AS max_id FROM o_straight")


@query("edit_draw_segment", "SELECT grid_id, highway, start_is_intersection FROM o_straight UNION ALL SELECT 'drawn_' || CAST((SELECT max_id FROM o_maxid) + row_number() OVER (ORDER BY edit_id) AS VARCHAR), 'unclassified', false FROM fx_changes WHERE edit_type = 'add_point'")
def edit_draw_segment(c: City):
    d = of_type(c, "add_point").select("edit_id", G.line_of(C("lon"), C("lat"), C("lon") + 0.001, C("lat") + 0.0005).alias("geom"),
                                       G.line_of(C("x"), C("y"), C("x") + 88.0, C("y") + 55.0).alias("utm"))
    return ED.draw_segments(c.straight, d).select("grid_id", "highway", "start_is_intersection")


part("o_splitpt", f"""SELECT DISTINCT seg_id, edit_id FROM (SELECT edit_id, seg_id FROM (SELECT c.edit_id, s.seg_id, {pseg('c.x','c.y','s.x0','s.y0','s.x1','s.y1')} AS d FROM o_splits c JOIN o_straight s ON least(s.x0,s.x1) <= c.x + 40 AND greatest(s.x0,s.x1) >= c.x - 40 AND least(s.y0,s.y1) <= c.y + 40 AND greatest(s.y0,s.y1) >= c.y - 40) WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY edit_id ORDER BY round(d,6), seg_id) = 1)""")
part("o_splits", "SELECT edit_id, x + 31.0e0 AS x, y + 7.0e0 AS y FROM o_changes WHERE edit_type = 'add_point'")
part("o_splitm", f"SELECT *, t*len AS m FROM (SELECT p.seg_id, p.edit_id, s.start_node, s.end_node, {tparam('c.x','c.y','s.x0','s.y0','s.x1','s.y1')} AS t, {dist('s.x0','s.y0','s.x1','s.y1')} AS len FROM o_splitpt p JOIN o_splits c USING (edit_id) JOIN o_straight s ON s.seg_id = p.seg_id) WHERE t*len > 0.01 AND t*len < len - 0.01")


part("o_cuts", "SELECT *, row_number() OVER w AS k, lead(m) OVER w AS next_m, lead(edit_id) OVER w AS next_id FROM (SELECT *, lag(m) OVER (PARTITION BY seg_id ORDER BY m, edit_id) AS m0 FROM o_splitm) WHERE m0 IS NULL OR m - m0 > 0.01 WINDOW w AS (PARTITION BY seg_id ORDER BY m, edit_id)")


@query("edit_split_segment", f"SELECT seg_id, edit_id, CAST(0 AS INTEGER) AS part, start_node, -2305843009213693952 - edit_id AS end_node, {r('m',3)} AS length FROM o_cuts WHERE k = 1 UNION ALL SELECT seg_id, edit_id, CAST(k AS INTEGER), -2305843009213693952 - edit_id, coalesce(-2305843009213693952 - next_id, end_node), {r('coalesce(next_m, len)-m',3)} FROM o_cuts")
def edit_split_segment(c: City):
    pts = of_type(c, "add_point").select("edit_id", (C("x") + 31.0).alias("x"), (C("y") + 7.0).alias("y"))
    s = ED.split_segments(c.straight, pts)
    return rounded(s.select("seg_id", "edit_id", "part", "start_node", "end_node", G.length(C("utm")).alias("length")), length=3)


@query("edit_hull", f"SELECT node_id, {r('x0',6)} AS x0, {r('y0',6)} AS y0 FROM (SELECT node_id, arg_max(x, edit_id) - 5 AS x0, arg_max(y, edit_id) - 5 AS y0 FROM o_changes WHERE edit_type = 'move_point' GROUP BY node_id UNION ALL SELECT node_id, ax, ay FROM o_hfaces WHERE face = 0 AND node_id NOT IN (SELECT node_id FROM fx_changes WHERE edit_type = 'move_point'))")
def edit_hull(c: City):
    ring = G.line_of(C("x") - 5, C("y") - 5, C("x") + 5, C("y") - 5, C("x") + 5, C("y") + 5, C("x") - 5, C("y") + 5)
    e = of_type(c, "move_point").select("edit_id", "node_id", ring.alias("ring"))
    h = ED.edit_hulls(c.node_hulls, e)
    return rounded(h.select("node_id", C("ring")[0]["x"].alias("x0"), C("ring")[0]["y"].alias("y0")), x0=6, y0=6)


part("o_hcent", """SELECT node_id, fx + sum((ax+bx)*c)/(3*sum(c)) AS x, fy + sum((ay+by)*c)/(3*sum(c)) AS y FROM (SELECT *, ax*by-ay*bx AS c FROM (SELECT node_id, fx, fy, ax-fx AS ax, ay-fy AS ay, bx-fx AS bx, by-fy AS by FROM (SELECT *, first_value(ax) OVER (PARTITION BY node_id ORDER BY face) AS fx, first_value(ay) OVER (PARTITION BY node_id ORDER BY face) AS fy FROM o_hfaces))) GROUP BY node_id, fx, fy""")
part("o_pick", f"SELECT key_id, node_id, d FROM (SELECT k.key_id, h.node_id, {dist('k.x','k.y','h.x','h.y')} AS d FROM (SELECT edit_id AS key_id, x + 37.0e0 AS x, y + 11.0e0 AS y FROM o_changes WHERE edit_type = 'delete_point') k CROSS JOIN o_hcent h) QUALIFY row_number() OVER (PARTITION BY key_id ORDER BY round(d,6), node_id) = 1")


def hull_picks(c: City):
    keys = of_type(c, "delete_point").select(C("edit_id").alias("key_id"), (C("x") + 37.0).alias("x"), (C("y") + 11.0).alias("y"))
    return ED.nearest_hulls(keys, c.node_hulls)


@query("nearest_hull", f"SELECT key_id, node_id, {r('d',2)} AS d FROM o_pick")
def nearest_hull(c: City):
    return rounded(hull_picks(c), d=2)


part("o_picks2", "SELECT key_id AS edit_id, node_id FROM o_pick UNION SELECT p.key_id, c.node_id FROM o_pick p JOIN fx_changes c ON c.edit_id = p.key_id WHERE c.node_id IN (SELECT node_id FROM o_hfaces)")


def picks(c: City):
    """Each deletion stands for a consolidation of the hull under the cursor and the hull of the named node."""
    a = hull_picks(c).select(C("key_id").alias("edit_id"), "node_id")
    b = of_type(c, "delete_point").select("edit_id", "node_id").join(c.node_hulls.select("node_id"), "node_id", "left_semi").select("edit_id", "node_id")
    return a.unionByName(b).distinct()


@query("max_gap", f"""SELECT edit_id, {r('max(d)',2)} AS max_gap, {r('max(d)/2+0.5',2)} AS buffer_m FROM (SELECT a.edit_id, p.node_id AS n1, q.node_id AS n2, min({segseg('p.','q.')}) AS d FROM o_picks2 a JOIN o_picks2 b ON a.edit_id = b.edit_id AND a.node_id < b.node_id
 JOIN (SELECT node_id, ax AS x0, ay AS y0, bx AS x1, by AS y1 FROM o_hfaces) p ON p.node_id = a.node_id JOIN (SELECT node_id, ax AS x0, ay AS y0, bx AS x1, by AS y1 FROM o_hfaces) q ON q.node_id = b.node_id GROUP BY ALL) GROUP BY edit_id""")
def max_gap(c: City):
    return rounded(ED.merge_gap(picks(c), c.node_hulls), max_gap=2, buffer_m=2)


part("o_link", "SELECT DISTINCT m.a, p.node_id AS b FROM o_picks2 p JOIN (SELECT edit_id, min(node_id) AS a FROM o_picks2 GROUP BY edit_id) m USING (edit_id) WHERE p.node_id > m.a")


@query("edit_consolidate", "SELECT id AS node_id, min(label) AS hull_id FROM (WITH RECURSIVE e AS (SELECT a, b FROM o_link UNION ALL SELECT b, a FROM o_link), reach(id, label) AS (SELECT DISTINCT node_id, node_id FROM o_hfaces UNION SELECT e.b, reach.label FROM reach JOIN e ON e.a = reach.id WHERE reach.label < e.b) SELECT * FROM reach) GROUP BY id")
def edit_consolidate(c: City):
    ids = c.node_hulls.select(C("node_id").alias("id"))
    comps = IX.connected_components(ids, IX.hull_pairs(c.node_hulls).select("a", "b").unionByName(ED.consolidate_links(picks(c))))
    return comps.select(C("id").alias("node_id"), C("component").alias("hull_id"))


@query("edit_bbox", f"SELECT {r('min(x)',7)} AS min_x, {r('min(y)',7)} AS min_y, {r('max(x)',7)} AS max_x, {r('max(y)',7)} AS max_y FROM fx_changes WHERE edit_type IN ('move_point','add_point','delete_point')")
def edit_bbox(c: City):
    return rounded(ED.edit_bbox(of_type(c, "move_point", "add_point", "delete_point")), min_x=7, min_y=7, max_x=7, max_y=7)


@query("dirty_stage", "SELECT user_id, CAST(min(CASE edit_type WHEN 'move_point' THEN 0 WHEN 'add_point' THEN 1 WHEN 'delete_point' THEN 1 ELSE 99 END) AS INTEGER) AS dirty_from_stage FROM fx_changes GROUP BY user_id")
def dirty_stage(c: City):
    return ED.dirty_stage(c.changes, ["user_id"])


@query("drawn_crosswalks", f"SELECT c.edit_id, b.seg_id, b.pos, {r('a.x',6)} AS ax, {r('a.y',6)} AS ay, {r('b.x',6)} AS bx, {r('b.y',6)} AS by FROM fx_changes c JOIN o_nodeseg s ON s.node_id = c.node_id JOIN o_ramps a ON a.seg_id = s.seg_id AND a.side = 'left' AND a.pos = 'start' AND a.n = 1 JOIN o_ramps b ON b.seg_id = s.seg_id AND b.side = 'right' AND b.pos = 'start' AND b.n = 1 WHERE c.edit_type = 'add_point'")
def drawn_crosswalks(c: City):
    first = c.straight.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id"))
    one = F.lit(1)
    req = of_type(c, "add_point").join(first, "node_id").select(
        "edit_id", C("seg_id").alias("a_seg_id"), F.lit("left").alias("a_side"), F.lit("start").alias("a_pos"), one.alias("a_n"),
        C("seg_id").alias("b_seg_id"), F.lit("right").alias("b_side"), F.lit("start").alias("b_pos"), one.alias("b_n"))
    d = ED.draw_crosswalks(req, c.ramps)
    p, q = C("line")[0], C("line")[1]
    return rounded(d.select("edit_id", "seg_id", "pos", p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by")), ax=6, ay=6, bx=6, by=6)


part("o_drag2", "SELECT start_node AS n FROM o_straight WHERE seg_id IN (SELECT seg_id FROM o_nodeseg JOIN fx_changes USING (node_id) WHERE edit_type = 'move_point') UNION SELECT end_node FROM o_straight WHERE seg_id IN (SELECT seg_id FROM o_nodeseg JOIN fx_changes USING (node_id) WHERE edit_type = 'move_point')")


@query("affected_rows", """SELECT seg_id FROM o_straight WHERE start_node IN (SELECT node_id FROM fx_changes WHERE edit_type = 'delete_point') OR end_node IN (SELECT node_id FROM fx_changes WHERE edit_type = 'delete_point') OR seg_id IN (SELECT seg_id FROM o_toggle)
 OR start_node IN (SELECT n FROM o_drag2) OR end_node IN (SELECT n FROM o_drag2)""")
def affected_rows(c: City):
    first = c.straight.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id"))
    named = of_type(c, "delete_point", "add_point").join(first, "node_id").select("seg_id")
    dragged = of_type(c, "move_point").join(first, "node_id").select("seg_id").distinct()
    return ED.affected_segments(c.straight, of_type(c, "delete_point").select("node_id"), named, dragged).select("seg_id")


# -- a log of every kind of edit, applied in one changeset ------------------------

_KIND = """CASE edit_type WHEN 'attr_edit' THEN CASE WHEN edit_id % 4 = 3 THEN 'toggle_curb_ramp' ELSE 'attr_edit' END
 WHEN 'move_point' THEN CASE WHEN edit_id % 3 = 1 THEN 'edit_polygon_face' ELSE 'move_point' END
 WHEN 'delete_point' THEN CASE edit_id % 3 WHEN 0 THEN 'delete_point' WHEN 1 THEN 'merge_segments' ELSE 'delete_polygon' END
 WHEN 'add_point' THEN CASE edit_id % 4 WHEN 0 THEN 'add_point' WHEN 1 THEN 'draw_segment' WHEN 2 THEN 'split_segment' ELSE 'draw_crosswalk' END ELSE edit_type END"""


def edit_log(c: City):
    """The change log as an edit table of every kind; a merge names the two least streets at its node."""
    e = c.changes.withColumn("edit_type", F.expr(_KIND))
    first = c.straight.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("_first"))
    merges = ED.merge_requests(e.where("edit_type = 'merge_segments'").select("node_id").distinct(), c.straight).select(
        "node_id", C("seg_id").alias("_a"), C("consumed_id").alias("_b"))
    j = e.join(first, "node_id", "left").join(merges, "node_id", "left")
    def when(kind: str, value):
        return F.when(C("edit_type") == kind, value)
    ring = G.line_of(C("x") - 5, C("y") - 5, C("x") + 5, C("y") - 5, C("x") + 5, C("y") + 5, C("x") - 5, C("y") + 5)
    ramp = C("edit_type").isin("toggle_curb_ramp", "draw_crosswalk")
    return j.select(
        "edit_id", "user_id", "edit_type", F.when((C("edit_type") != "merge_segments") | C("_a").isNotNull(), C("node_id")).alias("node_id"),
        F.when(C("edit_type").isin("attr_edit", "toggle_curb_ramp", "draw_crosswalk"), C("_first")).otherwise(when("merge_segments", C("_a"))).alias("seg_id"),
        when("merge_segments", C("_b")).alias("consumed_id"), "col", "new_value", "lon", "lat", "x", "y",
        F.when(ramp, F.when((C("edit_type") == "draw_crosswalk") | (C("edit_id") % 2 == 0), "left").otherwise("right")).alias("side"),
        F.when(ramp, "start").alias("pos"), when("draw_crosswalk", F.lit(1)).otherwise(when("toggle_curb_ramp", (1 + C("edit_id") % 3).cast("int"))).alias("n"),
        when("toggle_curb_ramp", C("edit_id") % 8 == 7).alias("enabled"), when("draw_crosswalk", C("_first")).alias("b_seg_id"),
        when("draw_crosswalk", F.lit("right")).alias("b_side"), when("draw_crosswalk", F.lit("start")).alias("b_pos"), when("draw_crosswalk", F.lit(1)).alias("b_n"),
        when("draw_segment", G.line_of(C("lon"), C("lat"), C("lon") + 0.001, C("lat") + 0.0005)).alias("geom"),
        when("draw_segment", G.line_of(C("x"), C("y"), C("x") + 88.0, C("y") + 55.0)).otherwise(when("edit_polygon_face", ring)).alias("utm"))


def straight_network(c: City) -> plan.Network:
    """The straight network with all that is booked on it."""
    if not hasattr(c, "_straight_network"):
        for names in (("nodes", "edges", "facs", "crossings", "calming", "changes"), ("straight",), ("facilities", "footpaths"), ("ramps", "zones"), ("slots", "hull_arms")):
            c.ready(*names)
        calming = stage(CA.collect(c.calming, CA.match_to_vertices(c.calming, c.straight), c.straight), "straight-calming")
        footways = c.footpaths.withColumn("edge_id", F.lit(None).cast("long"))
        c._straight_network = plan.Network(
            segments=c.straight, facilities=c.facilities, sidewalks=c.sidewalks, ramps=c.ramps, hulls=c.merged[0], members=c.merged[1], slots=c.slots,
            crosswalks=c.crosswalks, calming=calming, facility_ends=FA.facility_ends(c.facilities, c.straight), crossings=c.crossings, footways=footways)
    return c._straight_network


def edited(c: City) -> plan.Network:
    if not hasattr(c, "_edited"):
        c._edited = changes.direct_edits(straight_network(c), stage(ED.effective_edits(ED.edit_table(edit_log(c))), "live-log"))[0]
    return c._edited


part("o_log", f"""SELECT c.* REPLACE ({_KIND} AS edit_type) FROM o_changes c JOIN (SELECT edit_id FROM (SELECT *, min(depth) OVER (PARTITION BY user_id ORDER BY edit_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later FROM o_depth)
 WHERE edit_type <> 'undo' AND (later IS NULL OR later >= depth)) USING (edit_id)""")
part("o_l1", """SELECT s.seg_id, s.grid_id, s.start_node, s.end_node, s.start_is_intersection AS sf, s.end_is_intersection AS ef, s.name,
 coalesce(a.x, s.x0) AS x0, coalesce(a.y, s.y0) AS y0, coalesce(b.x, s.x1) AS x1, coalesce(b.y, s.y1) AS y1 FROM o_straight s LEFT JOIN o_lmove a ON a.node_id = s.start_node LEFT JOIN o_lmove b ON b.node_id = s.end_node""")
part("o_lmove", "SELECT node_id, arg_max(x, edit_id) AS x, arg_max(y, edit_id) AS y FROM o_log WHERE edit_type = 'move_point' GROUP BY node_id")
part("o_ladd", f"""SELECT seg_id, pos FROM (SELECT c.edit_id, e.seg_id, e.pos, {dist('c.x','c.y','e.x','e.y')} AS d FROM o_log c JOIN (SELECT seg_id, 'start' AS pos, x0 AS x, y0 AS y FROM o_l1 UNION ALL SELECT seg_id, 'end', x1, y1 FROM o_l1) e
 ON e.x BETWEEN c.x - 40 AND c.x + 40 AND e.y BETWEEN c.y - 40 AND c.y + 40 WHERE c.edit_type = 'add_point') WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY edit_id ORDER BY round(d,6), seg_id, pos DESC) = 1""")
part("o_ldel", "SELECT DISTINCT node_id FROM o_log WHERE edit_type IN ('delete_point', 'delete_polygon')")
part("o_l2", """SELECT t.seg_id, t.grid_id, t.start_node, t.end_node, t.x0, t.y0, t.x1, t.y1, coalesce(n.v, t.name) AS name,
 (t.sf OR t.seg_id IN (SELECT seg_id FROM o_ladd WHERE pos = 'start')) AND t.start_node NOT IN (SELECT node_id FROM o_ldel) AS sf,
 (t.ef OR t.seg_id IN (SELECT seg_id FROM o_ladd WHERE pos = 'end')) AND t.end_node NOT IN (SELECT node_id FROM o_ldel) AS ef
 FROM o_l1 t LEFT JOIN (SELECT s.seg_id, arg_max(c.new_value, c.edit_id) AS v FROM o_log c JOIN o_nodeseg s USING (node_id) WHERE c.edit_type = 'attr_edit' AND c.col = 'name' GROUP BY s.seg_id) n USING (seg_id)""")
part("o_lreq0", f"SELECT node_id, list(seg_id ORDER BY seg_id)[1] AS a, list(seg_id ORDER BY seg_id)[2] AS b FROM (SELECT start_node AS node_id, seg_id FROM o_straight WHERE start_node <> end_node UNION ALL SELECT end_node, seg_id FROM o_straight WHERE start_node <> end_node) WHERE node_id IN (SELECT node_id FROM fx_changes WHERE {_KIND} = 'merge_segments') GROUP BY node_id HAVING count(*) >= 2")
part("o_lreq", """SELECT m.* FROM o_lreq0 m JOIN (SELECT s, min(node_id) AS f FROM (SELECT a AS s, node_id FROM o_lreq0 UNION ALL SELECT b, node_id FROM o_lreq0) GROUP BY s) x ON x.s = m.a AND x.f = m.node_id
 JOIN (SELECT s, min(node_id) AS f FROM (SELECT a AS s, node_id FROM o_lreq0 UNION ALL SELECT b, node_id FROM o_lreq0) GROUP BY s) y ON y.s = m.b AND y.f = m.node_id WHERE m.node_id IN (SELECT node_id FROM o_log WHERE edit_type = 'merge_segments')""")
# a merged line has three vertices: its own far end, the shared node, the far end of the other
part("o_l3", """SELECT seg_id, grid_id, start_node, end_node, name, sf, ef, [{'x': x0, 'y': y0}, {'x': x1, 'y': y1}] AS pts FROM o_l2 WHERE seg_id NOT IN (SELECT a FROM o_lreq UNION ALL SELECT b FROM o_lreq)
 UNION ALL SELECT t.seg_id, t.grid_id, CASE WHEN t.end_node = m.node_id THEN t.start_node ELSE c.far END, CASE WHEN t.end_node = m.node_id THEN c.far ELSE t.end_node END, t.name,
 CASE WHEN t.end_node = m.node_id THEN t.sf ELSE c.ff END, CASE WHEN t.end_node = m.node_id THEN c.ff ELSE t.ef END,
 CASE WHEN t.end_node = m.node_id THEN [{'x': t.x0, 'y': t.y0}, {'x': t.x1, 'y': t.y1}, {'x': c.fx, 'y': c.fy}] ELSE [{'x': c.fx, 'y': c.fy}, {'x': t.x0, 'y': t.y0}, {'x': t.x1, 'y': t.y1}] END
 FROM o_lreq m JOIN o_l2 t ON t.seg_id = m.a JOIN (SELECT r.node_id, CASE WHEN k.start_node = r.node_id THEN k.end_node ELSE k.start_node END AS far, CASE WHEN k.start_node = r.node_id THEN k.ef ELSE k.sf END AS ff,
 CASE WHEN k.start_node = r.node_id THEN k.x1 ELSE k.x0 END AS fx, CASE WHEN k.start_node = r.node_id THEN k.y1 ELSE k.y0 END AS fy FROM o_lreq r JOIN o_l2 k ON k.seg_id = r.b) c ON c.node_id = m.node_id""")
part("o_l4", """SELECT * FROM o_l3 UNION ALL SELECT -1152921504606846976 - id, 'drawn_' || CAST(id AS VARCHAR), -1152921504606846976 - 2 * id, -1152921504606846977 - 2 * id, NULL, false, false, [{'x': x, 'y': y}, {'x': x + 88.0e0, 'y': y + 55.0e0}]
 FROM (SELECT x, y, (SELECT max(CAST(regexp_replace(grid_id, '[^0-9]', '', 'g') AS BIGINT)) FROM o_l3) + row_number() OVER (ORDER BY edit_id) AS id FROM o_log WHERE edit_type = 'draw_segment')""")
part("o_l4p", f"""SELECT *, coalesce(sum(len) OVER (PARTITION BY seg_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS m0 FROM (
 SELECT seg_id, k, pts[k].x AS ax, pts[k].y AS ay, pts[k+1].x AS bx, pts[k+1].y AS by, {dist('pts[k].x','pts[k].y','pts[k+1].x','pts[k+1].y')} AS len FROM (SELECT *, unnest(range(1, len(pts))) AS k FROM o_l4))""")
part("o_lnear", f"""SELECT edit_id, seg_id, m FROM (SELECT edit_id, seg_id, arg_min(m, d) AS m, min(d) AS d FROM (SELECT c.edit_id, s.seg_id, s.m0 + s.len * {tparam('c.x','c.y','s.ax','s.ay','s.bx','s.by')} AS m, {pseg('c.x','c.y','s.ax','s.ay','s.bx','s.by')} AS d
 FROM o_log c JOIN o_l4p s ON least(s.ax,s.bx) <= c.x + 40 AND greatest(s.ax,s.bx) >= c.x - 40 AND least(s.ay,s.by) <= c.y + 40 AND greatest(s.ay,s.by) >= c.y - 40 WHERE c.edit_type = 'split_segment') GROUP BY edit_id, seg_id)
 WHERE d <= 40 QUALIFY row_number() OVER (PARTITION BY edit_id ORDER BY round(d,6), seg_id) = 1""")
part("o_lcut", """SELECT *, row_number() OVER w AS k, lead(m) OVER w AS next_m, lead(edit_id) OVER w AS next_id FROM (SELECT n.*, t.len, lag(m) OVER (PARTITION BY n.seg_id ORDER BY m, edit_id) AS before FROM o_lnear n
 JOIN (SELECT seg_id, sum(len) AS len FROM o_l4p GROUP BY seg_id) t ON t.seg_id = n.seg_id WHERE m > 0.01 AND m < t.len - 0.01) WHERE before IS NULL OR m - before > 0.01 WINDOW w AS (PARTITION BY seg_id ORDER BY m, edit_id)""")
part("o_l5", """SELECT seg_id, seg_id AS of, start_node, end_node, sf, ef, name, 0.0e0 AS lo, 1e18 AS hi FROM o_l4 WHERE seg_id NOT IN (SELECT seg_id FROM o_lcut)
 UNION ALL SELECT s.seg_id, s.seg_id, s.start_node, -2305843009213693952 - c.edit_id, s.sf, false, s.name, 0.0e0, c.m FROM o_lcut c JOIN o_l4 s USING (seg_id) WHERE c.k = 1
 UNION ALL SELECT -2305843009213693952 - c.edit_id, s.seg_id, -2305843009213693952 - c.edit_id, coalesce(-2305843009213693952 - c.next_id, s.end_node), false, s.ef AND c.next_id IS NULL, s.name, c.m, coalesce(c.next_m, c.len) FROM o_lcut c JOIN o_l4 s USING (seg_id)""")


@query("changeset_segments", f"""SELECT l.seg_id, l.start_node, l.end_node, l.sf, l.ef, l.name, {r('max(least(l.hi, p.m0 + p.len)) - any_value(l.lo)', 3)} AS length,
 CAST(2 + count(*) FILTER (WHERE p.k > 1 AND p.m0 > l.lo + 1e-9 AND p.m0 < l.hi - 1e-9) AS INTEGER) AS n_vertices FROM o_l5 l JOIN o_l4p p ON p.seg_id = l.of GROUP BY l.seg_id, l.start_node, l.end_node, l.sf, l.ef, l.name""")
def changeset_segments(c: City):
    """Streets after a log of every kind: moves, added and deleted points, attributes, merges, drawn lines and cuts, undone edits left out.

    A vertex between the ends counts where it lies past the start, on a piece of a cut street also before the end.
    """
    s = edited(c).segments
    ms = G.measured(C("utm"))
    is_piece = F.least("start_node", "end_node") <= ED.SPLIT_NODES
    end = F.when(is_piece, F.element_at(ms, -1)["m1"] - VERTEX_APART_M)
    inner = F.filter(F.slice(ms, F.lit(2), F.size(ms)), lambda p: (p["m0"] > VERTEX_APART_M) & F.coalesce(p["m0"] < end, F.lit(True)))
    return rounded(s.select("seg_id", "start_node", "end_node", C("start_is_intersection").alias("sf"), C("end_is_intersection").alias("ef"), "name",
                            G.length(C("utm")).alias("length"), (2 + F.size(inner)).alias("n_vertices")), length=3)


part("o_ltoggle", "SELECT seg_id, CASE WHEN edit_id % 2 = 0 THEN 'left' ELSE 'right' END AS side, CAST(1 + edit_id % 3 AS INTEGER) AS n, arg_max(edit_id % 8 = 7, edit_id) AS enabled FROM o_log JOIN o_nodeseg USING (node_id) WHERE edit_type = 'toggle_curb_ramp' GROUP BY ALL")
part("o_lon", "SELECT r.* FROM o_ramps r LEFT JOIN o_ltoggle t ON t.seg_id = r.seg_id AND t.side = r.side AND r.pos = 'start' AND t.n = r.n WHERE coalesce(t.enabled, true)")


# what is booked on a street's ends goes with the pieces; a street that begins at the shared node keeps its id in a merge
@query("changeset_overrides", f"""SELECT 'ramp' AS kind, t.seg_id AS id, t.side, 'start' AS pos, t.n, t.enabled, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS y FROM o_ltoggle t
 UNION ALL SELECT 'crosswalk', s.seg_id, NULL, 'start', NULL, NULL, {r('any_value(a.x)',3)}, {r('any_value(a.y)',3)} FROM o_log c JOIN o_nodeseg s USING (node_id) JOIN o_lon a ON a.seg_id = s.seg_id AND a.side = 'left' AND a.pos = 'start' AND a.n = 1
 JOIN o_lon b ON b.seg_id = s.seg_id AND b.side = 'right' AND b.pos = 'start' AND b.n = 1 WHERE c.edit_type = 'draw_crosswalk' GROUP BY s.seg_id
 UNION ALL SELECT 'hull', node_id, NULL, NULL, NULL, NULL, {r('arg_max(x, edit_id) - 5',3)}, {r('arg_max(y, edit_id) - 5',3)} FROM o_log WHERE edit_type = 'edit_polygon_face' GROUP BY node_id""")
def changeset_overrides(c: City):
    """What the same log leaves for every later recomputation: ramps switched off or on, crosswalks and hulls drawn."""
    o = edited(c).overrides
    null = F.lit(None)
    def row(df, kind, key, side=null, pos=null, n=null, enabled=null, p=None):
        return df.select(F.lit(kind).alias("kind"), C(key).alias("id"), side.cast("string").alias("side"), pos.cast("string").alias("pos"), n.cast("int").alias("n"),
                         enabled.cast("boolean").alias("enabled"), (p["x"] if p is not None else null).cast("double").alias("x"), (p["y"] if p is not None else null).cast("double").alias("y"))
    out = row(o.ramps, "ramp", "seg_id", C("side"), C("pos"), C("n"), C("enabled")).unionByName(
        row(o.crosswalks, "crosswalk", "seg_id", pos=C("pos"), p=C("line")[0])).unionByName(row(o.hulls, "hull", "node_id", p=C("ring")[0]))
    return rounded(out, x=3, y=3)
