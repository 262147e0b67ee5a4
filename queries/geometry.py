"""Per-row geometry queries over whole street tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.functions import crs, geom as G
from kerbline.operators import network as N
from queries.registry import City, query, rounded
from queries.sqltext import axis_diff, bearing, cross, dist, haversine, not_parallel, part, pseg, r, tparam, utm

C = F.col

part("o_segs", """
SELECT *, sum(len) OVER (PARTITION BY edge_id ORDER BY k ROWS UNBOUNDED PRECEDING) - len AS m0,
  sum(len) OVER (PARTITION BY edge_id ORDER BY k ROWS UNBOUNDED PRECEDING) AS m1
FROM (SELECT edge_id, CAST(seq AS INTEGER) AS k, x AS ax, y AS ay, nx AS bx, ny AS by, sqrt((nx-x)*(nx-x)+(ny-y)*(ny-y)) AS len,
  lon AS alon, lat AS alat, nlon AS blon, nlat AS blat
FROM (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lead(lon) OVER w AS nlon, lead(lat) OVER w AS nlat FROM o_verts WINDOW w AS (PARTITION BY edge_id ORDER BY seq)) WHERE nx IS NOT NULL)""")
part("o_probe", """
SELECT a.edge_id, (a.x+b.x)/2 + 7.0e0*(a.edge_id % 3 - 1) + 0.3e0 AS px, (a.y+b.y)/2 + 5.0e0*(a.edge_id % 5 - 2) + 0.2e0 AS py
FROM o_verts a JOIN o_verts b ON a.edge_id = b.edge_id AND a.seq = 0 AND b.seq = 2""")
part("o_near", f"""
SELECT edge_id, k, d, m0 + t*len AS m, ax+t*(bx-ax) AS x, ay+t*(by-ay) AS y, {cross('bx-ax','by-ay','px-(ax+t*(bx-ax))','py-(ay+t*(by-ay))')} AS c
FROM (SELECT *, {dist('px','py','ax+t*(bx-ax)','ay+t*(by-ay)')} AS d FROM (SELECT s.*, p.px, p.py, {tparam('px','py','ax','ay','bx','by')} AS t FROM o_segs s JOIN o_probe p USING (edge_id)))
QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY d, k) = 1""")
part("o_length", "SELECT edge_id, sum(len) AS length FROM o_segs GROUP BY edge_id")


def probes(c: City):
    """Lines with one probe point each, a few metres off the middle of the end-to-end chord."""
    a, b = G.first_pt(C("utm")), G.last_pt(C("utm"))
    e = C("edge_id")
    return c.lines.select("edge_id", "geom", "utm",
                          ((a["x"] + b["x"]) / 2 + 7.0 * (e % 3 - 1) + 0.3).alias("px"),
                          ((a["y"] + b["y"]) / 2 + 5.0 * (e % 5 - 2) + 0.2).alias("py"))


def xy_rows(df, line: str, keep: list[str], digits: int = 3):
    v = G.vertices(df, line, keep).drop("endpoint")
    return rounded(v, x=digits, y=digits)


@query("g_endpoints", f"SELECT a.edge_id, {r('a.lon',7)} AS lon0, {r('a.lat',7)} AS lat0, {r('b.lon',7)} AS lon1, {r('b.lat',7)} AS lat1 FROM fx_vertices a JOIN fx_vertices b ON a.edge_id = b.edge_id AND a.seq = 0 AND b.seq = 2")
def g_endpoints(c: City):
    a, b = G.first_pt(C("geom")), G.last_pt(C("geom"))
    return rounded(c.lines.select("edge_id", a["x"].alias("lon0"), a["y"].alias("lat0"), b["x"].alias("lon1"), b["y"].alias("lat1")),
                   lon0=7, lat0=7, lon1=7, lat1=7)


@query("g_flatten", f"SELECT edge_id, CAST(row_number() OVER (PARTITION BY edge_id ORDER BY g, seq) - 1 AS INTEGER) AS i, {r('lon',7)} AS x, {r('lat',7)} AS y FROM (SELECT *, 0 AS g FROM fx_vertices WHERE seq < 2 UNION ALL SELECT *, 1 FROM fx_vertices WHERE seq > 0)")
def g_flatten(c: City):
    parts = F.array(F.slice("geom", 1, 2), F.slice("geom", 2, 2))
    return xy_rows(c.lines.select("edge_id", F.flatten(parts).alias("flat")), "flat", ["edge_id"], 7)


@query("g_linemerge", f"SELECT edge_id, CAST(seq AS INTEGER) AS i, {r('lon',7)} AS x, {r('lat',7)} AS y FROM fx_vertices WHERE edge_id % 3 <> 2 "
       f"UNION ALL SELECT edge_id, CAST(seq AS INTEGER), {r('lon',7)}, {r('lat',7)} FROM fx_vertices WHERE edge_id % 3 = 2 AND seq < 2")
def g_linemerge(c: City):
    head, tail = F.slice("geom", 1, 2), F.slice("geom", 2, 2)
    away = F.transform(F.slice("geom", 2, 2), lambda p: G.pt(p["x"] * 0.5 + 100, p["y"] * 1e-3))
    parts = (F.when(C("edge_id") % 3 == 0, F.array(head, tail))
             .when(C("edge_id") % 3 == 1, F.array(head, F.reverse(tail))).otherwise(F.array(F.transform(away, lambda p: G.pt(p["x"] * 1e-6, p["y"] * 1e-6)), head)))
    return xy_rows(c.lines.select("edge_id", G.merge_parts(parts).alias("m")), "m", ["edge_id"], 7)


@query("g_deflections", "SELECT edge_id, CAST(seq AS INTEGER) AS vertex FROM o_breaks WHERE brk")
def g_deflections(c: City):
    return c.lines.select("edge_id", F.explode(G.deflections(C("utm"), 45.0)).alias("v")).select("edge_id", (C("v") - 1).alias("vertex"))


@query("split_deflections", f"SELECT seg_id, edge_id, piece, start_node, end_node, n AS n_vertices, {r('lon0',7)} AS lon0, {r('lat0',7)} AS lat0, {r('lon1',7)} AS lon1, {r('lat1',7)} AS lat1 FROM o_pieces")
def split_deflections(c: City):
    a, b = G.first_pt(C("geom")), G.last_pt(C("geom"))
    s = N.split_deflections(c.lines).select(
        "seg_id", "edge_id", C("piece").cast("long").alias("piece"), "start_node", "end_node", F.size("geom").cast("long").alias("n_vertices"),
        a["x"].alias("lon0"), a["y"].alias("lat0"), b["x"].alias("lon1"), b["y"].alias("lat1"))
    return rounded(s, lon0=7, lat0=7, lon1=7, lat1=7)


@query("g_bearing", f"SELECT seg_id, {r('bearing',4)} AS bearing FROM o_split0")
def g_bearing(c: City):
    return rounded(N.raw_bearings(N.split_deflections(c.lines)).select("seg_id", "bearing"), bearing=4)


@query("g_axis_diff", f"SELECT edge_id, {r(axis_diff('b1','b2'),4)} AS diff FROM (SELECT a.edge_id, {bearing('a.bx-a.ax','a.by-a.ay')} AS b1, {bearing('b.bx-b.ax','b.by-b.ay')} AS b2 FROM o_segs a JOIN o_segs b ON a.edge_id = b.edge_id AND a.k = 0 AND b.k = 1)")
def g_axis_diff(c: City):
    p, q, s = (F.element_at("utm", i) for i in (1, 2, 3))
    b = c.lines.select("edge_id", G.bearing_of(q["x"] - p["x"], q["y"] - p["y"]).alias("b1"), G.bearing_of(s["x"] - q["x"], s["y"] - q["y"]).alias("b2"))
    return rounded(b.select("edge_id", G.axis_diff(C("b1"), C("b2")).alias("diff")), diff=4)


@query("g_point_on_segment", f"SELECT edge_id, k, {r(f'ax+t*(bx-ax)',3)} AS x, {r(f'ay+t*(by-ay)',3)} AS y FROM (SELECT s.*, {tparam('px','py','ax','ay','bx','by')} AS t FROM o_segs s JOIN o_probe p USING (edge_id))")
def g_point_on_segment(c: City):
    p = G.pieces(probes(c), "utm", ["edge_id", "px", "py"])
    t = G.param_on_segment(*[C(n) for n in ("px", "py", "ax", "ay", "bx", "by")])
    p = p.withColumn("t", t)
    return rounded(p.select("edge_id", "k", (C("ax") + C("t") * (C("bx") - C("ax"))).alias("x"), (C("ay") + C("t") * (C("by") - C("ay"))).alias("y")), x=3, y=3)


@query("g_nearest_on_line", f"SELECT edge_id, {r('d',3)} AS d, {r('x',3)} AS x, {r('y',3)} AS y FROM o_near")
def g_nearest_on_line(c: City):
    n = probes(c).withColumn("n", G.nearest(G.measured(C("utm")), C("px"), C("py")))
    return rounded(n.select("edge_id", "n.d", "n.x", "n.y"), d=3, x=3, y=3)


part("o_probe_deg", "SELECT edge_id, lon + 0.00005e0*(edge_id % 3 - 1) AS plon, lat + 0.00004e0*(edge_id % 5 - 2) + 0.00001e0 AS plat FROM fx_vertices WHERE seq = 1")


@query("g_point_line_dist_m", f"""SELECT edge_id, {r('min(m)',3)} AS metres FROM (SELECT edge_id, {haversine('plon','plat','alon+t*(blon-alon)','alat+t*(blat-alat)')} AS m
FROM (SELECT s.*, p.plon, p.plat, {tparam('plon','plat','alon','alat','blon','blat')} AS t FROM o_segs s JOIN o_probe_deg p USING (edge_id))) GROUP BY edge_id""")
def g_point_line_dist_m(c: City):
    m = F.element_at("geom", 2)
    p = c.lines.select("edge_id", "geom", (m["x"] + 0.00005 * (C("edge_id") % 3 - 1)).alias("plon"), (m["y"] + 0.00004 * (C("edge_id") % 5 - 2) + 0.00001).alias("plat"))
    p = G.pieces(p, "geom", ["edge_id", "plon", "plat"])
    p = p.withColumn("t", G.param_on_segment(*[C(n) for n in ("plon", "plat", "ax", "ay", "bx", "by")]))
    d = crs.haversine(C("plon"), C("plat"), C("ax") + C("t") * (C("bx") - C("ax")), C("ay") + C("t") * (C("by") - C("ay")))
    return rounded(p.groupBy("edge_id").agg(F.min(d).alias("metres")), metres=3)


@query("g_locate", f"SELECT edge_id, {r('m',3)} AS measure FROM o_near")
def g_locate(c: City):
    return rounded(probes(c).select("edge_id", G.nearest(G.measured(C("utm")), C("px"), C("py"))["m"].alias("measure")), measure=3)


@query("g_interpolate", f"SELECT edge_id, {r('ax+(bx-ax)*(at-m0)/len',3)} AS x, {r('ay+(by-ay)*(at-m0)/len',3)} AS y FROM (SELECT s.*, l.length * (1 + edge_id % 9) / 10.0e0 AS at FROM o_segs s JOIN o_length l USING (edge_id)) WHERE m1 >= at QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY k) = 1")
def g_interpolate(c: City):
    at = G.length(C("utm")) * (1 + C("edge_id") % 9) / 10.0
    i = c.lines.select("edge_id", "utm", at.alias("at")).withColumn("p", G.interpolate(G.measured(C("utm")), C("at")))
    return rounded(i.select("edge_id", "p.x", "p.y"), x=3, y=3)


@query("g_side_of_line", "SELECT edge_id, CASE WHEN c > 0 THEN 'left' ELSE 'right' END AS side FROM o_near WHERE abs(c) > 0.01")
def g_side_of_line(c: City):
    p = probes(c).withColumn("n", G.nearest(G.measured(C("utm")), C("px"), C("py")))
    clear = F.abs(G.cross(C("n.bx") - C("n.ax"), C("n.by") - C("n.ay"), C("px") - C("n.x"), C("py") - C("n.y"))) > 0.01
    return p.where(clear).select("edge_id", G.side_of(G.measured(C("utm")), C("px"), C("py")).alias("side"))


@query("g_substring", f"""SELECT edge_id, CAST(row_number() OVER (PARTITION BY edge_id ORDER BY m) - 1 AS INTEGER) AS i, {r('x',3)} AS x, {r('y',3)} AS y FROM (
SELECT edge_id, at AS m, ax+(bx-ax)*(at-m0)/len AS x, ay+(by-ay)*(at-m0)/len AS y FROM (SELECT s.*, l.length*f AS at, f FROM o_segs s JOIN o_length l USING (edge_id) CROSS JOIN (SELECT unnest([0.2e0, 0.7e0]) AS f)) WHERE m1 >= at QUALIFY row_number() OVER (PARTITION BY edge_id, f ORDER BY k) = 1
UNION ALL SELECT edge_id, m1, bx, by FROM (SELECT s.*, l.length FROM o_segs s JOIN o_length l USING (edge_id)) WHERE m1 > length*0.2e0 AND m1 < length*0.7e0)""")
def g_substring(c: City):
    l = c.lines.withColumn("l", G.length(C("utm"))).withColumn("ms", G.measured(C("utm")))
    return xy_rows(l.select("edge_id", G.substring(C("ms"), C("l") * 0.2, C("l") * 0.7).alias("s")), "s", ["edge_id"])


part("o_chord", "SELECT edge_id, x0, y0, x1, y1, sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)) AS len FROM o_lines2")


@query("g_offset_curve", f"SELECT edge_id, i, {r('CASE i WHEN 0 THEN x0 ELSE x1 END - (y1-y0)/len*d',3)} AS x, {r('CASE i WHEN 0 THEN y0 ELSE y1 END + (x1-x0)/len*d',3)} AS y FROM (SELECT *, CAST(edge_id % 9 - 4 AS DOUBLE) AS d FROM o_chord) CROSS JOIN (SELECT CAST(unnest([0,1]) AS INTEGER) AS i)")
def g_offset_curve(c: City):
    s = c.straight.select("edge_id", G.offset(C("utm"), (C("edge_id") % 9 - 4).cast("double")).alias("o"))
    return xy_rows(s, "o", ["edge_id"])


def _ray_sql() -> str:
    det = "(dbx*day-dax*dby)"
    t = f"((dby*(pax-pbx)-dbx*(pay-pby))/nullif({det},0.0e0))"
    part("o_pair_rays", f"""SELECT *, {det} AS det, {t} AS t FROM (
SELECT a.edge_id AS a_id, b.edge_id AS b_id, a.x0 - (a.y1-a.y0)/a.len*5 AS pax, a.y0 + (a.x1-a.x0)/a.len*5 AS pay, (a.x0-a.x1) AS dax, (a.y0-a.y1) AS day,
 b.x0 + (b.y1-b.y0)/b.len*5 AS pbx, b.y0 - (b.x1-b.x0)/b.len*5 AS pby, (b.x0-b.x1) AS dbx, (b.y0-b.y1) AS dby
FROM o_chord_u a JOIN o_chord_u b ON a.u = b.u WHERE a.edge_id <> b.edge_id)""")
    return f"""SELECT a_id, b_id, {r('ix',2)} AS x, {r('iy',2)} AS y FROM (SELECT *, pax+t*dax AS ix, pay+t*day AS iy FROM o_pair_rays)
WHERE {not_parallel('dax','day','dbx','dby')} AND t >= 0 AND {dist('pax','pay','ix','iy')} <= 30 AND {dist('pbx','pby','ix','iy')} <= 30"""


part("o_chord_u", "SELECT c.*, e.u FROM o_chord c JOIN fx_edges e USING (edge_id)")


@query("g_ray_ray", _ray_sql())
def g_ray_ray(c: City):
    """Corner of the left offset of one street with the right offset of another leaving the same node."""
    left, right = (c.straight.select("start_node", C("edge_id").alias(f"{n}_id"), G.offset(C("utm"), F.lit(d)).alias(n)) for n, d in (("a", 5.0), ("b", -5.0)))
    j = left.join(right, "start_node").where("a_id <> b_id")
    p = {n: (F.element_at(n, 1), F.element_at(n, 2)) for n in "ab"}
    args = []
    for n in "ab":
        s, e = p[n]
        args += [s["x"], s["y"], s["x"] - e["x"], s["y"] - e["y"]]
    return rounded(j.select("a_id", "b_id", G.ray_ray(*args).alias("p")).where("p IS NOT NULL").select("a_id", "b_id", "p.x", "p.y"), x=2, y=2)


@query("g_extend", f"SELECT edge_id, CAST(seq + CASE WHEN edge_id % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS i, {r('x',3)} AS x, {r('y',3)} AS y FROM o_verts UNION ALL SELECT edge_id, CAST(CASE WHEN edge_id % 2 = 0 THEN 0 ELSE 3 END AS INTEGER), {r('px',3)}, {r('py',3)} FROM o_probe")
def g_extend(c: City):
    p = probes(c).withColumn("e", G.extend(C("utm"), G.pt(C("px"), C("py")), C("edge_id") % 2 == 0))
    return xy_rows(p, "e", ["edge_id"])


@query("g_intersection", f"""SELECT edge_id, {r('x',3)} AS x, {r('y',3)} AS y FROM (SELECT DISTINCT edge_id, ax+t*(bx-ax) AS x, ay+t*(by-ay) AS y FROM (SELECT *,
 {cross('cx-ax','cy-ay','dx-cx','dy-cy')}/nullif(det,0.0e0) AS t, {cross('cx-ax','cy-ay','bx-ax','by-ay')}/nullif(det,0.0e0) AS w FROM (SELECT *, {cross('bx-ax','by-ay','dx-cx','dy-cy')} AS det FROM (
 SELECT s.*, px - (by1-ay1)*0.2e0 AS cx, py + (bx1-ax1)*0.2e0 AS cy, px + (by1-ay1)*0.2e0 AS dx, py - (bx1-ax1)*0.2e0 AS dy FROM o_segs s JOIN o_probe p USING (edge_id)
 JOIN (SELECT a.edge_id, a.x AS ax1, a.y AS ay1, b.x AS bx1, b.y AS by1 FROM o_verts a JOIN o_verts b ON a.edge_id=b.edge_id AND a.seq=0 AND b.seq=2) USING (edge_id)))) WHERE t BETWEEN 0 AND 1 AND w BETWEEN 0 AND 1)""")
def g_intersection(c: City):
    a, b = G.first_pt(C("utm")), G.last_pt(C("utm"))
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    p = probes(c)
    probe = G.line_of(C("px") - dy * 0.2, C("py") + dx * 0.2, C("px") + dy * 0.2, C("py") - dx * 0.2)
    hits = p.withColumn("probe", probe).select("edge_id", F.explode(G.line_cross(C("utm"), C("probe"))).alias("p"))
    return rounded(hits.select("edge_id", "p.x", "p.y"), x=3, y=3)


@query("g_buffer_flat", f"""SELECT edge_id, i, {r('CASE WHEN i IN (0,3) THEN x0 ELSE x1 END + (y1-y0)/len*3*CASE WHEN i < 2 THEN 1 ELSE -1 END',3)} AS x,
 {r('CASE WHEN i IN (0,3) THEN y0 ELSE y1 END - (x1-x0)/len*3*CASE WHEN i < 2 THEN 1 ELSE -1 END',3)} AS y FROM o_chord CROSS JOIN (SELECT CAST(unnest([0,1,2,3]) AS INTEGER) AS i)""")
def g_buffer_flat(c: City):
    a, b = G.first_pt(C("utm")), G.last_pt(C("utm"))
    return xy_rows(c.straight.select("edge_id", G.buffer_flat(a["x"], a["y"], b["x"], b["y"], 3.0).alias("q")), "q", ["edge_id"])


part("o_rect", """SELECT edge_id, (x0+x1)/2 AS mx, (y0+y1)/2 AS my, (x1-x0)/len AS ux, (y1-y0)/len AS uy, len*0.3e0 AS hl, 6.0e0 AS hw FROM o_chord""")


def rect_ring(c: City):
    """Rectangle around the middle 60 % of each straight street, 6 m to each side."""
    a, b = G.first_pt(C("utm")), G.last_pt(C("utm"))
    at = [a["x"] + (b["x"] - a["x"]) * 0.2, a["y"] + (b["y"] - a["y"]) * 0.2, a["x"] + (b["x"] - a["x"]) * 0.8, a["y"] + (b["y"] - a["y"]) * 0.8]
    return c.straight.select("edge_id", G.buffer_flat(*at, 6.0).alias("ring"))


@query("g_contains_point", "SELECT p.edge_id, abs((px-mx)*ux+(py-my)*uy) <= hl AND abs((px-mx)*uy-(py-my)*ux) <= hw AS inside FROM o_probe p JOIN o_rect r ON p.edge_id = r.edge_id")
def g_contains_point(c: City):
    j = probes(c).join(rect_ring(c), "edge_id")
    return j.select("edge_id", G.contains_point(C("ring"), C("px"), C("py")).alias("inside"))


part("o_rect_clip", """
SELECT edge_id, sum(len * greatest(0.0e0, least(1.0e0, hi) - greatest(0.0e0, lo))) / sum(len) AS share FROM (
 SELECT edge_id, k, len, greatest(least((-hl-a1)/d1, (hl-a1)/d1), least((-hw-a2)/d2, (hw-a2)/d2)) AS lo, least(greatest((-hl-a1)/d1, (hl-a1)/d1), greatest((-hw-a2)/d2, (hw-a2)/d2)) AS hi
 FROM (SELECT s.edge_id, k, len, hl, hw, (ax-mx)*ux+(ay-my)*uy AS a1, (ay-my)*ux-(ax-mx)*uy AS a2, (bx-ax)*ux+(by-ay)*uy + 1e-15 AS d1, (by-ay)*ux-(bx-ax)*uy + 1e-12 AS d2
 FROM o_segs s JOIN o_rect r ON s.edge_id = r.edge_id)) GROUP BY edge_id""")


@query("g_frac_inside", f"SELECT edge_id, {r('share',4)} AS share FROM o_rect_clip")
def g_frac_inside(c: City):
    j = c.lines.select("edge_id", "utm").join(rect_ring(c), "edge_id")
    return rounded(j.select("edge_id", G.frac_inside(C("utm"), C("ring")).alias("share")), share=4)


@query("g_centroid", f"""SELECT s.edge_id, {r('sum(len*(ax+bx)/2)/sum(len)',3)} AS x, {r('sum(len*(ay+by)/2)/sum(len)',3)} AS y, {r('any_value(mx)',3)} AS poly_x, {r('any_value(my)',3)} AS poly_y FROM o_segs s JOIN o_rect r ON s.edge_id = r.edge_id GROUP BY s.edge_id""")
def g_centroid(c: City):
    j = c.lines.select("edge_id", "utm").join(rect_ring(c), "edge_id").withColumn("c", G.centroid(C("utm"))).withColumn("p", G.ring_centroid(C("ring")))
    return rounded(j.select("edge_id", "c.x", "c.y", C("p.x").alias("poly_x"), C("p.y").alias("poly_y")), x=3, y=3, poly_x=3, poly_y=3)


@query("g_bbox", f"SELECT {r('min(lon)',7)} AS x0, {r('min(lat)',7)} AS y0, {r('max(lon)',7)} AS x1, {r('max(lat)',7)} AS y1, {r('(min(lon)+max(lon))/2',7)} AS lng, {r('(min(lat)+max(lat))/2',7)} AS lat FROM fx_vertices")
def g_bbox(c: City):
    b = c.lines.select(G.bbox(C("geom")).alias("b")).agg(F.min("b.x0").alias("x0"), F.min("b.y0").alias("y0"), F.max("b.x1").alias("x1"), F.max("b.y1").alias("y1"))
    return rounded(b.withColumns({"lng": (C("x0") + C("x1")) / 2, "lat": (C("y0") + C("y1")) / 2}), x0=7, y0=7, x1=7, y1=7, lng=7, lat=7)


@query("g_vertices", f"""SELECT 'e' || CAST(edge_id AS VARCHAR) AS src, CAST(seq AS INTEGER) AS i, CAST(CASE WHEN seq = 1 THEN 0 ELSE 1 END AS INTEGER) AS endpoint, {r('lon',7)} AS x, {r('lat',7)} AS y FROM fx_vertices
UNION ALL SELECT 'n' || CAST(node_id AS VARCHAR), -1, 1, {r('lon',7)}, {r('lat',7)} FROM fx_nodes""")
def g_vertices(c: City):
    lines = G.vertices(c.lines.select(F.concat(F.lit("e"), C("edge_id").cast("string")).alias("src"), "geom"), "geom", ["src"])
    pts = c.nodes.select(F.concat(F.lit("n"), C("node_id").cast("string")).alias("src"), F.lit(-1).alias("i"), C("lon").alias("x"), C("lat").alias("y"), F.lit(1).alias("endpoint"))
    return rounded(lines.unionByName(pts), x=7, y=7)


@query("g_insert_index", f"SELECT edge_id, CAST(k + 1 AS INTEGER) AS line_index FROM (SELECT s.edge_id, k, {pseg('px','py','ax','ay','bx','by')} AS d FROM o_segs s JOIN o_probe p USING (edge_id)) QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY round(d,6), k) = 1")
def g_insert_index(c: City):
    return probes(c).select("edge_id", G.insert_index(C("utm"), C("px"), C("py")).alias("line_index"))


@query("g_edit_vertex", f"""SELECT edge_id, CAST(row_number() OVER (PARTITION BY edge_id ORDER BY o) - 1 AS INTEGER) AS i, {r('x',3)} AS x, {r('y',3)} AS y FROM (
 SELECT v.edge_id, CAST(v.seq AS DOUBLE) AS o, CASE WHEN v.edge_id % 3 = 1 AND seq = 1 THEN px ELSE x END AS x, CASE WHEN v.edge_id % 3 = 1 AND seq = 1 THEN py ELSE y END AS y FROM o_verts v JOIN o_probe p USING (edge_id) WHERE NOT (v.edge_id % 3 = 2 AND seq = 1)
 UNION ALL SELECT p.edge_id, n.k + 0.5e0, px, py FROM o_probe p JOIN (SELECT s.edge_id, k, {pseg('px','py','ax','ay','bx','by')} AS d FROM o_segs s JOIN o_probe p USING (edge_id) QUALIFY row_number() OVER (PARTITION BY s.edge_id ORDER BY round(d,6), k) = 1) n ON n.edge_id = p.edge_id WHERE p.edge_id % 3 = 0)""")
def g_edit_vertex(c: City):
    """Insert, move or delete a vertex, by edge id."""
    p = probes(c).withColumn("at", G.insert_index(C("utm"), C("px"), C("py")))
    pt = G.pt(C("px"), C("py"))
    e = (F.when(C("edge_id") % 3 == 0, G.insert_vertex(C("utm"), C("at"), pt))
         .when(C("edge_id") % 3 == 1, G.move_vertex(C("utm"), F.lit(1), pt)).otherwise(G.delete_vertex(C("utm"), F.lit(1))))
    return xy_rows(p.withColumn("e", e), "e", ["edge_id"])


@query("g_reproject", f"SELECT edge_id, CAST(seq AS INTEGER) AS i, {r('x',3)} AS x, {r('y',3)} AS y FROM o_verts")
def g_reproject(c: City):
    return xy_rows(c.lines.select("edge_id", crs.utm_line(C("geom")).alias("u")), "u", ["edge_id"])
