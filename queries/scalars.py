"""Scalar projections, predicates and network foundation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbline.config import default_rows, layered
from kerbline.functions import crs, tags, view
from kerbline.operators import network as N
from queries.registry import City, query, rounded
from queries.sqltext import bearing, haversine, lonlat, part, r, utm

C = F.col


@query("parse_maxspeed", """SELECT edge_id, CAST(coalesce(floor(TRY_CAST(replace(replace(replace(maxspeed,' mph',''),' km/h',''),' kph','') AS DOUBLE)), 25) AS BIGINT) AS maxspeed FROM fx_edges""")
def parse_maxspeed(c: City):
    return c.edges.select("edge_id", tags.parse_maxspeed(C("maxspeed")).alias("maxspeed"))


@query("parse_lanes", "SELECT edge_id, CAST(TRY_CAST(lanes AS DOUBLE) AS INTEGER) AS lanes FROM fx_edges")
def parse_lanes(c: City):
    return c.edges.select("edge_id", tags.parse_lanes(C("lanes")).alias("lanes"))


@query("parse_lane_width", "SELECT edge_id, TRY_CAST(lane_width AS DOUBLE) AS lane_width FROM fx_edges")
def parse_lane_width(c: City):
    return c.edges.select("edge_id", tags.parse_lane_width(C("lane_width")).alias("lane_width"))


@query("parse_float_tag", r"""SELECT edge_id, TRY_CAST(nullif(regexp_extract(cycleway_width, '([+-]?[0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE) AS width,
 TRY_CAST(nullif(regexp_extract(maxspeed, '([+-]?[0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE) AS speed_number FROM fx_edges""")
def parse_float_tag(c: City):
    return c.edges.select("edge_id", tags.parse_float_tag(C("`cycleway:width`")).alias("width"),
                          tags.parse_float_tag(C("maxspeed")).alias("speed_number"))


@query("parse_incline", """SELECT edge_id, round(TRY_CAST(CASE WHEN incline NOT IN ('up','down') THEN replace(replace(incline,'%',''),'°','') END AS DOUBLE), 4) AS incline FROM fx_edges""")
def parse_incline(c: City):
    return c.edges.select("edge_id", tags.parse_incline(C("incline")).alias("incline"))


@query("first_if_list", "SELECT CAST(p_partkey AS BIGINT) AS part_id, split_part(p_type, ' ', 1) AS first_word, CAST(NULL AS VARCHAR) AS of_empty FROM part")
def first_if_list(c: City):
    p = c.spark.read.parquet(f"{c.sf_dir}/part.parquet")
    words = F.split("p_type", " ")
    return p.select(C("p_partkey").cast("long").alias("part_id"), tags.first_if_list(words).alias("first_word"),
                    tags.first_if_list(F.slice(words, 1, 0)).alias("of_empty"))


@query("coalesce_tags", "SELECT edge_id, coalesce(sidewalk_left_tag, sidewalk_both, sidewalk) AS left_presence, coalesce(sidewalk_both, sidewalk) AS right_presence FROM fx_edges")
def coalesce_tags(c: City):
    e = c.edges
    return e.select("edge_id", tags.coalesce_tags(e, "sidewalk:left", "sidewalk:both", "sidewalk").alias("left_presence"),
                    tags.coalesce_tags(e, "sidewalk:right", "sidewalk:both", "sidewalk").alias("right_presence"))


@query("stringify_id", "SELECT edge_id, CAST(edge_id AS VARCHAR) AS street_id, '[' || CAST(u AS VARCHAR) || ', ' || CAST(v AS VARCHAR) || ']' AS node_list FROM fx_edges")
def stringify_id(c: City):
    return c.edges.select("edge_id", tags.stringify_id(C("edge_id")).alias("street_id"),
                          tags.stringify_id(F.array("u", "v"), True).alias("node_list"))


part("o_fac_rows", r"""
SELECT edge_id, facility, side, slot, presence, TRY_CAST(nullif(regexp_extract(width, '([+-]?[0-9]+(\.[0-9]+)?)', 1),'') AS DOUBLE) AS width,
  round(TRY_CAST(CASE WHEN incline NOT IN ('up','down') THEN replace(incline,'%','') END AS DOUBLE), 4) AS incline
FROM (SELECT edge_id, 'sidewalk' AS facility, 'left' AS side, 1 AS slot, coalesce(sidewalk_left_tag, sidewalk_both, sidewalk) AS presence, CAST(NULL AS VARCHAR) AS width, CAST(NULL AS VARCHAR) AS incline FROM fx_edges
UNION ALL SELECT edge_id, 'sidewalk', 'right', 1, coalesce(sidewalk_both, sidewalk), NULL, NULL FROM fx_edges
UNION ALL SELECT edge_id, 'bikeway', 'left', 1, cycleway, cycleway_width, incline FROM fx_edges
UNION ALL SELECT edge_id, 'bikeway', 'right', 1, cycleway, cycleway_width, incline FROM fx_edges
UNION ALL SELECT edge_id, 'bikeway', 'left', 2, NULL, NULL, incline FROM fx_edges
UNION ALL SELECT edge_id, 'bikeway', 'right', 2, NULL, NULL, incline FROM fx_edges)""")


@query("facility_tags", "SELECT * FROM o_fac_rows")
def facility_tags(c: City):
    return tags.facility_rows(c.edges, ["edge_id"]).select("edge_id", "facility", "side", "slot", "presence", "width", "incline")


@query("crossing_attrs", "SELECT osmid, type, controlled, marked, markings, signals, kerb, tactile_paving FROM o_crossings")
def crossing_attrs(c: City):
    return tags.crossing_attributes(c.fx["fx_crossings"]).select(
        "osmid", "type", "controlled", "marked", "markings", "signals", "kerb", "tactile_paving")


@query("classify_highway", """SELECT id, highway,
  highway IN ('primary','secondary','residential','service') AS is_road, highway = 'cycleway' AS is_cycleway,
  highway = 'footway' AS is_footway, highway = 'crossing' AS is_crossing
FROM (SELECT edge_id AS id, highway FROM fx_edges UNION ALL SELECT fac_id, highway FROM fx_facilities
      UNION ALL SELECT osmid, highway FROM fx_crossings WHERE highway IS NOT NULL)""")
def classify_highway(c: City):
    rows = (c.edges.select(C("edge_id").alias("id"), "highway")
            .unionByName(c.fx["fx_facilities"].select(C("fac_id").alias("id"), "highway"))
            .unionByName(c.fx["fx_crossings"].where("highway IS NOT NULL").select(C("osmid").alias("id"), "highway")))
    none = F.lit(None).cast("string")
    h = C("highway")
    return rows.select("id", "highway", tags.is_road(h).alias("is_road"), tags.is_cycleway(h, none).alias("is_cycleway"),
                       tags.is_footway(h, none).alias("is_footway"), tags.is_crossing(h, none).alias("is_crossing"))


@query("absent_mask", "SELECT edge_id, facility, side, slot, coalesce(lower(trim(presence)) IN ('no','none'), false) AS absent FROM o_fac_rows")
def absent_mask(c: City):
    return tags.facility_rows(c.edges, ["edge_id"]).select("edge_id", "facility", "side", "slot", tags.absent(C("presence")).alias("absent"))


part("o_reversed", """SELECT seg_id, edge_id, CASE WHEN abs(normalized_bearing-bearing) > 180 THEN 360-abs(normalized_bearing-bearing) ELSE abs(normalized_bearing-bearing) END >= 150 AS is_reversed FROM o_straight""")


@query("swap_left_right", """SELECT edge_id, CASE WHEN is_reversed THEN r ELSE l END AS sidewalk_left_presence, CASE WHEN is_reversed THEN l ELSE r END AS sidewalk_right_presence
FROM (SELECT e.edge_id, v.is_reversed, coalesce(sidewalk_left_tag, sidewalk_both, sidewalk) AS l, coalesce(sidewalk_both, sidewalk) AS r FROM fx_edges e JOIN o_reversed v ON v.edge_id = e.edge_id)""")
def swap_left_right(c: City):
    s = c.straight
    wide = s.select("edge_id", "normalized_bearing", "bearing",
                    tags.coalesce_tags(s, "sidewalk:left", "sidewalk:both", "sidewalk").alias("sidewalk_left_presence"),
                    tags.coalesce_tags(s, "sidewalk:right", "sidewalk:both", "sidewalk").alias("sidewalk_right_presence"))
    return tags.swap_pairs(wide, tags.reversed_flag(C("normalized_bearing"), C("bearing"))).drop("normalized_bearing", "bearing")


@query("haversine", f"SELECT edge_id, {r(haversine('lon0','lat0','lon1','lat1'), 4)} AS metres FROM o_lines2")
def haversine_q(c: City):
    e = N.attach_node_points(c.edges, c.nodes).where("start_x IS NOT NULL AND end_x IS NOT NULL")
    return rounded(e.select("edge_id", crs.haversine(C("start_lon"), C("start_lat"), C("end_lon"), C("end_lat")).alias("metres")), metres=4)


@query("utm_forward", f"SELECT node_id, {r('x',4)} AS x, {r('y',4)} AS y FROM o_nodes")
def utm_forward(c: City):
    return rounded(crs.add_utm(c.fx["fx_nodes"]).select("node_id", "x", "y"), x=4, y=4)


@query("utm_inverse", f"SELECT node_id, {r('lon_b',8)} AS lon, {r('lat_b',8)} AS lat FROM ({lonlat('(SELECT node_id, x + 3.7e0 AS x, y - 2.9e0 AS y FROM o_nodes)', lon='lon_b', lat='lat_b')})")
def utm_inverse(c: City):
    moved = c.nodes.select("node_id", (C("x") + 3.7).alias("x"), (C("y") - 2.9).alias("y"))
    return rounded(crs.add_lonlat(moved).select("node_id", "lon", "lat"), lon=8, lat=8)


def _state_plane_sql() -> str:
    k, p = crs.conic_constants(), crs.CALIFORNIA_3
    e = repr(k["e"])
    sql = (f"SELECT node_id, pow(sqrt(sx*sx+sy*sy)/{k['af']!r}, {1/k['n']!r}) AS t, {p['lon0']!r} + degrees(atan2(sx, sy)/{k['n']!r}) AS lon "
           f"FROM (SELECT node_id, x_ft*(1200.0e0/3937.0e0) - 2000000.0e0 AS sx, {k['rho0']!r} - (y_ft*(1200.0e0/3937.0e0) - 500000.0e0) AS sy "
           f"FROM (SELECT node_id, 6000000.0e0 + x/10.0e0 AS x_ft, 2100000.0e0 + (y-4170000.0e0)*3.0e0 AS y_ft FROM o_nodes))")
    sql = f"SELECT *, pi()/2 - 2*atan(t) AS phi FROM ({sql})"
    for _ in range(6):
        sql = f"SELECT node_id, t, lon, pi()/2 - 2*atan(t*pow((1-{e}*sin(phi))/(1+{e}*sin(phi)), {e}/2)) AS phi FROM ({sql})"
    return f"SELECT node_id, {r('lon', 8)} AS lon, {r('degrees(phi)', 8)} AS lat FROM ({sql})"


@query("state_plane_inverse", _state_plane_sql())
def state_plane_inverse(c: City):
    feet = c.nodes.select("node_id", (6000000.0 + C("x") / 10.0).alias("x_ft"), (2100000.0 + (C("y") - 4170000.0) * 3.0).alias("y_ft"))
    return rounded(crs.add_state_plane_lonlat(feet, "x_ft", "y_ft", "lon", "lat").select("node_id", "lon", "lat"), lon=8, lat=8)


@query("zoom_tier", "SELECT part_id, zoom, CASE WHEN zoom >= 18 THEN 5 WHEN zoom >= 17 THEN 4 WHEN zoom >= 15 THEN 3 WHEN zoom >= 13 THEN 2 ELSE 1 END AS tier FROM (SELECT CAST(p_partkey AS BIGINT) AS part_id, CAST(10 + (p_size % 20) / 2.0 AS DOUBLE) AS zoom FROM part)")
def zoom_tier(c: City):
    p = c.spark.read.parquet(f"{c.sf_dir}/part.parquet")
    z = p.select(C("p_partkey").cast("long").alias("part_id"), (10 + (C("p_size") % 20) / 2.0).cast("double").alias("zoom"))
    return z.withColumn("tier", view.zoom_tier(C("zoom")))


@query("tier_filter", "SELECT edge_id, highway, tier FROM (SELECT edge_id, highway, CAST(1 + edge_id % 5 AS INTEGER) AS tier FROM fx_edges) WHERE tier > 2 OR highway IN ('primary','secondary')")
def tier_filter(c: City):
    t = c.edges.select("edge_id", "highway", (1 + C("edge_id") % 5).cast("int").alias("tier"))
    return t.where(view.shown_in_tier(C("highway"), C("tier")))


@query("incline_color", """SELECT edge_id, CASE WHEN inc IS NULL THEN '#c0392b' ELSE format('#{:02x}{:02x}{:02x}', CAST(floor(192*f) AS BIGINT), CAST(floor(57*f) AS BIGINT), CAST(floor(43*f) AS BIGINT)) END AS color
FROM (SELECT edge_id, inc, 1 - least(abs(inc)/30.0e0, 1.0e0)*0.5e0 AS f FROM (SELECT edge_id, TRY_CAST(replace(incline,'%','') AS DOUBLE) AS inc FROM fx_edges))""")
def incline_color(c: City):
    return c.edges.select("edge_id", view.incline_color(F.lit(view.COLOURS["street"]), tags.parse_incline(C("incline"))).alias("color"))


@query("mid_vertex", f"SELECT edge_id, {r('lon',7)} AS lon, {r('lat',7)} AS lat FROM fx_vertices WHERE seq = 1")
def mid_vertex(c: City):
    from kerbline.functions import geom as G
    m = c.lines.select("edge_id", G.mid_vertex(C("geom")).alias("m")).select("edge_id", C("m.x").alias("lon"), C("m.y").alias("lat"))
    return rounded(m, lon=7, lat=7)


@query("feature_types_parse", """SELECT part_id, CAST(i AS INTEGER) AS i, CASE WHEN m = 0 THEN p_type WHEN i = 0 THEN p_brand ELSE p_type END AS feature_type
FROM (SELECT CAST(p_partkey AS BIGINT) AS part_id, p_partkey % 3 AS m, p_brand, p_type FROM part) CROSS JOIN (SELECT unnest([0,1]) AS i) WHERE m < 2 AND (m = 1 OR i = 0)""")
def feature_types_parse(c: City):
    p = c.spark.read.parquet(f"{c.sf_dir}/part.parquet")
    m = C("p_partkey") % 3
    raw = F.when(m == 0, C("p_type")).when(m == 1, F.to_json(F.array("p_brand", "p_type")))
    t = p.select(C("p_partkey").cast("long").alias("part_id"), view.feature_types(raw).alias("t"))
    return t.select("part_id", F.posexplode("t").alias("i", "feature_type"))


part("o_fids", """SELECT seg_id, CASE WHEN seg_id % 8192 = 0 THEN 'bk_left_2_' || grid_id ELSE 'right_end_3_' || grid_id END AS fid, grid_id, seg_id % 8192 = 0 AS bike FROM o_straight""")


@query("fid_parse", """SELECT fid, CASE WHEN bike THEN 'bikeway' ELSE 'ramp' END AS kind, CASE WHEN bike THEN 'left' ELSE 'right' END AS side,
 CASE WHEN bike THEN NULL ELSE 'end' END AS pos, CASE WHEN bike THEN '2' ELSE '3' END AS n, grid_id AS seg_id FROM o_fids""")
def fid_parse(c: City):
    fid = F.when(C("seg_id") % 8192 == 0, F.concat(F.lit("bk_left_2_"), "grid_id")).otherwise(F.concat(F.lit("right_end_3_"), "grid_id"))
    return c.straight.select(fid.alias("fid")).withColumn("p", view.fid_parts(C("fid"))).select("fid", "p.*")


_FOCUS_SQL = " UNION ALL ".join(
    f"SELECT seg_id, {i} AS ordinal, '{label}' AS label, {value} AS value, {str(rw).lower()} AS editable FROM o_straight"
    for i, (label, value, rw) in enumerate((
        ("Name", "name", False), ("Highway", "highway", False), ("OSM ID", "CAST(NULL AS VARCHAR)", False),
        ("Grid ID", "grid_id", False), ("Bearing (°)", "CAST(NULL AS VARCHAR)", False), ("Lanes", "lanes", True),
        ("Lane width", "lane_width", True), ("Max speed", "maxspeed", False), ("Oneway", "oneway", True),
        ("Length (m)", "CAST(NULL AS VARCHAR)", False), ("Surface", "CAST(NULL AS VARCHAR)", True),
        ("Incline", "CAST(NULL AS VARCHAR)", False), ("Start node", "CAST(start_node AS VARCHAR)", False),
        ("End node", "CAST(end_node AS VARCHAR)", False))))


@query("focus_view", _FOCUS_SQL)
def focus_view(c: City):
    return view.focus_view(c.straight.drop("normalized_bearing"), "street", "seg_id")


@query("typed_attr_cast", """SELECT edit_id, col, CASE WHEN col <> 'name' THEN TRY_CAST(new_value AS DOUBLE) END AS number,
 CASE WHEN col = 'name' THEN new_value END AS text, col = 'name' AND new_value LIKE 'N%' AND TRY_CAST(new_value AS DOUBLE) IS NULL AS not_a_number
FROM fx_changes WHERE edit_type = 'attr_edit'""")
def typed_attr_cast(c: City):
    e = c.changes.where("edit_type = 'attr_edit'")
    value, reject = tags.typed_cast(C("new_value"), "double")
    return e.select("edit_id", "col", F.when(C("col") != "name", value).alias("number"),
                    F.when(C("col") == "name", C("new_value")).alias("text"),
                    ((C("col") == "name") & reject).alias("not_a_number"))


# -- sources and shaping -----------------------------------------------------

@query("config_layers", """
WITH regions AS (SELECT n_name AS region, n_nationkey AS k FROM nation),
p AS (SELECT * FROM (VALUES ('default_maxspeed',25.0e0),('default_lane_width',3.0e0),('default_lanes',2.0e0),('deflection_angle_threshold',45.0e0),('default_bikeway_width',1.5e0),('hull_merge_buffer_m',10.0e0),('crosswalk_buffer_m',3.0e0),('curb_ramp_snap_m',1.0e0),('dem_resolution_m',10.0e0),('slope_cap_pct',40.0e0),('grid_cell_size',500.0e0),('curb_ramp_match_radius_m',5.0e0),('match_radius_m',30.0e0),('parallel_deg',45.0e0),('hull_ramp_max_m',15.0e0),('utm_zone',10.0e0)) t(param, value))
SELECT r.region, p.param, CAST(CASE WHEN param = 'default_lanes' AND k % 3 = 0 THEN 3.0e0 + k WHEN param = 'slope_cap_pct' THEN 35.0e0 WHEN param = 'default_lanes' THEN 4.0e0 ELSE value END AS DOUBLE) AS value,
 CASE WHEN param = 'default_lanes' AND k % 3 = 0 THEN 'city' WHEN param IN ('slope_cap_pct','default_lanes') THEN 'global' ELSE 'default' END AS tier
FROM regions r CROSS JOIN p""")
def config_layers(c: City):
    n = c.spark.read.parquet(f"{c.sf_dir}/nation.parquet").select(C("n_name").alias("region"), C("n_nationkey").alias("k"))
    city = n.select(F.lit("city").alias("tier"), "region", F.lit("default_lanes").alias("param"),
                    F.when(C("k") % 3 == 0, 3.0 + C("k")).cast("double").alias("value"))
    none = F.lit(None).cast("string").alias("region")
    r0 = n.where("k = 0")
    glob = r0.select(F.lit("global").alias("tier"), none, F.explode(F.map_from_arrays(
        F.array(F.lit("slope_cap_pct"), F.lit("default_lanes")), F.array(F.lit(35.0), F.lit(4.0)))).alias("param", "value"))
    return layered(n.select("region"), default_rows(c.spark), city.unionByName(glob))


@query("network_foundation", f"SELECT seg_id, start_node, end_node, name, highway, {r('normalized_bearing',4)} AS normalized_bearing, grid_id, start_is_intersection, end_is_intersection FROM o_straight")
def network_foundation(c: City):
    lines = N.straight_lines(c.edges, c.nodes)
    s = N.foundation(c.edges, lines, c.nodes)
    return rounded(s.select("seg_id", "start_node", "end_node", "name", "highway", "normalized_bearing", "grid_id",
                            "start_is_intersection", "end_is_intersection"), normalized_bearing=4)
