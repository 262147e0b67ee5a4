"""Scans, sinks, schema shaping, streams and the whole build."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from kerbline import schema
from kerbline.functions import geom as G
from kerbline.operators import edits as ED, network as N
from kerbline.plans import changes, city
from kerbline.sources import changeset, tables, wkb
from kerbline.staging import new_folder
from kerbline.streaming import edits as ES
from queries.editing import attr_edits
from queries.registry import City, query, rounded
from queries.sqltext import r

C = F.col


def saved(df, name: str, fmt: str = "parquet", **options) -> str:
    path = new_folder(df.sparkSession, name)
    df.write.format(fmt).options(**options).save(path)
    return path


@query("scan_edges", "SELECT edge_id, u, v, name, highway, oneway, lanes, maxspeed, sidewalk, cycleway FROM fx_edges")
def scan_edges(c: City):
    return tables.scan_edges(c.spark, saved(c.edges, "edges-in")).select("edge_id", "u", "v", "name", "highway", "oneway", "lanes", "maxspeed", "sidewalk", "cycleway")


@query("scan_nodes", f"SELECT osmid, {r('lon',7)} AS lon, {r('lat',7)} AS lat, crossing, highway, kerb FROM fx_crossings")
def scan_nodes(c: City):
    n = tables.scan_nodes(c.spark, saved(c.fx["fx_crossings"], "nodes-in"))
    return rounded(n.select("osmid", "lon", "lat", "crossing", "highway", "kerb"), lon=7, lat=7)


@query("scan_calming", "SELECT osmid, traffic_calming FROM fx_calming")
def scan_calming(c: City):
    """Point features, with as many line features beside them that the scan must leave out."""
    pts = c.calming.select("osmid", "traffic_calming", F.lit("Point").alias("geom_type"))
    lines = c.edges.select(C("edge_id").alias("osmid"), F.lit("table").alias("traffic_calming"), F.lit("LineString").alias("geom_type"))
    return tables.scan_calming(c.spark, saved(pts.unionByName(lines), "calming-in")).select("osmid", "traffic_calming")


@query("scan_gov_ramps", f"SELECT locid, {r('longitude',7)} AS longitude, {r('latitude',7)} AS latitude, curbreturnloc, conditionscore FROM fx_gov_ramps WHERE crexist = '1'")
def scan_gov_ramps(c: City):
    none = F.lit(None).cast("double")
    rows = c.fx["fx_gov_ramps"].select("crexist", "longitude", "latitude", none.alias("xloc"), none.alias("yloc"), "locid", "curbreturnloc", "positiononreturn", "conditionscore")
    g = tables.scan_inventory(c.spark, saved(rows, "inventory-in", "csv", header=True))
    return rounded(g.select("locid", "longitude", "latitude", "curbreturnloc", "conditionscore"), longitude=7, latitude=7)


@query("wkb_decode", f"SELECT edge_id, CAST(seq AS INTEGER) AS i, {r('lon',7)} AS x, {r('lat',7)} AS y FROM fx_vertices")
def wkb_decode(c: City):
    """Lines written in both byte orders and read back."""
    odd = wkb.encode(c.lines.where("edge_id % 2 = 1").select("edge_id", "geom"), "geom", "b", big_endian=True)
    even = wkb.encode(c.lines.where("edge_id % 2 = 0").select("edge_id", "geom"), "geom", "b")
    d = wkb.decode(odd.unionByName(even).select("edge_id", "b"), "b", "g")
    v = d.select("edge_id", F.posexplode(F.flatten("g.parts")).alias("i", "p")).select("edge_id", "i", "p.x", "p.y")
    return rounded(v, x=7, y=7)


@query("wkb_kinds", f"""SELECT edge_id, kind, CAST(part AS INTEGER) AS part, CAST(i AS INTEGER) AS i, {r('lon',7)} AS x, {r('lat',7)} AS y FROM (
SELECT edge_id, 'Point' AS kind, 0 AS part, 0 AS i, lon, lat FROM fx_vertices WHERE seq = 0
UNION ALL SELECT edge_id, 'LineString', 0, seq, lon, lat FROM fx_vertices
UNION ALL SELECT edge_id, 'MultiPoint', seq, 0, lon, lat FROM fx_vertices
UNION ALL SELECT edge_id, 'MultiLineString', seq, 0, lon, lat FROM fx_vertices v WHERE seq < (SELECT max(seq) FROM fx_vertices w WHERE w.edge_id = v.edge_id)
UNION ALL SELECT edge_id, 'MultiLineString', seq - 1, 1, lon, lat FROM fx_vertices WHERE seq > 0
UNION ALL SELECT edge_id, 'Polygon', 0, seq, lon, lat FROM fx_vertices
UNION ALL SELECT v.edge_id, 'Polygon', 0, m.n, lon, lat FROM fx_vertices v JOIN (SELECT edge_id, count(*) AS n FROM fx_vertices GROUP BY edge_id) m ON m.edge_id = v.edge_id WHERE seq = 0)""")
def wkb_kinds(c: City):
    """Every kind of geometry that the vertices of an edge make, written in both byte orders and read back."""
    shapes = {"Point": F.slice("geom", 1, 1), "LineString": C("geom"), "MultiPoint": C("geom"),
              "MultiLineString": F.transform(F.sequence(F.lit(1), F.size("geom") - 1), lambda i: F.slice("geom", i, F.lit(2))),
              "Polygon": F.array(F.concat("geom", F.slice("geom", 1, 1)))}
    written = [wkb.encode(c.lines.where(f"edge_id % 2 = {int(big)}").select("edge_id", shape.alias("s")), "s", "b", big, kind).select("edge_id", "b")
               for kind, shape in shapes.items() for big in (False, True)]
    d = wkb.decode(reduce(DataFrame.unionByName, written), "b", "g")
    v = (d.select("edge_id", "g.kind", F.posexplode("g.parts").alias("part", "line"))
         .select("edge_id", "kind", "part", F.posexplode("line").alias("i", "p")).select("edge_id", "kind", "part", "i", "p.x", "p.y"))
    return rounded(v, x=7, y=7)


def written_network(c: City) -> str:
    path = new_folder(c.spark, "network")
    tables.write_network(c.straight, N.grid_origin(c.nodes), path, "lattice")
    return path


@query("sink_network", "SELECT seg_id, grid_id, 'lattice' AS region FROM o_straight")
def sink_network(c: City):
    return c.spark.read.parquet(written_network(c) + "/segments").select("seg_id", "grid_id", "region")


@query("scan_network", f"SELECT seg_id, 'LineString' AS kind, {r('lon0',7)} AS lon0, {r('lat0',7)} AS lat0 FROM o_straight")
def scan_network(c: City):
    n = tables.scan_network(c.spark, written_network(c) + "/segments")
    p = C("geometry.parts")[0][0]
    return rounded(n.select("seg_id", C("geometry.kind").alias("kind"), p["x"].alias("lon0"), p["y"].alias("lat0")), lon0=7, lat0=7)


@query("multi_region", "SELECT n_name AS region FROM nation WHERE n_regionkey <> 1")
def multi_region(c: City):
    n = c.spark.read.parquet(f"{c.sf_dir}/nation.parquet").select(C("n_name").alias("region"), "n_regionkey")
    return tables.unfinished(n.select("region"), n.where("n_regionkey = 1").select("region"))


@query("schema_fill", "SELECT seg_id, grid_id AS street_grid_id, name, CAST(0 AS BIGINT) AS maxspeed, false AS intersection_review_flag, 'no' AS sidewalk_left_offset, CAST(NULL AS VARCHAR) AS crosswalk_end_type, CAST(273 AS INTEGER) AS n_columns FROM o_straight")
def schema_fill(c: City):
    w = schema.fill(c.straight.select("seg_id", C("grid_id").alias("street_grid_id"), "name"))
    return w.select("seg_id", "street_grid_id", "name", "maxspeed", "intersection_review_flag", "sidewalk_left_offset", "crosswalk_end_type", F.lit(len(w.columns)).alias("n_columns"))


@query("type_normalise", "SELECT CAST(p_partkey AS BIGINT) AS part_id, split_part(p_type, ' ', 1) AS name, p_brand AS surface_first, CAST(1 AS INTEGER) AS surface_size, '{\"brand\":\"' || p_brand || '\"}' AS street_feature_attributes FROM part")
def type_normalise(c: City):
    p = c.spark.read.parquet(f"{c.sf_dir}/part.parquet")
    loose = p.select(C("p_partkey").cast("long").alias("part_id"), F.split("p_type", " ").alias("name"), C("p_brand").alias("surface"),
                     F.create_map(F.lit("brand"), "p_brand").alias("street_feature_attributes"))
    t = schema.normalise_types(loose)
    return t.select("part_id", "name", C("surface")[0].alias("surface_first"), F.size("surface").alias("surface_size"), "street_feature_attributes")


@query("changeset_read", f"""SELECT edit_id AS doc, CASE edit_type WHEN 'attr_edit' THEN 'attr_edits' WHEN 'move_point' THEN 'moved_endpoints' WHEN 'delete_point' THEN 'deleted_points' ELSE 'added_nodes' END AS kind,
 CASE WHEN edit_type IN ('move_point','delete_point') THEN CAST(node_id AS VARCHAR) END AS node_id, CASE WHEN edit_type = 'attr_edit' THEN CAST(node_id AS VARCHAR) END AS segment_id, CASE WHEN edit_type = 'attr_edit' THEN col END AS col, CASE WHEN edit_type = 'attr_edit' THEN new_value END AS new_value,
 {r("CASE WHEN edit_type <> 'attr_edit' THEN x END", 7)} AS x, {r("CASE WHEN edit_type <> 'attr_edit' THEN y END", 7)} AS y FROM fx_changes WHERE edit_type <> 'undo'""")
def changeset_read(c: City):
    """One changeset document per edit, written as JSON and read back."""
    e = c.changes.where("edit_type <> 'undo'")
    node = C("node_id").cast("string")
    lists = {
        "attr_edits": ("attr_edit", F.struct(node.alias("street_grid_id"), "col", "new_value")),
        "moved_endpoints": ("move_point", F.struct(node.alias("node_id"), C("lon").alias("new_x"), C("lat").alias("new_y"))),
        "deleted_points": ("delete_point", F.struct(node.alias("node_id"), C("lon").alias("x"), C("lat").alias("y"))),
        "added_nodes": ("add_point", F.struct(C("lon").alias("x"), C("lat").alias("y")))}
    edits = F.struct(*[F.when(C("edit_type") == t, F.array(s)).alias(k) for k, (t, s) in lists.items()])
    docs = e.select(F.to_json(F.struct(C("edit_id").cast("string").alias("parquet"), ED.stage_of(C("edit_type")).alias("dirty_from_stage"), edits.alias("edits"))).alias("value"))
    flat = changeset.flatten(changeset.read(c.spark, saved(docs, "changesets", "text")))
    return rounded(flat.select(C("parquet").cast("long").alias("doc"), "kind", "node_id", "segment_id", "col", "new_value", "x", "y"), x=7, y=7)


@query("edit_stream", "SELECT seg_id, col, arg_max(new_value, edit_id) AS new_value, max(edit_id) AS edit_id FROM o_attr GROUP BY seg_id, col")
def edit_stream(c: City):
    """Attribute edits delivered twice through a file stream; the stored batches give the last value once."""
    rows = attr_edits(c).join(c.changes.select("edit_id", C("ts").cast("timestamp").alias("ts"), "user_id", "edit_type", "node_id"), "edit_id")
    log = rows.select("edit_id", "ts", "user_id", "edit_type", "node_id", "seg_id", "col", "new_value")
    folder = saved(log.unionByName(log), "edit-log")
    target = new_folder(c.spark, "edit-batches")
    q = ES.run(ES.edit_stream(c.spark, folder), new_folder(c.spark, "edit-progress"), ES.store_batches(target))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return ED.latest_edits(ES.stored(c.spark, target), "seg_id")


def inputs(c: City) -> city.Inputs:
    return city.Inputs(edges=c.edges, lines=c.lines, nodes=c.nodes, facility_lines=c.facility_lines, crossings=c.crossings,
                       calming=c.calming, elevation=c.elev, inventory=c.fx["fx_gov_ramps"])


def network_of(c: City) -> city.Network:
    if not hasattr(c, "_network"):
        c._network = city.build(inputs(c))
    return c._network


@query("build_network")
def build_network(c: City):
    """Every step on the split network, as one wide row per segment with all columns."""
    return city.wide(network_of(c))


@query("apply_changeset")
def apply_changeset(c: City):
    """The whole change log applied to the built network; one row per street end with its crosswalk and ramps."""
    net = changes.apply_changeset(network_of(c), c.changes.join(
        c.split.groupBy(C("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id")), "node_id", "left"))
    ramps = net.ramps.groupBy("seg_id", "pos").agg(F.count("*").alias("n_ramps"))
    return net.crosswalks.select("seg_id", "pos", "source").join(ramps, ["seg_id", "pos"], "full_outer")
