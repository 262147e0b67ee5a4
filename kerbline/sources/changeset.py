"""Changeset documents: nested edit lists read as JSON and flattened to one edit table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from kerbline.functions import crs, geom as G
from kerbline.operators import edits as ED

_RAMP = "struct<segment_id:string,side:string,position:string,index:int>"
# fixed values: edit list name to element type
KINDS = {
    "added_nodes": "struct<x:double,y:double>",
    "consolidated_hulls": "struct<node_keys:array<array<double>>,buffer_m:double>",
    "moved_endpoints": "struct<node_id:string,new_x:double,new_y:double,rubber_band_segments:array<string>>",
    "toggled_curb_ramps": "struct<segment_id:string,side:string,position:string,index:int,enabled:boolean>",
    "drawn_crosswalks": f"struct<ramp_a:{_RAMP},ramp_b:{_RAMP}>",
    "edited_hulls": "struct<node_id:string,geometry:struct<type:string,coordinates:array<array<array<double>>>>>",
    "attr_edits": "struct<street_grid_id:string,col:string,old_value:string,new_value:string>",
    "deleted_points": "struct<node_id:string,x:double,y:double>",
    "deleted_hulls": "struct<node_id:string>",
    "merged_segments": "struct<surviving_seg_id:string,consumed_seg_id:string,shared_node_id:string>",
    "drawn_segments": "struct<coordinates:array<array<double>>>",
}
SCHEMA = ("parquet string, dirty_from_stage int, bbox struct<minX:double,minY:double,maxX:double,maxY:double>, edits struct<"
          + ",".join(f"{k}:array<{t}>" for k, t in KINDS.items()) + ">")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).json(path)


def flatten(changesets: DataFrame, key: str = "parquet") -> DataFrame:
    """(key, kind, ordinal, node_id, segment_id, col, new_value, x, y, payload), one row per edit."""
    def kind(name: str) -> DataFrame:
        e = changesets.select(key, F.lit(name).alias("kind"), F.posexplode(f"edits.{name}").alias("ordinal", "e"))
        names = changesets.schema["edits"].dataType[name].dataType.elementType.names

        def pick(*paths: str, typ: str = "string"):
            known = [p for p in paths if p in names]
            return F.col(f"e.{known[0]}").cast(typ) if known else F.lit(None).cast(typ)

        return e.select(key, "kind", "ordinal", pick("node_id", "shared_node_id").alias("node_id"),
                        pick("segment_id", "street_grid_id", "surviving_seg_id").alias("segment_id"), pick("col").alias("col"),
                        pick("new_value").alias("new_value"), pick("x", "new_x", typ="double").alias("x"), pick("y", "new_y", typ="double").alias("y"),
                        F.to_json("e").alias("payload"))
    return reduce(lambda a, b: a.unionByName(b), [kind(k) for k in KINDS])


# fixed values: edit list name to edit type, in the order in which a document's lists take effect
EDIT_TYPES = {
    "moved_endpoints": "move_point", "added_nodes": "add_point", "toggled_curb_ramps": "toggle_curb_ramp", "drawn_crosswalks": "draw_crosswalk",
    "attr_edits": "attr_edit", "deleted_points": "delete_point", "deleted_hulls": "delete_polygon", "merged_segments": "merge_segments",
    "drawn_segments": "draw_segment", "edited_hulls": "edit_polygon_face", "consolidated_hulls": "consolidate_hulls"}
DOCUMENT_BITS = 20  # a document holds less than 2 ** 20 edits


def _points(coordinates: Column) -> Column:
    return F.transform(coordinates, lambda p: G.pt(p[0], p[1]))


def to_edits(flat: DataFrame, segments: DataFrame, key: str = "doc", zone: int = 10) -> DataFrame:
    """Edit table of flattened documents, which ``key`` numbers upwards in the order of saving (below 2 ** 40).

    Streets are named by grid id and become segments; edits of unknown streets are left
    out.  Places are degrees; the keys of consolidated hulls may be metres too, as all
    values beyond degrees are.
    """
    place = W.partitionBy(key).orderBy("_kind", "ordinal")  # one document
    number = F.row_number().over(place)
    number = F.when(number < 1 << DOCUMENT_BITS, number).otherwise(F.raise_error(F.lit("a changeset document holds too many edits")).cast("int"))
    order = F.create_map(*[F.lit(v) for i, k in enumerate(EDIT_TYPES) for v in (k, i)])
    base = flat.withColumn("_kind", order[F.col("kind")]).withColumn(
        "edit_id", F.shiftleft(F.col(key).cast("long"), DOCUMENT_BITS) + number.cast("long")).select("edit_id", "kind", "payload")
    streets = segments.select(F.col("grid_id").alias("_grid"), F.col("seg_id").alias("_seg"))

    def named(df: DataFrame, grid: str, out: str) -> DataFrame:
        return df.join(streets.select(F.col("_grid").alias(grid), F.col("_seg").alias(out)), grid)

    def of(kind: str, **columns: Column) -> DataFrame:
        e = base.where(F.col("kind") == kind).withColumn("e", F.from_json("payload", KINDS[kind]))
        return e.select("edit_id", F.lit(EDIT_TYPES[kind]).alias("edit_type"), *[c.alias(n) for n, c in columns.items()])

    def ramp(r: str, p: str = "") -> dict[str, Column]:
        return {f"{p}_grid": F.col(f"{r}.segment_id"), f"{p}side": F.col(f"{r}.side"), f"{p}pos": F.col(f"{r}.position"), f"{p}n": F.col(f"{r}.index")}

    node = F.col("e.node_id").try_cast("long")
    moves = of("moved_endpoints", node_id=node, lon=F.col("e.new_x"), lat=F.col("e.new_y"), _band=F.col("e.rubber_band_segments"))
    band = named(moves.select("edit_id", F.explode("_band").alias("_g")), "_g", "s").groupBy("edit_id").agg(F.collect_list("s").alias("band"))
    moves = moves.join(band, "edit_id", "left").withColumn("band", F.when(F.col("_band").isNotNull(), F.coalesce("band", F.array().cast("array<long>"))))
    keys = of("consolidated_hulls", k=F.explode("e.node_keys")).withColumns({"_x": F.col("k")[0], "_y": F.col("k")[1]})
    degrees = (F.abs("_x") <= 180) & (F.abs("_y") <= 90)
    keys = keys.withColumns({"lon": F.when(degrees, F.col("_x")), "lat": F.when(degrees, F.col("_y"))})
    rows = [
        moves, keys, of("added_nodes", lon=F.col("e.x"), lat=F.col("e.y")),
        named(of("toggled_curb_ramps", enabled=F.col("e.enabled"), **ramp("e")), "_grid", "seg_id"),
        named(named(of("drawn_crosswalks", **ramp("e.ramp_a"), **ramp("e.ramp_b", "b_")), "_grid", "seg_id"), "b__grid", "b_seg_id"),
        named(of("attr_edits", _grid=F.col("e.street_grid_id"), col=F.col("e.col"), new_value=F.col("e.new_value")), "_grid", "seg_id"),
        of("deleted_points", node_id=node), of("deleted_hulls", node_id=node),
        named(named(of("merged_segments", _grid=F.col("e.surviving_seg_id"), _other=F.col("e.consumed_seg_id"),
                       node_id=F.col("e.shared_node_id").try_cast("long")), "_grid", "seg_id"), "_other", "consumed_id"),
        of("drawn_segments", geom=_points(F.col("e.coordinates"))).where(F.size("geom") >= 2),
        of("edited_hulls", node_id=node, geom=_points(F.get(F.col("e.geometry.coordinates"), F.lit(0)))).withColumn(
            "geom", F.when(G.first_pt(F.col("geom")) == G.last_pt(F.col("geom")), F.slice("geom", F.lit(1), F.size("geom") - 1)).otherwise(F.col("geom")))]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    table = crs.add_utm(table, zone=zone).withColumn("utm", crs.utm_line(F.col("geom"), zone))
    table = table.withColumns({"x": F.coalesce("x", "_x"), "y": F.coalesce("y", "_y")})
    return ED.edit_table(table)
