"""The network as versioned, tiled tables, of which an edit rewrites the touched tiles only.

Every row of every table lies in the tile of its street or hull and has a box
(min_x, min_y, max_x, max_y, in metres).  Data lie at ``tables/NAME/tile=T/version=V``; a
version is a small manifest ``versions/version=V`` that says for each table and tile which
data version holds its rows, how many they are, what box they fill and a checksum of them.
The manifest is written last, in one file, and makes the version; what a failed attempt
left behind is not named by any manifest and is overwritten by the next attempt.

A manifest also names the last batch of edits that its version contains, so a stream that
delivers a batch again after a failure finds it done.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import fields

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from kerbline.config import Params
from kerbline.functions import crs, geom as G
from kerbline.operators import edits as ED, facilities as FA
from kerbline.plans.changes import apply_changeset
from kerbline.plans.city import Network
from kerbline.plans.overrides import TABLES as OVERRIDES, Overrides
from kerbline.staging import new_folder, stage

TILE_M = 10_000.0
BOX = ("min_x", "min_y", "max_x", "max_y")
MANIFEST = ("name string, tile string, data_version long, n long, checksum long, min_x double, min_y double, max_x double, max_y double, "
            "table_schema string, batch long")
# how a row finds its place: its own line or point, or the street or hull that it belongs to
PLACES = {
    "segments": "utm", "hulls": "ring", "footways": "utm", "crossings": "point",
    "facilities": "seg_id", "sidewalks": "seg_id", "ramps": "seg_id", "crosswalks": "seg_id", "calming": "seg_id", "slots": "hull_id", "members": "hull_id",
    "override_hulls": "ring", "override_crosswalks": "line", "override_ramps": "seg_id", "override_links": "a"}
FEW_TILES = 200  # tiles named in a filter; beyond that they are joined


def _box(place: str) -> Column:
    if place == "point":
        return F.struct(F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    return G.bbox(F.col(place))


def _boxed(df: DataFrame, place: str) -> DataFrame:
    names = dict(zip(BOX, ("x0", "y0", "x1", "y1"), strict=True))
    return df.withColumn("_b", _box(place)).withColumns({b: F.col(f"_b.{c}") for b, c in names.items()}).drop("_b")


def tile(x: Column, y: Column, size: float) -> Column:
    return F.concat_ws("_", *[F.floor(c / size).cast("string") for c in (x, y)])


def tables_of(net: Network) -> dict[str, DataFrame]:
    """All stored tables of a network; what follows from others (``facility_ends``) is not stored."""
    own = net.overrides or Overrides.none(net.segments.sparkSession)
    out = {t: getattr(net, t) for t in PLACES if not t.startswith("override_")}
    return {**out, **{f"override_{t}": getattr(own, t) for t in OVERRIDES}}


def placed(tables: dict[str, DataFrame], size: float = TILE_M) -> dict[str, DataFrame]:
    """Tables with box and tile; a row whose street or hull is gone has no place and is left out."""
    out = {}
    for name, place in PLACES.items():
        if place not in ("seg_id", "hull_id", "a"):
            out[name] = _boxed(tables[name], place).withColumn("tile", tile(F.col("min_x"), F.col("min_y"), size))
    at = {"seg_id": out["segments"].select("seg_id", *BOX, "tile"), "hull_id": out["hulls"].select("hull_id", *BOX, "tile")}
    at["a"] = tables["members"].select(F.col("node_id").alias("a"), "hull_id").join(at["hull_id"], "hull_id").drop("hull_id")
    for name, place in PLACES.items():
        if place in at:
            out[name] = tables[name].join(at[place], place)
    return out


class NetworkStore:
    def __init__(self, spark: SparkSession, path: str, params: Params = Params(), tile_m: float = TILE_M):
        self.spark, self.path, self.params, self.tile_m = spark, path.rstrip("/"), params, tile_m

    # versions

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST + ", version long").parquet(f"{self.path}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def head(self) -> tuple[int, int | None] | None:
        """(newest version, last batch of edits in it); None while nothing is stored."""
        m = self._manifests()
        row = None if m is None else m.groupBy("version").agg(F.max("batch").alias("batch")).orderBy(F.col("version").desc()).first()
        return (row["version"], row["batch"]) if row else None

    def manifest(self, version: int) -> DataFrame:
        return self._manifests().where(F.col("version") == version).drop("version")

    # reading

    def table(self, name: str, version: int | None = None, tiles: list[str] | None = None) -> DataFrame:
        """A table with its boxes as it is in a version; with ``tiles`` only these folders are read."""
        version = self.head()[0] if version is None else version
        m = self.manifest(version).where(F.col("name") == name)
        schema = T.StructType.fromJson(json.loads(m.where("table_schema IS NOT NULL").first()["table_schema"]))
        m = m.where("tile IS NOT NULL").select("tile", F.col("data_version").alias("version"))
        if tiles is not None:
            m = m.where(F.col("tile").isin(tiles))
        if m.isEmpty():
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("tile", T.StringType()), T.StructField("version", T.LongType())])).parquet(
            f"{self.path}/tables/{name}")
        if tiles is not None and len(tiles) <= FEW_TILES:
            hit = F.lit(False)
            for r in m.collect():  # no more rows than tiles asked for
                hit = hit | ((F.col("tile") == r["tile"]) & (F.col("version") == r["version"]))
            return rows.where(hit).select(*schema.names)
        return rows.join(F.broadcast(m), ["tile", "version"]).select(*schema.names)  # a row a tile

    def read(self, version: int | None = None, tiles: list[str] | None = None) -> Network:
        version = self.head()[0] if version is None else version
        got = {n: self.table(n, version, tiles).drop(*BOX) for n in PLACES}
        own = Overrides(**{t: got.pop(f"override_{t}") for t in OVERRIDES})
        ends = FA.facility_ends(got["facilities"], got["segments"], got["crosswalks"])
        return Network(**{f.name: got[f.name] for f in fields(Network) if f.name in got}, facility_ends=ends, overrides=own)

    def tiles_in(self, box: tuple[float, float, float, float], version: int | None = None, name: str = "segments") -> list[str]:
        """Tiles whose rows may meet a box in metres."""
        version = self.head()[0] if version is None else version
        x0, y0, x1, y1 = box
        m = self.manifest(version).where((F.col("name") == name) & (F.col("min_x") <= x1) & (F.col("max_x") >= x0) & (F.col("min_y") <= y1) & (F.col("max_y") >= y0))
        return [r["tile"] for r in m.select("tile").collect()]

    def metric_box(self, box: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
        """Metres that enclose a box in degrees; its sides are bent, by less than a thousandth of their length."""
        lon0, lat0, lon1, lat1 = box
        corners = [(x, y) for x in (lon0, (lon0 + lon1) / 2, lon1) for y in (lat0, (lat0 + lat1) / 2, lat1)]
        p = crs.add_utm(self.spark.createDataFrame(corners, "lon double, lat double"), zone=self.params.utm_zone)
        r = p.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
        pad = 0.001 * max(r[2] - r[0], r[3] - r[1]) + 1
        return r[0] - pad, r[1] - pad, r[2] + pad, r[3] + pad

    def viewport(self, box: tuple[float, float, float, float], version: int | None = None) -> Network:
        """Streets whose box meets a viewport in degrees, with what is booked on them; folders and row groups outside are not read."""
        version = self.head()[0] if version is None else version
        m = self.metric_box(box)

        def part(name: str) -> DataFrame:
            t = self.table(name, version, self.tiles_in(m, version, name))
            return t.where((F.col("min_x") <= m[2]) & (F.col("max_x") >= m[0]) & (F.col("min_y") <= m[3]) & (F.col("max_y") >= m[1])).drop(*BOX)

        got = {n: part(n) for n in PLACES}
        own = Overrides(**{t: got.pop(f"override_{t}") for t in OVERRIDES})
        return Network(**{f.name: got[f.name] for f in fields(Network) if f.name in got},
                       facility_ends=FA.facility_ends(got["facilities"], got["segments"], got["crosswalks"]), overrides=own)

    # writing

    def save(self, net: Network, batch: int | None = None, within: list[str] | None = None) -> int:
        """A new version with the network's rows; tiles whose rows are as they were keep their files.

        ``within`` names the tiles that ``net`` was read from: all other tiles stay.
        """
        head = self.head()
        version = 1 if head is None else head[0] + 1
        old = None if head is None else stage(self.manifest(head[0]), "manifest")
        parts = []
        for name, df in placed(tables_of(net), self.tile_m).items():
            plain = sorted(c for c in df.columns if c not in (*BOX, "tile"))
            rows = stage(df.select(*plain, *BOX, "tile"), f"placed-{name}")
            now = rows.groupBy("tile").agg(F.count("*").alias("n"), F.expr(f"bit_xor(xxhash64({', '.join(f'`{c}`' for c in plain)}))").alias("checksum"),
                                           *[(F.min if b.startswith("min") else F.max)(b).alias(b) for b in BOX])
            if old is None:
                state = now.withColumn("data_version", F.lit(version).cast("long"))
            else:
                mine = old.where((F.col("name") == name) & F.col("tile").isNotNull())
                before = mine.select("tile", F.col("n").alias("_n"), F.col("checksum").alias("_sum"), F.col("data_version").alias("_v"))
                same = (F.col("_n") == F.col("n")) & F.col("_sum").eqNullSafe(F.col("checksum"))
                state = now.join(before, "tile", "left").withColumn("data_version", F.when(same, F.col("_v")).otherwise(F.lit(version).cast("long")))
                if within is not None:
                    state = state.drop("_n", "_sum", "_v").unionByName(mine.where(~F.col("tile").isin(within)).select("tile", "n", "checksum", *BOX, "data_version"))
            state = stage(state.select("tile", "n", "checksum", *BOX, "data_version"), f"state-{name}")
            new = state.where(F.col("data_version") == version).select("tile")
            fresh = rows.join(F.broadcast(new), "tile", "left_semi").withColumn("version", F.lit(version).cast("long"))  # a row a tile
            fresh = fresh.repartitionByRange("tile", "min_x", "min_y").sortWithinPartitions("tile", "min_x", "min_y")
            fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile", "version").parquet(f"{self.path}/tables/{name}")
            schema = T.StructType([f for f in rows.schema.fields if f.name != "tile"]).json()
            named = state.withColumn("table_schema", F.lit(None).cast("string")).unionByName(
                self.spark.createDataFrame([(schema,)], "table_schema string"), allowMissingColumns=True)
            parts.append(named.withColumn("name", F.lit(name)))
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        last = batch if batch is not None else (head[1] if head else None)
        whole = whole.withColumn("batch", F.lit(last).cast("long")).select(*[f.split()[0] for f in MANIFEST.split(", ")])
        whole.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")  # some rows a tile
        return version

    # edits

    def reach(self, edits: DataFrame, version: int) -> list[str]:
        """Tiles that an edit table can change: those of its streets, nodes and places, and all around them."""
        seg = self.table("segments", version).select("seg_id", "start_node", "end_node", *BOX)
        e = ED.edit_table(edits)
        ids = e.select(F.explode(F.array("seg_id", "consumed_id", "b_seg_id")).alias("seg_id")).where("seg_id IS NOT NULL").distinct()
        nodes = e.select("node_id").where("node_id IS NOT NULL").distinct()
        hit = seg.join(ids, "seg_id", "left_semi").select(*BOX)
        for end in ("start", "end"):
            hit = hit.unionByName(seg.join(nodes.withColumnRenamed("node_id", f"{end}_node"), f"{end}_node", "left_semi").select(*BOX))
        spots = hit.select(F.explode(F.array(F.struct(F.col("min_x").alias("x"), F.col("min_y").alias("y")), F.struct(F.col("max_x").alias("x"), F.col("max_y").alias("y")))).alias("p")).select("p.*")
        spots = spots.unionByName(e.where("x IS NOT NULL").select("x", "y")).unionByName(e.select(F.explode("utm").alias("p")).select("p.x", "p.y"))
        cells = spots.select(F.floor(F.col("x") / self.tile_m).alias("c"), F.floor(F.col("y") / self.tile_m).alias("r")).distinct()
        around = cells.select(F.explode(F.array(*[F.concat_ws("_", (F.col("c") + i).cast("string"), (F.col("r") + j).cast("string"))
                                                  for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("tile")).distinct()
        return [r["tile"] for r in around.collect()]  # bounded by the area that the edits of one batch touch

    def apply(self, edits: DataFrame, batch: int) -> int:
        """The version that contains a batch of edits; a batch that is in already changes nothing."""
        version, last = self.head()
        if last is not None and batch <= last:
            return version
        # a stream hands its batches over in a session of its own
        path = new_folder(self.spark, "batch-edits")
        ED.edit_table(edits).write.parquet(path)
        edits = self.spark.read.schema(", ".join(f"{c} {t}" for c, t in ED.EDIT_COLUMNS.items())).parquet(path)
        tiles = self.reach(edits, version)
        top = ED.max_drawn_id(self.table("segments", version)).first()["max_id"]
        while True:
            net = apply_changeset(self.read(version, tiles), edits, self.params, top)
            rows = placed(tables_of(net), self.tile_m)
            own = [rows[n].select("tile") for n, place in PLACES.items() if place not in ("seg_id", "hull_id", "a")]
            out = own[0]
            for o in own[1:]:
                out = out.unionByName(o)
            beyond = [r["tile"] for r in out.distinct().where(~F.col("tile").isin(tiles)).collect()]
            if not beyond:
                return self.save(net, batch, tiles)
            tiles = [*tiles, *beyond]  # a line that was moved there needs what lies there

    def sink(self) -> Callable[[DataFrame, int], None]:
        """For ``foreachBatch``: batches of an edit table, each once, whatever fails in between."""
        return lambda edits, batch: self.apply(edits, batch) and None


def build_regions(spark: SparkSession, path: str, makers: dict[str, Callable[[], Network]], skip_existing: bool = True,
                  params: Params = Params()) -> dict[str, int]:
    """Version of each region's store after building those that are not there yet, or all of them.

    A region is finished when its manifest is written; one that failed is built again.
    """
    out = {}
    for region, make in makers.items():
        store = NetworkStore(spark, f"{path}/region={region}", params)
        head = store.head()
        out[region] = head[0] if head and skip_existing else store.save(make())
    return out
