"""Registry of queries, each with its checking SQL where one can be stated."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbline.config import Params
from kerbline.functions import crs, geom as G, tags
from kerbline.operators import crosswalks as XW, facilities as FA, intersections as IX, network as N
from kerbline.sources import fixtures
from kerbline.staging import stage, together
from queries import sqltext

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
_cities: dict[tuple[str, str], City] = {}


class City:
    """Staged inputs and intermediate networks of one data folder."""

    params = Params()

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.fx = fixtures.load(spark, sf_dir)

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> City:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _cities:
            _cities[key] = cls(spark, sf_dir)
        return _cities[key]

    def ready(self, *names: str) -> None:
        """Have tables that do not depend on each other made at the same time."""
        together(*[lambda name=name: getattr(self, name) for name in names])

    @cached_property
    def nodes(self) -> DataFrame:
        return stage(crs.add_utm(self.fx["fx_nodes"]), "nodes")

    @cached_property
    def edges(self) -> DataFrame:
        e = self.fx["fx_edges"]
        names = {"sidewalk_both": "sidewalk:both", "sidewalk_left_tag": "sidewalk:left",
                 "cycleway_width": "cycleway:width"}
        return stage(e.withColumnsRenamed(names), "edges")

    @cached_property
    def lines(self) -> DataFrame:
        """Edges with their three-vertex geometry."""
        return stage(N.lines_from_vertices(self.edges, self.fx["fx_vertices"]), "lines")

    @cached_property
    def split(self) -> DataFrame:
        return stage(N.foundation(self.edges, self.lines, self.nodes), "split")

    @cached_property
    def straight(self) -> DataFrame:
        """Network of straight streets, the input of facility and crossing queries."""
        return stage(N.foundation(self.edges, N.straight_lines(self.edges, self.nodes), self.nodes), "straight")

    @cached_property
    def crossings(self) -> DataFrame:
        return stage(tags.crossing_attributes(crs.add_utm(self.fx["fx_crossings"])), "crossings")

    @cached_property
    def calming(self) -> DataFrame:
        return stage(crs.add_utm(self.fx["fx_calming"]), "calming")

    @cached_property
    def facility_lines(self) -> DataFrame:
        f = self.fx["fx_facilities"]
        c = F.col
        return stage(f.select("fac_id", "highway", "name", G.line_of(c("lon0"), c("lat0"), c("lon1"), c("lat1")).alias("geom"))
                     .withColumn("utm", crs.utm_line(c("geom"))), "facility_lines")

    @cached_property
    def elev(self) -> DataFrame:
        return stage(self.fx["fx_elev"], "elev")

    @cached_property
    def facs(self) -> DataFrame:
        return stage(FA.facility_lines(self.facility_lines), "facs")

    @cached_property
    def roads(self) -> DataFrame:
        return self.straight.where(tags.is_road(F.col("highway")))

    @cached_property
    def tag_rows(self) -> DataFrame:
        """Facility slots of the straight network with sides after the left/right swap."""
        s = self.straight.withColumn("_rev", tags.reversed_flag(F.col("normalized_bearing"), F.col("bearing")))
        return tags.facility_rows(s, ["seg_id", "_rev"]).withColumn("side", tags.flip_side(F.col("side"), F.col("_rev"))).drop("_rev")

    @cached_property
    def placed(self) -> DataFrame:
        return stage(FA.match_separate(self.facs, self.roads)[0], "placed")

    @cached_property
    def offset_rows(self) -> DataFrame:
        rows = FA.place(FA.empty_slots(self.tag_rows), self.placed, self.facs)
        return stage(FA.add_offsets(rows, self.straight), "offset_rows")

    @cached_property
    def late(self) -> DataFrame:
        return stage(FA.match_leftovers(self.facs, self.roads, self.placed, FA.taken_slots(self.offset_rows)), "late")

    @cached_property
    def facilities(self) -> DataFrame:
        rows = FA.place(self.offset_rows, self.late, self.facs, fill=True)
        return stage(FA.add_ids(rows, self.straight), "facilities")

    @cached_property
    def sidewalks(self) -> DataFrame:
        return stage(IX.sidewalk_lines(self.facilities, self.straight), "sidewalks")

    @cached_property
    def arms(self) -> DataFrame:
        return stage(IX.endpoint_registry(self.sidewalks), "arms")

    @cached_property
    def ramp_points(self) -> DataFrame:
        return stage(IX.ramp_points(self.arms, self.straight), "ramp-points")

    @cached_property
    def ramps(self) -> DataFrame:
        return stage(IX.curb_ramps(self.ramp_points), "ramps")

    @cached_property
    def zones(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return IX.junction_zones(self.ramp_points)

    @property
    def node_hulls(self) -> DataFrame:
        return self.zones[0]

    @property
    def merged(self) -> tuple[DataFrame, DataFrame]:
        return self.zones[1:]

    @cached_property
    def hull_arms(self) -> DataFrame:
        return stage(XW.hull_arms(IX.node_arms(self.straight), self.merged[1]), "hull-arms")

    @cached_property
    def slots(self) -> DataFrame:
        return stage(IX.crosswalk_slots(self.merged[0]), "slots")

    @cached_property
    def crossed(self) -> DataFrame:
        return stage(XW.crossed_street(self.slots, self.hull_arms, self.straight, *self.merged), "crossed")

    @cached_property
    def live_slots(self) -> DataFrame:
        return self.slots.join(self.crossed.select(*XW.SLOT), XW.SLOT, "left_semi")

    @cached_property
    def slot_points(self) -> DataFrame:
        return stage(XW.crossing_points(self.live_slots, self.crossings), "slot-points")

    @cached_property
    def slot_ramps(self) -> DataFrame:
        return stage(XW.ramps_in_slots(self.live_slots, self.hull_arms, self.ramps), "slot-ramps")

    @cached_property
    def slot_hits(self) -> DataFrame:
        return stage(XW.sidewalk_hits(self.slot_points, self.crossed, self.straight, self.hull_arms, self.sidewalks, self.merged[0]), "slot-hits")

    @cached_property
    def footpaths(self) -> DataFrame:
        """Short mapped footways across each seventh street near its start, for chain crosswalks."""
        a, b = G.first_pt(F.col("utm")), G.last_pt(F.col("utm"))
        l = G.dist(a["x"], a["y"], b["x"], b["y"])
        ux, uy = (b["x"] - a["x"]) / l, (b["y"] - a["y"]) / l
        def at(t: float, v: float):
            return a["x"] + ux * t - uy * v, a["y"] + uy * t + ux * v
        s = self.straight.where("edge_id % 7 = 3")
        two = F.array(G.line_of(*at(5.0, -1.5), *at(5.0, 0.0)), G.line_of(*at(5.0, 0.0), *at(5.0, 1.5)))
        f = s.select("edge_id", F.posexplode(two).alias("k", "utm")).select((F.col("edge_id") * 2 + F.col("k")).alias("fac_id"), "utm")
        return stage(f, "footpaths")

    @cached_property
    def detected(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return XW.detect(self.slots, self.hull_arms, self.straight, self.sidewalks, self.ramps, self.crossings, self.footpaths, *self.merged)

    @cached_property
    def crosswalks(self) -> DataFrame:
        return stage(XW.write(self.detected[0], self.straight, self.facilities), "crosswalks")

    @cached_property
    def gov(self) -> DataFrame:
        return stage(crs.add_utm(self.fx["fx_gov_ramps"], "longitude", "latitude"), "gov")

    @cached_property
    def changes(self) -> DataFrame:
        return stage(crs.add_utm(self.fx["fx_changes"].withColumnsRenamed({"x": "lon", "y": "lat"})), "changes")


def query(name: str, sql: str | None = None):
    """Register ``fn(city) -> DataFrame`` as a query, with optional checking SQL."""
    def wrap(fn: Callable[[City], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(City.of(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round result columns for comparison; adding zero folds negative zero."""
    return df.withColumns({c: F.round(F.col(c), d) + F.lit(0.0) for c, d in digits.items()})
