"""Plans that stay small, lines that stay off the driver, and work that is not asked for."""

from pyspark.sql import functions as F

from kerbline import staging
from kerbline.functions import geom as G
from kerbline.operators import crosswalks as XW, edits as ED, intersections as IX, ramps as RP, spatial as SP


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def roads(spark, n: int):
    y = F.col("id") * 100.0
    return spark.range(n).select(F.col("id").alias("l_id"), G.line_of(F.lit(0.0), y, F.lit(50.0), y).alias("utm"))


def points(spark, n: int):
    return spark.range(n).select(F.col("id").alias("p_id"), F.lit(25.0).alias("px"), (F.col("id") * 100.0 + 3).alias("py"))


def test_hull_plan_holds_each_ring_a_few_times(spark):
    pts = spark.range(50).select(F.col("id").alias("node_id"), F.col("id").cast("double").alias("sx"), F.lit(0.0).alias("sy"),
                                 F.col("id").cast("double").alias("nx"), F.lit(0.0).alias("ny"), F.lit(2).alias("n_ramps"))
    assert len(plan(IX.build_hulls(pts))) < 100_000


def test_lines_on_cells_are_not_broadcast(spark):
    near = SP.nearest_line(points(spark, 20), roads(spark, 20), 10.0)
    pairs = SP.lines_near_lines(roads(spark, 20).withColumnRenamed("l_id", "a_id"), roads(spark, 20).withColumnRenamed("l_id", "b_id"), 5.0)
    assert "cx" in plan(near) and "Broadcast" not in plan(pairs)
    assert not [x for x in plan(near).splitlines() if "BroadcastHashJoin" in x and "cx" in x]


def test_nearest_line_takes_the_least_id_among_equals_and_no_line_out_of_reach(spark):
    two = roads(spark, 3).unionByName(roads(spark, 3).withColumn("l_id", F.col("l_id") - 10))
    got = {r["p_id"]: (r["l_id"], round(r["d"], 9)) for r in SP.nearest_line(points(spark, 4), two, 10.0).collect()}
    assert got == {0: (-10, 3.0), 1: (-9, 3.0), 2: (-8, 3.0)}
    assert SP.nearest_line(points(spark, 4), two, 2.9).isEmpty()


def test_roads_far_off_are_found_in_the_wide_pass(spark):
    inv = points(spark, 3).select(F.col("p_id").alias("locid"), (F.col("px") + F.when(F.col("p_id") == 1, 300.0).otherwise(0.0)).alias("x"), F.col("py").alias("y"))
    lines = roads(spark, 3).withColumnRenamed("l_id", "seg_id")
    got = {r["locid"]: round(r["d"], 6) for r in RP.nearest_roads(inv, lines).collect()}
    assert got == {0: 3.0, 1: round((275 ** 2 + 3 ** 2) ** 0.5, 6), 2: 3.0}


def test_streets_as_geojson_build_no_crosswalks(spark):
    from queries import viewing
    from queries.registry import City
    c = City(spark, "/root/testdata/sf0.001")
    assert viewing.features_geojson(c).count() > 0
    assert not {"crosswalks", "detected", "ramps", "zones", "calming"} & set(c.__dict__)


def merged(spark, monkeypatch, *asked):
    """(seg_id: its nodes, rounds) after the named merges on a chain of three streets."""
    rounds, stage = [], staging.stage
    def counted(df, name, *args):
        rounds.extend([name] if name == "merged-segments" else [])
        return stage(df, name, *args)
    monkeypatch.setattr(staging, "stage", counted)
    monkeypatch.setattr(ED, "stage", counted)
    x = F.col("id") * 10.0
    line = G.line_of(x, F.lit(0.0), x + 10, F.lit(0.0))
    chain = spark.range(1, 4).select(F.col("id").alias("seg_id"), (F.col("id") + 9).alias("start_node"), (F.col("id") + 10).alias("end_node"),
                                     F.lit(True).alias("start_is_intersection"), F.lit(True).alias("end_is_intersection"), line.alias("utm"), line.alias("geom"))
    rows = [(i, *a) for i, a in enumerate(asked)]
    out = ED.merge_named(chain, spark.createDataFrame(rows, "edit_id long, seg_id long, consumed_id long, node_id long")).collect()
    return {r["seg_id"]: (r["start_node"], r["end_node"], len(r["utm"])) for r in out}, len(rounds)


def test_merges_asked_for_again_add_no_rounds(spark, monkeypatch):
    one, two = (1, 2, 11), (1, 3, 12)
    assert merged(spark, monkeypatch, one, one, one, two, one, two) == ({1: (10, 13, 4)}, 2)


def test_a_merge_that_fits_only_later_is_done_when_asked_for_again(spark, monkeypatch):
    one, two = (1, 2, 11), (1, 3, 12)
    assert merged(spark, monkeypatch, two, two, one, two)[0] == {1: (10, 13, 4)}


def test_farthest_pair_plan_holds_each_hull_a_few_times(spark):
    x = F.col("id").cast("double")
    pts = spark.range(40).select((F.col("id") % 5).alias("hull_id"), F.lit(0).alias("face"), x.alias("x"), (x * x).alias("y"))
    far = XW.farthest_pairs(pts, "x", "y")
    assert len(plan(far)) < 20_000
    assert {r["hull_id"]: [p["x"] for p in r["pair"]] for r in far.collect()} == {i: [float(i), float(35 + i)] for i in range(5)}
    assert XW.farthest_pairs(pts.where("id < 5"), "x", "y").isEmpty()  # one point has no partner


def test_crossing_plan_holds_each_point_a_few_times(spark):
    x, zero = F.col("id").cast("double"), F.lit(0.0)
    arms = spark.range(20).select(
        (F.col("id") % 5).alias("node_id"), zero.alias("nx"), zero.alias("ny"), F.col("id").alias("seg_id"), F.lit("left").alias("side"), F.lit("start").alias("pos"),
        F.lit("g").alias("grid_id"), F.col("id").cast("string").alias("arm"), G.line_of(-x, zero - 5.0, x + 1.0, zero + 5.0).alias("utm"))
    pairs = IX.pair_crossings(arms)
    assert len(plan(pairs)) < 14_000 and pairs.count() == 30
