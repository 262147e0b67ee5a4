"""Invariants of operators and plans that no single SQL text states."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from kerbline.functions import geom as G, tags
from kerbline.operators import edits as ED, facilities as FA, intersections as IX, snap, spatial as SP
from kerbline.operators.ranking import lookup, numbered
from kerbline.plans import changes, city as plan
from queries.tables import network_of


def rows(df):
    return sorted(map(str, df.collect()))


def test_numbering_with_hot_groups_equals_plain_numbering(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 100003).alias("o"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("g"))
    assert rows(numbered(df, ["g"], "o", "n", hot_rows=10)) == rows(numbered(df, ["g"], "o", "n"))


def test_lookup_with_hot_keys_equals_plain_join(spark):
    big = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    small = big.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    assert rows(lookup(big, small, "k", "n", F.col("id"), hot_rows=150)) == rows(big.join(small.drop("n"), "k", "left").select("id", "k", "s"))


def test_undo_in_small_blocks_equals_a_stack(spark):
    rnd = random.Random(5)
    log = [(i, rnd.choice([1, 1, 1, 2]), rnd.choice(["attr_edit", "move_point", "undo"])) for i in range(600)]
    live = {}
    for i, user, kind in log:
        stack = live.setdefault(user, [])
        if kind != "undo":
            stack.append(i)
        elif stack:
            stack.pop()
    df = spark.createDataFrame(log, "edit_id long, user_id long, edit_type string")
    got = sorted(r["edit_id"] for r in ED.effective_edits(df, block=7).collect())
    assert got == sorted(i for s in live.values() for i in s)


def test_components_of_a_long_chain(spark):
    ids = spark.range(1, 402).select("id")
    pairs = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    comp = {r["id"]: r["component"] for r in IX.connected_components(ids, pairs).collect()}
    assert all(comp[i] == 1 for i in range(1, 301)) and all(comp[i] == i for i in range(301, 402))


def test_nearest_point_gives_every_copy_its_answer(spark):
    q = spark.createDataFrame([(i, 0.0, 0.0) for i in range(50)] + [(99, 3.0, 0.0)], "q_id long, qx double, qy double")
    t = spark.createDataFrame([(5, 1.0, 0.0), (4, 1.0, 0.0), (9, 2.5, 0.0)], "t_id long, tx double, ty double")
    got = {r["q_id"]: r["t_id"] for r in SP.nearest_point(q, t, 2.0).collect()}
    assert len(got) == 51 and all(got[i] == 4 for i in range(50)) and got[99] == 9


def test_grid_join_equals_brute_force(spark):
    rnd = random.Random(1)
    def line():
        x, y = rnd.uniform(0, 300), rnd.uniform(0, 300)
        return [{"x": x, "y": y}, {"x": x + rnd.uniform(-90, 90), "y": y + rnd.uniform(-90, 90)}, {"x": x + 5.0, "y": y + 40.0}]
    t = "array<struct<x:double,y:double>>"
    a = spark.createDataFrame([(i, line()) for i in range(40)], f"a_id long, utm {t}")
    b = spark.createDataFrame([(i, line()) for i in range(60)], f"b_id long, utm {t}")
    got = {(r["a_id"], r["b_id"]): round(r["d"], 6) for r in SP.lines_near_lines(a, b, 12.0).collect()}
    pa, pb = G.pieces(a, "utm", ["a_id"]), G.pieces(b, "utm", ["b_id"])
    for c in ("ax", "ay", "bx", "by"):
        pb = pb.withColumnRenamed(c, "r" + c)
    cols = [F.col(c) for c in ("ax", "ay", "bx", "by")]
    j = SP._segment_distance(pa.drop("k", "m0", "m1").join(pb.drop("k", "m0", "m1"), F.lit(True)), cols, [F.col("r" + c) for c in ("ax", "ay", "bx", "by")])
    want = {(r["a_id"], r["b_id"]): round(r["d"], 6) for r in j.groupBy("a_id", "b_id").agg(F.min("d").alias("d")).where("d <= 12").collect()}
    assert got == want and want


def test_swap_twice_is_identity(spark):
    df = spark.createDataFrame([(1, "a", "b", "p", "q")], "id int, sidewalk_left_width string, sidewalk_right_width string, public_left string, public_right string")
    once = tags.swap_pairs(df, F.lit(True))
    assert once.first()["sidewalk_left_width"] == "b" and once.first()["public_left"] == "q"
    assert rows(tags.swap_pairs(once, F.lit(True))) == rows(df)


def test_slots_never_exceed_capacity(city):
    assert city.placed.groupBy("seg_id", "side", "kind").count().where("count > CASE kind WHEN 'bikeway' THEN 2 ELSE 1 END").isEmpty()
    assert city.ramps.groupBy("seg_id", "side", "pos").count().where("count > 3").isEmpty()


def test_snapping_only_extends_or_trims(city):
    s = snap.snap_endpoints(city.sidewalks, city.straight)
    assert s.count() == city.sidewalks.count()
    assert s.where(G.length(F.col("utm")) < 1.0).isEmpty()


def test_foundation_does_not_depend_on_partitioning(city):
    from kerbline.operators import network as N
    lines = N.straight_lines(city.edges.repartition(7), city.nodes.repartition(5))
    a = N.foundation(city.edges.repartition(3), lines, city.nodes).select("seg_id", "grid_id", "start_is_intersection", F.round("normalized_bearing", 6))
    b = city.straight.select("seg_id", "grid_id", "start_is_intersection", F.round("normalized_bearing", 6))
    assert rows(a) == rows(b)


def test_recompute_equals_full_build_and_is_stable(city):
    net = network_of(city)
    w = plan.wide(net)
    assert len(w.columns) == 273 and w.count() == net.segments.count()
    nodes = net.members.select("node_id").orderBy("node_id").limit(12)
    again = plan.recompute(net, nodes)
    keys = ("seg_id", "pos", "source", "crosswalk_id")
    assert rows(again.hulls.select("hull_id", F.round(G.length(F.col("ring")), 3))) == rows(net.hulls.select("hull_id", F.round(G.length(F.col("ring")), 3)))
    twice = plan.recompute(again, nodes)
    assert rows(twice.crosswalks.select(*keys)) == rows(again.crosswalks.select(*keys))
    assert rows(twice.ramps.select("seg_id", "side", "pos", "n")) == rows(again.ramps.select("seg_id", "side", "pos", "n"))


def test_wide_view_holds_what_the_long_tables_hold(city):
    net = network_of(city)
    w = plan.wide(net)
    filled = w.agg(*[F.count(F.when(F.col(f"`{n}`").isNotNull(), 1)).alias(n) for n in w.columns]).first().asDict()
    at = net.segments.select("seg_id")
    assert filled["street_feature_types"] == net.calming.join(at, "seg_id", "left_semi").select("seg_id").distinct().count() > 0
    sides = net.facilities.where("facility = 'sidewalk' AND side = 'left' AND facility_grid_id IS NOT NULL")
    assert filled["sidewalk_left_from_segments"] == filled["sidewalk_left_to_segments"] == sides.count() > 0
    assert filled["crosswalk_start_from_segments"] == net.crosswalks.where("pos = 'start' AND crosswalk_id IS NOT NULL").count() > 0


def test_recompute_of_moved_nodes_replaces_sidewalks(city):
    net = network_of(city)
    node = net.members.select("node_id").orderBy("node_id").limit(1)
    moved = net.segments.join(node.withColumnRenamed("node_id", "start_node"), "start_node", "left_semi").select("seg_id")
    shift = F.transform("utm", lambda p: F.struct((p["x"] + 3.0).alias("x"), p["y"].alias("y")))
    fac = net.facilities.join(moved.withColumn("_m", F.lit(True)), "seg_id", "left").withColumn(
        "utm", F.when(F.col("_m"), shift).otherwise(F.col("utm"))).drop("_m")
    done = plan.recompute(replace(net, facilities=fac), node, from_snap=True)
    old, new = (n.sidewalks.join(moved, "seg_id", "left_semi").select("seg_id", "side", F.round(F.col("utm")[0]["x"], 3)) for n in (net, done))
    assert rows(old) != rows(new) and done.facility_ends.count() > 0


def test_attribute_edits_alone_recompute_nothing(city):
    net = network_of(city)
    first = net.segments.groupBy(F.col("start_node").alias("node_id")).agg(F.min("seg_id").alias("seg_id"))
    edits = city.changes.join(first, "node_id", "left").where("edit_type = 'attr_edit'")
    done = changes.apply_changeset(net, edits)
    assert done.ramps is net.ramps and done.segments.count() == net.segments.count()
    assert rows(changes.apply_changeset(done, edits).segments.select("seg_id", "name", "lanes")) == rows(done.segments.select("seg_id", "name", "lanes"))


def test_a_changeset_of_many_kinds(city):
    net = network_of(city)
    ends = net.segments.where("start_node <> end_node").select(F.explode(F.array("start_node", "end_node")).alias("node_id"))
    merge = ends.groupBy("node_id").count().where("count = 2").orderBy("node_id").first()["node_id"]
    far = {r["node_id"] for r in net.segments.where(f"{merge} IN (start_node, end_node)").select(F.explode(F.array("start_node", "end_node")).alias("node_id")).collect()}
    ramp = net.ramps.join(net.segments.where(~F.col("start_node").isin(*far) & ~F.col("end_node").isin(*far)), "seg_id", "left_semi").orderBy("seg_id", "side", "pos", "n").first()
    hulls = [r["node_id"] for r in net.members.where(~F.col("node_id").isin(*far)).orderBy("node_id").limit(2).collect()]
    gone = net.members.where(~F.col("node_id").isin(*far, *hulls)).orderBy(F.col("node_id").desc()).first()["node_id"]
    line = [{"x": 1.0, "y": 2.0}, {"x": 3.0, "y": 4.0}]
    rows_ = [(1, "merge_segments", merge, None), (2, "toggle_curb_ramp", None, ramp["seg_id"]), (3, "consolidate_hulls", hulls[0], None),
             (3, "consolidate_hulls", hulls[1], None), (4, "delete_polygon", gone, None), (5, "draw_segment", None, None)]
    t = "array<struct<x:double,y:double>>"
    edits = city.spark.createDataFrame(
        [(i, 1, k, n, s, None, None, None, None, None, None, ramp["side"], ramp["pos"], ramp["n"], False, line, line) for i, k, n, s in rows_],
        "edit_id long, user_id long, edit_type string, node_id long, seg_id long, col string, new_value string, lon double, lat double, x double, y double, "
        f"side string, pos string, n int, enabled boolean, geom {t}, utm {t}")
    done = changes.apply_changeset(net, edits)
    assert done.segments.count() == net.segments.count()  # one merged away, one drawn
    assert done.segments.where("grid_id LIKE 'drawn%'").count() == 1
    assert done.segments.where(f"{merge} IN (start_node, end_node)").isEmpty()
    key = {k: ramp[k] for k in ("seg_id", "side", "pos", "n")}
    assert done.ramps.where(" AND ".join(f"{k} = '{v}'" for k, v in key.items())).isEmpty()
    one = {r["hull_id"] for r in done.members.where(F.col("node_id").isin(*hulls)).collect()}
    assert len(one) == 1 and done.members.where(F.col("node_id") == gone).isEmpty()


def test_geojson_of_the_network_has_every_kind_of_feature(city):
    from queries.viewing import features_geojson
    kind = F.get_json_object("value", "$.properties._t")
    got = {r["t"]: r["n"] for r in features_geojson(city).groupBy(kind.alias("t")).agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"street", "bikeway", "sidewalk", "crosswalk", "calm", "node", "ramp"}
    assert got["street"] == city.straight.count() and got["ramp"] == city.ramps.count() and got["crosswalk"] == city.crosswalks.count()
