"""Sizes above former limits, ids of any width and sign, and lines as they come."""

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geom as G
from kerbline.operators import edits as ED, facilities as FA, intersections as IX, network as N, ramps as RP
from kerbline.streaming import edits as ES
from queries import sqltext

LINE = "array<struct<x:double,y:double>>"


def line(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def test_one_list_for_a_node_of_many_facilities(spark):
    ends = spark.range(1500).select(F.concat(F.lit("f"), "id").alias("fid"), F.lit("from").alias("end"), F.lit(7).cast("long").alias("node_id"))
    got = FA.neighbours(ends)
    assert got.count() == 1500 and got.where(F.size("ids") != 1499).isEmpty()


@pytest.mark.parametrize("n", [40, 65, 300])
def test_flat_points_make_a_thin_hull_at_any_count(spark, n):
    pts = spark.range(n).select(F.lit(1).cast("long").alias("node_id"), (F.col("id") * 0.01).alias("sx"), (F.col("id") * 0.02).alias("sy"),
                                F.lit(1.0).alias("nx"), F.lit(1.0).alias("ny"), F.lit(2).alias("n_ramps"))
    ring = IX.build_hulls(pts).first()["ring"]
    xs = [p["x"] for p in ring]
    assert len(ring) == 4 and min(xs) < 0 and max(xs) > (n - 1) * 0.01


def test_sql_of_flat_points_states_a_thin_hull(spark):
    import duckdb

    import queries
    queries.all_queries()
    con = duckdb.connect()
    con.execute("CREATE TABLE o_hpts AS SELECT CAST(n AS BIGINT) AS node_id, CAST(i AS DOUBLE) * (2 - n) AS x, CAST(i * 2 AS DOUBLE) AS y "
                "FROM range(1, 3) a(n) CROSS JOIN range(4) b(i)")
    for name in ("o_hcount", "o_hside", "o_hedge", "o_thin0"):
        con.execute(f"CREATE VIEW {name} AS {sqltext._quoted(sqltext.PARTS[name])}")
    assert con.execute('SELECT * FROM o_thin0 ORDER BY 1').fetchall() == [(1, 0, 0, 3, 6), (2, 0, 0, 0, 6)]


def test_components_of_a_long_path_in_random_order(spark):
    ids = [(i * 7919) % 1009 for i in range(80)]
    pairs = spark.createDataFrame(list(zip(ids, ids[1:], strict=False)), "a long, b long")
    got = IX.connected_components(spark.createDataFrame([(i,) for i in ids], "id long"), pairs)
    assert got.select("component").distinct().count() == 1 and got.count() == 80


def test_repeated_vertices_do_not_stop_a_build(spark):
    df = spark.createDataFrame([(line((0, 0), (0, 0), (10, 0), (10, 0), (10, 5)),), (line((3, 3), (3, 3)),)], f"utm {LINE}")
    got = [r["o"] for r in df.select(G.offset(F.col("utm"), F.lit(2.0)).alias("o")).collect()]
    assert [(round(p["x"], 6), round(p["y"], 6)) for p in got[0]] == [(0, 2), (8, 2), (8, 5)]
    assert [(p["x"], p["y"]) for p in got[1]] == [(3, 3)]
    spans = spark.createDataFrame([(0.0, 0.0, 10.0, 0.0, 5.0, 1.0, 5.0, 1.0), (5.0, 0.0, 5.0, 0.0, 0.0, 0.0, 9.0, 0.0)],
                                  "ax double, ay double, bx double, by double, cx double, cy double, ex double, ey double")
    assert FA.add_capsule_span(spans, 2.0).count() == 2 and len(FA.add_capsule_span(spans, 2.0).collect()) == 2


def test_keys_sort_like_numbers(spark):
    ids = [-(1 << 63), -5, -1, 0, 3, 10 ** 17, 10 ** 18, (1 << 63) - 1]
    df = spark.createDataFrame([(i,) for i in ids], "i long").select("i", IX._key((F.col("i"), 18)).alias("k"))
    assert [r["i"] for r in df.orderBy("k").collect()] == ids and df.select("k").distinct().count() == len(ids)


def test_inventory_matches_ramps_of_drawn_segments(spark):
    ramps = spark.createDataFrame([(-9, "left", "start", 1, 0.0, 0.0)], "seg_id long, side string, pos string, n int, x double, y double")
    points = spark.createDataFrame([(5, 1.0, 0.0)], "locid long, x double, y double")
    assert RP.match_existing(points, ramps).first()["seg_id"] == -9


def test_an_edge_of_too_many_pieces_is_refused(spark):
    zigzag = line(*[(i, i % 2 * 5) for i in range(N.PIECES_PER_EDGE + 2)])
    df = spark.createDataFrame([(1, 1, 2, zigzag, zigzag)], f"edge_id long, u long, v long, geom {LINE}, utm {LINE}")
    with pytest.raises(Exception, match="pieces"):
        N.split_deflections(df).collect()


def test_a_street_takes_all_its_cuts(spark):
    seg = spark.createDataFrame([(1, 10, 11, line((0, 0), (60, 0), (100, 0)))], f"seg_id long, start_node long, end_node long, utm {LINE}")
    pts = spark.createDataFrame([(3, 70.0, 1.0), (1, 20.0, -1.0), (2, 20.0, 2.0)], "edit_id long, x double, y double")
    got = sorted(ED.split_segments(seg, pts).collect(), key=lambda r: r["part"])
    node = ED.SPLIT_NODES
    assert [(r["start_node"], r["end_node"], r["utm"][0]["x"], r["utm"][-1]["x"]) for r in got] == [
        (10, node - 1, 0, 20), (node - 1, node - 3, 20, 70), (node - 3, 11, 70, 100)]


def test_a_stream_of_many_files_loses_no_late_edit(spark, tmp_path):
    rows = spark.range(200).selectExpr("id AS edit_id", "timestamp_seconds(1700000000 - id * 86400) AS ts", "id % 7 AS user_id", "'attr_edit' AS edit_type",
                                       "id AS node_id", "id AS seg_id", "'name' AS col", "'x' AS new_value")
    rows.repartitionByRange(200, "edit_id").write.parquet(str(tmp_path / "log"))
    rows.where("edit_id < 5").coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    ES.run(ES.edit_stream(spark, str(tmp_path / "log"), 16), str(tmp_path / "state"), ES.store_batches(str(tmp_path / "out"))).awaitTermination()
    got = ES.stored(spark, str(tmp_path / "out"))
    assert got.count() == 200 and got.select("edit_id").distinct().count() == 200


def test_a_part_is_defined_once():
    sqltext.part("o_test_part", "SELECT 1")
    with pytest.raises(ValueError):
        sqltext.part("o_test_part", "SELECT 2")
    del sqltext.PARTS["o_test_part"]


def test_merges_of_a_chain_leave_one_line(spark):
    rows = [(i, 100 + i, 101 + i, False, False, line((i * 10, 0), (i * 10 + 10, 0)), line((i, 0), (i + 1, 0))) for i in (3, 1, 4, 2, 0)]
    rows[1] = (1, 102, 101, False, True, rows[1][5][::-1], rows[1][6][::-1])  # drawn the other way
    seg = spark.createDataFrame(rows, f"seg_id long, start_node long, end_node long, start_is_intersection boolean, end_is_intersection boolean, utm {LINE}, geom {LINE}")
    got = ED.merge_all(seg, spark.createDataFrame([(n,) for n in (101, 102, 103, 104, 999)], "node_id long")).collect()
    assert len(got) == 1 and got[0]["seg_id"] == 0 and {got[0]["start_node"], got[0]["end_node"]} == {100, 105}
    assert sorted(p["x"] for p in got[0]["utm"]) == [0, 10, 20, 30, 40, 50]


def test_angular_pairs_of_a_crowded_node_are_those_of_one_window(spark):
    """100 000 ends round one node, many in one direction, beside small nodes."""
    from kerbline.operators import snap
    n = 100_000
    arms = spark.range(n + 7).selectExpr(
        f"CASE WHEN id < {n} THEN 1 ELSE id - {n} + 2 END AS node_id", "0.0D AS nx", "0.0D AS ny", "id AS seg_id",
        "CASE WHEN id % 2 = 0 THEN 'left' ELSE 'right' END AS side", "'start' AS pos", "'s' AS name",
        "round(sin(id % 5000 * 0.00125), 9) AS px", "round(cos(id % 5000 * 0.00125), 9) AS py", "1.0D AS dx", "0.0D AS dy", "lpad(string(id), 20, '0') AS arm")
    cols = ["node_id", "seg_id", "b.seg_id AS next", "pair"]
    cut = snap.angular_pairs(arms).selectExpr(*cols)
    whole = snap.angular_pairs(arms, crowded=n * 2).selectExpr(*cols)
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()
    assert cut.where("node_id = 1").count() == n and cut.where("node_id > 1").isEmpty()  # a lone end has no neighbour


def test_max_gap_measures_faces_of_few_pairs_and_agrees_with_all(spark):
    import itertools
    import math
    import random

    from kerbline.operators import edits as ED
    rnd = random.Random(4)
    rings = {}
    for i in range(40):
        x, y, w, h = rnd.uniform(0, 900), rnd.uniform(0, 900), rnd.uniform(2, 60), rnd.uniform(2, 60)
        rings[i] = [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]
    hulls = spark.createDataFrame([(i, [{"x": x, "y": y} for x, y in ring]) for i, ring in rings.items()], "node_id long, ring array<struct<x:double,y:double>>")
    picks = spark.createDataFrame([(1, i) for i in range(40)] + [(2, i) for i in range(3)] + [(2, 1), (3, 5)], "edit_id long, node_id long")

    def gap(a: list, b: list) -> float:
        dx = max(a[0][0] - b[1][0], b[0][0] - a[1][0], 0.0)
        dy = max(a[0][1] - b[2][1], b[0][1] - a[2][1], 0.0)
        return math.hypot(dx, dy)

    got = {r["edit_id"]: r["max_gap"] for r in ED.merge_gap(picks, hulls).collect()}
    want = {e: max(gap(rings[a], rings[b]) for a, b in itertools.combinations(range(n), 2)) for e, n in ((1, 40), (2, 3))}
    assert set(got) == {1, 2}  # one hull alone has no gap
    assert all(abs(got[e] - want[e]) < 1e-6 for e in want)


def test_sidewalks_that_go_straight_on_meet_where_they_touch(spark):
    from kerbline.operators import intersections as IX
    line = "array<struct<x:double,y:double>>"
    def met(*lines):
        rows = [(1, 100.0, 0.0, i, "left", pos, "g", str(i), [{"x": float(x), "y": float(y)} for x, y in utm]) for i, (pos, utm) in enumerate(lines)]
        arms = spark.createDataFrame(rows, f"node_id long, nx double, ny double, seg_id long, side string, pos string, grid_id string, arm string, utm {line}")
        return [(round(r["x"], 3), round(r["y"], 3)) for r in IX.pair_crossings(arms).collect()]
    for gap in (-1e-6, 0.0, 1e-6):  # overlapping, touching and apart by rounding alone, both ways round
        assert met(("end", ((0, 5), (100, 5))), ("start", ((100 + gap, 5 + 1e-7), (200, 5)))) == [(100, 5)]
        assert met(("start", ((100 + gap, 5), (0, 5))), ("start", ((100, 5), (200, 5 + 1e-5)))) == [(100, 5)]
    assert met(("end", ((0, 5), (100, 5))), ("start", ((100, 5), (0, 5)))) == []  # along each other
    assert met(("end", ((0, 5), (100, 5))), ("start", ((100.1, 5), (200, 5)))) == []
    assert met(("end", ((0, 0), (110, 10))), ("start", ((90, 10), (200, 0)))) == [(100, 9.091)]
