"""Changesets: named merges, overrides that last, cuts with all that is booked on a street, documents, ids."""

import json

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geom as G
from kerbline.operators import edits as ED, intersections as IX, network as N, snap
from kerbline.plans import changes, city as plan, cuts
from kerbline.sources import changeset
from queries.editing import straight_network

LINE = "array<struct<x:double,y:double>>"
SEGMENT = f"seg_id long, start_node long, end_node long, start_is_intersection boolean, end_is_intersection boolean, utm {LINE}, geom {LINE}"


def line(*pts):
    return [{"x": float(x), "y": float(y)} for x, y in pts]


def rows(df):
    return sorted(map(str, df.collect()))


def edits_of(spark, *given):
    names = list(ED.EDIT_COLUMNS)
    schema = ", ".join(f"{c} {t}" for c, t in ED.EDIT_COLUMNS.items())
    return spark.createDataFrame([tuple({"edit_id": i, "user_id": 1, **e}.get(n) for n in names) for i, e in enumerate(given, 1)], schema)


def test_named_merges_work_like_one_after_the_other(spark):
    star = [(1, 10, 11), (2, 11, 12), (3, 11, 13), (4, 12, 14), (5, 14, 14)]
    at = {10: (0, 0), 11: (10, 0), 12: (20, 0), 13: (10, 10), 14: (30, 0)}
    seg = spark.createDataFrame([(i, a, b, False, False, line(at[a], at[b]), line(at[a], at[b])) for i, a, b in star], SEGMENT)
    asked = [(1, 1, 3, 11),   # not the two least streets at the node
             (2, 1, 2, 11),   # no longer meets: the survivor ends at 13 now
             (3, 2, 4, 12), (4, 2, 5, 14),   # a loop does not lead on
             (5, 9, 1, 10), (6, 1, 1, 10)]
    got = {r["seg_id"]: r for r in ED.merge_named(seg, spark.createDataFrame(asked, "edit_id long, seg_id long, consumed_id long, node_id long")).collect()}
    assert sorted(got) == [1, 2, 5]
    assert (got[1]["start_node"], got[1]["end_node"]) == (10, 13) and [(p["x"], p["y"]) for p in got[1]["utm"]] == [(0, 0), (10, 0), (10, 10)]
    assert (got[2]["start_node"], got[2]["end_node"]) == (11, 14) and [p["x"] for p in got[2]["utm"]] == [10, 20, 30]


def test_a_chain_of_named_merges_in_edit_order(spark):
    n = 9
    seg = spark.createDataFrame([(i, i, i + 1, False, False, line((i, 0), (i + 1, 0)), line((i, 0), (i + 1, 0))) for i in range(n)], SEGMENT)
    asked = spark.createDataFrame([(i, 0, i, i) for i in range(1, n)], "edit_id long, seg_id long, consumed_id long, node_id long")
    got = ED.merge_named(seg, asked).collect()
    assert len(got) == 1 and (got[0]["start_node"], got[0]["end_node"]) == (0, n) and len(got[0]["utm"]) == n + 1


def test_only_listed_lines_follow_a_moved_node(spark):
    seg = spark.createDataFrame([(1, 10, 11, False, False, line((0, 0), (5, 0)), line((0, 0), (5, 0))), (2, 11, 12, False, False, line((5, 0), (9, 0)), line((5, 0), (9, 0)))], SEGMENT)
    moves = edits_of(spark, {"edit_type": "move_point", "node_id": 11, "lon": 6.0, "lat": 1.0, "x": 6.0, "y": 1.0, "band": [2]})
    got = {r["seg_id"]: r["utm"] for r in ED.move_nodes(seg, moves).collect()}
    assert got[1][-1]["x"] == 5 and got[2][0]["x"] == 6


def test_ids_of_edits_meet_no_others(spark):
    # the joints of this bent edge are -(edge * 4096 + piece); a drawn street numbered half of that used them before
    bent = spark.createDataFrame([(1, 5, 6, line((0, 0), (9, 0), (9, 9), (18, 9)), line((0, 0), (9, 0), (9, 9), (18, 9)))], f"edge_id long, u long, v long, geom {LINE}, utm {LINE}")
    seg = N.split_deflections(bent).withColumns({"grid_id": F.lit("2048"), "start_is_intersection": F.lit(False), "end_is_intersection": F.lit(False), "highway": F.lit("service")})
    drawn = spark.createDataFrame([(1, line((0, 0), (1, 1)), line((0, 0), (1, 1)))], f"edit_id long, geom {LINE}, utm {LINE}")
    out = ED.draw_segments(seg, drawn)
    joints = {r["n"] for r in seg.select(F.explode(F.array("start_node", "end_node")).alias("n")).collect()}
    new = out.where("grid_id LIKE 'drawn%'").first()
    assert not joints & {new["start_node"], new["end_node"]} and new["start_node"] != new["end_node"]
    cut = ED.SPLIT_NODES - (1 << 59)
    assert cut < ED.DRAWN_NODES - 2 * (1 << 58) and out.select("seg_id").distinct().count() == out.count()
    assert ED.draw_segments(seg, drawn, 7000).where("grid_id = 'drawn_7001'").count() == 1


def part_of(net):
    """Streets around a few junctions, chosen for what they hold."""
    ramp = net.ramps.orderBy("seg_id", "side", "pos", "n").first()
    hulls = [r["node_id"] for r in net.members.orderBy(F.col("node_id").desc()).limit(3).collect()]
    both = net.ramps.where("n = 1").groupBy("seg_id", "pos").agg(F.countDistinct("side").alias("k")).where("k = 2").orderBy(F.col("seg_id").desc()).first()
    return ramp, hulls, both


@pytest.fixture(scope="module")
def hand_made(city):
    net = straight_network(city)
    ramp, hulls, both = part_of(net)
    key = {k: ramp[k] for k in ("seg_id", "side", "pos", "n")}
    c = net.hulls.join(net.members.where(F.col("node_id") == hulls[0]), "hull_id").select(G.ring_centroid(F.col("ring")).alias("c")).first()["c"]
    ring = line((c["x"] - 9, c["y"] - 9), (c["x"] + 9, c["y"] - 9), (c["x"] + 9, c["y"] + 9), (c["x"] - 9, c["y"] + 9))
    edits = edits_of(city.spark, {"edit_type": "toggle_curb_ramp", **key, "enabled": False},
                     {"edit_type": "draw_crosswalk", "seg_id": both["seg_id"], "side": "left", "pos": both["pos"], "n": 1, "b_seg_id": both["seg_id"], "b_side": "right", "b_pos": both["pos"], "b_n": 1},
                     {"edit_type": "edit_polygon_face", "node_id": hulls[0], "utm": ring}, {"edit_type": "consolidate_hulls", "node_id": hulls[1]},
                     {"edit_type": "attr_edit", "seg_id": ramp["seg_id"], "col": "name", "new_value": "By Hand"})
    joined = edits.unionByName(edits.where("edit_type = 'consolidate_hulls'").withColumn("node_id", F.lit(hulls[2]).cast("long")))
    return net, changes.apply_changeset(net, joined), key, hulls, both


def holds(net, key, hulls, both):
    at = " AND ".join(f"{k} = '{v}'" for k, v in key.items())
    drawn = net.crosswalks.where(f"seg_id = {both['seg_id']} AND pos = '{both['pos']}'").collect()
    ring = net.hulls.join(net.members.where(F.col("node_id") == hulls[0]), "hull_id").first()["ring"]
    one = {r["hull_id"] for r in net.members.where(F.col("node_id").isin(hulls[1:])).collect()}
    return net.ramps.where(at).isEmpty(), [r["source"] for r in drawn] == ["manual"], len(ring) == 4 and round(ring[1]["x"] - ring[0]["x"], 6) == 18, len(one) == 1


def test_edits_by_hand_outlast_recomputation(hand_made):
    net, done, key, hulls, both = hand_made
    assert all(holds(done, key, hulls, both)) and not any(holds(net, key, hulls, both)[:2])
    nodes = done.segments.where(F.col("seg_id").isin(key["seg_id"], both["seg_id"])).select(F.explode(F.array("start_node", "end_node")).alias("node_id"))
    again = plan.recompute(done, nodes.unionByName(done.members.where(F.col("node_id").isin(hulls)).select("node_id")), from_snap=True)
    assert all(holds(again, key, hulls, both))
    assert again.segments.where("name = 'By Hand'").count() == 1


def test_a_ramp_switched_on_again_is_back(hand_made):
    net, done, key, _, _ = hand_made
    on = edits_of(net.segments.sparkSession, {"edit_id": 99, "edit_type": "toggle_curb_ramp", **key, "enabled": True})
    back = changes.apply_changeset(done, on)
    assert back.ramps.where(" AND ".join(f"{k} = '{v}'" for k, v in key.items())).count() == 1


def test_an_edited_network_is_the_network_of_edited_inputs(hand_made, city):
    """Junctions of the whole network made with the overrides equal those made again around the edits."""
    _, done, _, _, _ = hand_made
    lines = snap.snap_endpoints(IX.sidewalk_lines(done.facilities, done.segments), done.segments)
    start = plan.junctions(done.segments, done.facilities, lines, done.crossings, done.footways, own=done.overrides)
    drawn = done.members.join(done.overrides.hulls, "node_id", "left_semi").select("hull_id").distinct()
    def shape(hulls):
        return rows(hulls.join(drawn, "hull_id", "left_semi").select("hull_id", F.round(G.length(F.col("ring")), 3), "n_ramps"))
    def joined(members):
        nodes = done.overrides.links.select(F.explode(F.array("a", "b")).alias("node_id")).distinct()
        return rows(members.join(nodes, "node_id", "left_semi"))
    assert shape(done.hulls) == shape(start["hulls"]) and len(shape(done.hulls)) == 1
    assert joined(done.members) == joined(start["members"]) and len(joined(done.members)) == 2
    manual = ("seg_id", "pos", "source", "crosswalk_id")
    assert rows(start["crosswalks"].where("source = 'manual'").select(*manual)) == rows(done.crosswalks.where("source = 'manual'").select(*manual))


def test_what_is_booked_on_a_cut_street_goes_with_its_pieces(city):
    net = straight_network(city)
    busy = net.calming.groupBy("seg_id").count().join(net.ramps.where("pos = 'end'").select("seg_id").distinct(), "seg_id").orderBy("seg_id").first()["seg_id"]
    far = net.facilities.where("quality = 'separate' AND utm IS NOT NULL").orderBy("seg_id").first()["seg_id"]
    p = {r["seg_id"]: r for r in net.segments.where(F.col("seg_id").isin(busy, far)).select(
        "seg_id", G.interpolate(G.measured(F.col("utm")), G.length(F.col("utm")) * 0.4).alias("a"), G.interpolate(G.measured(F.col("utm")), G.length(F.col("utm")) * 0.7).alias("b")).collect()}
    pts = city.spark.createDataFrame([(i, v["x"], v["y"]) for i, v in enumerate([p[busy]["a"], p[busy]["b"], p[far]["a"]], 1)], "edit_id long, x double, y double")
    done, nodes = cuts.split_streets(net, pts)
    # a third street may lie nearer than one of those asked for; then it is cut instead
    new = done.segments.where(f"seg_id <= {ED.SPLIT_SEGMENTS}")
    assert new.count() == 3 and done.segments.count() == net.segments.count() + 3
    assert round(done.segments.agg(F.sum(G.length(F.col("utm")))).first()[0], 3) == round(net.segments.agg(F.sum(G.length(F.col("utm")))).first()[0], 3)
    for t in ("facilities", "sidewalks", "ramps", "crosswalks", "calming"):
        assert getattr(done, t).join(done.segments, "seg_id", "left_anti").isEmpty(), t
    for t in ("ramps", "crosswalks", "calming"):
        assert getattr(done, t).count() == getattr(net, t).count(), t
    cut = [r["seg_id"] for r in net.segments.join(done.segments.select("seg_id", F.round(G.length(F.col("utm")), 3).alias("l")), "seg_id").where(F.round(G.length(F.col("utm")), 3) != F.col("l")).collect()]
    assert net.ramps.where(F.col("seg_id").isin(cut) & (F.col("pos") == "end")).count() == done.ramps.where(f"seg_id <= {ED.SPLIT_SEGMENTS}").count()
    def length(n):
        return n.facilities.where("quality = 'separate' AND utm IS NOT NULL").agg(F.sum(G.length(F.col("utm")))).first()[0]
    assert abs(length(done) - length(net)) < 1e-3
    assert done.facilities.where("facility_grid_id IS NOT NULL").groupBy("facility_grid_id").count().where("count > 1").isEmpty()
    assert nodes.count() >= 4


def test_a_changeset_with_cuts_books_nothing_on_streets_that_are_gone(city):
    net = straight_network(city)
    mid = net.segments.orderBy("seg_id").limit(3).select(G.interpolate(G.measured(F.col("utm")), G.length(F.col("utm")) * 0.5).alias("p")).collect()
    done = changes.apply_changeset(net, edits_of(city.spark, *[{"edit_type": "split_segment", "x": r["p"]["x"], "y": r["p"]["y"]} for r in mid]))
    assert done.segments.where(f"seg_id <= {ED.SPLIT_SEGMENTS}").count() == 3
    for t in ("facilities", "sidewalks", "ramps", "crosswalks", "calming"):
        assert getattr(done, t).join(done.segments, "seg_id", "left_anti").isEmpty(), t
    ends = done.segments.select(F.explode(F.array("start_node", "end_node")).alias("node_id")).distinct()
    assert done.facility_ends.join(ends, "node_id", "left_anti").isEmpty()


def test_documents_of_every_list_become_edits(spark, tmp_path):
    ramp = {"segment_id": "1_1_0", "side": "left", "position": "end", "index": 2}
    ring = [[-122.5, 37.7], [-122.49, 37.7], [-122.49, 37.71], [-122.5, 37.7]]
    docs = [{"edits": {
        "merged_segments": [{"surviving_seg_id": "1_1_0", "consumed_seg_id": "1_1_1", "shared_node_id": "42"}],
        "moved_endpoints": [{"node_id": "7", "new_x": -122.5, "new_y": 37.7, "rubber_band_segments": ["1_1_1", "unknown"]}, {"node_id": "8", "new_x": -122.4, "new_y": 37.7, "rubber_band_segments": []}],
        "added_nodes": [{"x": -122.5, "y": 37.7}], "toggled_curb_ramps": [{**ramp, "enabled": False}], "drawn_crosswalks": [{"ramp_a": ramp, "ramp_b": {**ramp, "segment_id": "1_1_1"}}],
        "attr_edits": [{"street_grid_id": "1_1_0", "col": "name", "new_value": "N"}, {"street_grid_id": "gone", "col": "name", "new_value": "N"}],
        "deleted_points": [{"node_id": "5", "x": 0.0, "y": 0.0}], "deleted_hulls": [{"node_id": "6"}], "drawn_segments": [{"coordinates": [[-122.5, 37.7], [-122.49, 37.7]]}, {"coordinates": [[1, 2]]}],
        "edited_hulls": [{"node_id": "9", "geometry": {"type": "Polygon", "coordinates": [ring]}}],
        "consolidated_hulls": [{"node_keys": [[550000.0, 4172000.0], [-122.5, 37.7]], "buffer_m": None}]}}, {"edits": {"added_nodes": [{"x": -122.41, "y": 37.7}]}}]
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(d))
    read = changeset.read(spark, str(tmp_path)).withColumn("doc", F.when(F.size("edits.moved_endpoints") > 0, 3).otherwise(4))
    seg = spark.createDataFrame([(100, "1_1_0"), (101, "1_1_1")], "seg_id long, grid_id string")
    got = changeset.to_edits(changeset.flatten(read, "doc"), seg).orderBy("edit_id", "x").collect()
    assert [r["edit_type"] for r in got] == ["move_point", "move_point", "add_point", "toggle_curb_ramp", "draw_crosswalk", "attr_edit", "delete_point", "delete_polygon",
                                             "merge_segments", "draw_segment", "edit_polygon_face", "consolidate_hulls", "consolidate_hulls", "add_point"]
    by = {}
    for r in got:
        by.setdefault(r["edit_type"], []).append(r)
    assert by["move_point"][0]["band"] == [101] and by["move_point"][1]["band"] == [] and by["move_point"][0]["node_id"] == 7
    assert (by["toggle_curb_ramp"][0]["seg_id"], by["toggle_curb_ramp"][0]["pos"], by["toggle_curb_ramp"][0]["n"], by["toggle_curb_ramp"][0]["enabled"]) == (100, "end", 2, False)
    assert (by["draw_crosswalk"][0]["seg_id"], by["draw_crosswalk"][0]["b_seg_id"]) == (100, 101)
    assert (by["merge_segments"][0]["seg_id"], by["merge_segments"][0]["consumed_id"], by["merge_segments"][0]["node_id"]) == (100, 101, 42)
    assert len(by["edit_polygon_face"][0]["utm"]) == 3 and len(by["draw_segment"][0]["utm"]) == 2
    assert by["consolidate_hulls"][0]["edit_id"] == by["consolidate_hulls"][1]["edit_id"] and round(by["consolidate_hulls"][0]["x"]) == 544077
    assert all(r["user_id"] == 0 for r in got) and by["add_point"][1]["edit_id"] > max(r["edit_id"] for r in got[:-1])


def test_vertices_at_the_ends_of_changed_streets_are_not_counted_again(spark):
    from types import SimpleNamespace

    from queries.editing import changeset_segments
    cut = ED.SPLIT_NODES - 5
    streets = [(1, 10, 11, line((0, 0), (0, 0), (9, 0))),   # merged with a street of no length
               (2, 10, 11, line((0, 0), (4, 0), (9, 0))),
               (3, 10, 10, line((5, 5), (5, 5), (5, 5))),
               (4, 10, 11, line((0, 0), (9, 0), (9, 0))),   # counts as long as the street is not cut
               (5, 10, cut, line((0, 0), (4, 0), (9, 0), (9, 0)))]
    rows = [(i, a, b, False, False, "n", utm) for i, a, b, utm in streets]
    seg = spark.createDataFrame(rows, f"seg_id long, start_node long, end_node long, start_is_intersection boolean, end_is_intersection boolean, name string, utm {LINE}")
    got = changeset_segments(SimpleNamespace(_edited=SimpleNamespace(segments=seg)))
    assert {r["seg_id"]: r["n_vertices"] for r in got.collect()} == {1: 2, 2: 3, 3: 2, 4: 3, 5: 3}
