"""Hand-made shapes for the geometry expressions."""

import math

import pytest
from pyspark.sql import functions as F

from kerbline.functions import geom as G
from kerbline.sources import wkb

LINE = "array<struct<x:double,y:double>>"


def one(spark, schema, row, *cols):
    return spark.createDataFrame([row], schema).select(*cols).first()


def pts(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def flat(line):
    return [(round(p["x"], 6), round(p["y"], 6)) for p in line]


def test_parallel_rays_have_no_corner(spark):
    args = [F.lit(float(v)) for v in (0, 0, 1, 0, 0, 5, 1, 0)]
    assert spark.range(1).select(G.ray_ray(*args).alias("p")).first()["p"] is None


def test_lines_parallel_but_for_rounding_have_no_corner(spark):
    # a bend of 3e-7, as two streets in one row have it: rounding alone decided whether these met
    args = [F.lit(float(v)) for v in (0, 0, 1, 3e-7, 0, 0, 1, 0)]
    assert spark.range(1).select(G.ray_ray(*args).alias("p")).first()["p"] is None
    from kerbline.operators import intersections as IX
    def crossings(bend):
        rows = [(1, 100.0, 0.0, seg, "left", pos, "g", arm, pts(*line)) for seg, pos, arm, line in (
            (1, "end", "a", ((0, 0), (100.000001, bend))), (2, "start", "b", ((99.999999, bend), (200, 0))))]
        arms = spark.createDataFrame(rows, f"node_id long, nx double, ny double, seg_id long, side string, pos string, grid_id string, arm string, utm {LINE}")
        return IX.pair_crossings(arms).count()
    assert crossings(3e-5) == 0 and crossings(3) == 1


def test_collinear_points_have_no_ring(spark):
    r = one(spark, f"p {LINE}", (pts((0, 0), (1, 1), (2, 2)),), G.hull_ring(F.col("p")).alias("h"))
    assert len(r["h"]) < 3


def test_hull_contains_its_points(spark):
    p = pts((0, 0), (4, 0), (4, 3), (0, 3), (2, 1), (4, 1.5), (1, 2))
    r = one(spark, f"p {LINE}", (p,), G.hull_ring(F.col("p")).alias("h"))
    assert flat(r["h"]) == [(0, 0), (4, 0), (4, 3), (0, 3)]


def test_large_hull_in_groups_equals_single_hull(spark):
    from kerbline.operators import intersections as IX
    df = spark.range(4000).select(F.lit(1).alias("k"), (F.cos("id") * 50 * F.sqrt(F.rand(1))).alias("x"), (F.sin("id") * 50 * F.sqrt(F.rand(2))).alias("y"))
    df = spark.createDataFrame(df.select("k", F.round("x", 3).alias("x"), F.round("y", 3).alias("y")).toPandas())
    whole = df.groupBy("k").agg(G.hull_ring(F.collect_list(F.struct("x", "y"))).alias("ring")).first()["ring"]
    parts = IX.convex_hulls(df, "k").first()["ring"]
    assert flat(parts) == flat(whole)


def test_pieces_of_a_split_join_to_the_parent(spark):
    from kerbline.operators import network as N
    line = pts((0, 0), (10, 0), (10, 10), (20, 10), (30, 10))
    df = spark.createDataFrame([(7, 1, 2, line, line)], f"edge_id long, u long, v long, geom {LINE}, utm {LINE}")
    rows = N.split_deflections(df).orderBy("piece").collect()
    assert [len(r["utm"]) for r in rows] == [2, 2, 3]
    joined = flat(rows[0]["utm"]) + [p for r in rows[1:] for p in flat(r["utm"])[1:]]
    assert joined == flat(line)
    assert rows[0]["start_node"] == 1 and rows[-1]["end_node"] == 2 and rows[0]["end_node"] == rows[1]["start_node"] < 0


def test_offset_of_a_corner_is_mitred(spark):
    r = one(spark, f"l {LINE}", (pts((0, 0), (10, 0), (10, 10)),), G.offset(F.col("l"), F.lit(1.0)).alias("o"))
    assert flat(r["o"]) == [(0, 1), (9, 1), (9, 10)]


def test_zero_length_and_closed_lines(spark):
    r = one(spark, f"l {LINE}", (pts((0, 0), (4, 0), (4, 4), (0, 0)),), G.bearing(F.col("l")).alias("b"), G.length(F.col("l")).alias("len"))
    assert r["b"] is None and math.isclose(r["len"], 8 + math.sqrt(32))


def test_substring_keeps_inner_vertices(spark):
    r = one(spark, f"l {LINE}", (pts((0, 0), (10, 0), (10, 10)),), G.substring(G.measured(F.col("l")), F.lit(5.0), F.lit(15.0)).alias("s"))
    assert flat(r["s"]) == [(5, 0), (10, 0), (10, 5)]


def test_capsule_span_against_sampling(spark):
    from kerbline.operators.facilities import add_capsule_span
    import random
    rnd = random.Random(3)
    rows = [tuple(rnd.uniform(-5, 5) for _ in range(8)) for _ in range(200)]
    names = ("ax", "ay", "bx", "by", "cx", "cy", "ex", "ey")
    out = add_capsule_span(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)), 1.0).select(*names, "s").collect()

    def near(px, py, r):
        dx, dy = r["ex"] - r["cx"], r["ey"] - r["cy"]
        t = max(0.0, min(1.0, ((px - r["cx"]) * dx + (py - r["cy"]) * dy) / (dx * dx + dy * dy)))
        return math.hypot(px - r["cx"] - t * dx, py - r["cy"] - t * dy) <= 1.0

    for r in out:
        hits = [i / 2000 for i in range(2001) if near(r["ax"] + i / 2000 * (r["bx"] - r["ax"]), r["ay"] + i / 2000 * (r["by"] - r["ay"]), r)]
        share = r["s"]["t1"] - r["s"]["t0"] if r["s"] else 0.0
        assert abs(share - (hits[-1] - hits[0] if hits else 0.0)) < 2e-3


def test_wkb_reads_all_kinds_and_rejects_garbage():
    import struct
    point = struct.pack("<BIdd", 1, 1, 1.0, 2.0)
    assert wkb.parse(point) == {"kind": "Point", "parts": [[{"x": 1.0, "y": 2.0}]]}
    multi = struct.pack(">BII", 0, 4, 2) + struct.pack(">BIdd", 0, 1, 1, 2) + struct.pack("<BIdd", 1, 1, 3, 4)
    assert [p[0]["x"] for p in wkb.parse(multi)["parts"]] == [1.0, 3.0]
    lines = struct.pack("<BII", 1, 5, 1) + struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", 0, 0, 1, 1)
    assert wkb.parse(lines)["kind"] == "MultiLineString"
    assert wkb.parse(b"\x01\x02") is None and wkb.parse(b"") is None and wkb.parse(struct.pack("<BI", 1, 3)) is None


def _random_shapes(kind: str, seed: int) -> tuple[list, list]:
    """(lists that ``encode_array`` takes, parts that decoding gives), nulls and empty ones among them."""
    import random
    rnd = random.Random(seed)

    def line(n: int) -> list:
        return [{"x": rnd.random(), "y": rnd.random()} for _ in range(n)]

    rows, parts = [], []
    for _ in range(120):
        if rnd.random() < 0.1:
            rows.append(None)
        elif kind == "Point":
            rows.append(line(1))
        elif kind in ("Polygon", "MultiLineString"):
            rows.append([line(rnd.randrange(5)) for _ in range(rnd.randrange(4))])
        else:
            rows.append(line(rnd.randrange(5)))
        r = rows[-1]
        parts.append(r if r is None or kind in ("Polygon", "MultiLineString") else [[p] for p in r] if kind == "MultiPoint" else [r])
    return rows, parts


@pytest.mark.parametrize("kind", list(wkb.CODES))
@pytest.mark.parametrize("big", [False, True])
def test_wkb_kinds_survive_a_round_trip_in_slices(kind, big):
    import pyarrow as pa
    line = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    rows, parts = _random_shapes(kind, 5)
    given = pa.array(rows, pa.list_(line) if kind in ("Polygon", "MultiLineString") else line)
    for lo, n in ((0, 120), (7, 80), (119, 1), (30, 0)):
        made = wkb.encode_array(given.slice(lo, n), kind, big)
        made.validate(full=True)
        want = [None if p is None else {"kind": kind, "parts": p} for p in parts[lo:lo + n]]
        assert wkb.decode_array(made).to_pylist() == want
        longer = pa.array([None if v is None else v + b"tail" for v in made.to_pylist()], pa.binary())
        assert wkb.decode_array(longer.slice(1)).to_pylist() == want[1:]


@pytest.mark.parametrize("kind", list(wkb.CODES))
def test_wkb_cut_off_anywhere_is_null_and_spares_its_neighbours(kind):
    import pyarrow as pa
    line = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    p = [{"x": 1.0, "y": 2.0}]
    row = {"Point": p, "LineString": p * 2, "MultiPoint": p * 2, "Polygon": [p * 4, p * 4], "MultiLineString": [p * 2, p * 3]}[kind]
    whole = wkb.encode_array(pa.array([row], pa.list_(line) if kind in ("Polygon", "MultiLineString") else line), kind)[0].as_py()
    good = wkb.parse(whole)
    mixed = [v for cut in range(len(whole)) for v in (whole[:cut], whole)]
    assert wkb.decode_array(pa.array(mixed, pa.binary())).to_pylist() == [None, good] * len(whole)
    huge = whole[:5] + b"\xff\xff\xff\xff" + whole[9:]
    assert kind == "Point" or wkb.parse(huge) is None


def test_wkb_point_needs_exactly_one_place():
    import pyarrow as pa
    line = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
    p = [{"x": 1.0, "y": 2.0}]
    made = wkb.encode_array(pa.array([p, [], p * 2, None, p], line), "Point")
    assert [g and g["parts"] for g in wkb.decode_array(made).to_pylist()] == [[p], None, None, None, [p]]
