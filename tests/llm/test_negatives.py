"""Hard negatives and the tree's bounds against all inner products."""

import numpy as np
from pyspark.sql import functions as F

from kerbline.llm import negatives as N

SCHEMA = "vec_id long, label int, embedding array<double>, block int, Score int"


def brute(rows, how):
    seen, out = set(), []
    for i, label, e, *_ in rows:
        if i is None or label is None or e is None or any(v is None or not np.isfinite(v) for v in e):
            continue
        if (i, label, tuple(e)) not in seen:
            seen.add((i, label, tuple(e)))
            out.append((i, label, [int(np.floor(256 * v)) for v in e]))

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2]))

    found = []
    for k, a in enumerate(out):
        if a[0] % how.every:
            continue
        near = sorted((-score(a, b), b[0]) for j, b in enumerate(out) if j != k and b[1] == a[1])[:how.positives]
        far = sorted((-score(a, b), b[0]) for b in out if b[1] != a[1])
        for p, pid in near:
            fit = [(s, i) for s, i in far if how.low * -p <= 100 * -s <= how.high * -p][:how.negatives]
            found += [(a[0], pid, r, i, -p, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(found)


def mined(spark, rows, how=None):
    out = N.hard_negatives(spark.createDataFrame(rows, SCHEMA), how)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def vectors(n, dim, seed, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) / np.sqrt(dim)
    x[n // 2:] = x[:n - n // 2] + 0.05 * x[n // 2:]  # near copies, so the bounds do cut
    if grid:
        x = np.round(x * grid) / grid  # many ties
    return [(i, int(rng.integers(0, 4)), [float(v) for v in x[i]], 0, 0) for i in range(n)]


def test_matches_all_inner_products(spark):
    how = N.Mining(every=10)
    for grid in (None, 4):
        rows = vectors(700, 8, 3, grid)
        assert mined(spark, rows, how) == brute(rows, how)


def test_blocks_too_many_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "FEW_BLOCKS", 2)
    monkeypatch.setattr(N, "PART_ROWS", 100)
    how = N.Mining(every=5)
    rows = vectors(400, 6, 5)
    assert mined(spark, rows, how) == brute(rows, how)


def test_rows_of_every_kind(spark):
    how = N.Mining(every=10)
    rows = vectors(200, 5, 7)
    rows += [rows[10]] * 50 + [(10, 1, [0.5] * 5, 0, 0), (11, 2, [0.1, 0.2], 0, 0), (20, 3, [], 0, 0), (None, 1, [1.0] * 5, 0, 0),
             (30, None, [1.0] * 5, 0, 0), (40, 1, None, 0, 0), (50, 1, [float("nan")] * 5, 0, 0), (60, 1, [float("inf")] + [0.0] * 4, 0, 0),
             (70, 1, [None] + [0.0] * 4, 0, 0), (-10, 2, [0.0] * 5, 0, 0), (-20, 2, [0.0] * 5, 0, 0)]
    padded = [(i, lb, e if e is None else e + [0.0] * (5 - len(e)), b, s) for i, lb, e, b, s in rows]
    assert mined(spark, rows, how) == brute(padded, how)


def test_numbers_beyond_double_precision(spark):
    how = N.Mining(every=10)
    rows = [(i, i % 2, [float((i * 7919) % 1009) * 2.0 ** 12 + i, 3.0 * i], 0, 0) for i in range(60)]
    assert mined(spark, rows, how) == brute(rows, how)


def test_no_anchor_no_positive_no_row(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1.0], 0, 0), (2, 1, [1.0], 0, 0)]) == []
    assert mined(spark, [(50, 1, [1.0], 0, 0), (2, 2, [0.9], 0, 0)]) == []


def test_bounds_hold_down_the_tree():
    rng = np.random.default_rng(2)
    a, x = np.round(rng.normal(size=(40, 6)) * 100), np.round(rng.normal(size=(300, 6)) * 100)
    tree = N.spanning_tree(a)
    assert sorted(tree.order) == list(range(40)) and (tree.parent >= 0).sum() == 39
    seen = {int(tree.order[0])}
    for i in tree.order[1:]:
        assert int(tree.parent[i]) in seen
        assert np.isclose(tree.edge[i], np.linalg.norm(a[i] - a[tree.parent[i]]))
        seen.add(int(i))

    def needed(i, low, high):
        true = x @ a[i]
        assert (low <= true).all() and (true <= high).all()
        return true > np.quantile(true, 0.9)

    got = {i: (at, s) for i, at, s in N.walk(tree, a, x, needed)}
    assert len(got) == 40
    for i, (at, s) in got.items():
        assert (s == x[at] @ a[i]).all()
        true = x @ a[i]
        assert set(np.flatnonzero(true > np.quantile(true, 0.9))) <= set(at.tolist())


def test_result_does_not_depend_on_partitions(spark):
    how = N.Mining(every=10)
    rows = vectors(300, 6, 9, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (sorted(map(tuple, N.hard_negatives(d, how).collect())) for d in (df.repartition(1), df.repartition(11, F.rand(5))))
    assert a == b
