"""Merkle manifest against a plain tree, its log against a recursive walk."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from kerbline.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf int, IDX int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def around(tree, i):
    out = []
    for row in tree[:-1]:
        lo = i // 16 * 16
        out.append(("".join(row[lo:i]), "".join(row[i + 1:lo + 16])))
        i //= 16
    return out


def plain(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(field, (*r[:4], text))))

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for x in names:
        by[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees.append(levels([leaf(r, r[4]) for r in by[x]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, x in enumerate(names):
        for i, r in enumerate(by[x]):
            path = around(trees[k], i) + around(top, k)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = leaf(r, text)
            for b, a in path:
                at = sha(b + at + a)
            out.append((r[0], leaf(r, r[4]), trees[k][-1][0], top[-1][0], sha("".join(b + a for b, a in path)), at, at == top[-1][0]))
    return sorted(out, key=str)


def verified(spark, rows, levels=M.LEVELS):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r) for r in M.verified(docs, M.lower_case_tampering(docs), levels).collect()), key=str)


def test_rows_of_every_kind_match_a_plain_tree(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i} Ä", 0, 0) for i in range(60)]
    rows += [(None, None, None, None, None, 0, 0), (None, None, None, None, None, 1, 1), (5, None, None, None, "", 0, 0),
             (7, "s1", "en", 7, "one id twice", 0, 0), (8, "lone", "x", -3, "x" * 300_000 + "A", 0, 0), (-4, "é", "", 0, "NO", 0, 0)]
    rows += [(1000, "s2", "en", 1, "Copy", 0, 0)] * 40
    assert verified(spark, rows) == plain(rows)


def test_more_leaves_than_one_builder_takes(spark):
    for n, levels in ((256, 2), (257, 2), (4097, 3), (300, 1)):
        rows = [(i, "ab"[i % 50 == 0], None, i, f"T{i}", 0, 0) for i in range(n)]
        assert verified(spark, rows, levels) == plain(rows)


def test_many_sources(spark):
    rows = [(i, f"source {i}", "en", 1, "Aa", 0, 0) for i in range(300)]
    assert verified(spark, rows) == plain(rows)


def test_empty_and_single(spark):
    assert verified(spark, []) == []
    one = [(1, "s", None, None, "X", 0, 0)]
    assert verified(spark, one) == plain(one)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4096, 4100])
def test_positions_are_those_of_a_postorder_walk(n):
    counts = [n]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // 16))
    order = []

    def visit(level, i):
        if level:
            for j in range(16 * i, min(16 * i + 16, counts[level - 1])):
                visit(level - 1, j)
        order.append((level, i))

    visit(len(counts) - 1, 0)
    assert [M.position(level, i, n) for level, i in order] == list(range(len(order)))
    assert M.depth(n) == len(counts) - 1


def test_log_lists_every_node_once_in_order(spark):
    docs = spark.createDataFrame([(i, "a", None, i, f"T{i}", 0, 0) for i in range(1000)], SCHEMA)
    made = M.Manifest(docs, levels=1)
    got = M.log(made.sources, levels=1).orderBy("position").collect()
    tree = levels([r["digest"].hex() for r in got if r["level"] == 0])
    assert [r["position"] for r in got] == list(range(sum(map(len, tree))))
    assert all(tree[r["level"]][r["number"]] == r["digest"].hex() for r in got)


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i % 90, f"s{i % 4}", "en", i, f"T{i}", 0, 0) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    a, b = (M.verified(d, M.lower_case_tampering(d)).orderBy("doc_id", "leaf").collect() for d in (docs.repartition(1), docs.repartition(13, F.rand(3))))
    assert a == b
