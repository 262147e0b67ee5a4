"""Hard negatives of anchor vectors, with score bounds along a spanning tree of the anchors.

Anchors are cut into blocks, and each block gets a minimum spanning tree over its
vectors.  Candidates meet every block in chunks.  The root of the tree scores all
candidates of a chunk; the score at any other anchor lies within (edge length times
candidate norm) of the score at its parent, so bounds pass down the tree and only
candidates whose bounds overlap what the anchor still looks for are scored again.
An anchor looks first for its likest rows of its own label (the positives), then,
for every positive, for the best rows of other labels within a share of its score.

Anchors are a stated query set: every anchor block meets every chunk once and keeps a
few rows of it, never all pairs.  Blocks are broadcast while they are few; beyond that
chunks and copies of the blocks are dealt over (block, part) keys of even size.

Components are taken as floor(quantum * x), scores are their integer inner products:
exact in double precision while they stay under 2**53, by Python integers otherwise
(and held to the range of a long in the result).

Defined results: a row with a null id, label or vector, or with a null or non-finite
component, takes no part; rows equal in id, label and vector count once, different
rows under one id are rows of their own, and an anchor is never its own positive;
shorter vectors count as filled up with zeros; ties go to the smaller id; anchors
without a positive, or positives without a row in their window, give no rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.llm.base import sized
from kerbline.staging import stage

BLOCK = 512  # anchors of one tree
CHUNK = 1024  # candidates scored at once
PART_ROWS = 1 << 20  # candidates that one task compares with a block, where blocks are too many to broadcast
FEW_BLOCKS = 64  # blocks sent to every executor: a few hundred kilobytes each
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Mining:
    every: int = 50  # rows whose id it divides are anchors
    positives: int = 5
    negatives: int = 3
    low: int = 50  # a negative's score lies within these percentages of the positive's score
    high: int = 95
    quantum: int = 256


@dataclass(frozen=True)
class Tree:
    """Anchors in an order in which parents come first; ``edge`` is the length of the edge to the parent."""

    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray


def spanning_tree(x: np.ndarray) -> Tree:
    """Minimum spanning tree by Prim's method, from the vector nearest to the mean."""
    n = len(x)
    root = int(np.argmin(((x - x.mean(0)) ** 2).sum(1)))
    order, parent, edge = [root], np.full(n, -1), np.zeros(n)
    near, by = np.full(n, np.inf), np.full(n, root)
    open_, last = np.ones(n, dtype=bool), root
    open_[root] = False
    while len(order) < n:
        d = np.sqrt(((x - x[last]) ** 2).sum(1))
        closer = open_ & (d < near)
        near[closer], by[closer] = d[closer], last
        last = int(np.argmin(np.where(open_, near, np.inf)))
        if not open_[last]:  # distances beyond the range of a double
            last = int(np.flatnonzero(open_)[0])
        parent[last], edge[last], open_[last] = by[last], near[last], False
        order.append(last)
    return Tree(np.array(order), parent, edge)


def inner(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` with ``a``, whole numbers all."""
    if np.abs(x).max(initial=0.0) * np.abs(a).max(initial=0.0) * max(x.shape[1], 1) < EXACT:
        return x @ a
    whole = np.vectorize(int, otypes=[object])
    return (whole(x) @ whole(a)) if x.size else np.zeros(len(x))


def walk(tree: Tree, anchors: np.ndarray, x: np.ndarray,
         needed: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows scored, their exact scores) down the tree.

    ``needed`` gets an anchor and the bounds of all rows and marks the rows to score.
    Where it marks most of them, all are scored, which keeps the bounds below tight.
    """
    width = max(anchors.shape[1], x.shape[1])
    anchors, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, x))
    norm = np.sqrt((x * x).sum(1))
    low, high = np.empty((len(anchors), len(x))), np.empty((len(anchors), len(x)))
    for i in tree.order:
        p = tree.parent[i]
        if p < 0:
            low[i], high[i] = -np.inf, np.inf
        else:
            slack = tree.edge[i] * norm * (1 + 1e-9) + 1  # above what rounding can take away
            low[i], high[i] = low[p] - slack, high[p] + slack
        mask = needed(i, low[i], high[i])
        at = np.arange(len(x)) if p < 0 or 2 * mask.sum() > len(x) else np.flatnonzero(mask)
        exact = inner(x[at], anchors[i])
        low[i, at], high[i, at] = exact.astype(float) - 0.5, exact.astype(float) + 0.5
        if exact.dtype == object:  # a double may be off by its last place there
            gap = np.abs(low[i, at]) * 1e-15 + 1
            low[i, at], high[i, at] = low[i, at] - gap, high[i, at] + gap
        yield i, at, exact


def kth(values: np.ndarray, k: int) -> float:
    """k-th largest of ``values``, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def best(score: np.ndarray, ids: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id and key."""
    if len(score) > 4 * k and score.dtype != object:
        some = np.flatnonzero(score >= kth(score, k))
    else:
        some = np.arange(len(score))
    down = -score[some]
    return some[sorted(range(len(some)), key=lambda j: (down[j], ids[some[j]], keys[some[j]]))[:k]]


@dataclass(frozen=True)
class Rows:
    """Vectors with their ids, keys and labels, as they travel in one row."""

    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    @staticmethod
    def of(r: dict, prefix: str) -> Rows:
        ids, keys, labels = (np.frombuffer(r[prefix + c], np.int64) for c in ("ids", "keys", "labels"))
        return Rows(ids, keys, labels, np.frombuffer(r[prefix + "x"], np.float64).reshape(len(ids), -1))


def _matrix(lists: pa.ListArray, quantum: int) -> np.ndarray:
    """floor(quantum * x), a row for each list, filled up with zeros."""
    at = np.asarray(lists.offsets, dtype=np.int64)
    flat = np.asarray(lists.values, dtype=np.float64)[at[0]:at[-1]]
    size = np.diff(at)
    out = np.zeros((len(size), max(1, int(size.max(initial=0)))))
    out[np.arange(out.shape[1]) < size[:, None]] = np.floor(quantum * flat)
    return out


def usable(vectors: DataFrame, quantum: int) -> DataFrame:
    """(vec_id, label, embedding, key) of the rows that take part, each once."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: v.isNotNull() & (F.abs(v.cast("double") * quantum) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()).where(finite)
    return (rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), e.cast("array<double>").alias("embedding"))
            .withColumn("key", F.xxhash64("label", "embedding")).dropDuplicates(["vec_id", "key"]))


CHUNK_COLUMNS = "ids binary, keys binary, labels binary, x binary"


def chunks(rows: DataFrame, quantum: int) -> DataFrame:
    """Rows packed by ``CHUNK``, as they lie."""
    def pack(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                numbers = [np.asarray(part.column(c), dtype=np.int64).tobytes() for c in ("vec_id", "key", "label")]
                x = _matrix(part.column("embedding"), quantum).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (*numbers, x)], names=["ids", "keys", "labels", "x"])
    return rows.select("vec_id", "key", "label", "embedding").mapInArrow(pack, CHUNK_COLUMNS)


def anchor_blocks(rows: DataFrame, how: Mining) -> DataFrame:
    """(block, vectors and their spanning tree), some ``BLOCK`` anchors in each."""
    anchors = rows.where(F.col("vec_id") % how.every == 0)
    n_blocks = max(1, -(-anchors.count() // BLOCK))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["vec_id", "key"])
        x = _matrix(pa.array(part["embedding"].tolist(), pa.list_(pa.float64())), how.quantum)
        tree = spanning_tree(x)
        return pd.DataFrame({"block": [key[0]], "a_ids": [part["vec_id"].to_numpy(np.int64).tobytes()],
                             "a_keys": [part["key"].to_numpy(np.int64).tobytes()], "a_labels": [part["label"].to_numpy(np.int64).tobytes()],
                             "a_x": [x.tobytes()], "t_order": [tree.order.astype(np.int64).tobytes()],
                             "t_parent": [tree.parent.astype(np.int64).tobytes()], "t_edge": [tree.edge.tobytes()]})

    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), F.lit(n_blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(
        build, "block int, a_ids binary, a_keys binary, a_labels binary, a_x binary, t_order binary, t_parent binary, t_edge binary")


def met(blocks: DataFrame, packed: DataFrame) -> DataFrame:
    """Every anchor block beside every chunk."""
    n_blocks, n_chunks = blocks.count(), packed.count()
    every = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(n_blocks, 1) - 1))))
    if n_blocks <= FEW_BLOCKS:
        return every.join(sized(blocks, FEW_BLOCKS), "block")
    parts = max(1, -(-n_chunks * CHUNK // PART_ROWS))
    return (every.withColumn("part", F.pmod(F.xxhash64("ids", "keys"), F.lit(parts)).cast("int"))
            .join(blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))), ["block", "part"]))


def _over_pairs(find: Callable[[dict, Rows, Rows, Tree], list[tuple]], names: list[str]):
    """Function for ``mapInArrow`` over rows of ``met``; ``find`` gives the result rows of one block and chunk, all of whole numbers."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():  # a few rows, each a block and a chunk
                tree = Tree(np.frombuffer(r["t_order"], np.int64), np.frombuffer(r["t_parent"], np.int64), np.frombuffer(r["t_edge"], np.float64))
                out = find(r, Rows.of(r, "a_"), Rows.of(r, ""), tree)
                cols = list(zip(*out, strict=True)) if out else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([pa.array([max(-LONG, min(LONG, int(v))) for v in c], pa.int64()) for c in cols], names=names)
    return run


def _positives(how: Mining):
    def find(r: dict, a: Rows, c: Rows, tree: Tree) -> list[tuple]:
        def others(i):
            return (c.labels == a.labels[i]) & ~((c.ids == a.ids[i]) & (c.keys == a.keys[i]))

        def needed(i, low, high):
            ok = others(i)
            return ok & (high >= kth(low[ok], how.positives))

        out = []
        for i, at, exact in walk(tree, a.x, c.x, needed):
            mine = others(i)[at]
            at, exact = at[mine], exact[mine]
            out += [(r["block"], i, c.ids[at[j]], c.keys[at[j]], exact[j]) for j in best(exact, c.ids[at], c.keys[at], how.positives)]
        return out
    return _over_pairs(find, ["block", "slot", "id", "key", "score"])


def window(score: int, how: Mining) -> tuple[int, int]:
    """Least and greatest whole score between the two percentages of ``score``."""
    return -((-how.low * score) // 100), (how.high * score) // 100


def _negatives(how: Mining):
    def find(r: dict, a: Rows, c: Rows, tree: Tree) -> list[tuple]:
        wanted: dict[int, list[tuple]] = {}
        for p in r["positives"]:
            lo, hi = window(p["score"], how)
            if lo <= hi:
                wanted.setdefault(p["slot"], []).append((p["place"], lo, hi))

        def needed(i, low, high):
            out = np.zeros(len(low), dtype=bool)
            if i not in wanted:
                return out
            ok = c.labels != a.labels[i]
            for _, lo, hi in wanted[i]:
                inside = ok & (low >= lo) & (high <= hi)
                out |= ok & (low <= hi) & (high >= max(lo, kth(low[inside], how.negatives)))
            return out

        out = []
        for i, at, exact in walk(tree, a.x, c.x, needed):
            if i not in wanted:
                continue
            ok = c.labels[at] != a.labels[i]
            for place, lo, hi in wanted[i]:
                inside = np.flatnonzero(ok & (exact >= lo) & (exact <= hi))
                some = at[inside]
                out += [(r["block"], i, place, c.ids[some[j]], c.keys[some[j]], exact[inside[j]])
                        for j in best(exact[inside], c.ids[some], c.keys[some], how.negatives)]
        return out
    return _over_pairs(find, ["block", "slot", "place", "id", "key", "score"])


def ranked(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    """The ``k`` highest scores of each group, numbered from 1; Spark cuts groups before the shuffle too."""
    order: list[Column] = [F.col("score").desc(), F.col("id"), F.col("key")]
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def positives(blocks: DataFrame, packed: DataFrame, how: Mining) -> DataFrame:
    """(block, slot, place, id, key, score): the likest rows of each anchor's label."""
    found = met(blocks, packed).mapInArrow(_positives(how), "block long, slot long, id long, key long, score long")
    return ranked(found, ["block", "slot"], how.positives, "place")


def hard_negatives(vectors: DataFrame, how: Mining | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label)."""
    how = how or Mining()
    rows = stage(usable(vectors, how.quantum), "vectors")
    packed = stage(chunks(rows, how.quantum), "chunks")
    blocks = stage(anchor_blocks(rows, how), "anchors")
    near = stage(positives(blocks, packed, how), "positives")
    # at most some BLOCK * how.positives structs in a row
    sought = near.groupBy("block").agg(F.collect_list(F.struct("slot", "place", "score")).alias("positives"))
    windows = stage(blocks.join(sought.withColumn("block", F.col("block").cast("int")), "block", "left")
                    .withColumn("positives", F.coalesce("positives", F.array().cast(sought.schema["positives"].dataType))), "windows")
    found = met(windows, packed).mapInArrow(_negatives(how), "block long, slot long, place long, id long, key long, score long")
    top = ranked(found, ["block", "slot", "place"], how.negatives, "rank")

    def named(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["a_ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), r["block"]), pa.int64()), pa.array(np.arange(len(ids)), pa.int64()), pa.array(ids)],
                                                 names=["block", "slot", "anchor_id"])

    anchors = blocks.select("block", "a_ids").mapInArrow(named, "block long, slot long, anchor_id long")
    pairs = near.select("block", "slot", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).join(anchors, ["block", "slot"])
    return pairs.join(top, ["block", "slot", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
