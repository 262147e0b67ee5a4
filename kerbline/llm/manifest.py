"""Merkle manifest of a dataset, kept as a postorder append log.

Every row is a leaf.  Each source has a tree of fan-in 16 over its leaves, in order of
their ids, and the roots of the sources are the leaves of one more tree.  Aligned
builders each take a run of up to 4096 leaves, whose subtree is complete in itself, and
write its nodes in the order in which they are completed.  Such a segment is a
contiguous stretch of the tree's postorder log; further rounds of builders do the same
over the segments' roots.

The place of a node in the log follows from its level and number alone (`position`),
as the sizes of all subtrees before it are known.  Proofs are read by these places: the
siblings inside a segment from the segment itself, and what lies above from a path
handed down once per segment, so no leaf is joined with its siblings.

A hot source only has more segments.  Ranks come from a range partition, not from a
window over a source.

Defined results: null fields count as ``-``; a null source is a source of its own, first
in order; null ids come first in their source and are never tampered with; rows of equal
id are ordered by their leaves, and repeated rows are leaves of their own; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.staging import stage

FAN = 16
LEVELS = 3  # levels that a builder adds, so it takes 4096 leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SIZE = 32


def position(level: int, number: int, leaves: int) -> int:
    """Place in the postorder log of node ``number`` of a level, in a tree over so many leaves.

    The node is completed with its last leaf: before it stand that many leaves, one node
    for every full run at every level, and the lower nodes completed with the same leaf.
    """
    last = min((number + 1) * FAN ** level, leaves) - 1
    place, runs = last + level, last // FAN
    while runs:
        place, runs = place + runs, runs // FAN
    return place


def depth(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def digest(data: bytes) -> bytes:
    """SHA-256 over digests written as hexadecimal text."""
    return hashlib.sha256(data.hex().encode()).digest()


def grown(leaves: list[bytes], levels: int) -> bytes:
    """All nodes of the subtree in the order of their completion."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def close(level: int) -> None:
        node = digest(b"".join(open_[level]))
        open_[level] = []
        open_[level + 1].append(node)
        log.append(node)

    for leaf in leaves:
        log.append(leaf)
        open_[0].append(leaf)
        level = 0
        while level < levels and len(open_[level]) == FAN:
            close(level)
            level += 1
    for level in range(levels):
        if open_[level]:
            close(level)
    return b"".join(log)


def raised(leaves: int, whole: bool, levels: int) -> int:
    """Levels of a segment over so many leaves: up to the root of its tree, or up to where the next builder begins."""
    return depth(leaves) if whole else levels


def siblings(nodes: bytes, leaves: int, levels: int) -> Iterator[list[tuple[bytes, bytes]]]:
    """For each leaf of a segment: what stands before and after it in its run, level by level."""
    runs: list[list[bytes]] = []
    for level in range(levels):
        n = -(-leaves // FAN ** level)
        at = [SIZE * position(level, i, leaves) for i in range(n)]
        runs.append([b"".join(nodes[p:p + SIZE] for p in at[lo:lo + FAN]) for lo in range(0, n, FAN)])
    for i in range(leaves):
        out = []
        for level in range(levels):
            own = i // FAN ** level
            run, cut = runs[level][own // FAN], SIZE * (own % FAN)
            out.append((run[:cut], run[cut + SIZE:]))
        yield out


def folded(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(docs: DataFrame, text: Column) -> Column:
    parts = [field(text if c == "text" else docs[c]) for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tree_key(source: Column) -> Column:
    """Name of a source's tree; names are in order of their bytes, null first."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit(":"), source))


def ordered(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Stage table of ``rows`` with ``idx``, the place in the group by ``order``, and ``n``, the size of the group.

    Ordered ranges are written with the number of each row in its range; a group's
    counts in the ranges before give the rest, so no group is sorted by one task.
    """
    place = F.monotonically_increasing_id()
    dealt = rows.withColumn("_place", place).repartitionByRange(*keys, *order, F.col("_place")).sortWithinPartitions(*keys, *order, F.col("_place"))
    dealt = stage(dealt.drop("_place").withColumn("_at", F.monotonically_increasing_id()), f"{name}-order")
    part = F.shiftright(F.col("_at"), 33)
    per = dealt.groupBy(*keys, part.alias("_part")).agg(F.count("*").alias("_c"), F.min("_at").alias("_first"))
    w = W.partitionBy(*keys).orderBy("_part")  # as many rows as the group has ranges
    before = per.select(*keys, "_part", "_first", F.coalesce(F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                        F.sum("_c").over(W.partitionBy(*keys)).alias("n"))
    return (dealt.withColumn("_part", part).join(before, [*keys, "_part"])
            .withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_first", "_before", "_at"))


def _builder(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = []
            lists = batch.column("rows")
            at = lists.offsets.to_pylist()
            leaves = lists.values.field("digest").slice(at[0], at[-1] - at[0]).to_pylist()
            for lo, hi, whole in zip(at, at[1:], batch.column("whole").to_pylist(), strict=False):
                nodes.append(grown(leaves[lo - at[0]:hi - at[0]], raised(hi - lo, whole, levels)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=[*batch.schema.names, "nodes"])
    return run


def segments(leaves: DataFrame, name: str, levels: int = LEVELS) -> list[DataFrame]:
    """Rounds of segments over (tree, idx, n, digest, ...): each (tree, block, n, whole, rows, nodes).

    ``n`` is the number of leaves of the tree; ``rows`` are what the segment was built
    over, in order; ``whole`` marks the segment that ends in the tree's root.
    """
    rounds: list[DataFrame] = []
    span = FAN ** levels
    most = leaves.agg(F.max("n")).first()[0] or 0
    below = leaves.withColumn("units", F.col("n"))
    while True:
        kept = [c for c in below.columns if c not in ("tree", "n", "units")]
        built = (below.withColumn("block", F.expr(f"idx div {span}")).groupBy("tree", "block", "n", "units")
                 .agg(F.array_sort(F.collect_list(F.struct("idx", *[c for c in kept if c != "idx"]))).alias("rows"))
                 .select("tree", "block", "n", (F.col("units") <= span).alias("whole"), "rows"))
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in built.schema.fields)
        rounds.append(stage(built.mapInArrow(_builder(levels), f"{schema}, nodes binary"), f"{name}-segments"))
        if most <= span:
            return rounds
        most = -(-most // span)
        reach = span ** len(rounds)
        below = rounds[-1].where("NOT whole").select(
            "tree", F.col("block").alias("idx"), "n", F.expr(f"substring(nodes, -{SIZE}, {SIZE})").alias("digest"),
            F.expr(f"(n + {reach - 1}) div {reach}").alias("units"))


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    out = None
    for r in rounds:
        part = r.where("whole").select("tree", F.expr(f"substring(nodes, -{SIZE}, {SIZE})").alias("digest"))
        out = part if out is None else out.unionByName(part)
    return out


PATH = "array<struct<before: binary, after: binary>>"


def _down(emit: Callable[[pa.RecordBatch, int, list, Iterator, list], list[tuple]], names: list[str], types: list[pa.DataType], levels: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("rows")[k].as_py()
                nodes, whole = batch.column("nodes")[k].as_py(), batch.column("whole")[k].as_py()
                above = [(p["before"], p["after"]) for p in batch.column("path")[k].as_py()]
                paths = siblings(nodes, len(rows), raised(len(rows), whole, levels))
                out = emit(batch, k, rows, paths, above)
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
    return run


def under(rounds: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """First-round segments, each with ``path``: before and after of every run from its root up.

    ``above``: (tree, subroot, root, path) of every tree.
    """
    kept = ["tree", "block", "n", "whole", "rows", "nodes", "subroot", "root", "path"]
    down = None
    for k in reversed(range(len(rounds))):
        full = rounds[k].where("whole").join(above, "tree").select(*kept)
        if down is not None:
            full = full.unionByName(rounds[k].where("NOT whole").join(down, ["tree", "block"]).select(*kept))
        if k:
            def children(batch, i, rows, paths, top):
                tree, sub, root = (batch.column(c)[i].as_py() for c in ("tree", "subroot", "root"))
                return [(tree, r["idx"], sub, root, [{"before": b, "after": a} for b, a in [*own, *top]]) for r, own in zip(rows, paths, strict=True)]

            pair = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
            down = full.mapInArrow(_down(children, ["tree", "block", "subroot", "root", "path"], [pa.string(), pa.int64(), pa.binary(), pa.binary(), pair], levels),
                                   f"tree string, block long, subroot binary, root binary, path {PATH}")
    return full


def log(rounds: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """(tree, position, level, number, digest): the append log of every tree."""
    out, span = None, FAN ** levels
    for k, r in enumerate(rounds):
        def entries(batches, k=k):
            for batch in batches:
                for b in batch.select(["tree", "block", "n", "whole", "nodes"]).to_pylist():
                    n = min(-(-b["n"] // span ** k) - b["block"] * span, span)
                    found = []
                    for level in range(min(k, 1), raised(n, b["whole"], levels) + 1):
                        for i in range(-(-n // FAN ** level)):
                            number, p = b["block"] * FAN ** (levels - level) + i, SIZE * position(level, i, n)
                            found.append((b["tree"], position(levels * k + level, number, b["n"]), levels * k + level, number, b["nodes"][p:p + SIZE]))
                    if found:
                        cols = list(zip(*found, strict=True))
                        types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                                         names=["tree", "position", "level", "number", "digest"])
        part = r.mapInArrow(entries, "tree string, position long, level int, number long, digest binary")
        out = part if out is None else out.unionByName(part)
    return out


class Manifest:
    """Logs of all trees: one per source, and the tree over their roots."""

    def __init__(self, docs: DataFrame, changed: Column | None = None, levels: int = LEVELS):
        """``changed``: digest of the row as it is found later, null where it is as it was; ``levels`` of a builder."""
        self.levels = levels
        leaf = leaf_of(docs, docs["text"])
        rows = docs.select(tree_key(docs["source"]).alias("tree"), "doc_id", leaf.alias("digest"),
                           (F.lit(None).cast("binary") if changed is None else changed).alias("changed"))
        self.leaves = ordered(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest")], "leaves")
        self.sources = segments(self.leaves, "sources", levels)
        subroots = roots(self.sources).select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
        self.subroots = ordered(subroots, ["tree"], [F.col("of")], "subroots")
        self.top = segments(self.subroots, "top", levels)

    def paths(self) -> DataFrame:
        """First-round segments of the sources with all that lies above them."""
        none = F.array().cast(PATH)
        ends = under(self.top, roots(self.top).select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"), none.alias("path")), self.levels)

        def each(batch, i, rows, paths, top):
            root = batch.column("root")[i].as_py()
            return [(r["of"], r["digest"], root, [{"before": b, "after": a} for b, a in [*own, *top]]) for r, own in zip(rows, paths, strict=True)]

        pair = pa.list_(pa.struct([("before", pa.binary()), ("after", pa.binary())]))
        above = ends.mapInArrow(_down(each, ["tree", "subroot", "root", "path"], [pa.string(), pa.binary(), pa.binary(), pair], self.levels),
                                f"tree string, subroot binary, root binary, path {PATH}")
        return under(self.sources, stage(above, "above"), self.levels)


def verified(docs: DataFrame, changed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, digests as hexadecimal text."""
    made = Manifest(docs, changed, levels)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column("rows")
            for k in range(batch.num_rows):
                rows = lists[k].values
                leaves, later = rows.field("digest").to_pylist(), rows.field("changed").to_pylist()
                sub, root = (batch.column(c)[k].as_py() for c in ("subroot", "root"))
                above = [(p["before"], p["after"]) for p in batch.column("path")[k].as_py()]
                upper = b"".join(b + a for b, a in above)
                proofs, tops = [], []
                n = len(leaves)
                inside = siblings(batch.column("nodes")[k].as_py(), n, raised(n, batch.column("whole")[k].as_py(), levels))
                for leaf, new, own in zip(leaves, later, inside, strict=True):
                    proofs.append(digest(b"".join(b + a for b, a in own) + upper).hex())
                    tops.append(folded(new or leaf, [*own, *above]).hex())
                yield pa.RecordBatch.from_arrays(
                    [rows.field("doc_id"), pa.array([x.hex() for x in leaves]), pa.array([sub.hex()] * n), pa.array([root.hex()] * n), pa.array(proofs), pa.array(tops)],
                    names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    out = made.paths().mapInArrow(run, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lower_case_tampering(docs: DataFrame, every: int = 5) -> Column:
    """Digest of a row whose text's capitals A-Z became small, where ``every`` divides the id's CRC-32; else null."""
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % every == 0
    return F.when(hit, leaf_of(docs, F.translate(docs["text"], UPPER, LOWER)))
