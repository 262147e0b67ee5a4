"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND.

Every training document is read in passages, windows of words that overlap by half and
hold any test item whole.  A passage is a query; its score for an item is BM25 over the
items, divided by the item's score for its own text, so 1 means that every weighted
word of the item is there.  All items above a threshold are retrieved, and stay only if
the passage holds enough of the word runs of their question and of their answer.

WAND, for a block of passages at once: terms with long posting lists cannot lift an
item over the threshold alone.  Their lists are not opened; their greatest weights in
each block of items bound what they could add.  The short lists give the candidates,
those whose sum with that bound misses the threshold are dropped, and the rest are
scored in full.  The bound is exact, so nothing above the threshold is lost.

The index is made of ``Rule.shard`` items at a time and broadcast; more items are further
passes over the documents, so no broadcast grows with the benchmark.  Document frequencies
and lengths are those of all items, so the number of passes changes no score.  Items longer
than half a window are indexed in pieces; a short last piece reaches back into the one before.

Defined results: items without words, or null, match nothing; documents that are null
or without words have no match; repeated items count once; a document is judged by its own
text, so of rows with one id, or none, only those with a leaking text leak; an item of fewer
words than a run is a run itself; an item without an id is shown as -1; empty tables give no match.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm import bytewise as B
from kerbline.llm.base import fresh, sized
from kerbline.staging import stage

K1, BM25_B = 1.2, 0.75
NO_ID = -1  # shown for an item without an id
ITEM_BLOCK = 8  # items that share a bound
ROOM = 1 << 22  # bounds and postings held at once


@dataclass(frozen=True)
class Rule:
    threshold: float = 0.6  # share of an item's own score
    overlap: float = 0.5  # share of its question's and its answer's word runs
    run: int = 5  # words
    answer: float = 0.25  # last part of an item's words that is its answer
    half: int = 128  # words between the starts of passages at most, and of an indexed piece
    shard: int = 20_000  # items in one index


@dataclass(frozen=True)
class Index:
    items: np.ndarray  # item id of each piece
    terms: np.ndarray  # sorted hashes
    first: np.ndarray  # first posting of each term, and the end
    posted: np.ndarray  # piece of each posting
    weight: np.ndarray
    closed: np.ndarray  # row in ``bound`` of each term whose list stays closed, else -1
    bound: np.ndarray  # greatest weight of a closed term in each block of pieces
    own: list[np.ndarray]  # terms of each piece
    own_weight: list[np.ndarray]
    question: list[np.ndarray]  # sorted run hashes
    answer: list[np.ndarray]
    half: int  # words of the longest piece, and between the starts of passages


@dataclass(frozen=True)
class Statistics:
    """Of the pieces of all items."""

    pieces: int
    mean: float  # words of a piece
    longest: int
    terms: np.ndarray  # sorted hashes, those of a shard at least
    df: np.ndarray


def cut_items(ids: list[int], texts: list[str], rule: Rule) -> tuple[list[int], list[np.ndarray]]:
    """(item, word hashes) of the pieces of items."""
    items, pieces = [], []
    for block in B.blocks(pa.array(texts, pa.string())):
        w = B.words(block)
        h = B.hashes(block.data, w.starts, w.ends)
        for r in range(block.hi - block.lo):
            own = h[w.rows[r]:w.rows[r + 1]]
            for lo in range(0, len(own), rule.half):
                if lo and len(own) - lo < 2 * rule.run:
                    lo = len(own) - rule.half  # the rest alone is too short to tell
                items.append(ids[block.lo + r])
                pieces.append(own[lo:lo + rule.half])
    return items, pieces


def build(ids: list[int], texts: list[str], rule: Rule, of: Statistics | None = None) -> Index | None:
    """Index of a shard of items; without ``of`` they are all items."""
    items, pieces = cut_items(ids, texts, rule)
    if not pieces:
        return None
    lengths = np.array([len(p) for p in pieces], dtype=float)
    kinds = [np.unique(p, return_counts=True) for p in pieces]
    terms, df = np.unique(np.concatenate([k for k, _ in kinds]), return_counts=True)
    if of is None:
        of = Statistics(len(pieces), float(lengths.mean()), int(lengths.max()), terms, df)
    norm = K1 * (1 - BM25_B + BM25_B * lengths / of.mean)
    common = of.df[np.searchsorted(of.terms, terms)]
    idf = np.log1p((of.pieces - common + 0.5) / (common + 0.5))
    own = [np.searchsorted(terms, k) for k, _ in kinds]
    own_weight = []
    for i, (t, (_, tf)) in enumerate(zip(own, kinds, strict=True)):
        x = idf[t] * tf * (K1 + 1) / (tf + norm[i])
        own_weight.append(x / x.sum())
    term = np.concatenate(own)
    order = np.argsort(term, kind="stable")
    posted = np.repeat(np.arange(len(pieces)), [len(t) for t in own])[order]
    weight = np.concatenate(own_weight)[order]
    first = np.concatenate([[0], np.cumsum(df)])
    # the longest lists stay closed, as long as all of them together stay below half the threshold for every piece
    closed = np.zeros(len(terms), dtype=bool)
    room = np.full(len(pieces), rule.threshold / 2)
    for t in np.argsort(-df, kind="stable"):
        if df[t] < 4:
            break
        at = slice(first[t], first[t + 1])
        if (room[posted[at]] >= weight[at]).all():
            room[posted[at]] -= weight[at]
            closed[t] = True
    n_blocks = -(-len(pieces) // ITEM_BLOCK)
    row = np.where(closed, np.cumsum(closed) - 1, -1)
    bound = np.zeros((int(closed.sum()), n_blocks), dtype=np.float32)
    shut = row[term[order]] >= 0
    np.maximum.at(bound, (row[term[order]][shut], posted[shut] // ITEM_BLOCK), weight[shut].astype(np.float32))
    question, answer = [], []
    for p in pieces:
        cut = len(p) - max(1, int(len(p) * rule.answer)) if len(p) > 1 else 1
        runs = [np.unique(B.shingles(x, np.array([0, len(x)]), rule.run)[0]) for x in (p[:cut], p[cut:])]
        question.append(runs[0])
        answer.append(runs[1])
    return Index(np.array(items), terms, first, posted, weight, row, bound, own, own_weight, question, answer, of.longest)


def candidates(passage: np.ndarray, term: np.ndarray, n_passages: int, ix: Index, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(passage, piece) pairs that may reach the threshold.  Input: distinct (passage, term) pairs in order.

    Passages are taken so many at once that their bounds and postings stay in ``ROOM``.
    """
    postings = np.where(ix.closed[term] >= 0, 0, ix.first[term + 1] - ix.first[term])
    per = np.bincount(passage, weights=postings, minlength=n_passages) + ix.bound.shape[1]
    group = (np.cumsum(per) // ROOM).astype(np.int64)
    if not len(group) or group[-1] == group[0]:
        return _some_candidates(passage, term, n_passages, ix, threshold)
    found = []
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [n_passages]])
    at = np.searchsorted(passage, cuts)
    for lo, hi, a, b in zip(cuts, cuts[1:], at, at[1:], strict=False):
        p, i = _some_candidates(passage[a:b] - lo, term[a:b], int(hi - lo), ix, threshold)
        found.append((p + lo, i))
    return np.concatenate([p for p, _ in found]), np.concatenate([i for _, i in found])


def _some_candidates(passage: np.ndarray, term: np.ndarray, n_passages: int, ix: Index, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(ix.items)
    rest = np.zeros((n_passages, ix.bound.shape[1]), dtype=np.float32)
    shut = ix.closed[term] >= 0
    if shut.any():
        p, t = passage[shut], term[shut]
        starts = np.flatnonzero(np.diff(p, prepend=-1))
        rest[p[starts]] = np.add.reduceat(ix.bound[ix.closed[t]], starts, axis=0)
    p, t = passage[~shut], term[~shut]
    size = ix.first[t + 1] - ix.first[t]
    total = int(size.sum())
    if not total:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at = np.repeat(ix.first[t] - (np.cumsum(size) - size), size) + np.arange(total)
    key = np.repeat(p, size) * n + ix.posted[at]
    if n_passages * n <= 1 << 24:
        sums = np.bincount(key, weights=ix.weight[at], minlength=n_passages * n)
        found = np.flatnonzero(sums)
        got = sums[found]
    else:
        found, inverse = np.unique(key, return_inverse=True)
        got = np.bincount(inverse, weights=ix.weight[at])
    keep = got + rest[found // n, found % n // ITEM_BLOCK] >= threshold - 1e-6
    return found[keep] // n, found[keep] % n


def matches(block: B.Block, ix: Index, rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, item id, score) of each verified match of a block of texts, the best passage of each row and item."""
    w = B.words(block)
    none = np.zeros(0, dtype=np.int64)
    if not len(w.starts):
        return none, none, none.astype(float)
    h = B.hashes(block.data, w.starts, w.ends)
    row = w.row_of()
    n_words = np.diff(w.rows)
    # passage k of a row holds its words from k * half to (k + 2) * half; the last one is the row's tail
    per = np.maximum(-(-n_words // ix.half) - 1, (n_words > 0).astype(n_words.dtype))
    base = np.cumsum(per) - per
    at = np.minimum(np.searchsorted(ix.terms, h), len(ix.terms) - 1)
    hit = np.flatnonzero(ix.terms[at] == h)
    if not len(hit):
        return none, none, none.astype(float)
    half = (hit - w.rows[row[hit]]) // ix.half
    of = base[row[hit]]
    last = per[row[hit]] - 1
    both = np.concatenate([of + np.minimum(half, last), of + np.clip(half - 1, 0, last)])
    n_terms = len(ix.terms)
    pairs = np.unique(both * n_terms + np.concatenate([at[hit], at[hit]]))
    passage, term = pairs // n_terms, pairs % n_terms
    p, piece = candidates(passage, term, int(per.sum()), ix, rule.threshold)
    out = {}
    begin = np.searchsorted(passage, np.arange(int(per.sum()) + 1))
    owner = np.repeat(np.arange(len(per)), per)
    for q, i in zip(p.tolist(), piece.tolist(), strict=True):
        here = term[begin[q]:begin[q + 1]]
        mine = ix.own[i]
        where = np.minimum(np.searchsorted(here, mine), len(here) - 1)
        score = float(ix.own_weight[i][here[where] == mine].sum())
        if score < rule.threshold:
            continue
        r = int(owner[q])
        lo = w.rows[r] + (q - base[r]) * ix.half
        words = h[lo:min(lo + 2 * ix.half, w.rows[r + 1])]
        if _overlap(words, ix.question[i], rule) and _overlap(words, ix.answer[i], rule):
            key = (r, int(ix.items[i]))
            out[key] = max(out.get(key, 0.0), min(score, 1.0))
    if not out:
        return none, none, none.astype(float)
    r, item = (np.array(x, dtype=np.int64) for x in zip(*out, strict=True))
    return r, item, np.array(list(out.values()))


def _overlap(words: np.ndarray, runs: np.ndarray, rule: Rule) -> bool:
    """Whether enough of ``runs`` are in the passage; runs of fewer words are looked for at their own length."""
    if not len(runs):
        return True
    found = 0
    for size in range(1, rule.run + 1):
        if size < rule.run and len(runs) > 1:
            continue  # only a short text has short runs, and then a single one
        if len(words) >= size:
            have = B.shingles(words, np.array([0, len(words)]), size)[0]
            found += int(np.isin(runs, have).sum())
    return found >= rule.overlap * len(runs)


def _terms(rule: Rule):
    """Function for ``mapInArrow``: every term of every piece once, and a row without a term for the pieces of a batch."""
    def run(batches):
        for batch in batches:
            _, pieces = cut_items([0] * batch.num_rows, batch.column("text").to_pylist(), rule)
            if not pieces:
                continue
            terms = np.concatenate([np.unique(p) for p in pieces])
            size = np.array([len(p) for p in pieces])
            yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.nulls(len(terms), pa.int64()), pa.nulls(len(terms), pa.int64())], names=["term", "words", "pieces"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(size), pa.int64()), pa.array(size), pa.array(np.ones(len(size), dtype=np.int64))], names=["term", "words", "pieces"])
    return run


def statistics(items: DataFrame, rule: Rule) -> tuple[int, float, int, DataFrame] | None:
    """(pieces, mean and greatest number of words, stage table (term, df)) of all items; None if they have no word."""
    rows = stage(items.select("text").mapInArrow(_terms(rule), "term long, words long, pieces long"), "item-terms")
    n, words, longest = rows.agg(F.sum("pieces"), F.avg("words"), F.max("words")).first()
    if not n:
        return None
    return n, words, longest, stage(rows.where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("df")), "item-df")


def leaks(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """(doc_id, body, item_id, score) of each verified match; ``body`` is a hash of the text.  ``benchmark``: (item_id, text)."""
    rule = rule or Rule()
    spark = docs.sparkSession
    items = benchmark.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("long"), F.lit(NO_ID)).alias("item_id"), "text").distinct()
    items = stage(items, "items")
    shards = max(1, -(-items.count() // rule.shard))
    if not (seen := statistics(items, rule)):
        return docs.select("doc_id", F.lit(0).cast("long").alias("body"), F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("score")).limit(0)
    pieces, mean, longest, df = seen
    docs = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    out = None
    for k in range(shards):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).orderBy("item_id", "text")
        got = mine.select("item_id", "text").toArrow()  # about ``shard`` items
        here = df.join(mine.select("text").mapInArrow(_terms(rule), "term long, words long, pieces long").select("term").distinct(), "term").orderBy("term").toArrow()
        terms = here.column("term").to_numpy().view(np.uint64)
        order = np.argsort(terms)
        of = Statistics(pieces, mean, longest, terms[order], here.column("df").to_numpy()[order])
        ix = build(got.column("item_id").to_pylist(), got.column("text").to_pylist(), rule, of)
        if ix is None:
            continue
        shared = spark.sparkContext.broadcast(ix)

        def run(batches, shared=shared):
            for batch in batches:
                for block in B.blocks(batch.column("text")):
                    r, item, score = matches(block, shared.value, rule)
                    keys = [batch.column(c).slice(block.lo, block.hi - block.lo).take(pa.array(r)) for c in ("doc_id", "body")]
                    yield pa.RecordBatch.from_arrays([*keys, pa.array(item), pa.array(score)], names=["doc_id", "body", "item_id", "score"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        found = docs.mapInArrow(run, f"doc_id {kind}, body long, item_id long, score double")
        out = found if out is None else out.unionByName(found)
    return out


def judged(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """(doc_id, item_ids, best, leaked), one row per document; ``item_ids`` in order, empty where nothing leaked."""
    found = stage(leaks(docs, benchmark, rule), "leaks")
    per = found.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("score").alias("best"))
    per = sized(stage(per.withColumnsRenamed({"doc_id": "leak_id", "body": "leak_body"}), "leaked"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("body"))
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.col("body") == F.col("leak_body")), "left")
    return joined.select("doc_id", F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                         F.coalesce("best", F.lit(0.0)).alias("best"), F.col("item_ids").isNotNull().alias("leaked"))


def clean(docs: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """``docs`` less every document that holds a test item."""
    key = fresh(docs.columns, "leak_id")
    body = fresh([*docs.columns, key], "leak_body")
    gone = sized(stage(leaks(docs, benchmark, rule).select(F.col("doc_id").alias(key), F.col("body").alias(body)).distinct(), "leaked"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone[key]) & (F.xxhash64(docs["text"]) == gone[body]), "left_anti")
