"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad.  Its features tell how it is written (capitals, symbols,
repeated words, word lengths, ...), and those of the lines before and after it count
too.  Forward-backward gives each line's probability of being good; weighted by the
lines' lengths they make the document's quality.

The field is fitted on a bounded sample of labelled documents: ``Fit.docs`` per label,
by hash of the id, longer ones than ``Fit.chars`` only where there are too few others,
and ``Fit.lines`` lines of each at most; lines take their document's label.
The features of the sample are made by the executors, the fit itself is a few hundred
gradient steps on the driver.  Scoring reads whole texts.

Defined results: null text, and text without words, has score 0 (nothing good in it);
blank lines carry no weight; without labels of both kinds every text with words scores
0.5; repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from kerbline.llm import bytewise as B
from kerbline.llm.base import fresh, held_out
from kerbline.staging import stage

THRESHOLD = 0.3


@dataclass(frozen=True)
class Fit:
    docs: int = 2000  # labelled documents per label at most
    chars: int = 100_000  # longer documents come last
    lines: int = 2000  # first lines of a document of the sample
    steps: int = 150
    rate: float = 0.1
    ridge: float = 1e-3


@dataclass(frozen=True)
class Field:
    """Weights of (line, before, after) features with a bias, and the log-odds of staying in a state."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    stay: np.ndarray  # 2 x 2 transition scores, [from, to], 0 bad, 1 good

    def potentials(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return chained((x - self.mean) / self.scale, starts) @ self.weights


UPPER = np.zeros(256)
UPPER[65:91] = 1
LETTER = UPPER.copy()
LETTER[97:123] = 1
LETTER[192:] = 1  # a byte that begins a letter beyond ASCII
DIGIT = np.zeros(256)
DIGIT[48:58] = 1
MARK = np.zeros(256)
MARK[[44, 46, 63, 58, 59]] = 1
SYMBOL = np.zeros(256)
SYMBOL[33:127] = 1
SYMBOL -= np.where(SYMBOL > 0, LETTER + DIGIT + MARK, 0)
LEAD = np.ones(256)
LEAD[128:192] = 0
FEATURES = 10


def line_features(block: B.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, lengths, row bounds) of the lines that hold a word, in order."""
    data, words = block.data, B.words(block)
    n_rows = len(block.bounds) - 1
    cuts = np.flatnonzero(data == 10)
    begins = np.unique(np.concatenate([block.bounds[:-1], cuts + 1]))
    begins = begins[begins < len(data)]
    line = np.searchsorted(begins, words.starts, "right") - 1  # line of each word
    held, first = np.unique(line, return_index=True)
    if not len(held):
        return np.zeros((0, FEATURES)), np.zeros(0), np.zeros(n_rows + 1, dtype=np.int64)
    ends = np.append(first[1:], len(line))
    n = (ends - first).astype(float)
    lo, hi = words.starts[first], words.ends[ends - 1]

    def share(table: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[data])])
        return total[hi] - total[lo]

    length = np.maximum(share(LEAD), 1)
    letters = np.maximum(share(LETTER), 1)
    hashed = B.hashes(data, words.starts, words.ends)
    of = np.repeat(np.arange(len(held)), ends - first)
    key = (hashed >> np.uint64(24)) ^ (of.astype(np.uint64) << np.uint64(40))
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    kinds = np.bincount(of[order][fresh], minlength=len(held))
    again = np.zeros(len(hashed))
    again[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    sizes = (words.ends - words.starts).astype(float)
    alone = np.bincount(of, weights=(sizes == 1) & (SYMBOL[data[words.starts]] > 0), minlength=len(held))
    mean = np.bincount(of, weights=sizes, minlength=len(held)) / n
    x = np.column_stack([
        share(UPPER) / letters, share(SYMBOL) / length, share(DIGIT) / length, share(MARK) / n,
        letters / length, kinds / n, np.bincount(of, weights=again, minlength=len(held)) / n, alone / n,
        np.log1p(n), np.minimum(mean, 40) / 10])
    row = np.searchsorted(block.bounds, lo, "right") - 1
    return x, length, np.searchsorted(row, np.arange(n_rows + 1))


def chained(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Features of each line, of the line before and the line after (zero at the ends of a document), and a bias.

    ``starts`` are the first lines of the documents.
    """
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[starts] = 0
    after[starts[starts > 0] - 1] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1))])


def _padded(starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents ordered by number of lines, longest first: (first line, number of lines)."""
    sizes = np.diff(np.append(starts, n))
    order = np.argsort(-sizes, kind="stable")
    return starts[order], sizes[order]


def marginals(score: np.ndarray, starts: np.ndarray, stay: np.ndarray, pairs: bool = False):
    """P(good) of each line by forward-backward, all documents abreast; with ``pairs`` also the summed pair marginals.

    ``score`` is the log-odds of good over bad of a line by itself; every document of ``starts`` has a line.
    """
    n = len(score)
    first, sizes = _padded(starts, n)
    m = np.exp(stay - stay.max())
    emit = np.empty((n, 2))
    emit[:, 1] = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
    emit[:, 0] = 1 - emit[:, 1]
    emit = np.maximum(emit, 1e-20)
    ahead, back = np.empty((n, 2)), np.ones((n, 2))
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(1, longest + 1), "right")  # documents with more than t lines
    for t in range(longest):
        at = first[:live[t]] + t
        f = emit[at] if t == 0 else (ahead[at - 1] @ m) * emit[at]
        ahead[at] = f / f.sum(1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = first[:live[t + 1]] + t
        b = (emit[at + 1] * back[at + 1]) @ m.T
        back[at] = b / b.sum(1, keepdims=True)
    both = ahead * back
    good = both[:, 1] / both.sum(1)
    if not pairs:
        return good
    inner = np.ones(n, dtype=bool)
    inner[starts] = False
    i = np.flatnonzero(inner)
    xi = ahead[i - 1][:, :, None] * m[None] * (emit[i] * back[i])[:, None, :]
    xi /= xi.sum((1, 2), keepdims=True)
    return good, xi.sum(0), i


def fit(x: np.ndarray, starts: np.ndarray, good: np.ndarray, weight: np.ndarray, how: Fit) -> Field:
    """Field of greatest conditional likelihood, by Adam.  ``good`` and ``weight`` are per line."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = chained((x - mean) / scale, starts)
    w, stay = np.zeros(z.shape[1]), np.zeros((2, 2))
    inner = np.ones(len(x), dtype=bool)
    inner[starts] = False
    i = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[i - 1].astype(int), good[i].astype(int)), 1)
    theta = np.zeros(len(w) + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, how.steps + 1):
        w, stay = theta[:-4], theta[-4:].reshape(2, 2)
        p, pairs, _ = marginals(z @ w, starts, stay, pairs=True)
        g = np.concatenate([z.T @ ((good - p) * weight) / weight.sum(), ((seen - pairs) / len(x)).ravel()]) - how.ridge * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta + how.rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
    return Field(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def _line_rows(batches, lines: int):
    """One row per document: features of its first lines."""
    for batch in batches:
        for block in B.blocks(batch.column("text")):
            x, _, rows = line_features(block)
            n = np.minimum(np.diff(rows), lines)
            kept = np.concatenate([[0], np.cumsum(n)])
            x = x[np.repeat(rows[:-1] - kept[:-1], n) + np.arange(kept[-1])]
            rows = kept
            lists = pa.ListArray.from_arrays(pa.array((rows * FEATURES).astype(np.int32)), pa.array(x.ravel().astype(np.float32)))
            part = [batch.column(c).slice(block.lo, block.hi - block.lo) for c in ("doc_id", "good")]
            yield pa.RecordBatch.from_arrays([*part, lists], names=["doc_id", "good", "x"])


def train(docs: DataFrame, labels: DataFrame, how: Fit | None = None) -> Field | None:
    """Field fitted on labelled documents that are not held out; None without both labels.

    ``labels``: (doc_id, quality).  The sample is the ``docs`` first of each label by
    hash of the id, so it is the same at every run.
    """
    how = how or Fit()
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(5, 0)).select("doc_id", F.col("quality").alias("good")).distinct()
    # of several texts under one id the least by hash stands for it
    body = F.xxhash64("text")
    sizes = docs.where("text IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(body.alias("body"), F.length("text").alias("chars"))).alias("t"))
    known = stage(known.join(sizes, "doc_id").select("doc_id", "good", "t.body", (F.col("t.chars") > how.chars).alias("long")), "labelled")
    order = [F.col("long"), F.xxhash64("doc_id"), F.col("doc_id")]
    some = known.where("good = 0").orderBy(*order).limit(how.docs).unionByName(known.where("good = 1").orderBy(*order).limit(how.docs))
    few = F.broadcast(stage(some.drop("long"), "sample"))  # at most 2 * how.docs rows of three numbers
    texts = docs.select("doc_id", body.alias("body"), "text").join(few, ["doc_id", "body"]).dropDuplicates(["doc_id", "body", "good"])
    rows = texts.select("doc_id", "good", "text").mapInArrow(lambda b: _line_rows(b, how.lines), "doc_id long, good int, x array<float>").collect()
    rows = sorted((r for r in rows if r["x"]), key=lambda r: (r["doc_id"], r["good"]))
    if len({r["good"] for r in rows}) < 2:
        return None
    x = np.concatenate([np.asarray(r["x"], dtype=float).reshape(-1, FEATURES) for r in rows])
    sizes = np.array([len(r["x"]) // FEATURES for r in rows])
    good = np.repeat(np.array([r["good"] for r in rows], dtype=float), sizes)
    # a document counts as one, whatever its number of lines
    return fit(x, np.cumsum(sizes) - sizes, good, np.repeat(1 / sizes, sizes), how)


def quality_of(block: B.Block, field: Field | None) -> np.ndarray:
    """Quality of each row of a block."""
    x, length, rows = line_features(block)
    out = np.zeros(len(rows) - 1)
    full = np.flatnonzero(np.diff(rows))
    if not len(full):
        return out
    starts = rows[full]
    good = np.full(len(x), 0.5) if field is None else marginals(field.potentials(x, starts), starts, field.stay)
    out[full] = np.add.reduceat(good * length, starts) / np.add.reduceat(length, starts)
    return np.clip(out, 0.0, 1.0)


def _scored(field: Field | None, name: str):
    return lambda block: {name: pa.array(quality_of(block, field))}


def scores(docs: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, score) of every row."""
    return docs.select("doc_id", "text").mapInArrow(
        B.over_blocks(_scored(field, "score"), ["doc_id"]), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, field: Field | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores ``threshold`` or more; texts are scored in place, without a join."""
    name = fresh(docs.columns, "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    rows = docs.mapInArrow(B.over_blocks(_scored(field, name), docs.columns), schema)
    return rows.where(F.col(name) >= threshold).drop(name)
