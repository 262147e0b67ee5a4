"""Language of a text by its nearest centroid among several per language.

A text is a vector of TF-IDF weights of its letter runs' byte n-grams, hashed to
``DIMS`` places and of length 1.  Each language has up to ``Fit.centroids`` centroids,
found by spherical k-means; the most alike centroid, by cosine, names the language.
A text farther from it than the centroid's own members is marked as rejected.

Document frequencies count every text of a known language that is not held out.
Centroids are fitted on a bounded sample: about ``Fit.docs`` texts per language, by
hash of the id, none longer than ``Fit.chars``; a language with less than ``Fit.least``
of these is known by about so many longer ones too.

Defined results: a text that is null or has no letter is ``und`` with score 0 and
rejected; without any known language all texts are; equal cosines go to the first
language in order; repeated rows agree; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm import bytewise as B
from kerbline.llm.base import held_out
from kerbline.staging import stage

DIMS = 1 << 13
SIZES = (2, 3, 4)
BLOCK = 1 << 19
UNKNOWN = "und"

LETTER = np.zeros(256, dtype=bool)
LETTER[97:123] = True
LETTER[128:] = True


@dataclass(frozen=True)
class Fit:
    docs: int = 500
    chars: int = 100_000
    least: int = 20
    centroids: int = 4
    rounds: int = 10
    slack: float = 1.25  # a text is rejected beyond so many times the distance of nearly all members
    nearly: float = 0.995


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    langs: np.ndarray  # of each centroid, in order
    centroids: np.ndarray
    radius: np.ndarray


ROWS = 2048  # texts whose vectors are held at once


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[B.Block]:
    """Blocks of ``BLOCK`` bytes and ``ROWS`` texts at most; a vector takes far more room than a short text."""
    for lo in range(0, len(column), ROWS):
        for b in B.blocks(column.slice(lo, ROWS), BLOCK):
            yield B.Block(b.lo + lo, b.hi + lo, b.data, b.bounds)


def counts(block: B.Block) -> np.ndarray:
    """Matrix of n-gram counts, a row for each text; runs of other bytes count as one space."""
    data = B.lowered(block.data)
    n_rows = len(block.bounds) - 1
    letter = LETTER[data]
    behind = np.zeros(len(data), dtype=bool)
    behind[1:] = letter[:-1]
    behind[block.bounds[:-1][block.bounds[:-1] < len(data)]] = False
    keep = letter | behind
    kept = np.concatenate([[0], np.cumsum(keep)])
    bounds = kept[block.bounds]
    text = np.where(letter, data, np.uint8(32))[keep]
    text = np.insert(text, bounds, np.uint8(32)).astype(np.uint32)
    starts = bounds + np.arange(n_rows + 1)
    row = np.repeat(np.arange(n_rows), np.diff(starts))
    last = starts[1:][row]  # the space behind the row
    at = np.arange(len(row))
    out = np.zeros(n_rows * DIMS, dtype=np.int64)
    gram = text[:len(row)].copy()
    with np.errstate(over="ignore"):
        for size in range(2, max(SIZES) + 1):
            nxt = np.zeros(len(row), dtype=np.uint32)
            m = max(0, min(len(row), len(text) - size + 1))
            nxt[:m] = text[size - 1:size - 1 + m]
            gram = gram * np.uint32(256) + nxt
            if size in SIZES:
                ok = at + size - 1 <= last
                place = ((gram[ok] ^ np.uint32(size * 0x2545F491 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMS.bit_length() + 1)
                out += np.bincount(row[ok] * DIMS + place, minlength=len(out))
    return out.reshape(n_rows, DIMS)


def vectors(block: B.Block, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts(block).astype(np.float32)) * idf.astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def clustered(v: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, cluster of each row) by spherical k-means; seeds are drawn by their distance from those before."""
    rng = np.random.default_rng(len(v))
    picked = [int(np.argmax(v @ v.mean(0)))]
    while len(picked) < min(k, len(v)):
        far = np.clip(1 - (v @ v[picked].T).max(1), 0, None) ** 2
        if far.sum() < 1e-6:
            break
        picked.append(int(rng.choice(len(v), p=far / far.sum())))
    c = v[picked]
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        c = np.stack([v[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c, np.argmax(v @ c.T, axis=1)


def _frequencies(batches):
    """Number of texts that hold each n-gram place; place -1 has the number of texts."""
    df, n = np.zeros(DIMS, dtype=np.int64), 0
    for batch in batches:
        for block in blocks(batch.column("text")):
            c = counts(block)
            df += (c > 0).sum(0)
            n += len(c)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["place", "n"])


def train(docs: DataFrame, how: Fit | None = None) -> Model | None:
    """Model from (doc_id, text, lang) of documents that are not held out; None if no language is known."""
    how = how or Fit()
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(3, 1))
    found = known.select("text").mapInArrow(_frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMS)
    total = 0
    for r in found:  # at most DIMS + 1 rows
        if r["place"] < 0:
            total = r["n"]
        else:
            df[r["place"]] = r["n"]
    if not total:
        return None
    idf = np.log((1 + total) / (1 + df)) + 1

    # about so many texts of each language, chosen by hash, so no language is gathered whole
    fits = F.length("text") <= how.chars
    sizes = stage(known.groupBy("lang").agg(F.count("*").alias("of"), F.count(F.when(fits, 1)).alias("fitting")), "langs")
    luck = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = known.join(sizes, "lang").where(F.when(fits, luck * F.col("of") < how.docs)
                                          .otherwise((F.col("fitting") < how.least) & (luck * (F.col("of") - F.col("fitting")) < how.least)))

    def centroids(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        texts = pa.array(rows.sort_values("doc_id")["text"], pa.string())
        v = np.concatenate([vectors(b, idf) for b in blocks(texts)])
        c, own = clustered(v, how.centroids, how.rounds)
        far = [1 - (v[own == j] @ c[j]) for j in range(len(c))]
        radius = [float(np.quantile(f, how.nearly)) if len(f) else 0.0 for f in far]
        return pd.DataFrame({"lang": key[0], "k": range(len(c)), "centroid": [x.astype(np.float32).tobytes() for x in c], "radius": radius})

    made = few.select("lang", "doc_id", "text").groupBy("lang").applyInPandas(centroids, "lang string, k int, centroid binary, radius double").collect()
    made = sorted(made, key=lambda r: (r["lang"], r["k"]))  # Fit.centroids for each language
    if not made:  # the draw left out the few texts there are
        return None
    return Model(idf, np.array([r["lang"] for r in made]), np.stack([np.frombuffer(r["centroid"], np.float32) for r in made]),
                 np.array([r["radius"] for r in made]))


def predictions(docs: DataFrame, model: Model | None, how: Fit | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row."""
    how = how or Fit()
    rows = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, letters boolean, lang string, best double, far boolean"
    if model is None:
        out = rows.select("doc_id", F.lit(False).alias("letters"), F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("best"), F.lit(True).alias("far"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def near(batches):
            m = shared.value
            for batch in batches:
                for b in blocks(batch.column("text")):
                    cos = vectors(b, m.idf) @ m.centroids.T
                    top = np.argmax(cos, axis=1)
                    best = np.clip(cos[np.arange(len(top)), top].astype(float), 0, 1)
                    part = [batch.column(c).slice(b.lo, b.hi - b.lo) for c in ("doc_id", "letters")]
                    yield pa.RecordBatch.from_arrays([*part, pa.array(m.langs[top].tolist(), pa.string()), pa.array(best),
                                                      pa.array(1 - best > m.radius[top] * how.slack)], names=["doc_id", "letters", "lang", "best", "far"])

        out = rows.mapInArrow(near, schema)
    return out.select("doc_id", F.when(F.col("letters"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
                      F.when(F.col("letters"), F.col("best")).otherwise(0.0).alias("score"),
                      (~F.col("letters") | F.col("far")).alias("rejected"))
