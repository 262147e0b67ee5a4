"""Toxicity by noisy-channel deobfuscation and word evidence.

A disguised word (look-alike signs, letters repeated or spaced out) is a lattice: each
sign may stand for itself's letter or the letters it looks like, a run of a letter for
one or two of it, separators for nothing or for the end of a word.  Viterbi finds the
likeliest path under a character trigram model of the corpus; a word with one path only
is itself.  Texts are scored with the words of the likeliest readings, and where a word
may well be meant as it is written (signs at its edges, one letter, few separators),
with that one too.

Character trigrams are counted over the texts of all documents.  Evidence comes from
labelled documents that are not held out, exact copies once: words and word beginnings
that stand in toxic texts far more often than in others (likelihood ratio), weighted by
log-odds; both counts are joined and tested on Spark, and what passes grows with the data.  A logistic model of a text's evidence makes the score; it is fitted on a
bounded sample, ``Fit.docs`` texts per label by hash.

Defined results: digits alone are a number and stay; a text that is null or has no words has the score of a text without
evidence; without labels of both kinds every score is 0; repeated rows score alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.llm import bytewise as B
from kerbline.llm.base import held_out, sized
from kerbline.staging import stage

# Letters that a sign may stand for.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "2": "z",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = ".-_*~ "
DISGUISE = -3.0  # log probability of writing a letter by another sign
REPEAT = -1.0  # of repeating a letter
READINGS = 16  # likeliest readings of a disguise whose words are taken
WINDOW = 48  # signs of a disguise read at once

PREFIXES = (4, 5, 6)  # bytes
SYMBOLS = 64

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
LETTER[128:] = True
DIGIT = np.zeros(256, dtype=bool)
DIGIT[48:58] = True
SIGN = np.zeros(256, dtype=bool)
SIGN[[ord(c) for c in LOOKS if ord(c) < 128]] = True
GAP = np.zeros(256, dtype=bool)
GAP[[ord(c) for c in SEPARATORS]] = True


@dataclass(frozen=True)
class Fit:
    docs: int = 5000  # texts per label for the logistic model
    least: int = 3  # toxic texts that must hold a feature, whatever their number
    ratio: float = 10.0  # likelihood ratio a feature needs


@dataclass(frozen=True)
class Model:
    logp: np.ndarray
    features: np.ndarray  # sorted
    weights: np.ndarray
    sieve: np.ndarray
    beta: np.ndarray


def symbols(data: np.ndarray) -> np.ndarray:
    """Class of each byte, in lower case: 0 no letter, 1-26 letters, the rest for bytes beyond ASCII."""
    return SYMBOL[data]


SYMBOL = np.zeros(256, dtype=np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[65:91] = np.arange(1, 27)
SYMBOL[128:192] = 27 + np.arange(64) % 32
SYMBOL[192:] = 59 + np.arange(64) % 4


def trigram_rows(batches):
    """Non-zero character trigram counts of a partition."""
    total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
    for batch in batches:
        for b in B.blocks(batch.column("text")):
            s = np.concatenate([[0, 0], SYMBOL[b.data], [0]])
            total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after two others, from all texts."""
    found = docs.select("text").mapInArrow(trigram_rows, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    c = np.zeros(SYMBOLS ** 3)
    for r in found:  # at most SYMBOLS ** 3 rows
        c[r["gram"]] = r["n"]
    c = c.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = c.sum(0), c.sum((0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
    return np.log((c + 20 * p2) / (c.sum(2, keepdims=True) + 20)).astype(np.float32)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Alternatives (letters, log probability) of each stretch of a disguised word."""
    out = []
    for run in re.finditer(r"(.)\1*", word.lower(), re.S):
        c, n = run.group(1), len(run.group())
        if not c.isalpha() and c not in LOOKS:
            out.append([("", 0.0), (" ", 0.0)])
            continue
        plain = [(c, 0.0)] if c.isalpha() else [(x, DISGUISE) for x in LOOKS[c]]
        if c.isalpha() and n <= 2:  # two of a letter are common; let them stand
            out.append([(c * n, 0.0)] + ([(c, REPEAT * 4)] if n == 2 else []))
        elif n == 1:
            out.append(plain)
        else:
            out.append([(x, p + REPEAT) for x, p in plain] + [(x * 2, p * 2 + REPEAT) for x, p in plain])
    return out


def readings(word: str, logp: np.ndarray, most: int = READINGS) -> list[str]:
    """Likeliest readings of a disguise, best first: Viterbi over its lattice, the state being the last two symbols."""
    best = {(0, 0): [(0.0, "")]}
    for choices in lattice(word):
        new: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for (a, b), ways in best.items():
            for letters, p in choices:
                x, y, s = a, b, p
                for byte in letters.encode():
                    z = int(SYMBOL[byte])
                    s += float(logp[x, y, z])
                    x, y = y, z
                new.setdefault((x, y), []).extend((score + s, text + letters) for score, text in ways)
        best = {k: sorted(v, reverse=True)[:most] for k, v in new.items()}
    ends = ((s + float(logp[a, b, 0]), t) for (a, b), ways in best.items() for s, t in ways)
    return [t for _, t in sorted(ends, reverse=True)[:most]]


def restored(word: str, logp: np.ndarray) -> str:
    """Likeliest reading of a disguise."""
    return readings(word, logp, 1)[0]


def _words_read(logp: np.ndarray):
    """Function that lists the distinct words of the likeliest readings of a disguise; repeated ones are remembered.

    A long one is read in windows that overlap by half, so each part has readings of its own.
    """
    def run(x: str) -> tuple[str, ...]:
        x = re.sub(r"(.)\1{3,}", r"\1\1\1", x.lower(), flags=re.S)
        parts = [x[i:i + WINDOW] for i in range(0, max(len(x) - WINDOW // 2, 1), WINDOW // 2)]
        return tuple(dict.fromkeys(w for part in parts for t in readings(part, logp) for w in t.split()))

    return functools.lru_cache(100_000)(run)


def disguised(block: B.Block, w: B.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(starts, ends, lattice?, plain too?, stretches): words cut to their letters and digits, and which of them need decoding.

    A word needs it if it mixes letters with signs that look like some, has a letter
    three times running, or has separators between single letters.  Stretches are
    (start, end) of what is decoded besides its words: runs of two or more words of one
    letter or sign each, words with signs at their edges, of signs alone, with signs
    and one letter, and short ones with separators.
    """
    data = B.LOWER[block.data]
    written = LETTER[data] | DIGIT[data] | SIGN[data]

    def cut(table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and behind the last byte of each word that is in ``table``, and whether there is one."""
        at = np.flatnonzero(table)
        if not len(at):
            return w.starts, w.starts, np.zeros(len(w.starts), dtype=bool)
        i, j = np.searchsorted(at, w.starts), np.searchsorted(at, w.ends) - 1
        some = i <= j
        return np.where(some, at[np.minimum(i, len(at) - 1)], w.starts), np.where(some, at[np.maximum(j, 0)] + 1, w.starts), some

    if not len(w.starts):
        none = np.zeros(0, dtype=bool)
        return w.starts, w.starts, none, none, []
    starts, ends, any_ = cut(LETTER[data] | DIGIT[data])
    # signs at the edges may be letters too: $tupid, a$$, @$$hole - but not a closing exclamation mark
    full, behind, signed = cut(written & (data != ord("!")))
    at = np.flatnonzero(written)
    full = np.where(signed, at[np.searchsorted(at, w.starts).clip(max=max(len(at) - 1, 0))], full) if len(at) else full
    lead = any_ & (starts - w.starts == 1) & SIGN[data[w.starts]]
    starts = starts - lead
    tail = w.ends - ends
    last = data[np.maximum(w.ends - 1, 0)]
    ends = np.where(any_ & (tail >= 1) & (tail <= 2) & ((last == ord("$")) | (last == ord("@"))), w.ends, ends)

    def total(table: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(table)])

    sums = [total(x[data]) for x in (LETTER, SIGN, GAP)] + [total(SIGN[data] & ~DIGIT[data])]
    n = ends - starts
    letters, signs, gaps, _ = (t[ends] - t[starts] for t in sums)
    thrice = np.zeros(len(data), dtype=bool)
    thrice[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & LETTER[data[2:]] & (data[2:] < 128)
    t = total(thrice)
    runs = np.where(n >= 3, t[ends] - t[np.minimum(starts + 2, ends)], 0) > 0
    mixed = (signs > 0) & (letters >= 2) & (letters + signs == n)
    spaced = (gaps >= 3) & (gaps * 2 + 1 == n) & (letters >= 2) & (letters + signs + gaps == n)
    hard = any_ & (mixed | runs | spaced)

    m = behind - full
    f_letters, f_signs, f_gaps, f_marks = (t[behind] - t[full] for t in sums)
    meant = signed & (f_letters + f_marks > 0)  # else a number
    more = meant & (m >= 2) & (f_letters + f_signs + f_gaps == m) & ((f_signs > 0) & (f_gaps == 0) | (f_gaps > 0) & (f_gaps * 2 + 1 == m))
    more &= ~(hard & (full == starts) & (behind == ends))
    found = list(zip(full[more].tolist(), behind[more].tolist(), strict=True))

    single = signed & (m == 1) & (data[full] < 128) & (w.ends - w.starts <= 2)
    edge = np.zeros(len(w.starts) + 1, dtype=bool)
    edge[w.rows] = True
    group = np.cumsum(~single | edge[:-1])
    at = np.flatnonzero(single)
    if len(at):
        key = group[at]
        cuts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        for a, b in zip(cuts, np.append(cuts[1:], len(at)), strict=True):
            if b - a >= 2 and meant[at[a:b]].any():
                found.append((int(full[at[a]]), int(behind[at[b - 1]])))
    return starts, ends, hard, hard & lead, found


def features(block: B.Block, logp: np.ndarray, cache=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature matrix, row, words per row): four hashes for each word, of itself and of its beginnings."""
    cache = cache or _words_read(logp)
    w = B.words(block)
    starts, ends, hard, both, stretches = disguised(block, w)
    row = w.row_of()
    keep = ends > starts
    fixed, at = [], []
    decode = [(starts[i], ends[i]) for i in np.flatnonzero(hard & keep)] + stretches
    if decode:
        rows = row[np.searchsorted(w.starts, [a for a, _ in decode], side="right") - 1]
        for (a, b), r in zip(decode, rows.tolist(), strict=True):
            for word in cache(block.data[a:b].tobytes().decode("utf-8", "ignore").replace("\n", " ")):
                fixed.append(word)
                at.append(r)
    keep &= ~hard | both
    starts = starts + both  # as written, without the sign before it
    extra = [x.encode() for x in fixed]
    data = np.concatenate([B.lowered(block.data), np.frombuffer(b" ".join(extra), dtype=np.uint8)])
    lens = np.array([len(x) for x in extra], dtype=np.int64)
    more = len(block.data) + np.concatenate([[0], np.cumsum(lens + 1)[:-1]]).astype(np.int64) if extra else np.zeros(0, dtype=np.int64)
    s = np.concatenate([starts[keep], more])
    e = np.concatenate([ends[keep], more + lens if extra else more])
    r = np.concatenate([row[keep], np.array(at, dtype=np.int64)])
    full = e > s
    s, e, r = s[full], e[full], r[full]
    out = np.empty((len(s), 1 + len(PREFIXES)), dtype=np.uint64)
    out[:, 0] = B.hashes(data, s, e, B.PLAIN_VALUE)
    for k, n in enumerate(PREFIXES):
        p = B.hashes(data, s, np.minimum(s + n, e), B.PLAIN_VALUE) ^ np.uint64(k + 1)
        out[:, k + 1] = np.where(e - s > n, p, out[:, 0])
    return out, r, np.bincount(r, minlength=len(block.bounds) - 1)


def _held(logp):
    """Number of texts of a partition that hold each feature."""
    def run(batches):
        cache = _words_read(logp)
        for batch in batches:
            for b in B.blocks(batch.column("text")):
                f, row, _ = features(b, logp, cache)
                pairs = np.unique(np.column_stack([f.ravel(), np.repeat(row, f.shape[1]).astype(np.uint64)]), axis=0) if len(f) else np.zeros((0, 2), np.uint64)
                got, n = np.unique(pairs[:, 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(got.view(np.int64)), pa.array(n.astype(np.int64))], names=["feature", "n"])
    return run


def _sieve(features_: np.ndarray) -> np.ndarray:
    """Table by the low bits of a feature: False where no feature can be."""
    table = np.zeros(1 << 20, dtype=bool)
    table[features_ & np.uint64((1 << 20) - 1)] = True
    return table


def _found(f: np.ndarray, known: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``f``, position in ``known``) of the entries of ``f`` that are known."""
    maybe = np.flatnonzero(sieve[f & np.uint64((1 << 20) - 1)])
    at = np.minimum(np.searchsorted(known, f[maybe]), len(known) - 1)
    hit = known[at] == f[maybe]
    return maybe[hit], at[hit]


def _telling(counts: DataFrame, n1: float, n0: float, least: float) -> DataFrame:
    """(feature, odds) of the features whose counts (bad of n1 texts, fine of n0) tell toxic texts."""
    bad, fine = F.col("bad"), F.col("fine")
    odds = F.log((bad + 0.5) / (n1 - bad + 0.5)) - F.log((fine + 0.5) / (n0 - fine + 0.5))
    # likelihood ratio of "as often in both" against "as counted"
    part = lambda k, n, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    p = F.col("expected")
    ratio = 2 * (part(bad, n1, p) + part(n1 - bad, n1, 1 - p) + part(fine, n0, p) + part(n0 - fine, n0, 1 - p))
    return (counts.withColumn("expected", (bad + fine) / (n1 + n0)).withColumn("odds", odds)
            .where((F.col("odds") > 1.5) & (ratio >= least)).select("feature", "odds"))


STATS = 5


def evidence(block: B.Block, m: Model, cache=None) -> np.ndarray:
    """What the logistic model sees of each text."""
    f, row, sizes = features(block, m.logp, cache)
    total, most, hits = np.zeros(len(sizes)), np.zeros(len(sizes)), np.zeros(len(sizes))
    if len(m.features) and len(f):
        pos, at = _found(f.ravel(), m.features, m.sieve)
        word = np.zeros(len(f))
        np.maximum.at(word, pos // f.shape[1], m.weights[at])
        hit = np.flatnonzero(word)
        total = np.bincount(row[hit], weights=word[hit], minlength=len(sizes))
        hits = np.bincount(row[hit], minlength=len(sizes)).astype(float)
        np.maximum.at(most, row[hit], word[hit])
    share = total / np.sqrt(np.maximum(sizes, 1))
    return np.column_stack([np.ones(len(sizes)), np.log1p(total), most, np.log1p(hits), share])


def score(stats: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(stats @ beta, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps for a logistic model of few columns."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = score(x, beta)
        w = p * (1 - p) + 1e-6
        step = np.linalg.solve(x.T @ (x * w[:, None]) + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, how: Fit | None = None) -> Model | None:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic); None without both labels."""
    how = how or Fit()
    logp = language_model(docs)
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(5, 0)).select("doc_id", "toxic").distinct()
    known = stage(known, "known")
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(sized(known), "doc_id")
    texts = texts.withColumn("body", F.xxhash64("text"))
    first = texts.groupBy("body", "toxic").agg(F.min("doc_id").alias("doc_id"))
    copies = texts.groupBy("body", "toxic", "doc_id").agg(F.count("*").alias("copies"))
    first = stage(copies.join(first.select("body", "toxic", "doc_id"), ["body", "toxic", "doc_id"]), "first")
    per = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(per) < 2:
        return None
    # labels of one copy of each text; the texts come straight from the table
    found = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    once, again = first.where("copies = 1"), first.where("copies > 1")  # of rows repeated as a whole one is read
    labelled = found.join(sized(once), ["doc_id", "body"])
    if not again.isEmpty():
        labelled = labelled.unionByName(found.join(sized(again), ["doc_id", "body"]).dropDuplicates(["doc_id", "body", "toxic"]))
    n1, n0 = float(per[1]), float(per[0])
    held = lambda toxic: (labelled.where(f"toxic = {toxic}").select("text").mapInArrow(_held(logp), "feature long, n long")
                          .groupBy("feature").agg(F.sum("n").cast("double").alias("n")))
    bad = stage(held(1).where(F.col("n") >= how.least).withColumnRenamed("n", "bad"), "features")
    both = bad.join(held(0).withColumnRenamed("n", "fine"), "feature", "left").na.fill(0.0, ["fine"])
    # features that pass are the model's evidence, broadcast with it: 16 bytes each
    rows = stage(_telling(both, n1, n0, how.ratio), "evidence").toArrow()
    names = rows.column("feature").to_numpy().view(np.uint64)
    order = np.argsort(names)
    names = names[order]
    model = Model(logp, names, rows.column("odds").to_numpy()[order], _sieve(names), np.zeros(STATS))

    order_by = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = (first.where("toxic = 0").orderBy(*order_by).limit(how.docs)
           .unionByName(first.where("toxic = 1").orderBy(*order_by).limit(how.docs)))
    few = F.broadcast(stage(few.drop("copies"), "sample"))  # at most 2 * how.docs rows of three numbers
    rows = (found.join(few, ["doc_id", "body"]).dropDuplicates(["doc_id", "body", "toxic"]).select("toxic", "text")
            .mapInArrow(B.over_blocks(lambda b: {"x": _listed(evidence(b, model))}, ["toxic"]), "toxic int, x array<double>").toArrow())
    x = np.array(rows.column("x").to_pylist()).reshape(-1, STATS)
    y = rows.column("toxic").to_numpy().astype(float)
    # the sample holds as many of each label as it can; the odds of the labels are put back
    weight = np.log(n1 / n0) - np.log(max(y.sum(), 1) / max((1 - y).sum(), 1))
    beta = _logistic(x, y)
    beta[0] += weight
    return Model(logp, model.features, model.weights, model.sieve, beta)


def _listed(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array((np.arange(len(x) + 1) * x.shape[1]).astype(np.int32)), pa.array(x.ravel()))


def scores(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        cache = _words_read(m.logp)
        yield from B.over_blocks(lambda b: {"score": pa.array(score(evidence(b, m, cache), m.beta))}, ["doc_id"])(batches)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
