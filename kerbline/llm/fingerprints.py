"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits.

The shingles of a text are hashed once.  The high bits of a hash choose one of
``BINS`` bins, the least hash of a bin is its value.  An empty bin borrows from the
full bin that comes first in a probing order of its own, a full cycle over all bins,
so that two texts borrow alike.  Of every value the low ``BITS`` bits are kept, two
hex digits each; the likeness of two fingerprints is the share of equal codes,
corrected for codes that agree by chance (2 ** -BITS).

Shingles are runs of ``WORDS`` words; a text of fewer words is one shingle.

Defined results: null text counts as empty; a text without words has the fingerprint
of dashes, likeness 1 to another such text and 0 to all else; the edited text of the
only document takes itself as next; rows of equal id follow each other by a hash of their
text, and a null id comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.llm.base import GAPS
from kerbline.staging import stage

WORDS = 5
BINS = 128
BITS = 8
SHIFT = 57  # 64 bits less log2(BINS)
LOW = (1 << 40) - 1


def shingle_hashes(text: Column) -> tuple[Column, Column]:
    """(word hashes of ``text``, expression for sorted shingle hashes over a column ``w`` of them)."""
    words = F.filter(F.split(text, GAPS), lambda x: x != "")
    hashed = F.transform(words, lambda x: F.xxhash64(x))
    starts = F.sequence(F.lit(0), F.size("w") - WORDS)
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(WORDS)]))
    one = F.array(F.xxhash64(F.col("w"), F.lit(-1)))
    return hashed, F.sort_array(F.when(F.size("w") >= WORDS, runs).when(F.size("w") > 0, one).otherwise(F.array().cast("array<bigint>")))


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, SHIFT)


def codes(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, the array of BINS codes (empty for a text without words), to ``docs``."""
    hashed, runs = shingle_hashes(F.col(text))
    rows = docs.withColumn("w", hashed).withColumn("h", runs).drop("w")
    # hashes are sorted, so the first of each bin is its least
    firsts = F.filter("h", lambda x, i: (i == 0) | (_bin(x) != _bin(F.get("h", i - 1))))
    rows = rows.withColumn("f", firsts).drop("h")
    rows = rows.withColumn("full", F.transform("f", lambda x: _bin(x).cast("int")))
    # probe order of bin i: start + step * attempt modulo BINS with an odd step, both hashed from i;
    # the attempt at which bin b is met is (b - start) * inverse(step) modulo BINS
    borrow = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(r).alias("r")) for s, r in PROBES])
    own = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.array_position("full", i.cast("int")) - 1)
    rows = rows.withColumn("own", own)

    def lent(i: Column) -> Column:
        probe = F.get("probes", i)
        met = lambda b: F.pmod((b - probe["s"]) * probe["r"], F.lit(BINS)).cast("bigint")
        return F.array_min(F.zip_with("full", "f", lambda b, h: F.shiftleft(met(b), 40).bitwiseOR(
            h.bitwiseAND(F.lit(LOW))))).bitwiseAND(F.lit(LOW))

    filled = F.transform("own", lambda at, i: F.when(at >= 0, F.get("f", at.cast("int"))).otherwise(lent(i)))
    low = F.transform(filled, lambda v: v.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
    none = F.array().cast("array<int>")
    return (rows.withColumn("probes", borrow).withColumn(out, F.when(F.size("f") > 0, low).otherwise(none))
            .drop("f", "full", "own", "probes"))


def _probes() -> list[tuple[int, int]]:
    """(start, inverse of the odd step) of each bin's probing order, by a multiplicative rule."""
    out = []
    for i in range(BINS):
        mixed = (i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        mixed = (mixed ^ mixed >> 31) * 0xBF58476D1CE4E5B9 % (1 << 64)
        out.append((mixed >> 40 & BINS - 1, pow(mixed >> 20 & BINS - 1 | 1, -1, BINS)))
    return out


PROBES = _probes()


def packed(codes: Column) -> Column:
    """Binary form: one byte a code, none without words."""
    return F.unhex(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def shown(fingerprint: Column) -> Column:
    """Text form: two hex digits a code, or dashes without words."""
    return F.when(F.length(fingerprint) == 0, "--").otherwise(F.lower(F.hex(fingerprint)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated likeness of two texts from their packed codes, 0 to 1, corrected for chance."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    fair = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return (F.when((F.length(a) == 0) & (F.length(b) == 0), 1.0).when((F.length(a) == 0) | (F.length(b) == 0), 0.0).otherwise(fair))


KEY = ["i", "nul", "tie"]  # id or 0, whether it is null, hash of the text


def successors(ids: DataFrame) -> DataFrame:
    """KEY columns of each row and ``next``, those of the row after it in order of id and tie, the first after the last.

    Ids are dealt into ordered ranges and written; a row finds its successor within
    its range, the last one of a range in the first of the next range that has rows.
    """
    order = [F.col("nul").desc(), F.col("i"), F.col("tie")]
    parts = stage(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ids")
    inside = F.lead(F.struct(*KEY)).over(W.partitionBy("part").orderBy(*order))
    heads = parts.groupBy("part").agg(F.min(F.struct((~F.col("nul")).alias("named"), "i", "tie")).alias("h"))  # one row per range
    heads = heads.withColumn("head", F.struct(F.col("h.i").alias("i"), (~F.col("h.named")).alias("nul"), F.col("h.tie").alias("tie")))
    over = W.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(over), F.first("head").over(
        over.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("after"))
    return parts.withColumn("inside", inside).join(heads, "part").select(*KEY, "n", F.coalesce("inside", "after").alias("next"))


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, KEY, next, text, n_chars, edited): the last half of each text replaced by the head of the next one.

    Texts are shuffled once, by their own key: both joins read the same columns of them,
    so the second takes the exchange of the first.  Of the next text only
    the piece that is used moves on to its predecessor.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "text", F.coalesce("doc_id", F.lit(0)).alias("i"), F.col("doc_id").isNull().alias("nul"), F.xxhash64("text").alias("tie"))
    ids = rows.select(*KEY, F.length("text").cast("bigint").alias("n")).distinct()
    links = stage(successors(ids), "successors")
    wanted = links.select(F.col("next.i").alias("i"), F.col("next.nul").alias("nul"), F.col("next.tie").alias("tie"),
                          F.struct(*KEY).alias("to"), F.floor(F.col("n") / 2).cast("int").alias("want"))
    heads = (rows.join(wanted, KEY).select("to.*", F.substring("text", F.lit(1), F.col("want")).alias("head"))
             .groupBy(*KEY).agg(F.any_value("head").alias("head")))  # repeated rows have equal heads
    joined = rows.join(heads, KEY).join(links.select(*KEY, "n", "next"), KEY)
    keep = F.substring("text", F.lit(1), (F.col("n") - F.floor(F.col("n") / 2)).cast("int"))
    return joined.select(F.when(~F.col("nul"), F.col("i")).alias("doc_id"), *KEY, "next", "text", F.col("n").alias("n_chars"), F.concat(keep, "head").alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: see the contract of the query for the columns."""
    both = edited(docs)
    both = codes(both, "edited", "ec").withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)).drop("edited")
    both = codes(both, "text", "c").drop("text").withColumn("c", packed(F.col("c"))).withColumn("ec", packed(F.col("ec")))
    both = stage(both, "codes")
    after = both.select(*KEY, F.col("c").alias("nc")).groupBy(*KEY).agg(F.any_value("nc").alias("nc"))
    after = after.select(F.struct(*KEY).alias("next"), "nc")
    return both.join(after, "next").select(
        "doc_id", "n_chars", "edited_sha256", shown(F.col("c")).alias("fingerprint"), shown(F.col("ec")).alias("edited_fingerprint"),
        likeness(F.col("c"), F.col("ec")).alias("near_edited"), likeness(F.col("c"), F.col("nc")).alias("near_next"))
