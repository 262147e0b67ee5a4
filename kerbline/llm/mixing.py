"""Mixing sources to target weights: whole repetitions plus one hash-seeded draw per document.

Words are summed per source, every source gets a share of the wanted total by its
weight, shares stop at ``max_rate`` times what the source holds and the excess goes
to the others.  A document is then taken floor(rate) times, and once more with
probability rate - floor(rate).  The draw is a hash of the document id and a seed,
so reruns agree.  Every source draws with the seed, of ``SEEDS`` tried, whose sum
comes nearest to its target: small sources would else miss it by chance.

Defined results: null text has size 0; null source is a source of its own, last in
order; a null id draws like any other; repeated rows are taken alike; if no text has
a word, all targets are 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from kerbline.llm.base import fresh, sized, word_count
from kerbline.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATE = 2
SEEDS = 16


def draw(doc_id: Column, seed: int) -> Column:
    """Number in [0, 1) from the id and a seed: the first eight hex digits of an MD5."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, weight): weights repeat over the sources in code point order, null last.

    The sources are dealt into ordered ranges, written once, and ranked within each
    range plus the number of sources in the ranges before it.
    """
    order = [F.col("source").isNull(), F.col("source")]
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = stage(per.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = (per.groupBy("part").agg(F.count("*").alias("n"))
              .withColumn("before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))))
    at = F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1 + F.coalesce("before", F.lit(0))
    return (per.join(before, "part").withColumn("at", at)
            .select("source", "source_size",
                    F.element_at(F.array(*map(F.lit, weights)), (F.pmod("at", F.lit(len(weights))) + 1).cast("int")).alias("weight")))


def target_words(sources: DataFrame, share: float, max_rate: int) -> DataFrame:
    """Adds ``target``: the wanted total by weight, none above its cap.

    The words for one unit of weight rise as capped sources drop out, until no
    further source is above its cap; each round is one aggregate over the sources.
    """
    cap = F.col("source_size") * max_rate
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    total = share * float(whole["size"] or 0)
    unit = total / float(whole["weight"] or 1)
    while True:
        full = F.lit(unit) * F.col("weight") > cap
        now = sources.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("capped"),
                          F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if not now["weight"]:
            break
        new = (total - float(now["capped"])) / float(now["weight"])
        if new <= unit:
            break
        unit = new
    return sources.withColumn("target", F.least(cap.cast("double"), F.lit(unit) * F.col("weight")))


def rates(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target, whole, part, seed) for each source of ``sizes`` (doc_id, source, size)."""
    sources = target_words(stage(weighted_sources(sizes, weights), "weights"), share, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = stage(sources.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate)), "targets")
    drawn = join_source(sizes, sources).groupBy("source").agg(
        *[F.sum(F.when(draw(F.col("doc_id"), j) < F.col("part"), F.col("size")).otherwise(0)).alias(f"s{j}") for j in range(SEEDS)])
    miss = F.array(*[F.abs(F.col("whole") * F.col("source_size") + F.col(f"s{j}") - F.col("target")) for j in range(SEEDS)])
    best = (sources.join(drawn, sources["source"].eqNullSafe(drawn["source"])).drop(drawn["source"])
            .withColumn("miss", miss))
    seed = (F.array_position("miss", F.array_min("miss")) - 1).cast("int")
    return stage(best.select("source", "source_size", "target", "whole", "part", seed.alias("seed")), "rates")


def join_source(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of ``sizes`` with what is known of their source; a hot source is split by the broadcast or the adaptive join."""
    few = sized(sources)
    return sizes.join(few, sizes["source"].eqNullSafe(few["source"])).drop(few["source"])


def mix(sizes: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to (doc_id, source, size, ...)."""
    seeds = F.element_at(F.array(*[draw(F.col("doc_id"), j) for j in range(SEEDS)]), F.col("seed") + 1)
    copies = F.col("whole") + F.when(seeds < F.col("part"), 1).otherwise(0)
    return join_source(sizes, known).withColumn("copies", copies.cast("long")).drop("whole", "part", "seed")


def document_sizes(docs: DataFrame) -> DataFrame:
    """Stage table (doc_id, source, size): the texts are read for their words once."""
    return stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def taken(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per document."""
    sizes = document_sizes(docs)
    return mix(sizes, rates(sizes, **how)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, numbered by ``copy`` from 1.

    A column of that name in ``docs`` is kept; the number then takes a longer name.
    The draw depends on id and source alone, so texts are not shuffled.
    """
    known = rates(document_sizes(docs), **how)
    own = docs.columns
    out = fresh(own, "copy")
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("d"), "doc_id", "source", F.lit(0).alias("size"))
    return (mix(inner, known).where("copies > 0")
            .select("d.*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias(out)))
