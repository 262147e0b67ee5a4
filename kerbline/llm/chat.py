"""Chat formatting with collapse of cumulative snapshots.

A log may hold a conversation once per turn, each copy a prefix of the next.  Turns are
hashed, and a rolling hash over them names every prefix of every conversation.  A
conversation whose whole hash is a proper prefix of another goes, by an anti-join on
prefix hashes; of equal conversations the least id stays.  What is left is rendered.

Only hashes travel until the maximal conversations are known; prefix hashes are reduced
to distinct ones before the join, so a first turn that many share is one row.

Defined results: turns without a conversation id belong to none and are left out;
repeated rows count once; turns of one number follow each other by role and a hash of the text; a
null role is ``unknown``, a null text empty; marks of the format inside texts are
broken by a space; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kerbline.staging import stage

# The marks of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turns(log: DataFrame) -> DataFrame:
    return log.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def _rolled(batches):
    """Prefix hashes of each conversation, the last being its whole hash."""
    for batch in batches:
        out = []
        for steps in batch.column("steps").to_pylist():
            h, chain = b"", []
            for step in steps:
                h = hashlib.blake2b(h + step["h"], digest_size=16).digest()
                chain.append(h)
            out.append(chain)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(out, pa.list_(pa.binary()))], names=["conv_id", "chain"])


def maximal(log: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies): conversations that are no proper prefix of another, once each."""
    rows = turns(log)
    hashed = rows.select("conv_id", "turn", F.unhex(F.sha2(F.concat_ws("\0", "role", "text").cast("binary"), 256)).alias("h"), "role",
                         F.xxhash64("text").alias("t"))
    # equal turns once; ties of a turn's number by role, then text hash
    steps = hashed.groupBy("conv_id", "turn", "role", "t", "h").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "h"))).alias("steps"))  # one conversation's turns
    chains = steps.mapInArrow(_rolled, f"conv_id {log.schema['conv_id'].dataType.simpleString()}, chain array<binary>")
    chains = stage(chains.withColumn("n_turns", F.size("chain")), "chains")
    whole = chains.groupBy(F.element_at("chain", -1).alias("h")).agg(
        F.min("conv_id").alias("conv_id"), F.min("n_turns").alias("n_turns"), F.count("*").alias("copies"))
    prefixes = chains.select(F.explode(F.expr("slice(chain, 1, n_turns - 1)")).alias("h")).distinct()
    return whole.join(prefixes, "h", "left_anti").select("conv_id", "n_turns", "copies")


def rendered(log: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies, text): every maximal conversation as one text."""
    kept = stage(maximal(log), "maximal")
    safe = F.replace("text", F.lit("<|"), F.lit("< |"))
    rows = turns(log).join(kept.select("conv_id"), "conv_id", "left_semi").distinct()
    order = F.unhex(F.sha2(F.concat_ws("\0", "role", "text").cast("binary"), 256))
    lines = F.concat(F.lit(OPEN), "role", F.lit("\n"), safe, F.lit(CLOSE + "\n"))
    texts = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", order.alias("h"), lines.alias("line")))).alias("l"))
    return texts.join(kept, "conv_id").select("conv_id", "n_turns", "copies", F.array_join("l.line", "").alias("text"))
