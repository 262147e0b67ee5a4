"""What the text operators share: table reads, word patterns and size-checked joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"

BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(mod: int, part: int) -> Column:
    """True where crc32 of the document id, as text, leaves ``part``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == part, F.lit(False))


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else left for a shuffled join.

    ``df`` should be a stage table or a small aggregate, as it is counted here.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column bears it, whatever the case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
