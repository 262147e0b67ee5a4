"""Group-wise numbering and lookups that hold when one group has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

HOT_ROWS = 1_000_000


def numbered(df: DataFrame, keys: list[str], order: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Zero-based position of each row in its group by a unique integer ``order`` column.

    Groups above ``hot_rows`` are cut into order ranges that are ranked apart and
    shifted by the sizes of the ranges before them, so no task sees a whole hot
    group.  The two broadcast tables hold at most (rows / hot_rows) groups and a
    few ranges per group.
    """
    hot = (df.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(order).alias("_lo"), F.max(order).alias("_hi"))
           .where(F.col("_n") > hot_rows)
           .withColumn("_w", F.expr(f"(_hi - _lo) div (4 * (_n div {hot_rows} + 1)) + 1"))
           .select(*keys, "_lo", "_w"))
    cut = (df.join(F.broadcast(hot), keys, "left")
           .withColumn("_b", F.coalesce(F.expr(f"({order} - _lo) div _w"), F.lit(-1).cast("long")))
           .drop("_lo", "_w"))
    ranges = cut.where("_b >= 0").groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    before = ranges.withColumn("_off", F.sum("_c").over(
        W.partitionBy(*keys).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))).drop("_c")
    local = F.row_number().over(W.partitionBy(*keys, "_b").orderBy(order)) - 1
    return (cut.withColumn(out, local.cast("long"))
            .join(F.broadcast(before), [*keys, "_b"], "left")
            .withColumn(out, F.col(out) + F.coalesce("_off", F.lit(0)))
            .drop("_b", "_off"))


def lookup(big: DataFrame, small: DataFrame, key: str, rows: str, spread: Column,
           hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of a pre-aggregated table, with frequent keys served by broadcast.

    ``small`` has one row per key and its row count in ``rows``.  Keys above
    ``hot_rows`` are few by construction and are broadcast; their rows and rows
    with a null key take a spread join key, so the shuffle stays even.
    """
    values = [c for c in small.columns if c not in (key, rows)]
    hot = small.where(F.col(rows) > hot_rows).select(
        key, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot"))
    cold = small.where(F.col(rows) <= hot_rows).select(
        F.concat(F.lit("k"), F.col(key).cast("string")).alias("_key"), *[F.col(v).alias(f"_cold_{v}") for v in values])
    joined = (big.join(F.broadcast(hot), key, "left")
              .withColumn("_key", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(),
                                         F.concat(F.lit("k"), F.col(key).cast("string")))
                          .otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string"))))
              .join(cold, "_key", "left"))
    return joined.select(*[big[c] for c in big.columns],
                         *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values])


def first_per(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """Row with the least ``order`` per key, as a mergeable aggregate rather than a window."""
    best = F.min_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])
