"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.005) -> Column:
    """Keys that hold more than `share` of the rows, each with the number of slices it is cut into, as a map.

    A slice holds a quarter of `share` at most, so the largest keys get the most slices.  By arithmetic there are
    at most 1/share keys, whatever the size of the data; smaller keys are left to the splitting of skewed
    partitions at run time.  The map is a scalar subquery: one aggregation with map-side combine.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    totals = counts.agg(F.sum("_n").alias("_total")).scalar()
    return (
        counts.where(F.col("_n") > totals * F.lit(share))
        .select(key, F.ceil(F.col("_n") / (totals * F.lit(share / 4))).cast("int").alias("_slices"))
        .agg(F.map_from_entries(F.collect_list(F.struct(key, "_slices"))).alias("_hot"))
        .scalar()
    )


def hot_key_join(
    facts: DataFrame,
    keyed: DataFrame,
    key: str,
    how: str = "left",
    share: float = 0.005,
) -> DataFrame:
    """Equi-join `facts` with `keyed` (one row per key) with the hot keys cut into slices.

    Rows of a hot key get one of its salts and its single row on the other side is repeated per
    salt, so no task sees more than a slice of it.  All other keys join as usual.  Nothing is dropped.
    """
    slices = F.coalesce(F.try_element_at(hot_keys(facts, key, share), F.col(key)), F.lit(1))
    others = [F.col(c) for c in facts.columns if c != key]
    # only rows of hot keys pay for a hash of their other columns
    spread = F.when(slices > 1, F.pmod(F.xxhash64(*others), slices).cast("int")).otherwise(0) if others else F.lit(0)
    left = facts.withColumn("_salt", spread)
    right = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")
