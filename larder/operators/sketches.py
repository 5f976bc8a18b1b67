"""Totals kept up to date by load: each load stores its counts and a sketch of its distinct values.

A sketch is the k least hashes of the values.  The k least of all sketches are the k least of all loads together, so a
merged sketch is the one that a rebuild over all rows would give, whatever the loads and their order.  Up to k values
the count is exact; beyond, the k-th hash tells how densely the range of hashes is filled, with a relative standard
error of about 1 / sqrt(k).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K = 4096
# 15 hexadecimal digits of a digest
_RANGE = 16**15


def hash_of(value: Column) -> Column:
    """A hash that any engine with MD5 can give: its first 60 bits."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def least_hashes(values: DataFrame, column: str, k: int = K, by: str | None = None) -> DataFrame:
    """The k least hashes of the values that are not null, as (hash) or, for many loads at once, (load, hash)."""
    known = values.where(F.col(column).isNotNull())
    hashed = hash_of(F.col(column).cast("string")).alias("hash")
    if by is None:
        return known.select(hashed).distinct().orderBy("hash").limit(k)
    # k rows of each load leave a task
    rank = F.row_number().over(Window.partitionBy("load").orderBy("hash"))
    return known.select(F.col(by).alias("load"), hashed).distinct().withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def merged(hashes: DataFrame, k: int = K) -> DataFrame:
    """The sketch of all loads together."""
    return hashes.select("hash").distinct().orderBy("hash").limit(k)


def estimate(sketch: DataFrame, k: int = K, name: str = "unique") -> DataFrame:
    """The number of distinct values that a sketch stands for, and the standard error it is known to."""
    n, top = F.count("*"), F.max("hash")
    dense = F.round(F.lit(k - 1.0) * F.lit(float(_RANGE)) / top).cast("long")
    return sketch.agg(
        F.when(n < k, n).otherwise(dense).alias(name),
        F.when(n < k, 0.0).otherwise(F.lit(1 / math.sqrt(k - 2))).alias("relative_error"),
    )


@dataclass(frozen=True)
class Totals:
    """Counts and sketches by load below one folder; a load that is written again replaces itself."""

    spark: SparkSession
    path: str
    k: int = K

    def add(self, load: str, recipes: DataFrame, lines: DataFrame) -> None:
        """Store a load: the number of its recipes and ingredient mentions, and the sketch of its ingredient names."""
        mentions = lines.select(F.count("name").alias("n")).scalar()
        counts = recipes.agg(F.count("id").alias("recipes")).withColumn("mentions", mentions)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/load={load}")
        least_hashes(lines, "name", self.k).write.mode("overwrite").parquet(f"{self.path}/hashes/load={load}")

    def sketch(self) -> DataFrame:
        return merged(self.spark.read.schema("hash long, load string").parquet(f"{self.path}/hashes"), self.k)

    def read(self) -> DataFrame:
        """One row: recipes, mentions and unique ingredients of all loads, from what the loads stored."""
        counts = self.spark.read.schema("recipes long, mentions long, load string").parquet(f"{self.path}/counts")
        sums = counts.agg(F.coalesce(F.sum("recipes"), F.lit(0)).alias("total_recipes"), F.coalesce(F.sum("mentions"), F.lit(0)).alias("mentions"))
        return sums.join(F.broadcast(estimate(self.sketch(), self.k, "unique_ingredients")), F.lit(True))  # one row


__all__ = ["Totals", "estimate", "hash_of", "least_hashes", "merged"]
