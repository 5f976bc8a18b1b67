"""Evaluate expensive columns exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a one-row generator.

    The optimizer inlines projected expressions into every filter and projection above them, which
    repeats expensive array work several times per row.  It does not do so across a generator, and a
    one-element explode is narrow and part of generated code.  Meant for costly expressions only.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    keep = [c for c in df.columns if c not in columns]
    return df.select(*[c for c in df.columns], F.explode(F.array(made)).alias("_once")).select(
        *keep, *[F.col("_once")[n].alias(n) for n in columns]
    )


def spread(df: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """Spread rows over all cores before CPU-heavy narrow work, when the scan they come from has fewer
    splits than there are cores.

    Large inputs already come in many splits and are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = (df if scan is None else scan).rdd.getNumPartitions()
    return df.repartition(cores) if splits < cores else df
