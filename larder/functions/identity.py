"""Deterministic identifiers: version-5 UUIDs as one built-in expression, and dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import lexicon
from larder.functions.text import let, strip


def uuid5(name: Column) -> Column:
    """RFC 4122 name-based UUID (SHA-1) in the recipe namespace."""

    def assemble(digest: Column) -> Column:
        # the variant bits replace the two top bits of the 17th digit
        variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
        return F.concat_ws(
            "-",
            F.substring(digest, 1, 8),
            F.substring(digest, 9, 4),
            F.concat(F.lit("5"), F.substring(digest, 14, 3)),
            F.concat(variant, F.substring(digest, 18, 3)),
            F.substring(digest, 21, 12),
        )

    return let(F.sha1(F.concat(F.unhex(F.lit(lexicon.RECIPE_NAMESPACE)), F.encode(name, "UTF-8"))), assemble)


def recipe_uuid(title: Column, source: Column | None = None) -> Column:
    """Identity of a recipe: normalised title and source, always joined by a colon."""
    source = F.lit("") if source is None else F.coalesce(source, F.lit(""))
    return uuid5(F.concat(F.lower(strip(title)), F.lit(":"), F.lower(strip(source))))


def post_uuid(title: Column, post_id: Column) -> Column:
    """Identity of a recipe that came from a forum post."""
    return recipe_uuid(title, F.concat(F.lit("reddit:"), post_id))


def backfill_uuid(title: Column, post_id: Column, source_url: Column, stored: Column) -> Column:
    """Stored uuid, else by post id, else by source url, else by title alone."""
    return F.coalesce(
        stored,
        F.when(post_id.isNotNull(), post_uuid(title, post_id)),
        recipe_uuid(title, source_url),
    )


def register_uuid_function(spark: SparkSession, name: str = "generate_recipe_uuid") -> None:
    """SQL twin of `recipe_uuid`, callable from any query of the session."""
    digest = (
        f"sha1(concat(unhex('{lexicon.RECIPE_NAMESPACE}'), encode(concat(lower(trim(title)), ':', "
        "lower(trim(coalesce(source, '')))), 'UTF-8')))"
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(title STRING, source STRING) RETURNS STRING RETURN
        concat_ws('-', substring({digest}, 1, 8), substring({digest}, 9, 4),
                  concat('5', substring({digest}, 14, 3)),
                  concat(translate(substring({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab'),
                         substring({digest}, 18, 3)),
                  substring({digest}, 21, 12))"""
    )


def dense_ids(df: DataFrame, key: str, start: Column, id_col: str = "id") -> DataFrame:
    """Add dense ids start+1, start+2, ... to rows with unique `key`.

    A row_number over everything would sort all rows in one task.  Here rows are numbered inside
    4096 hash buckets (the first three digits of the key's SHA-1), and each bucket starts where the
    ones before it end; only the 4096 bucket counts go through a single task.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.sha1(F.col(key).cast("string")), 1, 3))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_bucket").orderBy(key)
    return (
        bucketed.withColumn("_rank", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")  # never more than 4096 rows
        .withColumn(id_col, (start + F.col("_before") + F.col("_rank")).cast("bigint"))
        .drop("_bucket", "_rank", "_before")
    )
