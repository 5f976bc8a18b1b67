"""Relational queries over the recipe tables: lookup, filtered listing, statistics, quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest_ingredients(bridge: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """One row per recipe with its ingredient rows as an ordered array.

    The array is sorted inside the row, so no window over the bridge is needed, and the collecting
    aggregate works on both sides of the shuffle.  A row is as large as its recipe, no larger.
    """
    line = F.struct(*order, *[f for f in fields if f not in order])
    return bridge.groupBy("recipe_id").agg(F.array_sort(F.collect_list(line)).alias("ingredients"))


def get_recipe(
    recipes: DataFrame,
    bridge: DataFrame,
    order: list[str],
    fields: list[str],
    id: int | None = None,
    uuid: str | Column | None = None,
    title: str | Column | None = None,
) -> DataFrame:
    """Recipes with the given id, uuid or exact title, with ordered nested ingredients.

    The key filter reaches the scan; only the bridge rows of the hit are collected.
    """
    if id is not None:
        hit = recipes.where(F.col("id") == id)
    elif uuid is not None:
        hit = recipes.where(F.col("uuid") == uuid)
    else:
        hit = recipes.where(F.col("title") == title)
    mine = bridge.join(hit.select(F.col("id").alias("recipe_id")), "recipe_id", "left_semi")
    nested = nest_ingredients(mine, order, fields)
    return hit.join(nested, hit["id"] == nested["recipe_id"], "left").drop("recipe_id")


def with_ingredients(hits: DataFrame, recipes: DataFrame, bridge: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """A written page of ranked hits (id, score) as recipes with nested ingredients.

    Both tables meet the ids of the page only, which are broadcast because a page has a size.
    """
    page = F.broadcast(hits)
    mine = bridge.join(page.select(F.col("id").alias("recipe_id")), "recipe_id", "left_semi")
    nested = nest_ingredients(mine, order, fields)
    shown = recipes.join(page, "id")
    return shown.join(nested, shown["id"] == nested["recipe_id"], "left").drop("recipe_id")


def join_dictionaries(bridge: DataFrame, ingredients: DataFrame, measurements: DataFrame) -> DataFrame:
    """Bridge rows with ingredient and measurement attributes: left outer joins, rows are kept."""
    return bridge.join(
        ingredients.select(F.col("id").alias("ingredient_id"), F.col("name"), "category"),
        "ingredient_id",
        "left",
    ).join(
        measurements.select(
            F.col("id").alias("measurement_id"), F.col("name").alias("unit"), "abbreviation", "unit_type"
        ),
        "measurement_id",
        "left",
    )


def recipe_predicate(
    cuisine: str | None = None,
    meal: str | None = None,
    difficulty: str | None = None,
    tags: list[str] | None = None,
    max_prep: int | None = None,
    max_cook: int | None = None,
    min_servings: float | None = None,
) -> Column:
    """AND of the filters that are set; empty and zero values count as not set."""
    parts = []
    if cuisine:
        parts.append(F.col("cuisine_type") == cuisine)
    if meal:
        parts.append(F.col("meal_type") == meal)
    if difficulty:
        parts.append(F.col("difficulty") == difficulty)
    if tags:
        parts.append(F.arrays_overlap("dietary_tags", F.array(*[F.lit(t) for t in tags])))
    if max_prep:
        parts.append(F.col("prep_time_minutes") <= max_prep)
    if max_cook:
        parts.append(F.col("cook_time_minutes") <= max_cook)
    if min_servings:
        parts.append(F.col("servings") >= min_servings)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def page(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit) if offset else df.orderBy(*order).limit(limit)


def list_recipes(
    recipes: DataFrame,
    bridge: DataFrame,
    order: list[str],
    fields: list[str],
    limit: int = 50,
    offset: int = 0,
    **filters,
) -> DataFrame:
    """Filtered page, newest first, then the nested ingredients of that page only.

    The page is cut before the bridge is touched, so only its `limit` rows are joined: the id list is
    broadcast to the bridge scan because its size is the page size.
    """
    hits = page(
        recipes.where(recipe_predicate(**filters)), [F.desc("created_at"), F.desc("id")], limit, offset
    )
    ids = F.broadcast(hits.select(F.col("id").alias("recipe_id")))
    nested = nest_ingredients(bridge.join(ids, "recipe_id", "left_semi"), order, fields)
    return hits.join(nested, hits["id"] == nested["recipe_id"], "left").drop("recipe_id")


def corpus_statistics(recipes: DataFrame) -> DataFrame:
    return recipes.agg(
        F.count("*").alias("total_recipes"),
        F.countDistinct("cuisine_type").alias("cuisines"),
        F.countDistinct("meal_type").alias("meal_types"),
        F.avg("prep_time_minutes").alias("avg_prep"),
        F.avg("cook_time_minutes").alias("avg_cook"),
        F.avg(F.col("total_time_minutes").cast("double")).alias("avg_total"),
        F.avg(F.col("servings").cast("double")).alias("avg_servings"),
    )


def count_by(recipes: DataFrame, column: str, keep_null: bool = True) -> DataFrame:
    source = recipes if keep_null else recipes.where(F.col(column).isNotNull())
    return source.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


def most_recent(recipes: DataFrame, n: int) -> DataFrame:
    return page(recipes, [F.desc("created_at"), F.desc("id")], n)


def added_since(recipes: DataFrame, now: Column, interval: str = "1 hour") -> DataFrame:
    return recipes.where(F.col("created_at") > now - F.expr(f"INTERVAL {interval}"))


def count_by_source(recipes: DataFrame, pattern: str) -> DataFrame:
    return recipes.where(F.col("dataset").like(pattern)).groupBy("dataset").agg(F.count("*").alias("n"))


def quality_checks(recipes: DataFrame, bridge: DataFrame) -> DataFrame:
    """Null titles, recipes without ingredient rows, bridge rows, embeddings present."""
    used = bridge.select(F.col("recipe_id").alias("id")).distinct().withColumn("_used", F.lit(True))
    bridge_rows = bridge.select(F.count("*").alias("n")).scalar()
    has_vector = F.col("embedding").isNotNull() if "embedding" in recipes.columns else F.lit(False)
    return (
        recipes.join(used, "id", "left")
        .agg(
            F.count("*").alias("recipes"),
            F.count_if(F.col("title").isNull()).alias("null_titles"),
            F.count_if(F.col("_used").isNull()).alias("without_ingredients"),
            F.count_if(has_vector).alias("with_embedding"),
        )
        .withColumn("bridge_rows", bridge_rows)
    )


def without_embedding(recipes: DataFrame, vectors: DataFrame, limit: int | None = None) -> DataFrame:
    """Recipes without a stored vector: all of them in no order, or the first by id."""
    missing = recipes.join(vectors.select("id"), "id", "left_anti")
    return missing if limit is None else missing.orderBy("id").limit(limit)
