"""Nested aggregations over recipes and their ingredient lines.

`recipes` has one row per recipe, `lines` one row per ingredient mention (recipe_id, name, ...).  Every
aggregate combines on the map side first, and per-group top-k keeps only k rows per group and task before
the shuffle, so a name or cuisine that holds a large share of the rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def cuisine_lines(recipes: DataFrame, lines: DataFrame) -> DataFrame:
    """Ingredient mentions with the cuisine of their recipe."""
    known = recipes.where(F.col("cuisine_type").isNotNull()).select(F.col("id").alias("recipe_id"), "cuisine_type")
    return lines.select("recipe_id", "name").join(known, "recipe_id")


def ingredient_totals(recipes: DataFrame, lines: DataFrame, approx: bool = False) -> DataFrame:
    """Recipes, ingredient mentions and unique ingredients."""
    unique = F.approx_count_distinct("name") if approx else F.countDistinct("name")
    n_recipes = recipes.select(F.count("id").alias("n")).scalar()
    return lines.agg(F.count("name").alias("mentions"), unique.alias("unique_ingredients")).withColumn(
        "total_recipes", n_recipes
    )


def top_ingredients(lines: DataFrame, n: int) -> DataFrame:
    return (
        lines.groupBy("name").agg(F.count("*").alias("mentions")).orderBy(F.desc("mentions"), "name").limit(n)
    )


def top_ingredients_per_cuisine(
    recipes: DataFrame, lines: DataFrame, cuisines: int = 10, per_cuisine: int = 10
) -> DataFrame:
    """The leading ingredients in each of the leading cuisines (by number of recipes)."""
    leading = (
        recipes.where(F.col("cuisine_type").isNotNull())
        .groupBy("cuisine_type")
        .agg(F.count("*").alias("cuisine_recipes"))
        .orderBy(F.desc("cuisine_recipes"), "cuisine_type")
        .limit(cuisines)
    )
    mine = recipes.join(F.broadcast(leading), "cuisine_type").select(  # `cuisines` rows
        F.col("id").alias("recipe_id"), "cuisine_type", "cuisine_recipes"
    )
    counts = (
        lines.select("recipe_id", "name")
        .join(mine, "recipe_id")
        .groupBy("cuisine_type", "cuisine_recipes", "name")
        .agg(F.count("*").alias("mentions"))
    )
    return top_per_group(counts, ["cuisine_type"], [F.desc("mentions"), F.col("name")], per_cuisine)


def ingredient_frequency(recipes: DataFrame, lines: DataFrame, n: int = 30) -> DataFrame:
    """Mentions, recipe count and share of all recipes for the leading ingredients."""
    total = recipes.select(F.count("*").alias("n")).scalar()
    per_recipe = lines.groupBy("name", "recipe_id").agg(F.count("*").alias("_m"))
    return (
        per_recipe.groupBy("name")
        .agg(F.sum("_m").alias("mentions"), F.count("*").alias("recipe_count"))
        .orderBy(F.desc("mentions"), "name")
        .limit(n)
        .withColumn("percentage", F.round(F.col("recipe_count") * 100.0 / total, 6))
    )


def ingredient_titles(recipes: DataFrame, lines: DataFrame, n: int = 50, titles: int = 3) -> DataFrame:
    """Leading ingredients with their recipe count and most common recipe titles."""
    leading = F.broadcast(top_ingredients(lines, n))  # n rows
    used = (
        lines.select("recipe_id", "name").join(leading, "name").select("recipe_id", "name", "mentions").distinct()
    )
    per_title = (
        used.join(recipes.select(F.col("id").alias("recipe_id"), "title"), "recipe_id")
        .groupBy("name", "mentions", "title")
        .agg(F.count("*").alias("n"))
    )
    counts = per_title.groupBy("name", "mentions").agg(F.sum("n").alias("recipe_count"))
    best = top_per_group(per_title, ["name"], [F.desc("n"), F.col("title")], titles)
    named = best.groupBy("name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "title"))), lambda t: t["title"]).alias("titles")
    )
    return counts.join(named, "name")


def difficulty_profile(recipes: DataFrame, lines: DataFrame) -> DataFrame:
    """Average time, ingredient mentions and average score by difficulty.

    Lines are counted per recipe before the join, so the averages see each recipe once.
    """
    mentions = lines.groupBy(F.col("recipe_id").alias("id")).agg(F.count("*").alias("_m"))
    return (
        recipes.where(F.col("difficulty").isNotNull())
        .select("id", "difficulty", "total_time_minutes", "reddit_score")
        .join(mentions, "id", "left")
        .groupBy("difficulty")
        .agg(
            F.count("*").alias("n"),
            F.avg("total_time_minutes").alias("avg_time"),
            F.coalesce(F.sum("_m"), F.lit(0)).alias("mentions"),
            F.avg("reddit_score").alias("avg_score"),
        )
    )


def cuisine_samples(recipes: DataFrame, cuisines: int = 20, per_cuisine: int = 3) -> DataFrame:
    """Leading cuisines with their best recipes and difficulty breakdown."""
    leading = F.broadcast(
        recipes.where(F.col("cuisine_type").isNotNull())
        .groupBy("cuisine_type")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "cuisine_type")
        .limit(cuisines)
    )
    mine = recipes.join(leading, "cuisine_type")
    best = top_per_group(
        mine.select("cuisine_type", "n", "id", "title", "difficulty", "total_time_minutes", "reddit_score"),
        ["cuisine_type"],
        [F.desc("reddit_score"), F.col("id")],
        per_cuisine,
    )
    samples = best.groupBy("cuisine_type", "n").agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "title", "difficulty", "total_time_minutes"))
        ).alias("samples")
    )
    breakdown = (
        mine.where(F.col("difficulty").isNotNull())
        .groupBy("cuisine_type", "difficulty")
        .agg(F.count("*").alias("d"))
        .groupBy("cuisine_type")
        .agg(F.array_sort(F.collect_list(F.struct("difficulty", "d"))).alias("breakdown"))
    )
    return samples.join(breakdown, "cuisine_type", "left")


def average_prep_by_difficulty(recipes: DataFrame) -> DataFrame:
    return (
        recipes.where(F.col("difficulty").isNotNull())
        .groupBy("difficulty")
        .agg(F.count("*").alias("n"), F.avg("prep_time_minutes").alias("avg_prep"))
    )


def easy_with_ingredients(recipes: DataFrame, lines: DataFrame) -> DataFrame:
    """Easy recipes that have an ingredient, with the mention count over all easy recipes."""
    easy = recipes.where(F.col("difficulty") == "easy")
    per_recipe = lines.groupBy("recipe_id").agg(F.count("*").alias("mentions"))
    hits = easy.join(per_recipe, easy["id"] == per_recipe["recipe_id"]).select("id", "title", "mentions")
    total = (
        easy.select("id").join(per_recipe, easy["id"] == per_recipe["recipe_id"])
        .select(F.coalesce(F.sum("mentions"), F.lit(0)).alias("n")).scalar()
    )
    return hits.withColumn("total_mentions", total)
