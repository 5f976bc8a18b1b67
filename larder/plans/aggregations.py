"""Registered queries of the nested-aggregation group."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larder.operators import aggregates as agg
from larder.operators import sketches
from larder.operators.tables import count_by
from larder.plans.corpus import lines, oracle, recipes
from larder.session import shared_folder


def a1(spark, sf_dir):
    return agg.ingredient_totals(recipes(spark, sf_dir), lines(spark, sf_dir))


def a1_top(spark, sf_dir):
    return agg.top_ingredients(lines(spark, sf_dir), 50)


def a1_approx_error(spark, sf_dir):
    """The approximate distinct count next to the exact one: true when within 10 percent."""
    r, n = recipes(spark, sf_dir), lines(spark, sf_dir)
    exact = agg.ingredient_totals(r, n).select("unique_ingredients").scalar()
    return agg.ingredient_totals(r, n, approx=True).select(
        "mentions", (F.abs(F.col("unique_ingredients") - exact) <= exact * 0.1).alias("close")
    )


def a1_loads(spark, sf_dir):
    """Totals from what three loads stored."""
    r, n = recipes(spark, sf_dir), lines(spark, sf_dir)
    store = sketches.Totals(spark, f"{shared_folder(spark)}/totals/{uuid.uuid4().hex}")
    for part in range(3):
        store.add(str(part), r.where(F.col("id") % 3 == part), n.where(F.col("recipe_id") % 3 == part))
    return store.read().select("mentions", "unique_ingredients", "total_recipes")


def a1_titles(spark, sf_dir):
    """Distinct titles from the sketches of the datasets, with the exact number."""
    r = recipes(spark, sf_dir)
    sketch = sketches.merged(sketches.least_hashes(r, "title", 1024, by="dataset"), 1024)
    exact = r.select(F.countDistinct("title").alias("n")).scalar()
    return sketches.estimate(sketch, 1024, "unique_titles").withColumn("exact", exact)


def a2(spark, sf_dir):
    return agg.top_ingredients_per_cuisine(recipes(spark, sf_dir), lines(spark, sf_dir))


def a3(spark, sf_dir):
    return agg.ingredient_frequency(recipes(spark, sf_dir), lines(spark, sf_dir))


def a4_20(spark, sf_dir):
    return agg.top_ingredients(lines(spark, sf_dir), 20)


def a5(spark, sf_dir):
    df = agg.ingredient_titles(recipes(spark, sf_dir), lines(spark, sf_dir))
    return df.select("name", "mentions", "recipe_count", F.array_join("titles", "; ").alias("titles"))


def a6(spark, sf_dir):
    return agg.difficulty_profile(recipes(spark, sf_dir), lines(spark, sf_dir))


def a7(spark, sf_dir):
    df = agg.cuisine_samples(recipes(spark, sf_dir))
    sample = lambda s: F.concat_ws(
        "/", s["title"], F.coalesce(s["difficulty"], F.lit("-")),
        F.coalesce(s["total_time_minutes"].cast("string"), F.lit("-")),
    )
    return df.select(
        "cuisine_type", "n", F.array_join(F.transform("samples", sample), "; ").alias("samples"),
        F.array_join(
            F.transform("breakdown", lambda b: F.concat_ws("=", b["difficulty"], b["d"].cast("string"))), ", "
        ).alias("breakdown"),
    )


def a8_cuisine(spark, sf_dir):
    return count_by(recipes(spark, sf_dir), "cuisine_type", keep_null=False)


def a8_prep(spark, sf_dir):
    return agg.average_prep_by_difficulty(recipes(spark, sf_dir))


def a9(spark, sf_dir):
    return agg.easy_with_ingredients(recipes(spark, sf_dir), lines(spark, sf_dir))


_TOP = "SELECT name, count(*) AS mentions FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT "

ENTRIES = {
    "A1_ingredient_totals": (
        a1,
        oracle(
            """SELECT count(name) AS mentions, count(DISTINCT name) AS unique_ingredients,
               (SELECT count(id) FROM recipes) AS total_recipes FROM lines"""
        ),
    ),
    "A1_top_50_ingredients": (a1_top, oracle(_TOP + "50")),
    "A1_totals_by_load": (
        a1_loads,
        oracle(
            """SELECT count(name) AS mentions, count(DISTINCT name) AS unique_ingredients,
               (SELECT count(id) FROM recipes) AS total_recipes FROM lines"""
        ),
    ),
    "A1_titles_from_sketches": (
        a1_titles,
        oracle(
            """SELECT CASE WHEN count(*) < 1024 THEN count(*) ELSE round(1023::DOUBLE * 1152921504606846976::DOUBLE / max(h)::DOUBLE)::BIGINT END AS unique_titles,
                 CASE WHEN count(*) < 1024 THEN 0 ELSE 1 / sqrt(1022::DOUBLE) END AS relative_error, (SELECT count(DISTINCT title) FROM recipes) AS exact
               FROM (SELECT DISTINCT ('0x' || substr(md5(title), 1, 15))::BIGINT AS h FROM recipes ORDER BY h LIMIT 1024)"""
        ),
    ),
    "A1_approximate_unique": (a1_approx_error, oracle("SELECT count(name) AS mentions, true AS close FROM lines")),
    "A2_top_ingredients_per_cuisine": (
        a2,
        oracle(
            """SELECT cuisine_type, cuisine_recipes, name, mentions, CAST(rank AS INT) AS rank FROM (
                 SELECT *, row_number() OVER (PARTITION BY cuisine_type ORDER BY mentions DESC, name) AS rank FROM (
                   SELECT cuisine_type, cuisine_recipes, name, count(*) AS mentions
                   FROM lines JOIN recipes ON recipe_id = id JOIN
                     (SELECT cuisine_type, count(*) AS cuisine_recipes FROM recipes WHERE cuisine_type IS NOT NULL
                      GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) USING (cuisine_type)
                   GROUP BY 1, 2, 3)) WHERE rank <= 10"""
        ),
    ),
    "A3_ingredient_frequency": (
        a3,
        oracle(
            """SELECT name, count(*) AS mentions, count(DISTINCT recipe_id) AS recipe_count,
               round(count(DISTINCT recipe_id) * 100.0 / (SELECT count(*) FROM recipes), 6)::DOUBLE AS percentage
               FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30"""
        ),
    ),
    "A4_top_20_ingredients": (a4_20, oracle(_TOP + "20")),
    "A5_ingredients_with_titles": (
        a5,
        oracle(
            """SELECT name, mentions, CAST(sum(n) AS BIGINT) AS recipe_count,
                 string_agg(title, '; ' ORDER BY n DESC, title) FILTER (r <= 3) AS titles FROM (
                 SELECT name, title, count(DISTINCT recipe_id) AS n,
                   row_number() OVER (PARTITION BY name ORDER BY count(DISTINCT recipe_id) DESC, title) AS r
                 FROM lines JOIN recipes ON recipe_id = id GROUP BY 1, 2)
               JOIN (SELECT name, count(*) AS mentions FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50) USING (name)
               GROUP BY 1, 2"""
        ),
    ),
    "A6_difficulty_profile": (
        a6,
        oracle(
            """SELECT difficulty, count(*) AS n, avg(total_time_minutes) AS avg_time,
                 CAST(coalesce(sum(m), 0) AS BIGINT) AS mentions, avg(reddit_score) AS avg_score
               FROM recipes LEFT JOIN (SELECT recipe_id, count(*) AS m FROM lines GROUP BY 1) ON id = recipe_id
               WHERE difficulty IS NOT NULL GROUP BY 1"""
        ),
    ),
    "A7_cuisine_samples": (
        a7,
        oracle(
            """SELECT * FROM (SELECT cuisine_type, max(c) AS n,
                 string_agg(concat_ws('/', title, coalesce(difficulty, '-'), coalesce(CAST(total_time_minutes AS VARCHAR), '-')),
                            '; ' ORDER BY r) FILTER (r <= 3) AS samples FROM (
                 SELECT *, count(*) OVER (PARTITION BY cuisine_type) AS c,
                   row_number() OVER (PARTITION BY cuisine_type ORDER BY reddit_score DESC, id) AS r FROM recipes
                 WHERE cuisine_type IS NOT NULL) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20)
               JOIN (SELECT cuisine_type, string_agg(difficulty || '=' || d, ', ' ORDER BY difficulty) AS breakdown FROM
                 (SELECT cuisine_type, difficulty, count(*) AS d FROM recipes WHERE difficulty IS NOT NULL GROUP BY 1, 2)
                 GROUP BY 1) USING (cuisine_type)"""
        ),
    ),
    "A8_count_by_cuisine": (
        a8_cuisine,
        oracle("SELECT cuisine_type, count(*) AS n FROM recipes WHERE cuisine_type IS NOT NULL GROUP BY 1"),
    ),
    "A8_average_prep_by_difficulty": (
        a8_prep,
        oracle(
            """SELECT difficulty, count(*) AS n, avg(prep_time_minutes) AS avg_prep FROM recipes
               WHERE difficulty IS NOT NULL GROUP BY 1"""
        ),
    ),
    "A9_easy_with_ingredients": (
        a9,
        oracle(
            """SELECT id, title, mentions, (SELECT count(*) FROM lines JOIN recipes ON recipe_id = id
                 WHERE difficulty = 'easy') AS total_mentions
               FROM recipes JOIN (SELECT recipe_id, count(*) AS mentions FROM lines GROUP BY 1) ON id = recipe_id
               WHERE difficulty = 'easy'"""
        ),
    ),
}
