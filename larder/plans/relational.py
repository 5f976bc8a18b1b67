"""Registered queries of the relational group."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.functions.identity import backfill_uuid
from larder.operators import tables
from larder.plans.corpus import bridge, lines, oracle, recipes, table

ORDER = ["order_index", "name", "quantity", "line_tie"]
FIELDS = ORDER + ["unit", "notes"]


def _shown(nested):
    """Nested ingredient arrays as one text column, so both engines print the same."""
    return F.array_join(
        F.transform(
            "ingredients",
            lambda i: F.concat_ws(
                "/", i["order_index"].cast("string"), i["name"], i["quantity"].cast("int").cast("string"), i["unit"],
                F.coalesce(i["notes"], F.lit("-")),
            ),
        ),
        ";",
    ).alias("ingredients")


_NESTED_SQL = """
nested AS (
  SELECT recipe_id, string_agg(concat_ws('/', order_index, name, CAST(quantity AS INT), unit, coalesce(notes, '-')), ';'
         ORDER BY order_index, name, quantity, line_tie, unit, coalesce(notes, '')) AS ingredients
  FROM bridge GROUP BY recipe_id)
"""


def _with_uuid(spark, sf_dir):
    r = recipes(spark, sf_dir)
    return r.withColumn(
        "uuid",
        backfill_uuid(F.col("title"), F.col("reddit_post_id"), F.col("source_url"), F.lit(None).cast("string")),
    )


UUID_SQL = """
hashed AS (
  SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title)) || ':' ||
    CASE WHEN reddit_post_id IS NOT NULL THEN 'reddit:' || reddit_post_id
         ELSE lower(trim(coalesce(source_url, ''))) END)) AS h FROM recipes),
named AS (
  SELECT *, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
    || h[18:20] || '-' || h[21:32] AS uuid FROM hashed)
"""


def _get(spark, sf_dir, **key):
    hit = tables.get_recipe(_with_uuid(spark, sf_dir), bridge(spark, sf_dir), ORDER, FIELDS, **key)
    return hit.select("id", "title", "uuid", "difficulty", _shown(hit))


_GET_SQL = "SELECT id, title, uuid, difficulty, ingredients FROM named LEFT JOIN nested ON id = recipe_id WHERE "


def q1_by_id(spark, sf_dir):
    return _get(spark, sf_dir, id=42)


def q1_by_uuid(spark, sf_dir):
    return _get(spark, sf_dir, uuid=_with_uuid(spark, sf_dir).where("id = 42").select("uuid").scalar())


def q1_by_title(spark, sf_dir):
    return _get(spark, sf_dir, title=recipes(spark, sf_dir).where("id = 77").select("title").scalar())


def q1_dictionaries(spark, sf_dir):
    """The three left outer joins, aggregated so that every row counts."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    ingredients = part.where("id % 10 <> 3").withColumn("category", F.lit("food"))
    supplier = table(spark, sf_dir, "supplier")
    measurements = supplier.where("s_suppkey % 4 <> 1").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.lit("u").alias("abbreviation"), F.lit("other").alias("unit_type"),
    )
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("recipe_id"), F.col("l_partkey").alias("ingredient_id"),
        F.col("l_suppkey").alias("measurement_id"), F.col("l_quantity").alias("amount"),
    )
    return (
        tables.join_dictionaries(raw, ingredients, measurements)
        .groupBy("name", "unit_type")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))
    )


def q2_list(spark, sf_dir):
    hit = tables.list_recipes(
        recipes(spark, sf_dir), bridge(spark, sf_dir), ORDER, FIELDS, limit=50, offset=10,
        meal="dinner", difficulty="easy", tags=["vegan", "keto"], max_prep=30, max_cook=120, min_servings=2,
    )
    return hit.select("id", "title", "created_at", "prep_time_minutes", "cook_time_minutes", _shown(hit))


def q2_list_defaults(spark, sf_dir):
    """No filter is set: empty values are ignored."""
    hit = tables.list_recipes(
        recipes(spark, sf_dir), bridge(spark, sf_dir), ORDER, FIELDS, cuisine="", tags=[], max_prep=0
    )
    return hit.select("id", "title", "created_at", _shown(hit))


def q4(spark, sf_dir):
    return tables.corpus_statistics(recipes(spark, sf_dir))


def q5(spark, sf_dir):
    return tables.count_by(recipes(spark, sf_dir), "cuisine_type")


def q5_known(spark, sf_dir):
    return tables.count_by(recipes(spark, sf_dir), "cuisine_type", keep_null=False)


def q6(spark, sf_dir):
    return tables.most_recent(recipes(spark, sf_dir), 20).select("id", "title", "created_at")


def q7(spark, sf_dir):
    now = F.lit(dt.datetime(1998, 6, 2, 0, 30))
    return tables.added_since(recipes(spark, sf_dir), now).select("id", "title", "created_at")


def q8(spark, sf_dir):
    return tables.count_by_source(recipes(spark, sf_dir), "%u%")


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.lit(True).alias("embedding"))


def q9(spark, sf_dir):
    r = recipes(spark, sf_dir).join(_vectors(spark, sf_dir), "id", "left")
    return tables.quality_checks(r, bridge(spark, sf_dir))


def q10(spark, sf_dir):
    return tables.without_embedding(recipes(spark, sf_dir), _vectors(spark, sf_dir), 100).select("id", "title")


def q10_all(spark, sf_dir):
    return tables.without_embedding(recipes(spark, sf_dir), _vectors(spark, sf_dir)).select("id")


ENTRIES = {
    "Q1_get_recipe_by_id": (q1_by_id, oracle(_GET_SQL + "id = 42", UUID_SQL + "," + _NESTED_SQL)),
    "Q1_get_recipe_by_uuid": (
        q1_by_uuid, oracle(_GET_SQL + "uuid = (SELECT uuid FROM named WHERE id = 42)", UUID_SQL + "," + _NESTED_SQL),
    ),
    "Q1_get_recipe_by_title": (
        q1_by_title, oracle(_GET_SQL + "title = (SELECT title FROM recipes WHERE id = 77)", UUID_SQL + "," + _NESTED_SQL),
    ),
    "Q1_dictionary_outer_joins": (
        q1_dictionaries,
        """SELECT i.p_name AS name, CASE WHEN m.s_suppkey IS NOT NULL THEN 'other' END AS unit_type, count(*) AS n,
             sum(l_quantity) AS amount
           FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 10 <> 3) i ON l_partkey = p_partkey
             LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 4 <> 1) m ON l_suppkey = m.s_suppkey GROUP BY 1, 2""",
    ),
    "Q2_list_recipes": (
        q2_list,
        oracle(
            """SELECT id, title, created_at, prep_time_minutes, cook_time_minutes, ingredients FROM
               (SELECT * FROM recipes WHERE meal_type = 'dinner' AND difficulty = 'easy'
                  AND list_has_any(dietary_tags, ['vegan', 'keto']) AND prep_time_minutes <= 30
                  AND cook_time_minutes <= 120 AND servings >= 2 ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 10)
               LEFT JOIN nested ON id = recipe_id""",
            _NESTED_SQL,
        ),
    ),
    "Q2_list_recipes_defaults": (
        q2_list_defaults,
        oracle(
            """SELECT id, title, created_at, ingredients FROM
               (SELECT * FROM recipes ORDER BY created_at DESC, id DESC LIMIT 50)
               LEFT JOIN nested ON id = recipe_id""",
            _NESTED_SQL,
        ),
    ),
    "Q4_corpus_statistics": (
        q4,
        oracle(
            """SELECT count(*) AS total_recipes, count(DISTINCT cuisine_type) AS cuisines,
               count(DISTINCT meal_type) AS meal_types, avg(prep_time_minutes) AS avg_prep,
               avg(cook_time_minutes) AS avg_cook, avg(total_time_minutes) AS avg_total,
               avg(CAST(servings AS DOUBLE)) AS avg_servings FROM recipes"""
        ),
    ),
    "Q5_count_by_cuisine": (
        q5, oracle("SELECT cuisine_type, count(*) AS n FROM recipes GROUP BY 1 ORDER BY n DESC, 1 NULLS LAST"),
    ),
    "Q5_count_by_cuisine_known": (
        q5_known,
        oracle("SELECT cuisine_type, count(*) AS n FROM recipes WHERE cuisine_type IS NOT NULL GROUP BY 1"),
    ),
    "Q6_most_recent": (
        q6, oracle("SELECT id, title, created_at FROM recipes ORDER BY created_at DESC, id DESC LIMIT 20"),
    ),
    "Q7_added_in_last_hour": (
        q7,
        oracle(
            """SELECT id, title, created_at FROM recipes
               WHERE created_at > TIMESTAMP '1998-06-02 00:30:00' - INTERVAL 1 HOUR"""
        ),
    ),
    "Q8_count_by_source": (
        q8, oracle("SELECT dataset, count(*) AS n FROM recipes WHERE dataset LIKE '%u%' GROUP BY 1"),
    ),
    "Q9_quality_checks": (
        q9,
        oracle(
            """SELECT count(*) AS recipes, count(*) FILTER (title IS NULL) AS null_titles,
               count(*) FILTER (id NOT IN (SELECT recipe_id FROM bridge)) AS without_ingredients,
               count(*) FILTER (id IN (SELECT vec_id FROM embeddings)) AS with_embedding,
               (SELECT count(*) FROM bridge) AS bridge_rows FROM recipes"""
        ),
    ),
    "Q10_without_embedding": (
        q10,
        oracle("SELECT id, title FROM recipes WHERE id NOT IN (SELECT vec_id FROM embeddings) ORDER BY id LIMIT 100"),
    ),
    "Q10_without_embedding_all": (
        q10_all, oracle("SELECT id FROM recipes WHERE id NOT IN (SELECT vec_id FROM embeddings)"),
    ),
}
