"""Registered queries of the ingredient-search and discovery group."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions.identity import backfill_uuid
from larder.operators import ingredients as ing
from larder.operators.tables import nest_ingredients, page
from larder.plans.corpus import lines, oracle, recipes
from larder.plans.relational import UUID_SQL


def _rl(spark, sf_dir):
    return recipes(spark, sf_dir), lines(spark, sf_dir)


def t10_title(spark, sf_dir):
    return ing.wildcard_title(recipes(spark, sf_dir), "*ring*cake*").select("id", "title")


def t10_ingredient(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return ing.with_line(r, n, ing.contains_wildcard(F.col("name"), "*D?WIDGET*")).select("id", "title")


def t11(spark, sf_dir):
    return ing.count_with_line(lines(spark, sf_dir), ing.contains_wildcard(F.col("name"), "*gear*"))


def t12(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return ing.with_line(r, n, ing.matches(F.col("name"), "Anvil")).select("id", "title")


def _scored(df):
    return df.select("id", "title", "score")


def t13(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return _scored(ing.all_of(r, n, ["gizmos"]))


def t14(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return _scored(ing.all_of(r, n, ing.split_list("red ring, bolts; plate")))


EXPRESSION = "widget AND (anvil OR rod) AND NOT gea"


def t15(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return ing.boolean_search(r, n, EXPRESSION).select("id", "title")


def t15_precedence(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return ing.boolean_search(r, n, "NOT plate AND ring OR anvil").select("id")


def t15_documents(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    nested = nest_ingredients(n, ["name"], ["name"])
    documents = r.join(nested, r["id"] == nested["recipe_id"], "left")
    return ing.filter_documents(documents, EXPRESSION).select("id", "title")


def _with_list(df):
    return df.withColumn("ingredients", F.array_join("ingredients", ";"))


def t16(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return _with_list(ing.any_of(r, n, ["ring", "gear", "red"], 10))


def t20(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return _with_list(ing.any_of(r, n, ["widget", "bolt", "cold", "gizmo"], 10))


def t17(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    avoid = ["ring", "bolt", "rod", "small", "blue"]
    return ing.dietary_search(r, n, "dinner", "nation 3", ["vegan", "keto"], avoid).select(
        "id", "title", "cuisine_type"
    )


def t18_ui(spark, sf_dir):
    return ing.quick(recipes(spark, sf_dir), 30, size=10, start=10).select("id", "title", "total_time_minutes")


def t18_score(spark, sf_dir):
    return ing.quick(recipes(spark, sf_dir), 30, by_score=True).select("id", "reddit_score", "total_time_minutes")


def t19(spark, sf_dir):
    return ing.weekend_projects(recipes(spark, sf_dir)).select("id", "title", "reddit_score")


def t21(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    df = ing.personalised(r, n, ["red ring", "hot gear", "cold rod"], "nation_1 nation_4", (15, 45))
    return df.select("id", "title", "score")


def t22(spark, sf_dir):
    df = ing.popularity(recipes(spark, sf_dir)).select("id", "title", F.round("score", 6).alias("score"))
    return page(df, [F.desc("score"), F.col("id")], 50)


def t23(spark, sf_dir):
    return ing.random_recipe(recipes(spark, sf_dir), seed=7).select("id", "title")


def t25(spark, sf_dir):
    return ing.autocomplete(recipes(spark, sf_dir), "Red R", 10).select("id", "title", "reddit_score")


def t26_uuid(spark, sf_dir):
    r = recipes(spark, sf_dir)
    r = r.withColumn("uuid", backfill_uuid(F.col("title"), F.col("reddit_post_id"), F.col("source_url"), F.lit(None).cast("string")))
    wanted = r.where("id = 500").select("uuid").scalar()
    return ing.by_uuid(r, wanted, ["uuid", "title", "meal_type"])


def t26_terms(spark, sf_dir):
    r, n = _rl(spark, sf_dir)
    return ing.with_names(r, n, ["red ring", "blue bolt"]).select("id", "title", "difficulty")


def t26_all(spark, sf_dir):
    return recipes(spark, sf_dir).select("id", "title", "description", "cuisine_type", "meal_type", "difficulty")


def _word(col: str, *terms: str) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"list_has_any(regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}]+'), [{listed}])"


def _fuzzy(col: str, term: str) -> str:
    parts = []
    for w in ing.query_words(term):
        parts.append(f"levenshtein(x, '{w}') <= {ing.allowed_edits(w)}")
    return (
        f"len(list_filter(regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}]+'), lambda x: {' OR '.join(parts)})) > 0"
    )


def _line_score(term: str) -> str:
    return (
        f"(CASE WHEN {_word('name', *ing.query_words(term))} THEN 3 ELSE 0 END"
        f" + CASE WHEN name ILIKE '%{term}%' THEN 2 ELSE 0 END"
        f" + CASE WHEN {_fuzzy('name', term)} THEN 1 ELSE 0 END)"
    )


def _has(term: str) -> str:
    return f"id IN (SELECT recipe_id FROM lines WHERE {_line_score(term)} > 0)"


def _all_of(terms: list[str]) -> str:
    scores = ", ".join(f"max({_line_score(t)}) AS s{i}" for i, t in enumerate(terms))
    total = " + ".join(f"s{i}" for i in range(len(terms)))
    every = " AND ".join(f"s{i} > 0" for i in range(len(terms)))
    return f"""SELECT id, title, CAST({total} AS INT) AS score FROM recipes
        JOIN (SELECT recipe_id, {scores} FROM lines GROUP BY 1) ON id = recipe_id WHERE {every}"""


def _any_of(terms: list[str]) -> str:
    per_line = " + ".join(f"CAST({_word('name', t)} AS INT)" for t in terms)
    return f"""SELECT id, title, description, total_time_minutes, difficulty, score, ingredients FROM recipes
        JOIN (SELECT recipe_id, CAST(sum({per_line}) AS BIGINT) AS score, string_agg(name, ';' ORDER BY name) AS ingredients
              FROM lines GROUP BY 1) ON id = recipe_id
        WHERE score > 0 ORDER BY score DESC, id LIMIT 10"""


_PERSONAL = f"""SELECT id, title, coalesce(n, 0)::DOUBLE + CASE WHEN {_word('cuisine_type', 'nation', '1', '4')} THEN 2 ELSE 0 END
    + CASE WHEN total_time_minutes BETWEEN 15 AND 45 THEN 1.5 ELSE 0 END AS score FROM recipes LEFT JOIN
    (SELECT recipe_id, count(*) AS n FROM lines WHERE name IN ('red ring', 'hot gear', 'cold rod') GROUP BY 1)
    ON id = recipe_id"""

ENTRIES = {
    "T10_wildcard_title": (t10_title, oracle("SELECT id, title FROM recipes WHERE title ILIKE '%ring%cake%'")),
    "T10_wildcard_ingredient": (
        t10_ingredient,
        oracle(
            "SELECT id, title FROM recipes WHERE id IN (SELECT recipe_id FROM lines WHERE name ILIKE '%d_widget%')"
        ),
    ),
    "T11_count_ingredient_wildcard": (
        t11, oracle("SELECT count(DISTINCT recipe_id) AS n FROM lines WHERE name ILIKE '%gear%'"),
    ),
    "T12_nested_match": (
        t12,
        oracle(f"SELECT id, title FROM recipes WHERE id IN (SELECT recipe_id FROM lines WHERE {_word('name', 'anvil')})"),
    ),
    "T13_single_ingredient": (t13, oracle(_all_of(["gizmos"]))),
    "T14_ingredient_list": (t14, oracle(_all_of(["red ring", "bolts", "plate"]))),
    "T15_boolean_filter": (
        t15,
        oracle(
            f"SELECT id, title FROM recipes WHERE {_has('widget')} AND ({_has('anvil')} OR {_has('rod')}) AND NOT {_has('gea')}"
        ),
    ),
    "T15_boolean_precedence": (
        t15_precedence,
        oracle(f"SELECT id FROM recipes WHERE (NOT {_has('plate')} AND {_has('ring')}) OR {_has('anvil')}"),
    ),
    "T15_boolean_filter_documents": (
        t15_documents,
        oracle(
            f"SELECT id, title FROM recipes WHERE {_has('widget')} AND ({_has('anvil')} OR {_has('rod')}) AND NOT {_has('gea')}"
        ),
    ),
    "T16_what_should_i_make": (t16, oracle(_any_of(["ring", "gear", "red"]))),
    "T17_dietary_search": (
        t17,
        oracle(
            f"""SELECT id, title, cuisine_type FROM recipes WHERE meal_type = 'dinner' AND {_word('cuisine_type', 'nation', '3')}
                AND list_has_any(dietary_tags, ['vegan', 'keto']) AND id NOT IN
                (SELECT recipe_id FROM lines WHERE {_word('name', 'ring', 'bolt', 'rod', 'small', 'blue')})"""
        ),
    ),
    "T18_quick_recipes": (
        t18_ui,
        oracle(
            """SELECT id, title, total_time_minutes FROM recipes WHERE difficulty = 'easy' AND total_time_minutes <= 30
               ORDER BY total_time_minutes, id LIMIT 10 OFFSET 10"""
        ),
    ),
    "T18_quick_recipes_by_score": (
        t18_score,
        oracle(
            """SELECT id, reddit_score, total_time_minutes FROM recipes
               WHERE difficulty = 'easy' AND total_time_minutes <= 30"""
        ),
    ),
    "T19_weekend_projects": (
        t19,
        oracle(
            """SELECT id, title, reddit_score FROM recipes WHERE difficulty IN ('medium', 'hard')
               AND reddit_comments_count >= 50 AND total_time_minutes >= 120"""
        ),
    ),
    "T20_seasonal": (t20, oracle(_any_of(["widget", "bolt", "cold", "gizmo"]))),
    "T21_personalised": (t21, oracle(f"SELECT * FROM ({_PERSONAL}) WHERE score >= 2")),
    "T22_popularity": (
        t22,
        oracle(
            """SELECT id, title, round(1.0::DOUBLE + log10(1 + 0.5::DOUBLE * reddit_score) + log10(1 + 0.3::DOUBLE * reddit_comments_count), 6) AS score
               FROM recipes ORDER BY score DESC, id LIMIT 50"""
        ),
    ),
    "T23_random_recipe": (t23, oracle("SELECT id, title FROM recipes ORDER BY sha1('7:' || id) LIMIT 1")),
    "T25_autocomplete": (
        t25,
        oracle(
            """SELECT id, title, reddit_score FROM recipes WHERE starts_with(lower(title), 'red r')
               ORDER BY reddit_score DESC, id LIMIT 10"""
        ),
    ),
    "T26_by_uuid": (
        t26_uuid,
        oracle("SELECT uuid, title, meal_type FROM named WHERE uuid = (SELECT uuid FROM named WHERE id = 500)", UUID_SQL),
    ),
    "T26_exact_names": (
        t26_terms,
        oracle(
            """SELECT id, title, difficulty FROM recipes
               WHERE id IN (SELECT recipe_id FROM lines WHERE name IN ('red ring', 'blue bolt'))"""
        ),
    ),
    "T26_match_all": (
        t26_all, oracle("SELECT id, title, description, cuisine_type, meal_type, difficulty FROM recipes"),
    ),
}
