"""Registered queries of the extraction group: posts are rendered from order lines, parsed, and compared
with the lines they came from."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder import lexicon as lx
from larder.functions.staging import spread
from larder.operators import extract
from larder.plans.corpus import bridge, oracle, recipes, table

PHRASES = [
    "An easy dish", "Simple Thai curry paste meal", "Advanced pasta risotto", "Vegan gluten-free snack", "Korean bbq",
    "A challenging beef roast dinner", "Pancake morning treat", "Chocolate cake and beef gravy", "Tapas dip",
    "Intermediate sushi and miso", "Keto salad", "Plain food", "Honey sweet wine", "Cheese with olive oil and feta",
]
BULLETS = ["", "* ", "- ", "・", "1. "]
NOISE = ["For the Sauce", "(Serves 2)", "to taste"]


def _pick(values, by):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def _rendered_lines(spark, sf_dir):
    """All lines of each order as one text; the arrays are as large as an order."""
    k = F.col("recipe_id")
    line = F.concat(
        _pick(BULLETS, k), F.col("quantity").cast("int").cast("string"), F.lit(" "), "unit", F.lit(" "), "name"
    )
    return (
        bridge(spark, sf_dir)
        .groupBy("recipe_id")
        .agg(
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("order_index", "name", "quantity", "line_tie", line.alias("t")))),
                    lambda x: x["t"],
                ),
                "\n",
            ).alias("block")
        )
    )


def posts(spark, sf_dir):
    """One post per order that has lines."""
    r = recipes(spark, sf_dir).select("id", "title", "prep_time_minutes", "cook_time_minutes")
    k = F.col("id")
    text = F.concat(
        F.lit("Hello\n\nPrep time: "), F.col("prep_time_minutes").cast("string"), F.lit(" minutes\n"),
        F.when(k % 2 == 0, F.concat(F.lit("Bake for "), F.col("cook_time_minutes").cast("string"), F.lit(" min in a 9 inch pan\n"))).otherwise(""),
        F.lit("\n**Ingredients:**\n"), _pick(NOISE, k), F.lit("\n"), F.col("block"),
        F.lit("\n\n**Instructions:**\n1. Combine all of the parts number "), k.cast("string"),
        F.lit("\n2. Let it rest for one hour\n3. Short\n"),
    )
    made = r.join(_rendered_lines(spark, sf_dir), k == F.col("recipe_id")).select(
        F.col("id").alias("post_id"), F.when(k % 4 != 0, F.col("title")).alias("title"), text.alias("comment")
    )
    return spread(made, table(spark, sf_dir, "orders"))


def _extracted(spark, sf_dir):
    return extract.extract_recipes(posts(spark, sf_dir), ["post_id"])


def ingredients(spark, sf_dir):
    """E1, E4, E7, E11: parsed ingredients, grouped so that order does not matter."""
    i = _extracted(spark, sf_dir).select("post_id", F.explode("ingredients").alias("i"))
    return i.groupBy("post_id", "i.item", "i.amount").agg(F.count("*").alias("n"))


def steps_and_times(spark, sf_dir):
    """E12, E16, E17, E22."""
    return _extracted(spark, sf_dir).select(
        "post_id", "title", "description", "prepTime", "cookTime", "panSize",
        F.array_join(F.transform("instructions", lambda s: F.concat_ws(":", s["step"].cast("string"), s["description"])), " | ").alias("steps"),
    )


def long_posts(spark, sf_dir):
    """E4, E7, E11, E12 without limits: about eighty ingredients, long names, forty steps, one of them long."""
    name = F.when(F.col("order_index") == 2, F.concat("name", F.lit(" "), F.repeat(F.lit("z"), 300))).otherwise(F.col("name"))
    line = F.concat(F.lit("- "), F.col("quantity").cast("int").cast("string"), F.lit(" "), "unit", F.lit(" "), name)
    steps = F.transform(
        F.sequence(F.lit(1), F.lit(40)),
        lambda i: F.concat(
            i.cast("string"), F.lit(". Combine all of the parts number "), i.cast("string"), F.when(i == 7, F.repeat(F.lit(" again"), 80)).otherwise("")
        ),
    )
    known = bridge(spark, sf_dir).join(recipes(spark, sf_dir).select("id"), F.col("recipe_id") == F.col("id"), "left_semi")
    p = known.groupBy(F.floor(F.col("recipe_id") / 20).alias("post_id")).agg(F.collect_list(line).alias("all")).select(
        "post_id",
        F.concat(
            F.lit("Hello\n\n**Ingredients:**\n"), F.array_join("all", "\n"), F.lit("\n\n**Instructions:**\n"), F.array_join(steps, "\n")
        ).alias("comment"),
    )
    made = extract.extract_recipes(p, ["post_id"])
    items = F.array_sort(F.transform("ingredients", lambda i: F.concat_ws("/", i["item"], i["amount"])))
    last = F.array_max(F.transform("instructions", lambda s: F.length(s["description"])))
    return made.select(
        "post_id", F.size("ingredients").alias("n_items"), F.md5(F.array_join(items, ";")).alias("items"),
        F.size("instructions").alias("n_steps"), last.alias("longest_step"),
    )


def report(spark, sf_dir):
    p = posts(spark, sf_dir).withColumn("comment", F.when(F.col("post_id") % 9 != 0, F.col("comment")))
    return extract.extraction_report(extract.extract_recipes(p, ["post_id"]))


def structured_posts(spark, sf_dir):
    part = F.concat(
        F.lit("'"), F.col("quantity").cast("int").cast("string"), F.lit(" "), "unit", F.lit(" "), "name", F.lit("'")
    )
    lists = bridge(spark, sf_dir).groupBy("recipe_id").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(part)), ", "), F.lit("]")).alias("ingredients")
    )
    r = recipes(spark, sf_dir).select("id", "title")
    return r.join(lists, r["id"] == lists["recipe_id"]).select(
        F.col("id").alias("post_id"), "title", "ingredients", F.lit('["Mix it.", "", "Bake it."]').alias("directions")
    )


def structured(spark, sf_dir):
    """E10, E23, S4: list literals back to rows."""
    e = extract.extract_recipes(structured_posts(spark, sf_dir), ["post_id"])
    i = e.select("post_id", F.explode("ingredients").alias("i"), F.element_at("instructions", -1).alias("s"))
    return i.groupBy("post_id", "i.item", "i.amount", F.col("s.step").alias("last_step")).agg(F.count("*").alias("n"))


def keyword_posts(spark, sf_dir):
    """Titles and texts that hold the words the attribute rules look for."""
    r = recipes(spark, sf_dir)
    k, a = F.col("id"), F.col("reddit_author").cast("bigint")
    return r.select(
        k.alias("post_id"),
        F.concat(F.lit("**"), _pick(PHRASES, k), F.lit("**")).alias("head"),
        F.concat(
            F.lit("**"), _pick(PHRASES, k), F.lit("**\n\n"), _pick(PHRASES, a), F.lit(" \n"), F.repeat(F.lit("- x\n"), (a % 18).cast("int")),
            F.repeat(F.lit("1) y\n"), (k % 13).cast("int")),
        ).alias("comment"),
    )


def attributes(spark, sf_dir):
    """E18 - E21 with the title given, over every combination of phrases and counts."""
    p = keyword_posts(spark, sf_dir).select("post_id", _plain_title().alias("title"), F.col("comment").alias("text"))
    m = extract.add_attributes(p, "title", "text")
    return m.select("post_id", "difficulty", "cuisine", "mealType", F.array_join("dietaryTags", ",").alias("tags"))


def _plain_title():
    return F.replace(F.col("head"), F.lit("**"), F.lit(""))


# --- SQL ---------------------------------------------------------------------------------------------------
def _list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _any(c, words):
    return "(" + " OR ".join("contains({}, '{}')".format(c, w.replace("'", "''")) for w in words) + ")"


def _hits(c, words):
    return "(" + " + ".join("CAST(contains({}, '{}') AS INT)".format(c, w.replace("'", "''")) for w in words) + ")"


_POSTED = "EXISTS (SELECT 1 FROM bridge b WHERE b.recipe_id = id)"

_INGREDIENTS_SQL = """
SELECT recipe_id AS post_id, name AS item, CAST(CAST(quantity AS INT) AS VARCHAR) || ' ' || unit AS amount, count(*) AS n
FROM bridge
WHERE recipe_id IN (SELECT id FROM recipes) GROUP BY 1, 2, 3
"""

_LONG_SQL = """
SELECT recipe_id // 20 AS post_id, CAST(count(*) AS INT) AS n_items, md5(string_agg(t, ';' ORDER BY t)) AS items, 40::INT AS n_steps,
  length('Combine all of the parts number 7') + 480 AS longest_step
FROM (SELECT recipe_id, CASE WHEN order_index = 2 THEN name || ' ' || repeat('z', 300) ELSE name END || '/' || CAST(quantity AS INT) || ' ' || unit AS t
  FROM bridge WHERE recipe_id IN (SELECT id FROM recipes)) GROUP BY 1
"""

_STEPS_SQL = f"""
SELECT id AS post_id, CASE WHEN id % 4 <> 0 THEN title ELSE 'Ingredients:' END AS title, 'Hello' AS description,
  prep_time_minutes || ' minutes' AS "prepTime", CASE WHEN id % 2 = 0 THEN cook_time_minutes || ' min' END AS "cookTime",
  CASE WHEN id % 2 = 0 THEN '9 inch pan' END AS "panSize",
  '1:Combine all of the parts number ' || id || ' | 2:Let it rest for one hour' AS steps
FROM recipes WHERE {_POSTED}
"""

_STRUCTURED_SQL = """
SELECT recipe_id AS post_id, name AS item, CAST(CAST(quantity AS INT) AS VARCHAR) || ' ' || unit AS amount, 3 AS last_step,
  count(*) AS n FROM bridge WHERE recipe_id IN (SELECT id FROM recipes) GROUP BY 1, 2, 3
"""

_KEYWORD_CTE = f"""
keyword AS (
  SELECT id AS post_id, {_list(PHRASES)}[id % {len(PHRASES)} + 1] AS title,
    CAST(reddit_author AS BIGINT) % 18 AS bullets, id % 13 AS steps,
    '**' || {_list(PHRASES)}[id % {len(PHRASES)} + 1] || '**' || chr(10) || chr(10) || {_list(PHRASES)}[CAST(reddit_author AS BIGINT) % {len(PHRASES)} + 1]
      || ' ' || chr(10) || repeat('- x' || chr(10), CAST(CAST(reddit_author AS BIGINT) % 18 AS INT)) || repeat('1) y' || chr(10), CAST(id % 13 AS INT)) AS text
  FROM recipes),
lowered AS (SELECT *, lower(title) AS t, lower(text) AS x, lower(title) || ' ' || lower(text) AS b,
  -- the bold heading starts with an asterisk, which counts as a bullet
  bullets + 1 AS n_bullets FROM keyword)
"""

_M = lx.MEAL_WORDS
_ATTRIBUTES_SQL = f"""
SELECT post_id,
  CASE {' '.join(f"WHEN {_any('b', w)} THEN '{level}'" for level, w in lx.DIFFICULTY_WORDS.items())}
    WHEN {_any('x', lx.ADVANCED_TECHNIQUES)} OR n_bullets > 15 OR steps > 10 THEN 'hard'
    WHEN n_bullets > 8 OR steps > 5 THEN 'medium' WHEN n_bullets > 0 OR steps > 0 THEN 'easy' END AS difficulty,
  CASE {' '.join(f"WHEN contains(t, '{c.lower()}') THEN '{c}'" for c in lx.CUISINE_WORDS)}
    {' '.join(f"WHEN {_hits('b', w)} >= 2 OR {_any('t', w)} THEN '{c}'" for c, w in lx.CUISINE_WORDS.items())} END AS cuisine,
  CASE WHEN {_any('b', _M['dinner'])} AND {_any('b', _M['dessert'])} AND (
      ({_any('t', _M['dinner'])} AND NOT {_any('t', _M['dessert'])}) OR
      (NOT ({_any('t', _M['dessert'])} AND NOT {_any('t', _M['dinner'])}) AND {_hits('b', _M['dinner'])} >= {_hits('b', _M['dessert'])})) THEN 'dinner'
    WHEN {_any('b', _M['dinner'])} AND {_any('b', _M['dessert'])} AND {_any('t', _M['dessert'])} AND NOT {_any('t', _M['dinner'])} THEN 'dessert'
    {' '.join(f"WHEN {_any('b', w)} THEN '{m}'" for m, w in _M.items())}
    WHEN {_any('x', lx.SWEET_WORDS)} AND NOT {_any('b', lx.SAVOURY_WORDS)} THEN 'dessert' END AS "mealType",
  CASE WHEN {' OR '.join(_any('b', w) for w in lx.TAG_WORDS.values())}
    THEN concat_ws(',', {', '.join(f"CASE WHEN {_any('b', w)} THEN '{t}' END" for t, w in lx.TAG_WORDS.items())})
    WHEN NOT {_any('x', lx.MEAT_WORDS)} AND NOT {_any('x', lx.DAIRY_WORDS + lx.EGG_WORDS)} THEN 'vegan,vegetarian'
    WHEN NOT {_any('x', lx.MEAT_WORDS)} THEN 'vegetarian' END AS tags
FROM lowered
"""

ENTRIES = {
    "E1_E4_E7_E11_ingredients": (ingredients, oracle(_INGREDIENTS_SQL)),
    "E12_E16_E17_E22_steps_and_times": (steps_and_times, oracle(_STEPS_SQL)),
    "E4_E12_long_posts": (long_posts, oracle(_LONG_SQL)),
    "E10_E23_structured": (structured, oracle(_STRUCTURED_SQL)),
    "E18_E21_attributes": (attributes, oracle(_ATTRIBUTES_SQL, _KEYWORD_CTE)),
    "E24_extraction_report": (
        report,
        oracle(
            f"""SELECT count(*) AS processed, count(*) FILTER (id % 9 <> 0) AS successful,
                count(*) FILTER (id % 9 = 0) AS failed FROM recipes WHERE {_POSTED}"""
        ),
    ),
}
