"""Registered queries of the load group: dirty staged records made from the order tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder import lexicon
from larder.functions.identity import recipe_uuid
from larder.functions.staging import once
from larder.operators import load
from larder.plans.corpus import oracle, recipes, table
from larder.session import checkpointed

AMOUNTS = [
    "1 1/2 cups", "2-3 tbsp", "200g", "1/2 tsp", "to taste", "", "2 large", "cup", "1 1/0 cup", "½ cup",
    "2 pinches", "3", "12/5 oz", "1.5 kg", " As Needed ", "2 - 4 pieces",
]
ITEMS = [
    "Preheat the oven to 350 degrees.", "to taste", "ab", "12", "***", "For the Cookies", "Salt &amp; pepper",
    "2 cups flour (sifted)", "water\nmilk・egg yolk・x", "Toss all of these things well together now.", "L" * 501,
    "Fresh   basil\tleaves", "&lt;b&gt; sugar &#233;", "1 kg", "y" * 250, "optional",
    "3.5 oz dark chocolate", "200 g  Ricotta (fresh)", "&amp;lt; &quot;raw&quot;",
]
TIMES = ["30 minutes", "1 hour", "1.5 hr", "<UNKNOWN>", "", "45", "overnight", "1 hour 30 minutes"]
LEVELS = ["EASY", " Medium ", "hard", "impossible", "<UNKNOWN>"]
COURSES = ["Side dish", "soup", "Dinner", "Beverage", "brunch", "null", "", "snack"]
NOW = dt.datetime(2024, 1, 1)


def _pick(values, by):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def staged(spark, sf_dir):
    """One staged record per order, with the faults the load rules deal with."""
    k, c = F.col("id"), F.col("author")
    source = recipes(spark, sf_dir, cpu_heavy=True).withColumn("author", F.col("reddit_author").cast("bigint"))
    third = F.when(k % 9 == 0, F.lit("cook the rice")).otherwise(F.concat(F.lit("Olive oil "), (c % 50).cast("string")))
    line = lambda item, amount, notes: F.struct(item.alias("item"), amount.alias("amount"), notes.alias("notes"))
    none = F.lit(None).cast("string")
    step = lambda n, t, d: F.struct(F.lit(n).alias("step"), F.lit(t).alias("title"), F.lit(d).alias("description"))
    title = (
        F.when(k % 101 == 0, F.lit("   "))
        .when(k % 103 == 0, F.concat(F.repeat(F.lit("T"), 600), k.cast("string")))
        .otherwise(F.col("title"))
    )
    return source.select(
        F.concat(F.lit("staged/"), F.lpad(k.cast("string"), 12, "0")).alias("path"),
        recipe_uuid(title).alias("uuid"),
        title.alias("title"),
        F.when(k % 107 == 0, F.repeat(F.lit("d"), 1200)).otherwise(F.col("description")).alias("description"),
        F.when(
            k % 113 != 0,
            F.array(
                line(F.concat(F.lit("red "), F.lower("title")), _pick(AMOUNTS, k), none),
                line(_pick(ITEMS, k), _pick(AMOUNTS, c), F.when(k % 23 == 0, F.repeat(F.lit("n"), 600))),
                line(third, F.lit("2 tbsp"), F.lit("")),
            ),
        ).otherwise(F.array().cast("array<struct<item:string,amount:string,notes:string>>")).alias("ingredients"),
        F.array(step(1, "Step 1", "Do it"), step(2, "Mix", "Mix it well"), step(3, "Step 2", "Rest")).alias("instructions"),
        _pick(TIMES, k).alias("prepTime"),
        _pick(TIMES, c).alias("cookTime"),
        none.alias("chillTime"),
        none.alias("panSize"),
        _pick(LEVELS, k).alias("difficulty"),
        F.when(k % 5 == 0, F.lit("<UNKNOWN>")).otherwise(F.col("cuisine_type")).alias("cuisine"),
        _pick(COURSES, k).alias("mealType"),
        F.col("dietary_tags").alias("dietaryTags"),
    )


def _stored(spark, sf_dir):
    """Tables that already hold the recipes of every 29th order, and the seed measurements."""
    tables = load.empty_tables(spark)
    old = recipes(spark, sf_dir).where("id % 29 = 4").groupBy("title").agg(F.min("id").alias("id"))
    full = tables["recipes"]
    row = {
        **{c: F.lit(None) for c in full.columns}, "id": F.col("id"), "title": F.col("title"),
        "uuid": recipe_uuid(F.col("title")),
    }
    types = dict(full.dtypes)
    return {**tables, "recipes": old.select(*[row[c].cast(types[c]).alias(c) for c in full.columns])}


def _loaded(spark, sf_dir):
    return load.load_recipes(staged(spark, sf_dir), _stored(spark, sf_dir), F.lit(NOW), cut=checkpointed)


def l1_l3(spark, sf_dir):
    return load.clean_fields(staged(spark, sf_dir)).select(
        "path", "prepTime", "cookTime", "difficulty", "cuisine", "mealType"
    )


def l4(spark, sf_dir):
    df = staged(spark, sf_dir)
    return df.select("path", F.array_join(load.instruction_texts(), " | ").alias("steps"))


def _lines(spark, sf_dir):
    df = staged(spark, sf_dir)
    checked = once(df.select("path", "ingredients"), checked=load.check_lines())
    return checked.select("path", F.explode(load.prepare_lines()).alias("l"))


def l5_l6(spark, sf_dir):
    return _lines(spark, sf_dir).select(
        "path", "l.order_index", F.length("l.item").cast("int").alias("n_chars"), F.col("l.item").alias("item"),
        "l.reason",
    )


def l7_l8(spark, sf_dir):
    return _lines(spark, sf_dir).select("path", "l.order_index", "l.parsed.amount", "l.parsed.unit", "l.parsed.unit_type")


def l9(spark, sf_dir):
    return _lines(spark, sf_dir).where("l.reason IS NULL").select("path", "l.order_index", "l.name", "l.notes")


def l10_l11(spark, sf_dir):
    return load.clean_staged(staged(spark, sf_dir)).select(
        "path", "prep_time_minutes", "cook_time_minutes", "total_time_minutes"
    )


def l12_l13(spark, sf_dir):
    return load.clean_staged(staged(spark, sf_dir)).select(
        "path", F.length("title").cast("int").alias("title_length"),
        F.length("description").cast("int").alias("description_length"), "n_total", "n_valid", "problem",
    )


def l15_l18(spark, sf_dir):
    return _loaded(spark, sf_dir).status


def l16(spark, sf_dir):
    return staged(spark, sf_dir).select("path", "uuid")


def l19_ingredients(spark, sf_dir):
    return _loaded(spark, sf_dir).ingredients.select("id", "name")


def l19_measurements(spark, sf_dir):
    return _loaded(spark, sf_dir).measurements.select("id", "name", "abbreviation", "unit_type")


def l20_bridge(spark, sf_dir):
    df = _loaded(spark, sf_dir)
    return df.recipe_ingredients.select(
        "recipe_id", "ingredient_id", "measurement_id", F.col("amount").cast("double").alias("amount"), "notes", "order_index"
    )


def l20_recipes(spark, sf_dir):
    return _loaded(spark, sf_dir).recipes.select("id", "uuid", "title", "difficulty", "meal_type", "total_time_minutes")


def l21(spark, sf_dir):
    r = recipes(spark, sf_dir)
    updates = (
        table(spark, sf_dir, "orders").where("o_orderkey % 3 = 1").select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("New "), F.col("o_orderkey").cast("string"))).alias("title"),
            F.when(F.col("o_orderkey") % 5 == 0, F.lit("hard")).alias("difficulty"),
        )
    )
    return load.update_recipes(r, updates, F.lit(NOW)).select("id", "title", "difficulty", "meal_type", "updated_at")


def l21_lines(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem")
    bridge = raw.select(F.col("l_orderkey").alias("recipe_id"), F.col("l_partkey").alias("ingredient_id"))
    new = table(spark, sf_dir, "orders").where("o_orderkey % 4 = 1").select(
        F.col("o_orderkey").alias("recipe_id"), F.col("o_custkey").alias("ingredient_id")
    )
    return load.replace_lines(bridge, new).groupBy("recipe_id").agg(
        F.count("*").alias("n"), F.sum("ingredient_id").alias("s")
    )


def _ids(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 701).alias("id"))


def _delete(spark, sf_dir):
    bridge = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("recipe_id"), "l_quantity")
    return load.delete_recipes(recipes(spark, sf_dir), bridge, _ids(spark, sf_dir))


def l22(spark, sf_dir):
    left, bridge, _ = _delete(spark, sf_dir)
    n_left = left.select(F.count("*").alias("n")).scalar()
    return bridge.agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity")).withColumn("recipes", n_left)


def l22_hits(spark, sf_dir):
    return _delete(spark, sf_dir)[2]


def l23(spark, sf_dir):
    r = recipes(spark, sf_dir).withColumn("uuid", recipe_uuid(F.col("title")))
    part = table(spark, sf_dir, "part")
    bridge = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("recipe_id"), F.col("l_partkey").alias("ingredient_id"),
        F.col("l_suppkey").alias("measurement_id"), F.col("l_linenumber").alias("order_index"),
    )
    return load.violations(
        r.where("id % 50 <> 7").withColumn("difficulty", F.when(F.col("id") % 40 == 0, "tough").otherwise(F.col("difficulty"))),
        part.where("p_partkey % 20 <> 3").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("mass").alias("unit_type")
        ),
        bridge,
    )


def l24_drift(spark, sf_dir):
    s = staged(spark, sf_dir).withColumn(
        "uuid", F.when(F.col("path").endswith("7"), recipe_uuid(F.concat(F.col("title"), F.lit("!")))).otherwise(F.col("uuid"))
    )
    wanted = s.where("path LIKE '%3' OR path LIKE '%17'").select("uuid")
    again = load.reload_recipes(s, wanted, _stored(spark, sf_dir), F.lit(NOW))
    return again.drift.select("path", "uuid", "current_uuid", "drift")


def l24_recipes(spark, sf_dir):
    s = staged(spark, sf_dir)
    wanted = s.where("path LIKE '%3' OR path LIKE '%17'").select("uuid")
    again = load.reload_recipes(s, wanted, _stored(spark, sf_dir), F.lit(NOW))
    return again.recipes.groupBy("title").agg(
        F.max("difficulty").alias("difficulty"), F.max("total_time_minutes").alias("total"), F.count("*").alias("n")
    )


def l25(spark, sf_dir):
    return load.load_report(_loaded(spark, sf_dir).status)


def l25_errors(spark, sf_dir):
    return load.first_errors(_loaded(spark, sf_dir).status)


# --- the same in SQL ----------------------------------------------------------------------------------
def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _sql_pick(values, by) -> str:
    return f"{_list(values)}[{by} % {len(values)} + 1]"


def _any(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {_text(w)})" for w in words) + ")"


_UNIT_ROWS = ", ".join(
    f"({_text(s)}, {_text(n)}, {_text(a)}, {_text(t)})" for n, a, t, spellings in lexicon.UNITS for s in spellings
)
_ALIASES = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in lexicon.MEAL_TYPE_ALIASES.items())
_NULLS = ", ".join(_text(t) for t in lexicon.NULL_TOKENS)
_BLANK = r"' \t\n\r'".replace("\\t", "\t").replace("\\n", "\n").replace("\\r", "\r")


def _time(c: str) -> str:
    return f"""CASE WHEN {c} IN ({_NULLS}) THEN NULL WHEN regexp_full_match({c}, '\\d+') THEN {c} || ' minutes' ELSE {c} END"""


def _minutes(c: str) -> str:
    n = f"try_cast(regexp_extract(lower({c}), '(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE)"
    return f"CAST(floor(CASE WHEN {c} LIKE '%hour%' OR {c} LIKE '%hr%' THEN {n} * 60 ELSE {n} END) AS INT)"


STAGED_CTES = f"""
base AS (
  SELECT id, CAST(reddit_author AS BIGINT) AS author, 'staged/' || lpad(CAST(id AS VARCHAR), 12, '0') AS path,
    CASE WHEN id % 101 = 0 THEN '   ' WHEN id % 103 = 0 THEN repeat('T', 600) || id ELSE title END AS title,
    title AS plain_title,
    CASE WHEN id % 107 = 0 THEN repeat('d', 1200) ELSE description END AS description,
    {_sql_pick(TIMES, 'id')} AS prep_text, {_sql_pick(TIMES, 'CAST(reddit_author AS BIGINT)')} AS cook_text,
    {_sql_pick(LEVELS, 'id')} AS level, CASE WHEN id % 5 = 0 THEN '<UNKNOWN>' ELSE cuisine_type END AS cuisine_text,
    {_sql_pick(COURSES, 'id')} AS course
  FROM recipes),
staged AS (
  SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title)) || ':')) AS h FROM base),
named AS (
  SELECT *, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
    || h[18:20] || '-' || h[21:32] AS uuid FROM staged),
raw_lines AS (
  SELECT path, id, 1 AS pos, 'red ' || lower(plain_title) AS item, {_sql_pick(AMOUNTS, 'id')} AS amount, CAST(NULL AS VARCHAR) AS notes
    FROM staged WHERE id % 113 <> 0
  UNION ALL
  SELECT path, id, 2, {_sql_pick(ITEMS, 'id')}, {_sql_pick(AMOUNTS, 'author')}, CASE WHEN id % 23 = 0 THEN repeat('n', 600) END
    FROM staged WHERE id % 113 <> 0
  UNION ALL
  SELECT path, id, 3, CASE WHEN id % 9 = 0 THEN 'cook the rice' ELSE 'Olive oil ' || (author % 50) END, '2 tbsp', NULL
    FROM staged WHERE id % 113 <> 0),
split_lines AS (
  SELECT path, id, pos, unnest(CASE WHEN regexp_matches(item, '[\n・]')
      THEN list_filter(list_transform(regexp_split_to_array(item, '[\n・]'), lambda x: trim(x)), lambda x: length(x) > 2) ELSE [item] END) AS item,
    generate_subscripts(CASE WHEN regexp_matches(item, '[\n・]')
      THEN list_filter(list_transform(regexp_split_to_array(item, '[\n・]'), lambda x: trim(x)), lambda x: length(x) > 2) ELSE [item] END, 1) AS sub,
    amount, notes FROM raw_lines),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY path ORDER BY pos, sub) AS INT) AS order_index,
    lower(item) AS low, trim(item, {_BLANK}) AS bare, lower(trim(amount)) AS amt FROM split_lines),
parsed AS (
  SELECT *,
    CASE WHEN {_any('low', lexicon.LOAD_SKIP_WORDS)} THEN 'instruction or header'
         WHEN lower(bare) IN ({', '.join(_text(n) for n in lexicon.LOAD_NOTES)}) THEN 'note'
         WHEN length(bare) < 3 AND NOT regexp_full_match(bare, '\\d+') THEN 'too short'
         WHEN bare LIKE '%.' AND len(regexp_extract_all(item, '\\S+')) > 5 AND {_any('low', lexicon.LOAD_SENTENCE_VERBS)} THEN 'sentence'
         WHEN trim(item, '*[]()- ') = '' THEN 'formatting' END AS reason,
    CASE WHEN amt = '' OR amt IN ('to taste', 'as needed', 'taste', 'needed') THEN NULL
         WHEN regexp_matches(amt, '^(\\d+\\s+)?\\d+/\\d+') THEN
           CASE WHEN CAST(regexp_extract(amt, '^(?:(\\d+)\\s+)?(\\d+)/(\\d+)', 3) AS DOUBLE) <> 0 THEN
             coalesce(try_cast(regexp_extract(amt, '^(?:(\\d+)\\s+)?(\\d+)/(\\d+)', 1) AS DOUBLE), 0)
             + CAST(regexp_extract(amt, '^(?:(\\d+)\\s+)?(\\d+)/(\\d+)', 2) AS DOUBLE) / CAST(regexp_extract(amt, '^(?:(\\d+)\\s+)?(\\d+)/(\\d+)', 3) AS DOUBLE) END
         WHEN regexp_matches(amt, '^\\d+(\\.\\d+)?\\s*-\\s*\\d') THEN
           (CAST(regexp_extract(amt, '^(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE)
            + CAST(regexp_extract(amt, '^(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)', 2) AS DOUBLE)) / 2
         ELSE try_cast(regexp_extract(amt, '^(\\d+(?:\\.\\d+)?)', 1) AS DOUBLE) END AS amount_value,
    CASE WHEN amt IN ('to taste', 'as needed', 'taste', 'needed') THEN 'to taste'
         ELSE regexp_extract(amt, '^[\\d\\s/.-]*([a-z]+)', 1) END AS unit_text,
    replace(replace(replace(replace(replace(item, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#233;', 'é'), '&amp;', '&') AS unescaped
  FROM numbered),
unit_rows(spelling, unit, abbreviation, unit_type) AS (VALUES {_UNIT_ROWS}),
cleaned AS (
  SELECT parsed.*, u.unit, u.unit_type, u.abbreviation,
    trim(regexp_replace(CASE WHEN item LIKE '%&amp;lt;%' THEN replace(item, '&amp;lt;', '&lt;').replace('&quot;', '"') ELSE unescaped END, '\\s+', ' ', 'g')) AS n0
  FROM parsed LEFT JOIN unit_rows u ON unit_text = spelling),
final_lines AS (
  SELECT *, CASE WHEN regexp_matches(n0, '^\\d') AND length(n1) > 2 THEN n1 ELSE n0 END AS name FROM (
    SELECT *, trim(regexp_replace(regexp_replace(n0, '\\([^)]*\\)$', ''), '{lexicon.LEADING_QUANTITY_PATTERN}', '')) AS n1 FROM cleaned)),
counts AS (SELECT path, CAST(count(*) AS INT) AS n_total, CAST(count(*) FILTER (reason IS NULL) AS INT) AS n_valid FROM parsed GROUP BY 1),
checked AS (
  SELECT named.*, title AS short_title, coalesce(n_total, 0) AS n_total, coalesce(n_valid, 0) AS n_valid,
    CASE WHEN n_total IS NULL THEN 'record does not fulfil the schema'
         WHEN n_valid < 2 THEN 'too few valid ingredients (' || n_valid || ' valid, ' || (n_total - n_valid) || ' skipped of ' || n_total || ')'
         WHEN trim(title) = '' THEN 'recipe title is blank' END AS problem
  FROM named LEFT JOIN counts USING (path)),
stored AS (
  SELECT title, id AS stored_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
    || h[18:20] || '-' || h[21:32] AS uuid FROM (
  SELECT title, min(id) AS id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title)) || ':')) AS h
  FROM recipes WHERE id % 29 = 4 GROUP BY 1)),
firsts AS (
  SELECT short_title, arg_min(uuid, path) AS uuid, min(path) AS first_path FROM checked WHERE problem IS NULL GROUP BY 1),
fresh AS (SELECT * FROM firsts WHERE short_title NOT IN (SELECT title FROM stored)),
accepted AS (
  SELECT *, (SELECT coalesce(max(stored_id), 0) FROM stored)
     + row_number() OVER (ORDER BY substr(sha1(short_title), 1, 3), short_title) AS new_id FROM fresh
  WHERE uuid NOT IN (SELECT uuid FROM stored)
    AND first_path = (SELECT min(first_path) FROM fresh f2 WHERE f2.uuid = fresh.uuid)),
decided AS (
  SELECT f.short_title, f.first_path, coalesce(s.stored_id, a.new_id) AS recipe_id,
    CASE WHEN s.stored_id IS NOT NULL THEN 'exists' WHEN a.new_id IS NOT NULL THEN 'loaded' ELSE 'duplicate_uuid' END AS state
  FROM firsts f LEFT JOIN stored s ON f.short_title = s.title LEFT JOIN accepted a ON a.first_path = f.first_path),
status AS (
  SELECT path, short_title AS title, uuid,
    CASE WHEN problem IS NOT NULL OR state = 'duplicate_uuid' THEN 'failed'
         WHEN state = 'loaded' AND first_path = path THEN 'loaded' ELSE 'exists' END AS status,
    CASE WHEN problem IS NULL AND state <> 'duplicate_uuid' THEN recipe_id END AS recipe_id,
    coalesce(problem, CASE WHEN state = 'duplicate_uuid' THEN 'recipe uuid is already used by another title' END) AS error
  FROM checked LEFT JOIN decided USING (short_title)),
kept AS (
  SELECT new_id AS recipe_id, name, amount_value, unit, unit_type, abbreviation, notes, order_index
  FROM final_lines JOIN accepted ON path = first_path WHERE reason IS NULL),
ingredient_rows AS (
  SELECT row_number() OVER (ORDER BY substr(sha1(name), 1, 3), name) AS id, name FROM (SELECT DISTINCT name FROM kept)),
seeds(id, name, abbreviation, unit_type) AS (VALUES {', '.join(f"({i + 1}, {_text(n)}, {_text(a)}, {_text(t)})" for i, (n, a, t) in enumerate(lexicon.SEED_MEASUREMENTS))}),
measurement_rows AS (
  SELECT CAST(id AS BIGINT) AS id, name, abbreviation, unit_type FROM seeds UNION ALL
  SELECT {len(lexicon.SEED_MEASUREMENTS)} + row_number() OVER (ORDER BY substr(sha1(unit), 1, 3), unit), unit, abbreviation, unit_type
  FROM (SELECT DISTINCT unit, unit_type, any_value(abbreviation) AS abbreviation FROM (
        SELECT k.unit, k.unit_type, u.abbreviation FROM kept k JOIN unit_rows u ON k.unit = u.unit) WHERE unit NOT IN (SELECT name FROM seeds) GROUP BY 1, 2))
"""


def _uuid_of(h: str) -> str:
    return (
        f"{h}[1:8] || '-' || {h}[9:12] || '-5' || {h}[14:16] || '-' || "
        f"translate({h}[17:17], '0123456789abcdef', '89ab89ab89ab89ab') || {h}[18:20] || '-' || {h}[21:32]"
    )


def _sql(query: str, more: str = "") -> str:
    return oracle(query, STAGED_CTES + (", " + more if more else ""))


_CLEAN_SQL = f"""SELECT path, {_time('prep_text')} AS "prepTime", {_time('cook_text')} AS "cookTime",
  CASE WHEN lower(trim(level)) IN ('easy', 'medium', 'hard') THEN lower(trim(level)) END AS difficulty,
  nullif(cuisine_text, '<UNKNOWN>') AS cuisine,
  CASE WHEN lower(course) IN ('breakfast', 'lunch', 'dinner', 'snack', 'dessert') THEN lower(course)
       ELSE CASE lower(course) {_ALIASES} END END AS "mealType" FROM staged"""

ENTRIES = {
    "L1_L3_clean_fields": (l1_l3, _sql(_CLEAN_SQL)),
    "L4_instruction_texts": (l4, _sql("SELECT path, 'Do it | Mix: Mix it well | Step 2: Rest' AS steps FROM staged")),
    "L5_L6_L14_skip_reasons": (
        l5_l6,
        _sql("SELECT path, order_index, CAST(length(item) AS INT) AS n_chars, item, reason FROM parsed"),
    ),
    "L7_L8_amounts": (
        l7_l8, _sql("SELECT path, order_index, amount_value AS amount, unit, unit_type FROM cleaned"),
    ),
    "L9_names": (
        l9, _sql("SELECT path, order_index, name, notes FROM final_lines WHERE reason IS NULL"),
    ),
    "L10_L11_times": (
        l10_l11,
        _sql(
            f"""SELECT path, p AS prep_time_minutes, c AS cook_time_minutes,
                coalesce(nullif(p, 0) + nullif(c, 0), nullif(p, 0), nullif(c, 0)) AS total_time_minutes
                FROM (SELECT path, {_minutes('prep_text')} AS p, {_minutes('cook_text')} AS c FROM staged)"""
        ),
    ),
    "L12_L13_rejects_and_truncation": (
        l12_l13,
        _sql(
            """SELECT path, CAST(length(short_title) AS INT) AS title_length,
               CASE WHEN description IS NOT NULL THEN CAST(length(description) AS INT) END AS description_length, n_total, n_valid, problem FROM checked"""
        ),
    ),
    "L15_L18_load_status": (l15_l18, _sql("SELECT path, title, uuid, status, recipe_id, error FROM status")),
    "L16_uuid": (l16, _sql("SELECT path, uuid FROM named")),
    "L19_ingredient_dictionary": (l19_ingredients, _sql("SELECT id, name FROM ingredient_rows")),
    "L19_measurement_dictionary": (l19_measurements, _sql("SELECT id, name, abbreviation, unit_type FROM measurement_rows")),
    "L20_bridge_rows": (
        l20_bridge,
        _sql(
            """SELECT recipe_id, i.id AS ingredient_id, m.id AS measurement_id,
               CAST(CAST(amount_value AS DECIMAL(10,3)) AS DOUBLE) AS amount, notes, order_index
               FROM kept JOIN ingredient_rows i USING (name) LEFT JOIN measurement_rows m ON m.name = kept.unit"""
        ),
    ),
    "L20_recipes": (
        l20_recipes,
        _sql(
            f"""SELECT stored_id AS id, uuid, title, NULL AS difficulty, NULL AS meal_type, CAST(NULL AS INT) AS total_time_minutes
                FROM stored UNION ALL
                SELECT new_id, a.uuid, a.short_title, c.difficulty, c."mealType", t.total FROM accepted a
                JOIN ({_CLEAN_SQL}) c ON c.path = a.first_path
                JOIN (SELECT path, coalesce(nullif(p, 0) + nullif(c, 0), nullif(p, 0), nullif(c, 0)) AS total
                      FROM (SELECT path, {_minutes('prep_text')} AS p, {_minutes('cook_text')} AS c FROM staged)) t ON t.path = a.first_path"""
        ),
    ),
    "L21_partial_update": (
        l21,
        oracle(
            """SELECT id, CASE WHEN id % 3 = 1 AND id % 2 = 0 THEN 'New ' || id ELSE title END AS title,
               CASE WHEN id % 3 = 1 AND id % 5 = 0 THEN 'hard' ELSE difficulty END AS difficulty, meal_type,
               CASE WHEN id % 3 = 1 THEN TIMESTAMP '2024-01-01' ELSE updated_at END AS updated_at FROM recipes"""
        ),
    ),
    "L21_replace_lines": (
        l21_lines,
        """SELECT recipe_id, count(*) AS n, CAST(sum(ingredient_id) AS BIGINT) AS s FROM (
             SELECT l_orderkey AS recipe_id, l_partkey AS ingredient_id FROM lineitem
               WHERE NOT (l_orderkey % 4 = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders))
             UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 1) GROUP BY 1""",
    ),
    "L22_delete_cascade": (
        l22,
        oracle(
            """SELECT (SELECT count(*) FROM recipes WHERE id NOT IN (SELECT s_suppkey * 701 FROM supplier)) AS recipes,
               count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem
               WHERE l_orderkey NOT IN (SELECT s_suppkey * 701 FROM supplier)"""
        ),
    ),
    "L22_delete_hits": (
        l22_hits,
        oracle("SELECT s_suppkey * 701 AS id, s_suppkey * 701 IN (SELECT id FROM recipes) AS deleted FROM supplier"),
    ),
    "L23_violations": (
        l23,
        oracle(
            """SELECT 'enum difficulty' AS rule, 'tough' AS key, count(*) AS n FROM r WHERE id % 40 = 0 HAVING count(*) > 0
               UNION ALL SELECT 'enum unit_type', 'mass', count(*) FROM supplier
               UNION ALL SELECT 'unique uuid', uuid, count(*) FROM r GROUP BY 2 HAVING count(*) > 1
               UNION ALL SELECT 'unique ingredient name', p_name, count(*) FROM part WHERE p_partkey % 20 <> 3 GROUP BY 2 HAVING count(*) > 1
               UNION ALL SELECT 'unique measurement name', s_name, count(*) FROM supplier GROUP BY 2 HAVING count(*) > 1
               UNION ALL SELECT 'unique bridge', concat_ws('/', l_orderkey, l_partkey, l_linenumber), count(*) FROM lineitem GROUP BY 2 HAVING count(*) > 1
               UNION ALL SELECT 'foreign recipe_id', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT id FROM r) GROUP BY 2
               UNION ALL SELECT 'foreign ingredient_id', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
                 WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 20 <> 3) GROUP BY 2
               UNION ALL SELECT 'foreign measurement_id', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
                 WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 2""",
            """hr AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title)) || ':')) AS h FROM recipes),
               r AS (SELECT *, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || translate(h[17:17], '0123456789abcdef', '89ab89ab89ab89ab')
                 || h[18:20] || '-' || h[21:32] AS uuid FROM hr WHERE id % 50 <> 7)""",
        ),
    ),
    "L24_reload_drift": (
        l24_drift,
        _sql(
            f"""SELECT path, uuid, current_uuid, uuid <> current_uuid AS drift FROM (
                  SELECT path, CASE WHEN id % 10 = 7 THEN {_uuid_of("h2")} ELSE uuid END AS uuid, uuid AS current_uuid FROM (
                    SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title || '!')) || ':')) AS h2 FROM named))
                WHERE uuid IN (SELECT CASE WHEN id % 10 = 7 THEN {_uuid_of("h2")} ELSE uuid END FROM (
                    SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(lower(trim(title || '!')) || ':')) AS h2 FROM named)
                  WHERE path LIKE '%3' OR path LIKE '%17')"""
        ),
    ),
    "L24_reload_recipes": (
        l24_recipes,
        _sql(
            f"""SELECT title, max(difficulty) AS difficulty, max(total) AS total, count(*) AS n FROM (
                  SELECT s.title, u.difficulty, u.total FROM stored s LEFT JOIN updated u ON s.title = u.short_title
                  UNION ALL SELECT short_title, difficulty, total FROM chosen2 c WHERE c.path IN (
                    SELECT first_path FROM fresh2 WHERE uuid NOT IN (SELECT uuid FROM stored)
                      AND first_path = (SELECT min(first_path) FROM fresh2 f WHERE f.uuid = fresh2.uuid))) GROUP BY 1""",
            f"""chosen2 AS (
                  SELECT c.*, d.difficulty, t.total FROM checked c JOIN ({_CLEAN_SQL}) d USING (path)
                  JOIN (SELECT path, coalesce(nullif(p, 0) + nullif(c, 0), nullif(p, 0), nullif(c, 0)) AS total
                        FROM (SELECT path, {_minutes('prep_text')} AS p, {_minutes('cook_text')} AS c FROM staged)) t USING (path)
                  WHERE c.uuid IN (SELECT uuid FROM named WHERE path LIKE '%3' OR path LIKE '%17')),
                firsts2 AS (SELECT short_title, arg_min(uuid, path) AS uuid, min(path) AS first_path FROM chosen2 WHERE problem IS NULL GROUP BY 1),
                fresh2 AS (SELECT * FROM firsts2 WHERE short_title NOT IN (SELECT title FROM stored)),
                updated AS (SELECT short_title, arg_max(difficulty, path) AS difficulty, arg_max(total, path) AS total FROM (
                  SELECT * FROM chosen2 WHERE problem IS NULL AND path IN (SELECT max(path) FROM chosen2 WHERE problem IS NULL GROUP BY short_title)) GROUP BY 1)""",
        ),
    ),
    "L25_load_report": (
        l25,
        _sql(
            """SELECT count(*) AS "totalProcessed", count(*) FILTER (status = 'loaded') AS successful,
               count(*) FILTER (status = 'exists') AS "alreadyExists", count(*) FILTER (status = 'failed') AS failed FROM status"""
        ),
    ),
    "L25_first_errors": (
        l25_errors,
        _sql("SELECT path, error FROM status WHERE error IS NOT NULL ORDER BY path LIMIT 10"),
    ),
}
