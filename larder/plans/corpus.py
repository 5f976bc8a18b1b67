"""The given star-schema tables read as a recipe corpus.

`recipes`, `lines` and the rest are DataFrames over the parquet files; ORACLE_CTES is the same mapping
as SQL over the same tables, so every query can be checked against a second engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.staging import spread

DISHES = ["curry", "soup", "salad", "cake", "stew", "pasta", "tart", "roast", "dip", "bowl"]
MEALS = {
    "1-URGENT": "breakfast",
    "2-HIGH": "lunch",
    "3-MEDIUM": "dinner",
    "4-NOT SPECIFIED": "snack",
    "5-LOW": "dessert",
}
DIFFICULTY = {"F": "easy", "P": "medium", "O": "hard"}
SPELLINGS = {
    "ECONOMY": "cup",
    "SMALL": "Cups",
    "MEDIUM": "tbsp",
    "LARGE": "g",
    "STANDARD": "kg",
    "PROMO": "pinch",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(c: Column, mapping: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for key, value in mapping.items():
        chosen = F.when(c == key, F.lit(value)).otherwise(chosen)
    return chosen


def recipes(spark: SparkSession, sf_dir: str, cpu_heavy: bool = False) -> DataFrame:
    """One recipe per order; author attributes come from the customer and the part of the same number."""
    authors = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "part"), F.col("c_custkey") == F.col("p_partkey"))
        .select("c_custkey", "c_mktsegment", "n_name", "p_name")
    )
    k = F.col("o_orderkey")
    title = F.concat_ws(
        " ",
        "p_name",
        F.element_at(F.array(*[F.lit(d) for d in DISHES]), (k % 10 + 1).cast("int")),
        (k % 97).cast("string"),
    )
    orders = table(spark, sf_dir, "orders")
    made = (
        orders
        .join(authors, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            k.alias("id"),
            F.when(k % 11 == 0, F.upper(title)).otherwise(title).alias("title"),
            F.when(
                k % 13 != 0,
                F.concat(
                    F.lit("A "), F.lower("c_mktsegment"), F.lit(" dish from "), F.lower("n_name"),
                    F.lit(" with "), "p_name",
                ),
            ).alias("description"),
            F.array(
                F.concat(F.lit("Prepare the "), "p_name"),
                F.concat(F.lit("Cook for "), (F.col("o_custkey") % 150).cast("string"), F.lit(" minutes")),
                F.lit("Serve"),
            ).alias("instructions"),
            (k % 45).cast("int").alias("prep_time_minutes"),
            (F.col("o_custkey") % 150).cast("int").alias("cook_time_minutes"),
            F.nullif(k % 45 + F.col("o_custkey") % 150, F.lit(0)).cast("int").alias("total_time_minutes"),
            (k % 8 + 1).cast("decimal(10,2)").alias("servings"),
            F.when(k % 17 != 0, _choose(F.col("o_orderstatus"), DIFFICULTY)).alias("difficulty"),
            F.when(k % 19 != 0, F.col("n_name")).alias("cuisine_type"),
            _choose(F.col("o_orderpriority"), MEALS).alias("meal_type"),
            F.filter(
                F.array(
                    F.when(k % 3 == 0, F.lit("vegan")),
                    F.when(k % 4 == 0, F.lit("gluten-free")),
                    F.when(k % 5 == 0, F.lit("keto")),
                ),
                lambda t: t.isNotNull(),
            ).alias("dietary_tags"),
            F.when(k % 7 == 0, F.concat(F.lit("https://example.com/r/"), k.cast("string"))).alias("source_url"),
            F.when(k % 7 == 1, F.concat(F.lit("t3_"), k.cast("string"))).alias("reddit_post_id"),
            F.col("o_custkey").cast("string").alias("reddit_author"),
            F.floor(F.col("o_totalprice") / 1000).cast("int").alias("reddit_score"),
            (k % 120).cast("int").alias("reddit_comments_count"),
            F.lower("c_mktsegment").alias("dataset"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
    )
    return spread(made, orders) if cpu_heavy else made


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """recipe_ingredients: one row per order line, ingredient still by name."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").alias("recipe_id"),
            F.col("l_linenumber").alias("order_index"),
            F.col("l_extendedprice").alias("line_tie"),
            F.col("p_name").alias("name"),
            F.col("l_quantity").alias("quantity"),
            _choose(F.col("p_type"), SPELLINGS).alias("unit"),
            F.when(F.col("l_tax") > 0.05, F.lit("chopped")).alias("notes"),
        )
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge without its ordering columns: all that searches and aggregations need."""
    return bridge(spark, sf_dir).select("recipe_id", "name", "quantity", "unit", "notes")


def _sql_case(column: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {whens} END"


_SQL_DISHES = ", ".join(f"'{d}'" for d in DISHES)

ORACLE_CTES = f"""
recipes AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 11 = 0 THEN upper(t) ELSE t END AS title,
    CASE WHEN o_orderkey % 13 <> 0
         THEN 'A ' || lower(c_mktsegment) || ' dish from ' || lower(n_name) || ' with ' || p_name END AS description,
    ['Prepare the ' || p_name, 'Cook for ' || (o_custkey % 150) || ' minutes', 'Serve'] AS instructions,
    CAST(o_orderkey % 45 AS INT) AS prep_time_minutes,
    CAST(o_custkey % 150 AS INT) AS cook_time_minutes,
    CAST(nullif(o_orderkey % 45 + o_custkey % 150, 0) AS INT) AS total_time_minutes,
    CAST(o_orderkey % 8 + 1 AS DECIMAL(10,2)) AS servings,
    CASE WHEN o_orderkey % 17 <> 0 THEN {_sql_case('o_orderstatus', DIFFICULTY)} END AS difficulty,
    CASE WHEN o_orderkey % 19 <> 0 THEN n_name END AS cuisine_type,
    {_sql_case('o_orderpriority', MEALS)} AS meal_type,
    list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'vegan' END, CASE WHEN o_orderkey % 4 = 0 THEN 'gluten-free' END,
                 CASE WHEN o_orderkey % 5 = 0 THEN 'keto' END], lambda x: x IS NOT NULL) AS dietary_tags,
    CASE WHEN o_orderkey % 7 = 0 THEN 'https://example.com/r/' || o_orderkey END AS source_url,
    CASE WHEN o_orderkey % 7 = 1 THEN 't3_' || o_orderkey END AS reddit_post_id,
    CAST(o_custkey AS VARCHAR) AS reddit_author,
    CAST(floor(o_totalprice / 1000) AS INT) AS reddit_score,
    CAST(o_orderkey % 120 AS INT) AS reddit_comments_count,
    lower(c_mktsegment) AS dataset, o_orderdate AS created_at, o_orderdate AS updated_at
  FROM (SELECT *, p_name || ' ' || [{_SQL_DISHES}][o_orderkey % 10 + 1] || ' ' || (o_orderkey % 97) AS t
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN part ON c_custkey = p_partkey)
),
bridge AS (
  SELECT l_orderkey AS recipe_id, l_linenumber AS order_index, l_extendedprice AS line_tie, p_name AS name,
    l_quantity AS quantity, {_sql_case('p_type', SPELLINGS)} AS unit,
    CASE WHEN l_tax > 0.05 THEN 'chopped' END AS notes
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
lines AS (SELECT recipe_id, name, quantity, unit, notes FROM bridge)
"""


def oracle(query: str, extra: str = "") -> str:
    """A full statement: the mapping, optional further CTEs, then the query."""
    more = f", {extra.strip().rstrip(',')}" if extra.strip() else ""
    return f"WITH {ORACLE_CTES.strip()}{more}\n{query.strip()}"
