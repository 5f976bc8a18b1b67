"""Registered queries of text search from a written index; their SQL is that of the scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators import postings as p
from larder.operators import search as s
from larder.operators import tables
from larder.plans import relational
from larder.plans import searching as scan
from larder.plans.corpus import ORACLE_CTES, bridge, recipes
from larder.plans.searching import MISSPELT, QUERY, docs
from larder.session import checkpointed, shared_folder

FIELDS = ["title", "description", "ingredients", "instructions", "cuisine_type"]
BOTH = {"title": 3.0, "description": 1.0}
EVEN = {"title": 1.0, "description": 1.0}
_written: dict[tuple[str, str], str] = {}  # of a session: the index of each folder of tables


def index(spark: SparkSession, sf_dir: str) -> p.Index:
    """The index of the documents; written once in a session."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _written:
        path = f"{shared_folder(spark)}/index/{key[0]}-{uuid.uuid4().hex}"
        p.write(docs(spark, sf_dir), FIELDS, path, attributes=["cuisine_type", "n_chars"])
        _written[key] = path
    return p.read(spark, _written[key])


def _page(text: str, boosts: dict[str, float], match: str = "exact", prefix: int = 0, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        made = index(spark, sf_dir)
        return p.search(made, p.query(made, text, match, prefix), boosts, **options)

    return run


def t7(spark, sf_dir):
    made = index(spark, sf_dir)
    q = p.query(made, QUERY)
    total = p.total_hits(made, q, s.DEFAULT_BOOSTS).select("total").scalar()
    return p.search(made, q, s.DEFAULT_BOOSTS, size=10, start=20).withColumn("total", total)


def t9(spark, sf_dir):
    made = index(spark, sf_dir)
    return p.explain_scores(made, p.query(made, QUERY), EVEN)


def t24(spark, sf_dir):
    return p.more_like_this(index(spark, sf_dir), docs(spark, sf_dir), "description", F.col("id") == 1)


def t24_terms(spark, sf_dir):
    return p.typical_terms(index(spark, sf_dir), docs(spark, sf_dir).where("id = 1"), "description")


def t1_stems(spark, sf_dir):
    """How often each stem stands in all documents, from the dictionary and the postings."""
    made = index(spark, sf_dir)
    blocks = made.table("blocks").where("field = 'description'")
    counts = blocks.select("term", F.aggregate("postings", F.lit(0.0), lambda n, x: n + x["tf"]).alias("n"))
    stems = made.table("stems").select("term", "stem")
    return counts.groupBy("term").agg(F.sum("n").alias("n")).join(stems, "term").groupBy("stem").agg(F.sum("n").cast("long").alias("n"))


ORDER, NESTED = relational.ORDER, relational.FIELDS


def q3_recipes(spark, sf_dir):
    """Ranked recipes with both words, in any of their forms, in title or description, with nested ingredients."""
    made = recipes(spark, sf_dir)
    path = f"{shared_folder(spark)}/index/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    p.write(made, ["title", "description"], path)
    found = p.read(spark, path)
    hits = checkpointed(p.search(found, p.query(found, "dishes buildings", "stem"), EVEN, all_terms=True, size=20))
    page = tables.with_ingredients(hits, made, bridge(spark, sf_dir), ORDER, NESTED)
    text = F.transform("ingredients", lambda x: F.concat_ws("/", x["order_index"], x["name"], x["quantity"].cast("int"), x["unit"], F.coalesce(x["notes"], F.lit("-"))))
    return page.select("id", "title", "score", F.array_join(text, ";").alias("ingredients"))


_FORMS = {"dishes": ["dish", "dishes", "dished"], "buildings": ["build", "builds", "building", "buildings"]}
_RECIPE_DOCS = ORACLE_CTES.strip() + "," + relational._NESTED_SQL + ", docs AS (SELECT id, title, description FROM recipes)"
_Q3_RECIPES = (
    scan._scores("dishes buildings", EVEN, lambda t: "w IN (" + ", ".join(f"'{w}'" for w in _FORMS[t]) + ")", docs=_RECIPE_DOCS)
    + """, page AS (SELECT id, score FROM scores WHERE id IN (SELECT id FROM parts GROUP BY 1 HAVING count(DISTINCT term) = 2) ORDER BY score DESC, id LIMIT 20)
    SELECT id, title, score, ingredients FROM page JOIN recipes USING (id) LEFT JOIN nested ON id = recipe_id"""
)


def _sql(name: str) -> str:
    return scan.ENTRIES[name][1]


def t6(spark, sf_dir):
    keep = (F.col("cuisine_type") == "en") & (F.col("n_chars") <= 2000)
    return _page(QUERY, s.DEFAULT_BOOSTS, size=50, where=keep)(spark, sf_dir)


ENTRIES = {
    "T1_stems_from_index": (t1_stems, None),
    "T2_multi_field_from_postings": (_page(QUERY, s.DEFAULT_BOOSTS, size=50), _sql("T2_multi_field")),
    "T3_text_boosts_from_postings": (_page(QUERY, s.TEXT_BOOSTS, size=50), _sql("T3_text_boosts")),
    "T4_tie_breaker_from_postings": (
        _page(QUERY + " es src3", s.ANY_FIELD_BOOSTS, tie_breaker=0.3, size=50), _sql("T4_any_field_tie_breaker"),
    ),
    "T5_fuzzy_from_postings": (_page(MISSPELT, BOTH, "fuzzy", size=50), _sql("T5_fuzzy")),
    "T5_fuzzy_with_prefix_from_postings": (_page(MISSPELT, BOTH, "fuzzy", 2, size=50), _sql("T5_fuzzy_with_prefix")),
    "T6_filtered_from_postings": (t6, _sql("T6_filtered_search")),
    "T7_page_and_total_from_postings": (t7, _sql("T7_page_and_total")),
    "T9_explain_from_postings": (t9, _sql("T9_explain")),
    "T24_more_like_this_from_postings": (t24, _sql("T24_more_like_this")),
    "T24_typical_terms_from_postings": (t24_terms, _sql("T24_typical_terms")),
    "Q3_all_words_from_postings": (_page("ononst ernt", EVEN, all_terms=True, size=20), _sql("Q3_all_words")),
    "Q3_recipes_with_ingredients": (q3_recipes, _Q3_RECIPES),
    "Q3_stemmed_words_from_postings": (_page("reinging heing", EVEN, "stem", all_terms=True, size=20), None),
}
