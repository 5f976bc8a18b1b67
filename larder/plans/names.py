"""Registered queries of ingredient and title filters from an index; their SQL is that of the scans."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from larder.operators import ingredients as ing
from larder.operators import names as n
from larder.plans import discovery as scan
from larder.plans.corpus import lines, recipes
from larder.session import shared_folder

_written: dict[tuple[str, str, str], str] = {}  # of a session: the index of each folder of tables


def index(spark: SparkSession, sf_dir: str, kind: str) -> n.Names:
    """The index of ingredient names or of titles; written once in a session."""
    key = spark.sparkContext.applicationId, sf_dir, kind
    if key not in _written:
        path = f"{shared_folder(spark)}/names/{key[0]}-{uuid.uuid4().hex}"
        r = recipes(spark, sf_dir)
        named = lines(spark, sf_dir) if kind == "lines" else r.select(F.col("id").alias("recipe_id"), F.col("title").alias("name"))
        n.write_names(named, r, path)
        _written[key] = path
    return n.read_names(spark, _written[key])


def _of(spark, sf_dir, ids):
    return recipes(spark, sf_dir).join(ids, "id", "left_semi")


def t10_title(spark, sf_dir):
    made = index(spark, sf_dir, "titles")
    return _of(spark, sf_dir, n.using(made, n.names_like(made, "*ring*cake*"))).select("id", "title")


def t10_ingredient(spark, sf_dir):
    made = index(spark, sf_dir, "lines")
    return _of(spark, sf_dir, n.using(made, n.names_like(made, "*D?WIDGET*"))).select("id", "title")


def t11(spark, sf_dir):
    made = index(spark, sf_dir, "lines")
    return n.count_using(made, n.names_like(made, "*gear*"))


def t14(spark, sf_dir):
    hits = n.all_terms(index(spark, sf_dir, "lines"), ing.split_list("red ring, bolts; plate"))
    return recipes(spark, sf_dir).join(hits, "id").select("id", "title", "score")


def t15(spark, sf_dir):
    return _of(spark, sf_dir, n.boolean_ids(index(spark, sf_dir, "lines"), scan.EXPRESSION)).select("id", "title")


def t15_precedence(spark, sf_dir):
    return _of(spark, sf_dir, n.boolean_ids(index(spark, sf_dir, "lines"), "NOT plate AND ring OR anvil")).select("id")


def _best(terms):
    def run(spark, sf_dir):
        scored = n.any_term(index(spark, sf_dir, "lines"), terms)
        top = ing.top_with_names(recipes(spark, sf_dir), lines(spark, sf_dir), scored, 10)
        return top.withColumn("ingredients", F.array_join("ingredients", ";"))

    return run


def t25(spark, sf_dir):
    made = index(spark, sf_dir, "titles")
    hits = _of(spark, sf_dir, n.using(made, n.names_from(made, "Red R")))
    return hits.orderBy(F.desc("reddit_score"), "id").limit(10).select("id", "title", "reddit_score")


def _sql(key: str) -> str:
    return scan.ENTRIES[key][1]


ENTRIES = {
    "T10_title_from_trigrams": (t10_title, _sql("T10_wildcard_title")),
    "T10_ingredient_from_trigrams": (t10_ingredient, _sql("T10_wildcard_ingredient")),
    "T11_count_from_bitmaps": (t11, _sql("T11_count_ingredient_wildcard")),
    "T14_list_from_bitmaps": (t14, _sql("T14_ingredient_list")),
    "T15_boolean_from_bitmaps": (t15, _sql("T15_boolean_filter")),
    "T15_precedence_from_bitmaps": (t15_precedence, _sql("T15_boolean_precedence")),
    "T16_make_from_bitmaps": (_best(["ring", "gear", "red"]), _sql("T16_what_should_i_make")),
    "T20_seasonal_from_bitmaps": (_best(["widget", "bolt", "cold", "gizmo"]), _sql("T20_seasonal")),
    "T25_autocomplete_from_trigrams": (t25, _sql("T25_autocomplete")),
}
