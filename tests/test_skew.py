"""Salted joins and boolean laws."""

import pytest
from pyspark.sql import functions as F

from larder.operators.ingredients import boolean_search, split_list
from larder.operators.skew import hot_key_join


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_key_join_equals_plain_join(spark, how):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"), "id")
    keyed = facts.where("k IS NOT NULL AND k <> 'k5'").select("k").distinct().withColumn("v", F.length("k"))
    want = facts.join(keyed, "k", how).select("id", "v")
    got = hot_key_join(facts, keyed, "k", how).select("id", "v")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_boolean_laws(spark):
    recipes = spark.range(4).select("id", F.concat(F.lit("r"), "id").alias("title"))
    lines = spark.createDataFrame([(0, "chicken"), (0, "garlic"), (1, "chicken"), (2, "garlic clove")], "recipe_id bigint, name string")
    ids = lambda text: {r["id"] for r in boolean_search(recipes, lines, text).collect()}
    assert ids("chicken AND garlic") == {0}
    assert ids("chicken OR garlic") == {0, 1, 2}
    assert ids("NOT chicken") == {2, 3}
    assert ids("NOT (chicken OR garlic)") == ids("NOT chicken AND NOT garlic") == {3}
    assert ids("NOT chicken AND garlic OR chicken AND NOT garlic") == {1, 2}
    assert split_list("chicken, garlic; x|y\n") == ["chicken", "garlic", "x", "y"]


def test_slices_follow_the_count(spark):
    from larder.operators.skew import hot_keys

    df = spark.range(10_000).select(F.when(F.col("id") < 5000, "a").when(F.col("id") < 5200, "b").otherwise(F.col("id").cast("string")).alias("k"))
    hot = spark.range(1).select(hot_keys(df, "k").alias("m")).first()["m"]
    assert hot == {"a": 400, "b": 16}
