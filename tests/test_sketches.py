"""Totals from the sketches of loads against a rebuild and the exact count."""

from pyspark.sql import functions as F

from larder.operators.sketches import Totals, estimate, least_hashes, merged


def _tables(spark, n=20_000):
    recipes = spark.range(n // 4).select("id")
    lines = spark.range(n).select(
        (F.col("id") % (n // 4)).alias("recipe_id"),
        F.when(F.col("id") % 100 == 7, None).when(F.col("id") % 3 == 0, "salt").otherwise(F.concat(F.lit("name "), F.col("id") % 9001)).alias("name"),
    )
    return recipes, lines


def test_ten_appends_equal_a_rebuild(spark, tmp_path):
    recipes, lines = _tables(spark)
    store = Totals(spark, f"{tmp_path}/ten", k=512)
    for load in range(10):
        store.add(f"l{load}", recipes.where(F.col("id") % 10 == load), lines.where(F.col("recipe_id") % 10 == load))
    rebuilt = Totals(spark, f"{tmp_path}/one", k=512)
    rebuilt.add("all", recipes, lines)
    assert store.sketch().collect() == rebuilt.sketch().collect()
    got = store.read().first()
    assert got == rebuilt.read().first()
    exact = lines.agg(F.countDistinct("name").alias("u"), F.count("name").alias("m")).first()
    assert got["total_recipes"] == recipes.count() and got["mentions"] == exact["m"]
    # within three standard errors
    assert abs(got["unique_ingredients"] - exact["u"]) <= 3 * got["relative_error"] * exact["u"]
    # a load that is written again replaces itself
    store.add("l3", recipes.where("id % 10 = 3"), lines.where("recipe_id % 10 = 3"))
    assert store.read().first() == got


def test_few_values_are_counted_exactly(spark):
    _, lines = _tables(spark)
    few = lines.where("name = 'salt' OR name LIKE 'name 1%'")
    row = estimate(least_hashes(few, "name"), name="u").first()
    assert (row["u"], row["relative_error"]) == (few.agg(F.countDistinct("name")).first()[0], 0.0)
    assert estimate(least_hashes(lines.where("false"), "name"), name="u").first()["u"] == 0


def test_many_loads_at_once(spark):
    _, lines = _tables(spark)
    by_load = least_hashes(lines.withColumn("l", F.col("recipe_id") % 4), "name", 300, by="l")
    assert by_load.groupBy("load").count().where("count > 300").isEmpty()
    assert merged(by_load, 300).collect() == least_hashes(lines, "name", 300).collect()
