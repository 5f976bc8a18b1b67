"""Filters from the index of names, held against the scans of lines."""

import pytest
from pyspark.sql import functions as F

from larder.operators import ingredients as ing
from larder.operators import names as n

WORDS = ["red onion", "Garlic", "garlic powder", "onions", "cheddar cheese", "ÉCLAIR dough", "50% cream", "a", "ab", "", "İzmir figs", "x_y"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows = [(i % 900 - 100, WORDS[(i * 7) % len(WORDS)]) for i in range(3000)]
    # one name that a block of recipes shares, so that its container is a bitmap, and one recipe that repeats a name
    rows += [(40_000 + i, "salt") for i in range(5000)] + [(70_001, "pepper")] * 11 + [(70_002, None), (None, "salt")]
    lines = spark.createDataFrame(rows, "recipe_id long, name string").cache()
    ids = sorted({r for r, _ in rows if r is not None} | {90_000, -5_000})
    recipes = spark.createDataFrame([(i, f"Recipe {i}") for i in ids], "id long, title string").cache()
    return lines, recipes, n.write_names(lines, recipes, str(tmp_path_factory.mktemp("names")))


def _set(df, column="id"):
    found = [r[column] for r in df.select(column).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_containers_are_lists_or_bitmaps(made):
    kinds = made[2].containers.agg(F.count_if(F.col("bits").isNull()).alias("few"), F.count("bits").alias("many")).first()
    assert kinds["few"] > 0 and kinds["many"] == 1
    assert made[2].containers.where(F.size("places") > n.SPARSE).isEmpty()


@pytest.mark.parametrize("expression", [
    "garlic", "NOT garlic", "onion AND NOT cheese", "salt OR (garlic AND figs)", "NOT salt AND NOT pepper", "nothing", "salt AND salt",
])
def test_boolean(made, expression):
    lines, recipes, index = made
    expected = [r["id"] for r in ing.boolean_search(recipes, lines, expression).select("id").collect()]
    assert _set(n.boolean_ids(index, expression)) == set(expected)


def test_malformed_expression(made):
    with pytest.raises(SyntaxError):
        n.boolean_ids(made[2], "garlic onion")


@pytest.mark.parametrize("pattern", ["*garlic*", "g?rlic", "*ÉCL*", "*éclair*", "*%*", "*x_y*", "a", "?", "*", "", "*LIC P*er", "*zmir*", "x?y"])
def test_wildcard(made, pattern):
    lines, recipes, index = made
    expected = ing.with_line(recipes, lines, ing.contains_wildcard(F.col("name"), pattern))
    assert _set(n.using(index, n.names_like(index, pattern))) == {r["id"] for r in expected.collect()}
    count = ing.count_with_line(lines, ing.contains_wildcard(F.col("name"), pattern)).first()["n"]
    assert n.count_using(index, n.names_like(index, pattern)).first()["n"] == count


def test_prefix(made):
    index = made[2]
    for prefix in ("gar", "GARLIC P", "a", "", "éc", "zz"):
        expected = {w for w in [*WORDS, "salt", "pepper"] if w.lower().startswith(prefix.lower())}
        assert _set(n.names_from(index, prefix), "name") == expected


def test_only_names_with_all_trigrams_are_tested(made):
    index = made[2]
    assert n._grams_of(["é"]) == [] and n._grams_of(["ab", "cd"]) == []
    assert n._grams_of(["GARlic"]) == ["arl", "gar", "lic", "rli"]
    assert _set(n._candidates(index, n._grams_of(["garlic"])), "name") == {"Garlic", "garlic powder"}


@pytest.mark.parametrize("terms", [["garlic"], ["garlic", "onion"], ["salt", "figs"], ["garlik", "cheese"]])
def test_all_terms(made, terms):
    lines, recipes, index = made
    expected = {(r["id"], r["score"]) for r in ing.all_of(recipes, lines, terms).select("id", "score").collect()}
    got = n.all_terms(index, terms).join(recipes.select("id"), "id", "left_semi")
    assert {(r["id"], r["score"]) for r in got.collect()} == expected


def test_any_term_counts_repeated_lines(made):
    lines, recipes, index = made
    terms = ["garlic", "pepper", "salt", "powder"]
    got = {(r["recipe_id"], r["score"]) for r in n.any_term(index, terms).collect()}
    assert (70_001, 11) in got
    per_line = sum([ing.matches(F.col("name"), t).cast("int") for t in terms], F.lit(0))
    plain = lines.where("recipe_id IS NOT NULL").select("recipe_id", per_line.alias("s")).where("s > 0").groupBy("recipe_id").agg(F.sum("s").alias("s"))
    assert got == {(r["recipe_id"], r["s"]) for r in plain.collect()}


def test_empty_tables(spark, tmp_path):
    lines = spark.createDataFrame([], "recipe_id long, name string")
    recipes = spark.createDataFrame([], "id long, title string")
    index = n.write_names(lines, recipes, str(tmp_path / "none"))
    assert n.boolean_ids(index, "NOT garlic").count() == 0
    assert n.count_using(index, n.names_like(index, "*a*")).first()["n"] == 0
    assert n.all_terms(index, ["garlic"]).count() == 0 and n.any_term(index, ["garlic"]).count() == 0
