"""Load rules on literal cases, identity, and properties of whole loads."""

import uuid

import pytest
from pyspark.sql import functions as F

from larder.functions.amounts import clean_name, minutes, parse_amount, unescape
from larder.functions.identity import backfill_uuid, dense_ids, post_uuid, recipe_uuid, register_uuid_function
from larder.functions.text import strip, wildcard_to_like
from larder.operators import load
from larder.sources.writers import TableSet


def _map(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["r"] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


AMOUNTS = {
    "1 cup": (1.0, "cup", "volume"), "1/2 tbsp": (0.5, "tablespoon", "volume"), "1 1/2 cups": (1.5, "cup", "volume"),
    "2-3 cups": (2.5, "cup", "volume"), "200g": (200.0, "gram", "weight"), "to taste": (None, "to taste", "other"),
    "as needed": (None, "to taste", "other"), "taste": (None, "to taste", "other"), "": (None, None, None),
    "  ": (None, None, None), None: (None, None, None), "2 large": (2.0, None, None), "cup": (None, "cup", "volume"),
    "2 pinches": (2.0, "pinch", "other"), "1 1/0 cup": (None, "cup", "volume"), "½ cup": (None, None, None),
    "12/5 oz": (2.4, "ounce", "weight"), "3 - 5 KG": (4.0, "kilogram", "weight"),
}


def test_amounts(spark):
    assert [tuple(r) for r in _map(spark, parse_amount, AMOUNTS)] == list(AMOUNTS.values())


def test_minutes(spark):
    cases = {"30 minutes": 30, "1 hour": 60, "1.5 hr": 90, "1 hour 30 minutes": 60, "overnight": None, None: None}
    assert _map(spark, minutes, cases) == list(cases.values())


def test_names(spark):
    cases = {
        "Salt &amp; pepper": "Salt & pepper", "200 g flour (sifted)": "flour", "1 kg": "1 kg", "  a\n b ": "a b",
        "": "Unknown", "x" * 250: "x" * 250, "flour (sifted)": "flour (sifted)", "2 eggs": "2 eggs",
    }
    assert _map(spark, clean_name, cases) == list(cases.values())
    assert _map(spark, unescape, ["&lt;b&gt; &#233;&#x1F600; &amp;lt; &lt; &nosuch; &eacute;"]) == ["<b> é😀 &lt; < &nosuch; é"]


SKIP = [
    "Fill a wok or large skillet with 3 inches of vegetable oil over medium high heat.",
    "Toss to combine then serve with ricotta salata.", "Preheat the oven to 350 degrees.",
    "Mix the flour and sugar together.", "Serve with fresh herbs.", "Heat a large pan over medium heat.",
    "Combine all ingredients in a bowl.", "to taste", "For the Cookies", "For the Mousse Filling", "optional",
    "as needed", "if desired", "for garnish", "For Topping", "For Sauce",
]
KEEP = [
    "1 cup all-purpose flour", "2 eggs", "1/2 cup sugar", "3 tablespoons olive oil", "Salt and pepper to taste",
    "1 pound ground beef", "Fresh basil leaves", "4 cloves garlic, minced", "Cooking oil", "Pre-cooked chicken",
    "Heat-resistant spatula",
]


def test_skip_reasons(spark):
    reasons = dict(zip(SKIP, _map(spark, load.skip_reason, SKIP)))
    assert not [k for k, v in reasons.items() if v is None]
    assert _map(spark, load.skip_reason, KEEP) == [None] * len(KEEP)


def test_uuid(spark):
    df = spark.createDataFrame(
        [("Chocolate Chip Cookies", "https://example.com/recipe1"), (" Crème Brûlée ", None), ("Ramen", "reddit:t3_abc")],
        "t string, s string",
    )
    got = [r["u"] for r in df.select(recipe_uuid(F.col("t"), F.col("s")).alias("u")).collect()]
    assert got == [
        "addcaf86-060f-5323-afd0-16b7ea959ebb", "2e7c244c-27fb-58b6-9b7f-c0c9649fa4ed", "b0ebb6a7-089c-5033-97f9-3b251bf40960",
    ]
    assert got[0] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "chocolate chip cookies:https://example.com/recipe1"))
    register_uuid_function(spark)
    assert spark.sql("SELECT generate_recipe_uuid('Ramen', 'reddit:t3_abc')").first()[0] == got[2]
    assert df.limit(1).select(post_uuid(F.lit("ramen "), F.lit("t3_abc"))).first()[0] == got[2]


def test_uuid_backfill(spark):
    rows = [("R", "t3_1", "http://x", None), ("R", None, "http://x", None), ("R", None, None, None), ("R", "t3_1", None, "kept")]
    df = spark.createDataFrame(rows, "t string, p string, u string, s string")
    got = [r[0] for r in df.select(backfill_uuid(*[F.col(c) for c in "tpus"])).collect()]
    name = lambda source: str(uuid.uuid5(uuid.NAMESPACE_DNS, "r:" + source))
    assert got == [name("reddit:t3_1"), name("http://x"), name(""), "kept"]


def test_dense_ids(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("name"))
    ids = [r["id"] for r in dense_ids(df, "name", F.lit(100)).select("id").collect()]
    assert sorted(ids) == list(range(101, 5101))


def test_text_helpers(spark):
    assert _map(spark, strip, ["  \tx y　\n"]) == ["x y"]
    assert wildcard_to_like("*10%_a?*") == "%10\\%\\_a_%"


ING = "array<struct<item:string,amount:string,notes:string>>"
INS = "array<struct<step:int,title:string,description:string>>"
SCHEMA = f"""path string, uuid string, title string, description string, ingredients {ING}, instructions {INS},
  prepTime string, cookTime string, chillTime string, panSize string, difficulty string, cuisine string,
  mealType string, dietaryTags array<string>"""


def staged(spark, rows):
    full = []
    for path, title, items in rows:
        full.append((path, None, title, None, [(i, "1 cup", None) for i in items], [(1, "Step 1", "Do it")],
                     "10", "<UNKNOWN>", None, None, "Easy", "null", "Soup", None))
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def two_loads(spark, tmp_path_factory):
    store = TableSet(spark, str(tmp_path_factory.mktemp("tables")))
    batch = staged(spark, [
        ("a1", "Cake", ["flour", "eggs"]), ("a2", "Cake", ["other", "things"]), ("a3", "cake", ["flour", "milk"]),
        ("a4", "Pie", ["flour", "apples", "optional"]), ("a5", "Thin", ["only one"]), ("a6", " ", ["flour", "eggs"]),
        ("a7", None, ["flour", "eggs"]), ("a8", "Cakes", []),
    ])
    first = load.load_recipes(batch, store.read())
    status = {r["path"]: (r["status"], r["error"]) for r in first.status.collect()}
    store.append(first.new_tables(), "one")
    once = {n: t.count() for n, t in store.read().items()}
    second = load.load_recipes(batch, store.read())
    store.append(second.new_tables(), "two")
    twice = {n: t.count() for n, t in store.read().items()}
    return store, status, once, twice, second


def test_status(two_loads):
    _, status, *_ = two_loads
    assert {p: s for p, (s, _) in status.items()} == {
        "a1": "loaded", "a2": "exists", "a3": "failed", "a4": "loaded", "a5": "failed", "a6": "failed", "a7": "failed", "a8": "failed",
    }
    assert "1 valid, 0 skipped of 1" in status["a5"][1] and "blank" in status["a6"][1]


def test_loading_twice_changes_nothing(two_loads):
    store, _, once, twice, second = two_loads
    assert once == twice == {"recipes": 2, "ingredients": 3, "measurements": 10, "recipe_ingredients": 4}
    assert load.load_report(second.status).first().asDict() == {
        "totalProcessed": 8, "successful": 0, "alreadyExists": 3, "failed": 5,
    }
    assert store.committed("one") and not store.committed("three")


def test_recipe_row(two_loads):
    row = two_loads[0].read()["recipes"].where("title = 'Pie'").first()
    assert (row["difficulty"], row["meal_type"], row["cuisine_type"], row["prep_time_minutes"], row["total_time_minutes"]) == (
        "easy", "lunch", None, 10, 10)
    assert row["instructions"] == ["Do it"] and row["uuid"] == str(uuid.uuid5(uuid.NAMESPACE_DNS, "pie:"))


def test_no_violations_and_delete(two_loads, spark):
    t = two_loads[0].read()
    assert load.violations(t["recipes"], t["ingredients"], t["measurements"], t["recipe_ingredients"]).isEmpty()
    pie = t["recipes"].where("title = 'Pie'").first()["id"]
    ids = spark.createDataFrame([(pie,), (999,)], "id bigint")
    recipes, bridge, hit = load.delete_recipes(t["recipes"], t["recipe_ingredients"], ids)
    assert recipes.count() == 1 and bridge.count() == 2
    assert {r["id"]: r["deleted"] for r in hit.collect()} == {pie: True, 999: False}


def test_reload_updates_known_titles(two_loads, spark):
    store = two_loads[0]
    again = staged(spark, [("b1", "Pie", ["flour", "pears"]), ("b2", "Bread", ["flour", "water"])])
    again = again.withColumn("uuid", recipe_uuid(F.col("title"))).withColumn("difficulty", F.lit("hard"))
    result = load.reload_recipes(again, again.select("uuid"), store.read())
    rows = {r["title"]: r for r in result.recipes.collect()}
    assert set(rows) == {"Cake", "Pie", "Bread"} and rows["Pie"]["difficulty"] == "hard" and rows["Cake"]["difficulty"] == "easy"
    names = {r["id"]: r["name"] for r in result.ingredients.collect()}
    mine = result.recipe_ingredients.where(F.col("recipe_id") == rows["Pie"]["id"]).collect()
    assert {names[r["ingredient_id"]] for r in mine} == {"flour", "pears"}
    assert not any(r["drift"] for r in result.drift.collect())
