"""Extraction on literal posts and lines."""

import pytest
from pyspark.sql import functions as F

from larder import lexicon as lx
from larder.functions.text import contains_any, starts_with_any
from larder.operators import metadata
from larder.operators.extract import clean_model_output, extract_recipes, extraction_report
from larder.operators.lines import drop_bad, ingredient, line_parse, listed_parse, simple_parse, smart_parse

SMART = {
    "2 cups flour": ("flour", "2 cups", None),
    "1.5 tbsp sugar": ("sugar", "1.5 tbsp", None),
    "1/2 tsp salt": ("salt", "1/2 tsp", None),
    "270 g (9.5 oz) Cake Wheat Flour": ("Cake Wheat Flour", "270 g", None),
    "1 cup butter, softened": ("butter, softened", "1 cup", None),
    "Salt to taste": ("Salt to taste", "to taste", None),
    "2 cups all-purpose flour": ("all-purpose flour", "2 cups", None),
    "**2 cups flour**": ("flour", "2 cups", None),
    "270 g Flour": ("Flour", "270 g", None),
    "frozen corn": ("frozen corn", "to taste", None),
    "2 eggs": ("eggs", "2", None),
    "x2 (100 g) eggs": ("x2", "100 g", None),
    "2-3 cups flour": ("flour", "2-3 cups", None),
    "Ground beef (1.8 lb / 800 g)": ("Ground beef", "1.8 lb / 800 g", None),
    "1 Eggplant cut into cubes": ("Eggplant", "1", "cut into cubes"),
    "2 Garlic Cloves minced": ("Garlic", "2", "Cloves minced"),
    "1 Spanish Onion finely chopped": ("Spanish", "1", "Onion finely chopped"),
    "100 g Ricotta Salata grated": ("Ricotta Salata grated", "100 g", None),
    "About 1.5 packages worth of lady fingers": ("lady fingers", "1.5 packages", None),
    "Waffle Dough:": None,
    "**Buns:**": None,
    "#### Broth:": None,
    "Cook pasta until al dente": None,
    "Mix all ingredients together": None,
    "Add sugar and stir well": None,
    "g": None,
    "ml": None,
    "egg": None,
    "y" * 200: ("y" * 200, "to taste", None),
    "y" * 2010: ("y" * 2010, "to taste", None),
    "(optional)": None,
}


def _parsed(spark, parser, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parser(F.col("t")).alias("p")).collect()
    return {r["t"]: tuple(r["p"]) if r["p"] else None for r in rows}


def test_smart_parse(spark):
    assert _parsed(spark, smart_parse, SMART) == SMART


def test_line_parse(spark):
    want = {
        "2 cups flour": ("flour", "2 cups", None),
        "3-4 large eggs": ("eggs", "3-4 large", None),
        "fresh basil leaves": ("fresh basil leaves", "to taste", None),
        "cup sugar": ("sugar", "cup", None),
        "salt": ("salt", "to taste", None),
        "a. b. c. and so on": None,
        "x" * 2010: ("x" * 2010, "to taste", None),
        "1 cup " + "z" * 1510: ("z" * 1510, "1 cup", None),
    }
    assert _parsed(spark, line_parse, want) == want


def test_simple_and_listed_parse(spark):
    want = {"2 cups flour": ("flour", "2 cups", None), "salt": ("salt", "to taste", None), "1/2 tsp salt": ("salt", "1/2 tsp", None)}
    assert _parsed(spark, simple_parse, want) == want
    want = {"1 cup flour": ("flour", "1 cup", None), "2 eggs": ("eggs", "2", None), "salt": ("salt", "to taste", None),
            "1.5kg beef": ("beef", "1.5 kg", None), "1/2 cup milk": ("milk", "1/2 cup", None)}
    assert _parsed(spark, listed_parse, want) == want


def test_bad_ingredients(spark):
    bad = ["ab", "(Serves 2)", "For the Cookies", "For Topping", "to taste", "for garnish", "Mix well", "in a bowl",
           "in the oven", "The flour should be carefully folded in now.", "Instructions", "coat chicken"]
    good = ["1 cup all-purpose flour", "For 2 cups of broth", "Cooking oil", "egg", "Pre-cooked chicken"]
    df = spark.createDataFrame([(bad + good,)], "items array<string>")
    df = df.select(drop_bad(F.transform("items", lambda i: ingredient(i, F.lit("1")))).alias("k"))
    assert [i["item"] for i in df.first()["k"]] == good


POSTS = {
    "matcha": """Matcha mousse\n\n(Serves 2)\n\n・2 tsp matcha powder\n\n・200 ml milk\n\n・100 g marshmallow\n\n・1 tbsp hot water\n\nInstructions""",
    "nanban": """Chicken nanban\n\nIngredients:\n\nCoat the chicken with flour.\n\nCombine soy sauce and vinegar in a bowl.\n\nIn a pan heat the oil.""",
    "cookies": """**Ingredients:**\n\nFor the Cookies\n\n2 cups flour\n\n2 eggs\n\nFor the Filling\n\n1 cup sugar\n\n**Instructions:**\n\n1. Mix everything together well.\n2. Bake for 20 minutes until golden.""",
    "dots": "Ingredients: ・2 tsp matcha ・1 tbsp hot water ・200 ml milk\n\nDirections: 1. Whisk the matcha with the water. 2. Pour the milk over it slowly.",
    "sicilian": """# Sicilian pasta\n\n# Ingredients\n\n* 1 Eggplant cut into cubes\n* 2 Garlic cloves minced\n* 400 g Pasta\n* 1 bunch fresh basil\n* 2 tbsp capers\n* 400 g canned tomatoes\n* 3 tbsp olive oil\n* 1 tsp salt\n\n# Instructions:\n\n1. Fry the eggplant in olive oil until golden brown.\n2. Add the garlic and the tomatoes and simmer.\n3. Toss with the pasta and serve with basil.""",
    "waffle": """**Ingredients**\n\nWaffle Dough:\n\n* 270 g Flour\n* 150 g Butter\n* 1 Egg\n\nCaramel Syrup:\n\n* 200 g sugar\n* 50 ml water\n\n**Method:**\n\n1. Knead the dough for ten minutes.""",
    "curry": """**Thai Red Curry**\n\nPrep time: 15 minutes\nCook time: 20 minutes\n\nAn easy weeknight dinner.\n\n**Ingredients:**\n- 2 tbsp red curry paste\n- 400 ml coconut milk\n- 1 cup vegetables\n\n**Instructions:**\n1. Fry the curry paste in a deep pan.\n2. Add the coconut milk and simmer it.""",
    "lenient": "2 cups rice\n300 g tofu\nsoy sauce 2 tbsp",
    "nothing": "Hmm",
}


@pytest.fixture(scope="module")
def extracted(spark):
    df = spark.createDataFrame([(k, None, v) for k, v in POSTS.items()] + [("empty", "T", "")], "k string, title string, comment string")
    return {r["k"]: r for r in extract_recipes(df, ["k"]).collect()}


def _items(row):
    return [i["item"].lower() for i in row["ingredients"]]


def test_whole_posts(extracted):
    matcha = _items(extracted["matcha"])
    assert len(matcha) > 3 and not any("serves" in i or "instructions" in i for i in matcha)
    assert all(any(w in i for i in matcha) for w in ("matcha", "milk", "marshmallow"))
    assert not any(i.startswith(("coat", "combine", "in ")) and i != lx.NO_INGREDIENTS_ITEM.lower() for i in _items(extracted["nanban"]))
    cookies = _items(extracted["cookies"])
    assert cookies == ["flour", "eggs", "sugar"]
    assert [s["description"] for s in extracted["cookies"]["instructions"]] == ["Mix everything together well.", "Bake for 20 minutes until golden."]
    assert _items(extracted["dots"]) == ["matcha", "hot water", "milk"]
    assert len(extracted["dots"]["instructions"]) == 2
    sicilian = extracted["sicilian"]
    assert len(sicilian["ingredients"]) >= 8
    egg = next(i for i in sicilian["ingredients"] if i["item"] == "Eggplant")
    assert egg["amount"] == "1" and "cube" in egg["notes"]
    assert all(any(w in i for i in _items(sicilian)) for w in ("garlic", "pasta", "basil", "capers"))
    waffle = _items(extracted["waffle"])
    assert waffle == ["flour", "butter", "egg", "sugar", "water"]


def test_metadata(extracted):
    curry = extracted["curry"]
    assert (curry["prepTime"], curry["cookTime"], curry["difficulty"], curry["cuisine"], curry["mealType"]) == (
        "15 minutes", "20 minutes", "easy", "Thai", "dinner")
    assert curry["dietaryTags"] == ["vegetarian"]
    assert _items(curry) == ["red curry paste", "coconut milk", "vegetables"]


def test_fallbacks_and_errors(extracted):
    assert _items(extracted["lenient"]) == ["rice", "tofu", "soy sauce 2 tbsp"]
    assert extracted["nothing"]["ingredients"][0]["item"] == lx.NO_INGREDIENTS_ITEM
    assert extracted["nothing"]["instructions"][0]["description"] == lx.NO_STEPS_TEXT
    assert extracted["empty"]["error"] == "No recipe text found in entry" and extracted["empty"]["title"] == "T"
    assert extracted["nothing"]["error"] is None


def test_report(spark):
    df = spark.createDataFrame([("a", "text one"), ("b", ""), ("c", None)], "k string, comment string")
    assert tuple(extraction_report(extract_recipes(df, ["k"])).first()) == (3, 1, 2)


def test_structured(spark):
    df = spark.createDataFrame(
        [(1, "Easy Chicken Pasta", "['1 cup flour', \"2 eggs\", '', 7, 'salt']", '["Mix.", "", "Bake it."]'),
         (2, "", "not a list", "[]"), (3, "Soup", "['it\\'s water']", "['Boil.']")],
        "k int, title string, ingredients string, directions string",
    )
    rows = {r["k"]: r for r in extract_recipes(df, ["k"]).collect()}
    assert [tuple(i)[:2] for i in rows[1]["ingredients"]] == [("flour", "1 cup"), ("eggs", "2"), ("salt", "to taste")]
    assert [(s["step"], s["description"]) for s in rows[1]["instructions"]] == [(1, "Mix."), (3, "Bake it.")]
    assert (rows[1]["difficulty"], rows[1]["cuisine"], rows[1]["mealType"]) == ("easy", "Italian", "dinner")
    assert rows[1]["dietaryTags"] is None
    assert rows[2]["title"] == lx.UNTITLED and rows[2]["ingredients"] == [] and rows[2]["difficulty"] is None
    assert rows[3]["ingredients"][0]["item"] == "it's water"


def test_model_clean_up(spark):
    raw = [("1/2 cups beef stock", "1"), ("4oz pancetta", ""), ("1/3rd cup heavy cream", ""), ("Cook the brats first", ""),
           ("Deglaze the pan", "2"), ("Fix the gravy", ""), ("cut into cubes", "1 Eggplant"), ("**butter**", "1 tbsp"),
           ("salt **Preparation**", ""), ("2 onions finely diced", "")]
    df = spark.createDataFrame(
        [("Hunters Gravy with Brats", "dessert", [(i, a, None) for i, a in raw])],
        "title string, mealType string, ingredients array<struct<item:string,amount:string,notes:string>>",
    )
    row = clean_model_output(df).first()
    assert row["mealType"] == "dinner"
    assert [tuple(i) for i in row["ingredients"]] == [
        ("beef stock", "1/2 cups", None), ("pancetta", "4oz", None), ("heavy cream", "1/3rd cup", None),
        ("Eggplant", "1", "cut into cubes"), ("butter", "1 tbsp", None), ("onions finely", "2", "diced"),
    ]


def test_custom_extractor(spark):
    def extractor(frames):
        import pandas as pd

        for pdf in frames:
            yield pd.DataFrame([{
                "k": k, "error": None, "title": "Cake", "description": None,
                "ingredients": [{"item": "Mix it", "amount": "", "notes": None}, {"item": t, "amount": "", "notes": None}],
                "instructions": [], "prepTime": None, "cookTime": None, "chillTime": None, "panSize": None,
                "difficulty": None, "cuisine": None, "mealType": "dessert", "dietaryTags": None} for k, t in zip(pdf["k"], pdf["comment"])])

    df = spark.createDataFrame([("a", "flour")], "k string, comment string")
    row = extract_recipes(df, ["k"], extractor=extractor).first()
    assert [tuple(i) for i in row["ingredients"]] == [("flour", "to taste", None)] and row["mealType"] == "dessert"


def test_long_title_and_opening(spark):
    title = "Slow-" * 25 + "Sunday-Tomato-Pie"  # letters before a blank make an ingredient line
    opening = "this sauce was handed down to us " * 9 + "and it is good"
    post = f"{title}\n\nAnother-Shorter-Line\n\nIngredients:\n- 2 cups flour\n- 1 cup sugar\n\nInstructions:\n1. Mix it all in a large bowl"
    told = f"{opening}\n\n{'a later paragraph of this post ' * 3}\n\n**Ingredients**\n- 2 cups flour\n"
    df = spark.createDataFrame([(1, post), (2, told)], "k long, comment string")
    got = {r.k: r for r in extract_recipes(df, ["k"]).collect()}
    assert len(title) > 101 and got[1].title == title
    assert len(opening) > 200 and got[2].description == opening


def test_hits_are_the_words_that_a_text_contains(spark):
    words = metadata.BOTH_WORDS + metadata.TITLE_WORDS + metadata.TEXT_WORDS
    texts = ["", "hamburgers with sous vide beef", "bbbbq basil thai bratwurst", " ".join(words), "".join(words), "béarnaise\ngluten-freegg"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for some in (metadata.BOTH_WORDS, metadata.TITLE_WORDS, metadata.TEXT_WORDS):
        for r in df.select("t", metadata.hits(F.col("t"), some).alias("h")).collect():
            assert sorted(r["h"]) == sorted({w for w in some if w in r["t"]})


def test_attributes_that_nobody_reads_are_not_computed(spark):
    made = extract_recipes(spark.createDataFrame([(1, "1 cup rice")], "id int, comment string"), ["id"])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "vanilla extract|" not in plan(made.select("id", "ingredients")) and "_in_text" not in plan(made.select("id", "ingredients"))
    assert "_in_text" in plan(made)


def test_word_tests_are_one_pattern(spark):
    words = ["sous vide", "egg", "eggplant", "a.b", "[x]", "-", "é"]
    df = spark.createDataFrame([(t,) for t in ["", "nutmeg", "aXb", "a.b", "x", "[x]", "ab-", "café", "eggp", "sous", None]], "t string")
    found = df.select("t", contains_any(F.col("t"), words).alias("any"), starts_with_any(F.col("t"), words).alias("first"))
    for r in found.collect():
        assert r["any"] == (None if r["t"] is None else any(w in r["t"] for w in words))
        assert r["first"] == (None if r["t"] is None else any(r["t"].startswith(w) for w in words))
    assert "exists(" not in found._jdf.queryExecution().optimizedPlan().toString()
