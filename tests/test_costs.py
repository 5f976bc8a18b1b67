"""What is evaluated for each post, and how often a load reads its records."""

from pyspark.sql import functions as F

from larder.functions.text import let, none_if_blank, strip
from larder.operators import metadata
from larder.operators.lines import smart_parse
from larder.operators.load import empty_tables, load_recipes
from larder.session import checkpointed
from larder.sources.writers import TableSet, event_frame
from larder.streaming import events


def test_let_does_not_ask_its_body_for_its_type(spark):
    plan = spark.range(3).select(let(F.col("id") + 1, lambda x: F.when(x > 1, x * x)).alias("v"))
    assert [r.v for r in plan.collect()] == [None, 4, 9]
    assert "transform(" not in plan._jdf.queryExecution().analyzed().toString()


def test_strip_of_all_blanks(spark):
    texts = ["", " ", "　", "a", " a", "a ", "\x1ca b\x85", "é ", "é", "~", "\x01", "a\x01 ", "​", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s"), none_if_blank(F.col("t")).alias("n"))
    for r in rows.collect():
        assert r.s == (None if r.t is None else r.t.strip())
        assert r.n == (None if r.t is None or not r.t.strip() else r.t)


def test_words_that_lie_across_title_and_text(spark):
    texts = [("a sous", "vide stir"), ("stir", "fry gf"), ("no", "sugar"), ("x gf", "egg"), ("fish sauc", "e"), (None, "curry paste"), ("pad thai", None)]
    df = spark.createDataFrame(texts, "a string, b string").withColumns(
        {"t": metadata.hits(F.col("a"), metadata.IN_TITLE), "x": metadata.hits(F.col("b"), metadata.IN_TEXT)}
    )
    for r in df.select("a", "b", metadata.in_both(F.col("a"), F.col("b"), F.col("t"), F.col("x")).alias("w")).collect():
        whole = " ".join(t for t in (r.a, r.b) if t is not None)
        assert {w for w in r.w if w in metadata.BOTH_WORDS} == {w for w in metadata.BOTH_WORDS if w in whole}


def test_groups_count_different_words(spark):
    df = spark.createDataFrame([(["pasta", "basil", "cake"],), (["taco"],), ([],)], "w array<string>")
    both = metadata.groups_of(F.col("w"), metadata.BOTH_GROUPS)
    title = metadata.groups_of(F.array().cast("array<string>"), metadata.TITLE_GROUPS)
    got = df.select(metadata.cuisine(both, title).alias("c"), metadata.meal_type(both, title, title).alias("m")).collect()
    assert [tuple(r) for r in got] == [("Italian", "dinner"), (None, None), (None, None)]


def test_marks_in_a_line_stay(spark):
    line = "2 cups red\x01 \x01flour"
    got = spark.createDataFrame([(line,)], "t string").select(smart_parse(F.col("t")).alias("i")).first().i
    assert (got["item"], got["amount"]) == ("red\x01 \x01flour", "2 cups")


def _staged(spark, n):
    made = "array(named_struct('item', concat('flour ', id % 3), 'amount', '2 cups', 'notes', ''), named_struct('item', 'eggs', 'amount', '3', 'notes', ''))"
    steps = "array(named_struct('step', 1, 'title', 'Step 1', 'description', 'mix'))"
    text = {c: "cast(null as string)" for c in ("prepTime", "cookTime", "chillTime", "panSize", "difficulty", "cuisine", "mealType")}
    return spark.range(n).selectExpr(
        "concat('p', lpad(id, 4, '0')) AS path", "concat('u', id % 7) AS uuid", "concat('Cake ', id % 7) AS title", "'' AS description",
        f"{made} AS ingredients", f"{steps} AS instructions", *[f"{v} AS {c}" for c, v in text.items()], "cast(null as array<string>) AS dietaryTags",
    )


def test_new_rows_are_joined_once_where_they_are_cut(spark):
    cuts = []

    def cut(df):
        cuts.append(df)
        return checkpointed(df)

    now = F.lit("2024-01-01").cast("timestamp")
    plain = load_recipes(_staged(spark, 40), empty_tables(spark), now).new_tables()
    made = load_recipes(_staged(spark, 40), empty_tables(spark), now, cut=cut).new_tables()
    for name in plain:
        assert sorted(map(str, made[name].collect())) == sorted(map(str, plain[name].collect()))
    assert made["recipes"].count() == 7 and made["recipe_ingredients"].count() == 14
    assert "Join" in plain["recipes"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in made["recipes"]._jdf.queryExecution().optimizedPlan().toString()
    assert len(cuts) == 4  # cleaned records, first paths, decisions, new rows


def test_a_batch_is_extracted_and_cleaned_in_one_pass(spark, tmp_path, monkeypatch):
    cuts = []
    monkeypatch.setattr(events, "checkpointed", lambda df: cuts.append(df.columns) or checkpointed(df))
    text = "Ingredients:\n* 2 cups flour\n* 3 eggs\n\nInstructions:\n1. Mix everything together well.\n"
    rows = [("2024-01-01", 1, f"Cake {i % 4}", "u", text if i else None, 1) for i in range(10)]
    posts = spark.createDataFrame(rows, "date string, num_comments int, title string, user string, comment string, n_char int")
    raw = event_frame(posts).unionByName(spark.createDataFrame([("u", "{broken")], "key string, value string"))
    job = events.RecipeStream(TableSet(spark, f"{tmp_path}/tables"), f"{tmp_path}/run")
    wanted = {"received": 11, "saved_csv": 10, "processed": 9, "loaded_db": 4, "errors": 1}
    job.batch(raw, 0)
    assert job.metrics(spark).first().asDict() == wanted
    assert len(cuts) == 1 and "comment" in cuts[0]
    job.batch(raw, 0)  # delivered again, when it is committed already
    assert job.metrics(spark).first().asDict() == wanted
