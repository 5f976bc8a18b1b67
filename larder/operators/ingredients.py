"""Ingredient searches and the ready-made discovery queries.

All work on flat ingredient lines (recipe_id, name, ...): a line test is a plain column expression that
runs in the scan stage, only matching lines are shuffled, and per-recipe results are combined on the map
side.  Clause scores are constants (match 3, wildcard 2, fuzzy 1), a recipe takes its best line.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.text import quote_like, wildcard_to_like

WORD = r"[\p{L}\p{N}]+"
MATCH, WILDCARD, FUZZY = 3, 2, 1


def words(c: Column) -> Column:
    """Lower-cased word tokens of a text."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({WORD})"), F.lit(1))


def query_words(text: str) -> list[str]:
    """Lower-cased word tokens of a query, in order, each once."""
    return list(dict.fromkeys(re.findall(r"[^\W_]+", text.lower())))


def allowed_edits(word: str) -> int:
    return 0 if len(word) <= 2 else 1 if len(word) <= 5 else 2


def within_edits(token: Column, word: str, prefix: int = 0) -> Column:
    """Token within the allowed edits of a query word, optionally sharing its first characters.

    The length test comes first, so most tokens never reach the edit distance.
    """
    k = allowed_edits(word)
    near = (F.abs(F.length(token) - len(word)) <= k) & (F.levenshtein(token, F.lit(word), k) >= 0)
    return near & token.startswith(word[:prefix]) if prefix else near


def matches(name: Column, term: str) -> Column:
    """Any query word is a word of the name."""
    return F.arrays_overlap(words(name), F.array(*[F.lit(w) for w in query_words(term)]))


def contains_wildcard(name: Column, pattern: str) -> Column:
    return name.ilike(wildcard_to_like(pattern))


def matches_fuzzy(name: Column, term: str, prefix: int = 0) -> Column:
    tests = query_words(term)
    return F.exists(words(name), lambda t: reduce(lambda a, b: a | b, [within_edits(t, w, prefix) for w in tests]))


def line_score(name: Column, term: str) -> Column:
    """Sum of the clause scores of one ingredient line; 0 when no clause holds."""
    return (
        F.when(matches(name, term), MATCH).otherwise(0)
        + F.when(name.ilike(f"%{quote_like(term)}%"), WILDCARD).otherwise(0)
        + F.when(matches_fuzzy(name, term), FUZZY).otherwise(0)
    )


def wildcard_title(recipes: DataFrame, pattern: str) -> DataFrame:
    return recipes.where(F.col("title").ilike(wildcard_to_like(pattern)))


def with_line(recipes: DataFrame, lines: DataFrame, test: Column) -> DataFrame:
    """Recipes that have a line passing the test (semi-join; lines are filtered first)."""
    return recipes.join(lines.where(test).select(F.col("recipe_id").alias("id")), "id", "left_semi")


def without_line(recipes: DataFrame, lines: DataFrame, test: Column) -> DataFrame:
    return recipes.join(lines.where(test).select(F.col("recipe_id").alias("id")), "id", "left_anti")


def count_with_line(lines: DataFrame, test: Column) -> DataFrame:
    return lines.where(test).agg(F.countDistinct("recipe_id").alias("n"))


def split_list(text: str) -> list[str]:
    """A typed list: separated by comma, semicolon, vertical bar or newline."""
    return [t.strip() for t in re.split(r"[,;|\n]", text) if t.strip()]


def all_of(recipes: DataFrame, lines: DataFrame, terms: list[str]) -> DataFrame:
    """Recipes with a matching line for every term, scored by the sum of the best line per term."""
    scores = [line_score(F.col("name"), t) for t in terms]
    scored = lines.select("recipe_id", *[s.alias(f"_s{i}") for i, s in enumerate(scores)])
    hit = reduce(lambda a, b: a | b, [F.col(f"_s{i}") > 0 for i in range(len(terms))])
    best = scored.where(hit).groupBy("recipe_id").agg(*[F.max(f"_s{i}").alias(f"_s{i}") for i in range(len(terms))])
    every = reduce(lambda a, b: a & b, [F.col(f"_s{i}") > 0 for i in range(len(terms))])
    total = reduce(lambda a, b: a + b, [F.col(f"_s{i}") for i in range(len(terms))])
    best = best.where(every).select(F.col("recipe_id").alias("id"), total.cast("int").alias("score"))
    return recipes.join(best, "id")


def boolean_terms(expression: str) -> tuple[str, list[str]]:
    """Replace every term by a column name; the operators and parentheses stay as they are.

    NOT, AND, OR and parentheses mean the same in Spark SQL (NOT binds strongest, then AND), so the
    resulting text is an ordinary boolean SQL expression.
    """
    terms: list[str] = []

    def column(m: re.Match) -> str:
        word = m.group(0)
        if word in ("AND", "OR", "NOT"):
            return word
        if word not in terms:
            terms.append(word)
        return f"_t{terms.index(word)}"

    return re.sub(r"[^()\s]+", column, expression), terms


def boolean_search(recipes: DataFrame, lines: DataFrame, expression: str) -> DataFrame:
    """Recipes for which `chicken AND (garlic OR onion) AND NOT cheese` holds.

    One pass over the lines makes one flag per term and recipe; recipes without any matching line
    join with all flags false, so that NOT keeps them.
    """
    sql, terms = boolean_terms(expression)
    flags = [f"_t{i}" for i in range(len(terms))]
    tests = lines.select(
        F.col("recipe_id").alias("id"), *[(line_score(F.col("name"), t) > 0).alias(f) for f, t in zip(flags, terms)]
    )
    hit = reduce(lambda a, b: a | b, [F.col(f) for f in flags])
    found = tests.where(hit).groupBy("id").agg(*[F.bool_or(f).alias(f) for f in flags])
    return recipes.join(found, "id", "left").fillna(False, subset=flags).where(F.expr(f"({sql})")).drop(*flags)


def filter_documents(documents: DataFrame, expression: str, ingredients: str = "ingredients") -> DataFrame:
    """The same boolean filter on documents with nested ingredients: no join, one pass."""
    sql, terms = boolean_terms(expression)

    def some_line(term: str) -> Column:
        found = F.exists(ingredients, lambda line: line_score(line["name"], term) > 0)
        return F.coalesce(found, F.lit(False))

    flags = {f"_t{i}": some_line(t) for i, t in enumerate(terms)}
    return documents.withColumns(flags).where(F.expr(f"({sql})")).drop(*flags)


def any_of(recipes: DataFrame, lines: DataFrame, terms: list[str], k: int) -> DataFrame:
    """Top k recipes by the number of (line, term) matches; at least one is needed."""
    per_line = reduce(lambda a, b: a + b, [matches(F.col("name"), t).cast("int") for t in terms])
    scored = (
        lines.select("recipe_id", per_line.alias("_s"))
        .where("_s > 0")
        .groupBy("recipe_id")
        .agg(F.sum("_s").alias("score"))
    )
    return top_with_names(recipes, lines, scored, k)


def top_with_names(recipes: DataFrame, lines: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """The k best of scored recipes (recipe_id, score); only these get their ingredient list collected."""
    top = (
        recipes.join(scored, recipes["id"] == scored["recipe_id"])
        .select("id", "title", "description", "total_time_minutes", "difficulty", "score")
        .orderBy(F.desc("score"), "id")
        .limit(k)
    )
    ids = F.broadcast(top.select(F.col("id").alias("recipe_id")))  # k rows
    names = (
        lines.join(ids, "recipe_id", "left_semi")
        .groupBy("recipe_id")
        .agg(F.array_sort(F.collect_list("name")).alias("ingredients"))
    )
    return top.join(names, top["id"] == names["recipe_id"], "left").drop("recipe_id")


def dietary_search(
    recipes: DataFrame, lines: DataFrame, meal: str, cuisine: str, tags: list[str], avoid: list[str]
) -> DataFrame:
    """Meal and cuisine and any of the tags, and none of the ingredients to avoid."""
    wanted = recipes.where(
        (F.col("meal_type") == meal)
        & matches(F.col("cuisine_type"), cuisine)
        & F.arrays_overlap("dietary_tags", F.array(*[F.lit(t) for t in tags]))
    )
    return without_line(wanted, lines, reduce(lambda a, b: a | b, [matches(F.col("name"), t) for t in avoid]))


def quick(
    recipes: DataFrame, max_total: int, by_score: bool = False, size: int | None = None, start: int = 0
) -> DataFrame:
    """Easy recipes within a total time: all in no order, or a page of them, shortest or best score first."""
    hits = recipes.where((F.col("difficulty") == "easy") & (F.col("total_time_minutes") <= max_total))
    first = [F.desc("reddit_score")] if by_score else []
    return hits if size is None else hits.orderBy(*first, "total_time_minutes", "id").offset(start).limit(size)


def weekend_projects(
    recipes: DataFrame, min_comments: int = 50, min_total: int = 120, size: int | None = None
) -> DataFrame:
    """Long, much discussed recipes: all in no order, or the best `size` by score."""
    hits = recipes.where(
        F.col("difficulty").isin("medium", "hard")
        & (F.col("reddit_comments_count") >= min_comments)
        & (F.col("total_time_minutes") >= min_total)
    )
    return hits if size is None else hits.orderBy(F.desc("reddit_score"), "id").limit(size)


def personalised(
    recipes: DataFrame,
    lines: DataFrame,
    names: list[str],
    cuisines: str,
    time_range: tuple[int, int],
    min_score: float = 2.0,
) -> DataFrame:
    """Exact ingredient names (1 per line), cuisine words (2), total time in range (1.5); any may hold."""
    per_recipe = (
        lines.where(F.col("name").isin(names)).groupBy(F.col("recipe_id").alias("id")).agg(F.count("*").alias("_n"))
    )
    score = (
        F.coalesce(F.col("_n"), F.lit(0)).cast("double")
        + F.when(matches(F.col("cuisine_type"), cuisines), 2.0).otherwise(0.0)
        + F.when(F.col("total_time_minutes").between(*time_range), 1.5).otherwise(0.0)
    )
    return (
        recipes.join(per_recipe, "id", "left").withColumn("score", score).drop("_n").where(F.col("score") >= min_score)
    )


def popularity(recipes: DataFrame) -> DataFrame:
    """Base score 1 plus damped votes and comments; the damping logarithm has base 10."""
    damped = lambda c, factor: F.log10(1 + factor * F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)))
    return recipes.withColumn(
        "score", 1.0 + damped("reddit_score", 0.5) + damped("reddit_comments_count", 0.3)
    )


def random_recipe(recipes: DataFrame, seed: int, n: int = 1) -> DataFrame:
    """A pick that depends on the seed only, not on partitioning: smallest hash of seed and id."""
    return recipes.orderBy(F.sha1(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))).limit(n)


def autocomplete(recipes: DataFrame, prefix: str, k: int) -> DataFrame:
    return (
        recipes.where(F.lower("title").startswith(prefix.lower())).orderBy(F.desc("reddit_score"), "id").limit(k)
    )


def by_uuid(recipes: DataFrame, uuid: str | Column, fields: list[str] | None = None) -> DataFrame:
    """Lookup by uuid, optionally only some fields (the projection reaches the scan)."""
    hit = recipes.where(F.col("uuid") == uuid)
    return hit.select(*fields) if fields else hit


def with_names(recipes: DataFrame, lines: DataFrame, names: list[str]) -> DataFrame:
    """Recipes that use one of the exact ingredient names."""
    return with_line(recipes, lines, F.col("name").isin(names))
