"""Posts to recipes: one narrow Spark job over array columns, no shuffle and no Python per row.

The job is a sequence of column stages.  `once` keeps each costly stage from being repeated by those that
use it, and `when` keeps fallbacks from being evaluated unless the better way found nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import lexicon as lx
from larder.functions.staging import once
from larder.functions.text import (
    contains_any,
    let,
    none_if_blank,
    non_blank_lines,
    pick_first,
    split_keep_text,
    starts_with_any,
    strip,
)
from larder.operators import metadata
from larder.operators.lines import (
    drop_bad,
    has_quantity,
    ingredient,
    is_ingredient_line,
    is_instruction_line,
    line_parse,
    listed_parse,
    simple_parse,
    smart_parse,
    spaces,
)
from larder.schemas import EXTRACTED

_BULLET = r"^[*\-•・]+\s*"
_NUMBER = r"^\d+[.)]\s*"
_NUMBER_THEN_TEXT = r"^\d+[.)]\s+"


# --- text, title, description --------------------------------------------------------------------------
def normalise(text: Column) -> Column:
    """Resolve written-out escapes; without any newline, double blanks are the line breaks."""
    t = strip(text)
    for written, real in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ("\\*", "*")):
        t = F.replace(t, F.lit(written), F.lit(real))
    return let(
        t, lambda x: F.when(~x.contains("\n") & x.contains("  "), F.replace(x, F.lit("  "), F.lit("\n"))).otherwise(x)
    )


def _is_prose(line: Column) -> Column:
    return ~is_ingredient_line(line) & ~is_instruction_line(line)


def extract_title(text: Column, lines: Column) -> Column:
    tries = [
        F.when(text.rlike(p), let(strip(F.regexp_extract(text, p, 1)), lambda t: F.when(_is_prose(t), t)))
        for p in lx.TITLE_PATTERNS
    ]
    early = F.filter(lines, lambda x: (F.length(x) > 10) & _is_prose(x))
    return F.coalesce(*tries, pick_first(early), F.lit(lx.UNTITLED))


def extract_description(text: Column, lines: Column) -> Column:
    named, opening = (
        let(strip(F.regexp_extract(text, p, 1)), lambda d: F.when(F.length(d) > 20, d)) for p in lx.DESCRIPTION_PATTERNS
    )
    low = F.lower(text)
    tries = [F.when(low.contains("description:") | low.contains("about:"), named), opening]
    shouted = lambda x: (x == F.upper(x)) & (x != F.lower(x))
    early = F.filter(
        F.slice(lines, 2, F.size(lines)),
        lambda x: (F.length(x) > 30) & _is_prose(x) & ~shouted(x) & ~x.startswith("**"),
    )
    return F.coalesce(*tries, pick_first(early))


# --- ingredients ------------------------------------------------------------------------------------------
def section_items(section: Column) -> Column:
    """Pieces of the ingredient section: its lines, or the inline bullets when it is a single line."""
    lines = non_blank_lines(section)
    inline = split_keep_text(section, r"(?:^|(?<=\s))(?:\d+\.\s+|[*\-•]+\s*)|・\s*")
    items = let(lines, lambda x: F.when(F.size(x) <= 1, inline).otherwise(x))
    return F.flatten(
        F.transform(
            items, lambda x: F.when(x.contains("・"), split_keep_text(x, r"・\s*")).otherwise(F.array(x))
        )
    )


def _skip_item(item: Column, lower: Column) -> Column:
    for_header = lower.startswith("for ") & (F.length(item) < 50) & (item.contains(":") | (spaces(item) < 4))
    return (
        lower.isin(lx.SECTION_TITLE_ITEMS)
        | lower.rlike(lx.SERVES_PATTERN)
        | for_header
        | lower.isin(lx.LINE_NOTES)
    )


def section_ingredients(section: Column) -> Column:
    """Main path: section items without bullets and numbering, filtered and parsed."""

    def parse(raw: Column) -> Column:
        # a dash or number in front is layout, so short names behind it still count
        laid_out = raw.rlike(r"^(?:[-•]|\d+[.)]\s)")
        shortest = F.when(laid_out, 3).otherwise(5)
        bare = F.regexp_replace(F.regexp_replace(raw, r"^[*\-•・]+\s*", ""), _NUMBER_THEN_TEXT, "")
        return let(
            bare,
            lambda item: let(
                F.lower(item),
                lambda lower: F.when(
                    (F.length(raw) >= 5) & ~_skip_item(item, lower), smart_parse(item, shortest)
                ),
            ),
        )

    return F.filter(F.transform(section_items(section), parse), lambda i: i.isNotNull())


def _clean_for_marker(line: Column) -> Column:
    return F.lower(strip(F.replace(line, F.lit("*"), F.lit(""))))


def marked_ingredients(lines: Column) -> Column:
    """Fallback 1: lines between an ingredient marker and an instruction marker, else ingredient-like lines."""
    marks = F.transform(
        lines,
        lambda x, i: let(
            _clean_for_marker(x),
            lambda c: F.struct(
                i.alias("at"),
                contains_any(c, lx.INGREDIENT_START_WORDS).alias("start"),
                contains_any(c, lx.INGREDIENT_END_WORDS).alias("end"),
            ),
        ),
    )

    def within(m: Column) -> Column:
        first = pick_first(F.filter(m, lambda x: x["start"]))["at"]
        stop = pick_first(F.filter(m, lambda x: x["end"] & ~x["start"] & (x["at"] > first)))["at"]
        end = F.coalesce(stop, F.size(m))
        start = F.array_max(F.transform(F.filter(m, lambda x: x["start"] & (x["at"] < end)), lambda x: x["at"]))
        return F.when(start.isNotNull(), F.slice(lines, start + 2, F.greatest(end - start - 1, F.lit(0))))

    def parse_marked(line: Column) -> Column:
        bold = line.startswith("**") & line.endswith("**")
        plain = F.replace(line, F.lit("**"), F.lit(""))
        bare = F.regexp_replace(F.regexp_replace(plain, _BULLET, ""), _NUMBER, "")
        return let(
            bare,
            lambda x: F.when(
                (F.length(line) >= 3)
                & ~bold
                & (F.length(x) >= 3)
                & ~(F.lower(x).startswith("for ") & ~has_quantity(x, F.lower(x))),
                line_parse(x),
            ),
        )

    def parse_like(line: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(line, r"^[*\-•・]\s*", ""), r"^\d+\.\s*", "")
        return F.when(is_ingredient_line(line), line_parse(bare))

    known = lambda parsed: F.filter(parsed, lambda i: i.isNotNull())
    marked = known(F.transform(F.coalesce(let(marks, within), F.array().cast("array<string>")), parse_marked))
    anywhere = known(F.transform(lines, parse_like))
    return drop_bad(let(marked, lambda x: F.when(F.size(x) > 0, x).otherwise(anywhere)))


def lenient_ingredients(lines: Column) -> Column:
    """Fallback 2: any line with a digit or a unit."""

    def parse(line: Column) -> Column:
        plain = F.replace(line, F.lit("**"), F.lit(""))
        bare = F.regexp_replace(F.regexp_replace(plain, r"^[*\-•]+\s*", ""), _NUMBER, "")
        return let(
            bare,
            lambda x: F.when(
                (F.length(line) >= 3)
                & ~starts_with_any(F.lower(x), lx.LENIENT_SKIP_STARTS)
                & x.rlike(lx.LENIENT_MEASURE_PATTERN),
                simple_parse(x),
            ),
        )

    return F.filter(F.transform(lines, parse), lambda i: i.isNotNull())


def ingredients_of(section: Column, lines: Column) -> Column:
    """Section, else marked lines, else (only when nothing was found at all) lenient lines."""
    placeholder = F.array(ingredient(F.lit(lx.NO_INGREDIENTS_ITEM), F.lit(lx.NO_INGREDIENTS_AMOUNT)))
    raw = let(section_ingredients(section), lambda x: F.when(F.size(x) > 0, x).otherwise(marked_ingredients(lines)))
    kept = let(
        raw, lambda x: F.when(F.size(x) > 0, drop_bad(x)).otherwise(drop_bad(lenient_ingredients(lines)))
    )
    return let(kept, lambda x: F.when(F.size(x) > 0, x).otherwise(placeholder))


# --- instructions -----------------------------------------------------------------------------------------
def _numbered(texts: Column) -> Column:
    return F.transform(
        texts,
        lambda d, i: F.struct(
            (i + 1).alias("step"),
            F.concat(F.lit("Step "), (i + 1).cast("string")).alias("title"),
            d.alias("description"),
        ),
    )


def section_steps(text: Column) -> Column:
    """Main path: the text after the first instruction word, split at numbers and bullets."""
    section = strip(F.regexp_extract(text, lx.INSTRUCTION_SECTION_PATTERN, 1))
    items = split_keep_text(section, r"\d+\.\s+|[*\-•]\s+")

    def kept(x: Column) -> Column:
        lower = F.lower(x)
        bold_header = x.contains("**") & (F.length(F.replace(x, F.lit("*"), F.lit(""))) < 50)
        return (
            (F.length(x) >= 15)
            & ~lower.isin(lx.STEP_TITLE_ITEMS)
            & ~(x.endswith(":") & (F.length(x) < 40))
            & ~bold_header
            & ~starts_with_any(lower, lx.VIDEO_LINE_STARTS)
        )

    clean = F.transform(
        F.filter(items, kept),
        lambda x: F.regexp_replace(strip(F.replace(x, F.lit("**"), F.lit(""))), r"^\([^)]*\):\s*", ""),
    )
    return _numbered(F.filter(clean, lambda x: F.length(x) >= 15))


def marked_steps(lines: Column) -> Column:
    """Fallback 1: step-like lines after a marker line, else numbered lines anywhere."""
    start = F.array_position(
        F.transform(lines, lambda x: contains_any(_clean_for_marker(x), lx.INSTRUCTION_START_WORDS)), True
    )

    def usable(x: Column) -> Column:
        plain = F.replace(x, F.lit("**"), F.lit(""))
        verb = contains_any(F.lower(plain), lx.STEP_VERBS) | plain.rlike(_NUMBER_THEN_TEXT)
        bold = x.startswith("**") & x.endswith("**")
        return (F.length(x) >= 10) & ~bold & verb & (F.length(plain) > 15)

    def step(x: Column, i: Column) -> Column:
        bare = F.replace(
            F.regexp_replace(
                F.regexp_replace(F.replace(x, F.lit("**"), F.lit("")), r"^[*\-•]+\s*", ""), _NUMBER, ""
            ),
            F.lit("**"), F.lit(""),
        )

        def build(c: Column) -> Column:
            head = strip(F.substring_index(c, ":", 1))
            first = F.substring(head, 1, 1)
            lower_case = (first == F.lower(first)) & (first != F.upper(first))
            titled = (
                c.contains(":")
                & (F.instr(c, ":") <= 50)
                & F.length(head).between(1, 49)
                & ~lower_case
            )
            rest = strip(F.substring(c, F.instr(c, ":") + 1, F.length(c)))
            return F.struct(
                (i + 1).alias("step"),
                F.when(titled, head).otherwise(F.concat(F.lit("Step "), (i + 1).cast("string"))).alias("title"),
                F.when(titled, rest).otherwise(c).alias("description"),
            )

        return let(bare, build)

    after = F.when(start > 0, F.slice(lines, (start + 1).cast("int"), F.size(lines))).otherwise(
        F.array().cast("array<string>")
    )
    marked = F.filter(after, usable)
    numbered = F.filter(lines, lambda x: x.rlike(_NUMBER_THEN_TEXT))
    return F.transform(let(marked, lambda m: F.when(F.size(m) > 0, m).otherwise(numbered)), step)


def lenient_steps(lines: Column) -> Column:
    """Fallback 2: numbered lines or lines with a cooking verb."""
    plain = F.transform(F.filter(lines, lambda x: F.length(x) >= 15), lambda x: F.replace(x, F.lit("**"), F.lit("")))
    kept = F.filter(
        plain,
        lambda x: ~starts_with_any(F.lower(x), lx.LENIENT_STEP_SKIP_STARTS)
        & (x.rlike(_NUMBER_THEN_TEXT) | contains_any(F.lower(x), lx.LENIENT_STEP_VERBS)),
    )
    bare = F.transform(kept, lambda x: F.regexp_replace(F.regexp_replace(x, _NUMBER, ""), r"^[*\-•]+\s*", ""))
    return _numbered(bare)


def instructions_of(text: Column, lines: Column) -> Column:
    placeholder = F.array(
        F.struct(
            F.lit(1).alias("step"),
            F.lit(lx.NO_STEPS_TITLE).alias("title"),
            F.lit(lx.NO_STEPS_TEXT).alias("description"),
        )
    )
    first = section_steps(text)
    second = let(first, lambda x: F.when(F.size(x) > 0, x).otherwise(marked_steps(lines)))
    third = let(second, lambda x: F.when(F.size(x) > 0, x).otherwise(lenient_steps(lines)))
    return let(third, lambda x: F.when(F.size(x) > 0, x).otherwise(placeholder))


# --- whole job -------------------------------------------------------------------------------------------
def post_text(df: DataFrame) -> Column:
    """First non-empty of the text columns that the input has."""
    columns = [F.nullif(F.col(c), F.lit("")) for c in ("comment", "text") if c in df.columns]
    return F.coalesce(*columns, F.lit(None).cast("string"))


def add_attributes(df: DataFrame, title: str, text: str) -> DataFrame:
    """Difficulty, cuisine, meal type and tags from a title and a text column."""
    low_title, low_text = F.lower(title), F.lower(text)
    # plain projections, unlike a generator, go where no attribute is asked for
    df = df.withColumns({"_in_title": metadata.hits(low_title, metadata.IN_TITLE), "_in_text": metadata.hits(low_text, metadata.IN_TEXT)})
    in_title, in_text = F.col("_in_title"), F.col("_in_text")
    df = df.withColumn("_in_both", metadata.in_both(low_title, low_text, in_title, in_text)).withColumns(
        {
            "_both": metadata.groups_of(F.col("_in_both"), metadata.BOTH_GROUPS),
            "_in_title": metadata.groups_of(in_title, metadata.TITLE_GROUPS),
            "_in_text": metadata.groups_of(in_text, metadata.TEXT_GROUPS),
        }
    )
    both, in_title, in_text = F.col("_both"), F.col("_in_title"), F.col("_in_text")
    return df.withColumns(
        {
            "difficulty": metadata.difficulty(both, in_text, F.col(text)),
            "cuisine": metadata.cuisine(both, in_title),
            "mealType": metadata.meal_type(both, in_title, in_text),
            "dietaryTags": metadata.dietary_tags(both, in_text),
        }
    )


def extract_posts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Unstructured posts: `comment` or `text`, optionally `title`."""
    post_title = none_if_blank(strip(F.col("title"))) if "title" in df.columns else F.lit(None).cast("string")
    base = df.select(*keys, post_title.alias("_post_title"), post_text(df).alias("_raw"))
    base = once(base, _text=F.coalesce(normalise(F.col("_raw")), F.lit("")))
    base = once(
        base,
        _lines=non_blank_lines(F.col("_text")),
        _section=strip(F.regexp_extract("_text", lx.INGREDIENT_SECTION_PATTERN, 1)),
    )
    text, lines = F.col("_text"), F.col("_lines")
    parts = once(
        base,
        _found_title=extract_title(text, lines),
        _found_description=extract_description(text, lines),
        ingredients=ingredients_of(F.col("_section"), lines),
        instructions=instructions_of(text, lines),
    )
    described = add_attributes(parts, "_found_title", "_text")
    paragraph = F.get(F.split("_raw", "\n\n"), F.lit(0))
    opening = F.when(~F.lower(paragraph).contains("ingredient"), none_if_blank(strip(paragraph)))
    return described.select(
        *keys,
        F.when(F.col("_raw").isNull(), "No recipe text found in entry").alias("error"),
        F.coalesce("_post_title", "_found_title").alias("title"),
        F.coalesce("_found_description", opening).alias("description"),
        "ingredients",
        "instructions",
        *[c.alias(n) for n, c in metadata.times(text).items()],
        "difficulty",
        "cuisine",
        "mealType",
        "dietaryTags",
    )


def list_literal(c: str) -> Column:
    """A JSON or Python list literal; what cannot be parsed is empty, what is no string is null."""
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    parsed = F.from_json(F.coalesce(F.col(c), F.lit("[]")), "array<variant>", options)
    texts = F.transform(
        parsed, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    )
    return F.coalesce(texts, F.array().cast("array<string>"))


def extract_structured(df: DataFrame, keys: list[str]) -> DataFrame:
    """Structured posts: `title`, and list literals in `ingredients` and `directions`."""
    base = once(
        df.select(*keys, strip(F.col("title")).alias("_name"), "ingredients", "directions"),
        _items=list_literal("ingredients"),
        _steps=list_literal("directions"),
    )
    blank = lambda x: F.coalesce(strip(x) == "", F.lit(True))
    parts = once(
        base.drop("ingredients", "directions"),
        ingredients=F.transform(F.filter("_items", lambda x: ~blank(x)), lambda x: listed_parse(strip(x))),
        instructions=F.filter(
            F.transform(
                "_steps",
                lambda x, i: F.struct(
                    (i + 1).alias("step"),
                    F.concat(F.lit("Step "), (i + 1).cast("string")).alias("title"),
                    strip(x).alias("description"),
                ),
            ),
            lambda s: ~blank(s["description"]),
        ),
    )
    # tags are told from title and ingredient names, as there is no text
    named = parts.withColumn("_names", F.array_join(F.transform("ingredients", lambda i: i["item"]), " "))
    named = named.withColumn("_empty", F.lit(""))
    described = add_attributes(named, "_name", "_empty")
    words = F.concat_ws(" ", F.lower("_name"), F.lower("_names"))
    described = once(
        described,
        _tag_both=metadata.groups_of(metadata.hits(words, metadata.BOTH_WORDS), metadata.BOTH_GROUPS),
        _tag_text=metadata.groups_of(metadata.hits(words, metadata.TEXT_WORDS), metadata.TEXT_GROUPS),
    ).withColumn("dietaryTags", metadata.dietary_tags(F.col("_tag_both"), F.col("_tag_text")))
    has_title = F.col("_name") != ""
    none = F.lit(None).cast("string")
    return described.select(
        *keys,
        none.alias("error"),
        F.when(has_title, F.col("_name")).otherwise(lx.UNTITLED).alias("title"),
        none.alias("description"),
        "ingredients",
        "instructions",
        *[none.alias(c) for c in ("prepTime", "cookTime", "chillTime", "panSize")],
        *[F.when(has_title, F.col(c)).alias(c) for c in ("difficulty", "cuisine", "mealType", "dietaryTags")],
    )


def extract_recipes(
    df: DataFrame, keys: list[str], extractor: Callable | None = None
) -> DataFrame:
    """Extract every post; rows without text are kept with an error.

    Inputs with `ingredients` and `directions` columns are structured.  An `extractor` (an iterator of
    pandas frames to an iterator of frames with the recipe columns) replaces the built-in job, and its
    output is cleaned up.
    """
    if extractor is not None:
        types = dict(df.dtypes)
        schema = ", ".join([f"`{k}` {types[k]}" for k in keys]) + ", error string, " + EXTRACTED
        return clean_model_output(df.mapInPandas(extractor, schema))
    if "ingredients" in df.columns and "directions" in df.columns:
        return extract_structured(df, keys)
    return extract_posts(df, keys)


def extraction_report(extracted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals of an extraction: processed, successful, failed."""
    return extracted.groupBy(*(by or [])).agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("error").isNull()).alias("successful"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )


# --- clean-up of model output ------------------------------------------------------------------------------
def _clean_model_ingredient(i: Column) -> Column:
    """Undo swapped fields, split preparation notes, drop markup; null when it is no ingredient."""

    def unswap_amount(x: Column) -> Column:
        second = F.get(F.split(x["amount"], r"\s+"), F.lit(1))
        p = lx.MODEL_AMOUNT_PATTERN
        swapped = (
            second.rlike(r"^\p{Lu}") & ~F.lower(second).isin(lx.MODEL_UNITS) & x["amount"].rlike(p)
        )
        return F.when(
            swapped,
            ingredient(
                F.regexp_extract(x["amount"], p, 2), F.regexp_extract(x["amount"], p, 1), none_if_blank(x["item"])
            ),
        ).otherwise(x)

    def split_notes(x: Column) -> Column:
        # the first verb of the list that occurs after a blank decides
        result = x
        for verb in reversed(lx.PREP_VERBS):
            p = rf"(?is)^(.*?)\s+(?:{verb})(.*)$"
            result = F.when(
                x["item"].rlike(p),
                ingredient(
                    strip(F.regexp_extract(x["item"], p, 1)), x["amount"],
                    strip(F.concat(F.lit(verb), F.regexp_extract(x["item"], p, 2))),
                ),
            ).otherwise(result)
        return result

    def unswap_item(x: Column) -> Column:
        p = lx.MODEL_SWAP_PATTERN
        swapped = ingredient(
            strip(F.regexp_extract(x["item"], p, 2)), strip(F.regexp_extract(x["item"], p, 1)), x["notes"]
        )
        return F.when(x["item"].rlike(r"^\d") & x["item"].rlike(p), let(swapped, split_notes)).otherwise(x)

    def tidy(x: Column) -> Column:
        item = F.regexp_replace(F.regexp_replace(x["item"], r"\*+", ""), r"(?U)\s+", " ")
        amount = F.when(x["amount"] == "", F.lit("to taste")).otherwise(x["amount"])
        return let(strip(item), lambda t: F.when(F.length(t) > 2, ingredient(t, amount, x["notes"])))

    start = ingredient(strip(i["item"]), strip(F.coalesce(i["amount"], F.lit(""))), i["notes"])
    return let(
        start,
        lambda x: F.when(
            ~F.regexp_extract(F.lower(x["item"]), r"^\s*(\S+)", 1).isin(lx.MODEL_VERBS)
            & ~contains_any(F.lower(x["item"]), lx.MODEL_HEADERS),
            let(unswap_amount(x), lambda y: let(unswap_item(y), tidy)),
        ),
    )


def clean_model_output(df: DataFrame) -> DataFrame:
    """Repair recipes that a model extracted: ingredients, and main courses filed as dessert."""
    title = F.lower("title")
    main = contains_any(title, lx.MAIN_COURSE_WORDS) & ~contains_any(title, lx.DESSERT_WORDS)
    return df.withColumns(
        {
            "ingredients": F.filter(F.transform("ingredients", _clean_model_ingredient), lambda i: i.isNotNull()),
            "mealType": F.when((F.col("mealType") == "dessert") & main, "dinner").otherwise(F.col("mealType")),
        }
    )

