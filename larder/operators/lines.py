"""Parsing of single ingredient lines into {item, amount, notes}: column expressions for array lambdas.

Each parser returns a struct, or null when the line is not an ingredient.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import lexicon as lx
from larder.functions.text import contains_any, first_word, let, none_if_blank, strip, word_count



def ingredient(item: Column, amount: Column, notes: Column | None = None) -> Column:
    notes = F.lit(None).cast("string") if notes is None else notes
    return F.struct(item.alias("item"), amount.alias("amount"), notes.alias("notes"))


def nothing() -> Column:
    return F.lit(None).cast("struct<item:string,amount:string,notes:string>")


def spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def occurrences(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def strip_markup(line: Column) -> Column:
    """Without asterisks and heading marks."""
    marked = line.contains("*") | line.contains("#")
    return strip(F.when(marked, F.regexp_replace(F.regexp_replace(strip(line), r"\*+", ""), r"#+\s*", "")).otherwise(line))


# --- smart parse ----------------------------------------------------------------------------------
def _not_an_ingredient(text: Column, lower: Column) -> Column:
    short_header = text.endswith(":") & (
        (F.length(text) < 30) | ((F.length(text) < 50) & contains_any(lower, lx.GROUP_HEADER_WORDS))
    )
    sentence = text.endswith(".") & (word_count(text) > 6) & contains_any(lower, lx.SMART_VERBS)
    step_header = (F.length(text) < 50) & contains_any(lower, lx.STEP_HEADER_WORDS)
    return (
        (text == "")
        | lower.isin(lx.SMART_NOTES)
        | short_header
        | first_word(text).isin(lx.SMART_VERBS)
        | sentence
        | step_header
    )


def _amount_unit_item(text: Column, pattern: str) -> Column:
    """Amount, unit and item; a capitalised word that is no unit is the item and the rest are notes."""

    def build(p: Column) -> Column:
        is_name = ~F.lower(p["unit"]).isin(lx.STANDARD_UNITS) & p["unit"].rlike("^[A-Z]")
        return F.when(
            is_name, ingredient(p["unit"], p["amount"], none_if_blank(strip(p["rest"])))
        ).otherwise(ingredient(strip(p["rest"]), F.concat_ws(" ", p["amount"], p["unit"])))

    # one match for all three; the first two hold no mark, and the text ends without a line break
    marked = F.split(F.regexp_replace(text, pattern, "$1\x01$2\x01$3"), "\x01", 3)
    parts = let(
        marked,
        lambda m: F.struct(
            F.get(m, F.lit(0)).alias("amount"), F.get(m, F.lit(1)).alias("unit"), F.get(m, F.lit(2)).alias("rest")
        ),
    )
    return let(parts, build)


def _item_then_amount(text: Column) -> Column:
    p = lx.TRAILING_AMOUNT_PATTERN
    return ingredient(strip(F.regexp_extract(text, p, 1)), strip(F.regexp_extract(text, p, 2)))


def _amount_then_item(text: Column) -> Column:
    p = lx.QUANTITY_ONLY_PATTERN
    first, second = strip(F.regexp_extract(text, p, 1)), strip(F.regexp_extract(text, p, 2))
    bracketed = text.contains("(") & text.contains(")")
    return F.when(bracketed, ingredient(first, second)).otherwise(ingredient(second, first))


def smart_parse(line: Column, keep_from: Column | None = None) -> Column:
    """The main parser: five shapes in order, else the whole text with amount `to taste`.

    `keep_from` is the shortest whole text that is kept (5 characters unless given).
    """
    keep_from = F.lit(5) if keep_from is None else keep_from

    def shapes(text: Column) -> Column:
        tries = [
            (lx.QUANTITY_ALTERNATIVE_PATTERN, lambda: _amount_unit_item(text, lx.QUANTITY_ALTERNATIVE_PATTERN)),
            (lx.TRAILING_AMOUNT_PATTERN, lambda: _item_then_amount(text)),
            (lx.QUANTITY_UNIT_PATTERN, lambda: _amount_unit_item(text, lx.QUANTITY_UNIT_PATTERN)),
            (lx.ABOUT_QUANTITY_PATTERN, lambda: _amount_unit_item(text, lx.ABOUT_QUANTITY_PATTERN)),
            (lx.QUANTITY_ONLY_PATTERN, lambda: _amount_then_item(text)),
        ]
        bracketed = (lx.QUANTITY_ALTERNATIVE_PATTERN, lx.TRAILING_AMOUNT_PATTERN)
        found = [
            F.when(
                text.contains("(") & text.rlike(p) if p in bracketed else text.rlike(p),
                let(make(), lambda r: F.when(F.length(r["item"]) >= 2, r)),
            )
            for p, make in tries
        ]
        whole = F.when(F.length(text) >= keep_from, ingredient(text, F.lit("to taste")))
        return F.coalesce(*found, whole)

    def checked(text: Column) -> Column:
        return let(F.lower(text), lambda lower: F.when(~_not_an_ingredient(text, lower), shapes(text)))

    return let(strip_markup(line), checked)


# --- line-based and lenient parses ---------------------------------------------------------------------
def line_parse(line: Column) -> Column:
    """`amount unit item` lines; an unknown unit without amount belongs to the item."""
    p = lx.LINE_PATTERN

    def build(m: Column) -> Column:
        merge = (m["unit"] != "") & ~F.lower(m["unit"]).isin(lx.LINE_UNITS) & (m["amount"] == "")
        item = F.when(merge, F.concat_ws(" ", m["unit"], m["item"])).otherwise(m["item"])
        unit = F.when(merge, F.lit("")).otherwise(m["unit"])
        amount = F.concat_ws(" ", none_if_blank(m["amount"]), none_if_blank(unit))
        return ingredient(item, F.when(amount == "", F.lit("to taste")).otherwise(amount))

    groups = F.struct(
        strip(F.regexp_extract(line, p, 1)).alias("amount"),
        strip(F.regexp_extract(line, p, 2)).alias("unit"),
        strip(F.regexp_extract(line, p, 3)).alias("item"),
    )
    usable = (F.length(line) >= 2) & (occurrences(line, ".") < 3) & (occurrences(line, "!") < 3)
    return F.when(
        usable,
        F.when(line.rlike(p), let(groups, build)).otherwise(ingredient(line, F.lit("to taste"))),
    )


def simple_parse(line: Column) -> Column:
    p = lx.SIMPLE_LINE_PATTERN
    return F.when(
        line != "",
        F.when(
            line.rlike(p), ingredient(strip(F.regexp_extract(line, p, 2)), strip(F.regexp_extract(line, p, 1)))
        ).otherwise(ingredient(line, F.lit("to taste"))),
    )


def listed_parse(text: Column) -> Column:
    """Ingredient strings of structured recipes: `1 cup flour`, `2 eggs`, else the whole text."""
    unit, plain = lx.LISTED_UNIT_PATTERN, lx.LISTED_QUANTITY_PATTERN
    return (
        F.when(
            text.rlike(unit),
            ingredient(
                F.regexp_extract(text, unit, 3),
                F.concat_ws(" ", F.regexp_extract(text, unit, 1), F.regexp_extract(text, unit, 2)),
            ),
        )
        .when(text.rlike(plain), ingredient(F.regexp_extract(text, plain, 2), F.regexp_extract(text, plain, 1)))
        .otherwise(ingredient(text, F.lit("to taste")))
    )


# --- filters --------------------------------------------------------------------------------------------
def has_quantity(item: Column, lower: Column) -> Column:
    return contains_any(lower, lx.FOR_HEADER_QUANTITY_WORDS) | item.rlike(r"\d")


def is_bad_ingredient(raw: Column) -> Column:
    """Steps, headers and notes that were taken for ingredients."""

    def bad(item: Column, lower: Column) -> Column:
        for_header = lower.startswith("for ") & (F.length(item) < 50) & ~has_quantity(item, lower)
        sentence = item.endswith(".") & (word_count(item) > 6) & contains_any(lower, lx.BAD_FIRST_WORDS)
        return (
            (F.length(item) < 3)
            | lower.rlike(lx.SERVES_PATTERN)
            | for_header
            | lower.isin(lx.STANDALONE_NOTES)
            | first_word(item).isin(lx.BAD_FIRST_WORDS)
            | lower.startswith("in a ")
            | lower.startswith("in the ")
            | sentence
            | (lower.contains("instructions") & (F.length(item) < 20))
        )

    return let(strip(raw), lambda item: let(F.lower(item), lambda lower: bad(item, lower)))


def drop_bad(ingredients: Column) -> Column:
    return F.filter(ingredients, lambda i: ~is_bad_ingredient(i["item"]))


def is_ingredient_line(line: Column) -> Column:
    return line.rlike("(?d)" + lx.INGREDIENT_LINE_PATTERN) | contains_any(F.lower(line), lx.INGREDIENT_LINE_WORDS)


def is_instruction_line(line: Column) -> Column:
    return line.rlike("(?d)" + lx.INSTRUCTION_LINE_PATTERN) | contains_any(F.lower(line), lx.INSTRUCTION_LINE_WORDS)
