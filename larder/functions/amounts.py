"""Amounts, units, names and times as column expressions (usable inside array lambdas)."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import lexicon
from larder.functions.text import contains_any, let, squeeze, strip

# whole number (not the numerator of a fraction), fraction, end of a range, unit; all optional
_AMOUNT = (
    r"(?s)^(?:(\d+(?:\.\d+)?)(?![\d.]*\s*/))?(?:\s*(\d+)/(\d+))?(?:\s*-\s*(\d+(?:\.\d+)?))?\s*([a-zA-Z]+)?.*$"
)
_MARK = "\x01"


_columns: dict[tuple, Column] = {}


def constant(build: Callable[[], Column]) -> Column:
    """A constant column such as a lookup map, built once per driver connection."""
    key = (id(SparkContext._gateway), build)
    if key not in _columns:
        _columns[key] = build()
    return _columns[key]


def _unit_map() -> Column:
    pairs = []
    for name, abbreviation, kind, spellings in lexicon.UNITS:
        for s in spellings:
            pairs += [F.lit(s), F.struct(F.lit(name).alias("unit"), F.lit(kind).alias("unit_type"))]
    return F.create_map(*pairs)


def unit_of(spelling: Column) -> Column:
    """Canonical unit and its type for a spelling; null when it is not a unit."""
    return F.try_element_at(constant(_unit_map), spelling)


def parse_amount(c: Column) -> Column:
    """`1 1/2 cups` -> (1.5, cup, volume): struct of amount, unit and unit type."""

    def parse(text: Column) -> Column:
        marked = F.regexp_replace(text, _AMOUNT, f"$1{_MARK}$2{_MARK}$3{_MARK}$4{_MARK}$5")
        return let(F.split(marked, _MARK), from_parts)

    def from_parts(p: Column) -> Column:
        # a cast that fails raises an error inside, which costs more than all the rest
        whole, num, den, end = (F.when(F.get(p, F.lit(i)) != "", F.get(p, F.lit(i))).try_cast("double") for i in range(4))
        amount = (
            F.when(num.isNotNull(), F.coalesce(whole, F.lit(0.0)) + F.try_divide(num, den))
            .when(whole.isNotNull() & end.isNotNull(), (whole + end) / 2)
            .otherwise(whole)
        )
        return let(
            unit_of(F.get(p, F.lit(4))),
            lambda u: F.struct(amount.alias("amount"), u["unit"].alias("unit"), u["unit_type"].alias("unit_type")),
        )

    nothing = F.lit(None).cast("double").alias("amount")
    no_amount = F.struct(nothing, F.lit("to taste").alias("unit"), F.lit("other").alias("unit_type"))
    blank = F.struct(nothing, F.lit(None).cast("string").alias("unit"), F.lit(None).cast("string").alias("unit_type"))
    return let(
        F.lower(strip(F.coalesce(c, F.lit("")))),
        lambda t: F.when(t == "", blank).when(t.isin(lexicon.NO_AMOUNT_WORDS), no_amount).otherwise(parse(t)),
    )


def _entity_map() -> Column:
    return F.create_map(*[F.lit(v) for n, code in sorted(name2codepoint.items()) for v in (n, chr(code))])


def unescape(c: Column) -> Column:
    """Resolve HTML entities: the named ones of HTML 4 and all numeric ones.

    Each entity that occurs is replaced as a whole; `&amp;` goes last so that nothing is resolved twice.
    """
    names = constant(_entity_map)

    def character(entity: Column) -> Column:
        inner = F.substring_index(F.substr(entity, F.lit(2), F.length(entity)), ";", 1)
        digits = F.regexp_extract(inner, r"^#(\d{1,7})$", 1)
        hexes = F.regexp_extract(inner, r"^#[xX]([0-9a-fA-F]{1,6})$", 1)
        code = F.when(digits != "", F.hex(digits.try_cast("bigint"))).when(hexes != "", hexes)
        return F.coalesce(
            F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32"),
            F.try_element_at(names, inner),
            entity,
        )

    found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|\w{2,8});)"), F.lit(1)))
    resolved = F.aggregate(
        F.array_remove(found, "&amp;"), c, lambda text, entity: F.replace(text, entity, character(entity))
    )
    return F.when(F.instr(c, "&") > 0, F.replace(resolved, F.lit("&amp;"), F.lit("&"))).otherwise(c)


def clean_name(item: Column) -> Column:
    """Display name of an ingredient: entities resolved, blanks collapsed, leading quantity removed."""

    def without_quantity(name: Column) -> Column:
        bare = F.regexp_replace(name, r"\([^)]*\)$", "")
        return squeeze(F.regexp_replace(bare, lexicon.LEADING_QUANTITY_PATTERN, ""))

    def named(name: Column) -> Column:
        return F.when(name == "", F.lit("Unknown")).otherwise(name)

    return let(
        squeeze(unescape(F.coalesce(item, F.lit("")))),
        lambda name: F.when(
            name.rlike(r"^\d"),
            let(without_quantity(name), lambda bare: named(F.when(F.length(bare) > 2, bare).otherwise(name))),
        ).otherwise(named(name)),
    )


def minutes(c: Column) -> Column:
    """`1.5 hr` -> 90: the first number, times 60 when hours are mentioned, cut to an integer."""
    text = F.lower(c)
    value = F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1).try_cast("double")
    return F.when(contains_any(text, ["hour", "hr"]), value * 60).otherwise(value).try_cast("int")


def total_minutes(prep: Column, cook: Column) -> Column:
    """Sum of the known times; zero counts as unknown."""
    p, k = F.nullif(prep, F.lit(0)), F.nullif(cook, F.lit(0))
    return F.coalesce(p + k, p, k)
