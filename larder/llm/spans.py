"""Places of pattern matches as native columns.

`regexp_extract_all` tells the matches and `split` the text between them; lengths of both, summed up, are the
places in code points.  Patterns have to match at least one character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<kind:string,start:int,end:int,value:string>"
_BLOCK = 256


def found(text: Column, pattern: str) -> Column:
    """All matches from the left that do not overlap."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, also where `body` uses it inside further lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def _starts(gaps: Column, matches: Column) -> Column:
    """The place of each match: all gaps up to it and all matches before it.  Summed in blocks, so that a text
    with very many matches stays far from quadratic work."""
    add = lambda a, x: a + x

    def summed(steps: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
            lambda b: F.aggregate(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), add),
        )
        firsts = F.aggregate(
            blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
        )
        return let(
            firsts,
            lambda first: F.transform(
                steps,
                lambda _, i: F.get(first, F.floor(i / _BLOCK).cast("int"))
                + F.aggregate(
                    F.slice(steps, (i - i % _BLOCK) + 1, i % _BLOCK), F.lit(0), add
                ),
            ),
        )

    steps = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
    before = let(steps, summed)
    return F.zip_with(before, F.slice(gaps, 1, F.size(matches)), lambda s, g: s + F.length(g))


def placed(text: Column, pattern: str, matches: Column, kind: str) -> Column:
    """The matches (a column that `found` gave) with their places: array of (kind, start, end, value)."""
    made = let(
        F.split(text, pattern, -1),
        lambda gaps: F.zip_with(
            _starts(gaps, matches),
            matches,
            lambda s, m: F.struct(
                F.lit(kind).alias("kind"), s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")
            ),
        ),
    )
    return F.when(F.size(matches) > 0, made).otherwise(none()).cast(f"array<{SPAN}>")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas, in the given order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def digest(spans: Column) -> Column:
    return F.sha2(listed(spans), 256)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where a string of digits has a right Luhn check digit."""
    doubled = F.transform(
        F.filter(F.split(F.reverse(number), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """True where letters and digits, the first four moved to the end, leave 1 when divided by 97."""
    moved = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    value = lambda c: F.conv(c, 36, 10).cast("int")
    rest = F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: (a * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )
    return rest == 1
