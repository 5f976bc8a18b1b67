"""Column helpers for text: all built-in expressions, evaluated in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character a Unicode-aware strip removes
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "    　"
)
# characters that are no blank, the frequent ones first
_PLAIN = "".join(chr(c) for c in [*range(97, 123), *range(48, 58), *range(65, 91)]) + "*.:-()!?,;"


def strip(c: Column) -> Column:
    """Remove leading and trailing blanks of any kind (Spark's trim removes only spaces).

    A trim looks for the characters at both ends among all blanks; most texts have none, which is told at once.
    """
    plain = lambda end: F.lit(_PLAIN).contains(end)
    return let(
        c,
        lambda x: F.when(plain(F.substring(x, 1, 1)) & plain(F.substring(x, -1, 1)), x).otherwise(F.btrim(x, F.lit(_BLANKS))),
    )


def squeeze(c: Column) -> Column:
    """Collapse every run of blanks into one space and strip."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def none_if_blank(c: Column) -> Column:
    return let(c, lambda x: F.when(F.btrim(x, F.lit(_BLANKS)) != "", x))


def non_blank_lines(c: Column, separator: str = "\n") -> Column:
    return F.filter(F.transform(F.split(c, separator), strip), lambda line: line != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`.

    An aggregate of nothing: it starts with the value and ends with the body.  An element of a transformed array would
    ask the whole body for its type, and copy its result, each time it is evaluated.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def word_list(words: list[str]) -> Column:
    """Constant array of words, folded once when the query is planned."""
    return F.split(F.lit("\x01".join(words)), "\x01")


def longest_of(words: set[str]) -> str:
    """A pattern of the longest of some words at a place; words that begin alike share their beginning."""
    by_first: dict[str, set[str]] = {}
    for w in words - {""}:
        by_first.setdefault(w[0], set()).add(w[1:])
    parts = [(c if c.isalnum() or c == " " else f"\\{c}") + longest_of(rest) for c, rest in sorted(by_first.items())]
    if len(parts) == 1 and "" not in words:
        return parts[0]
    if len(parts) > 8:  # one test of a letter passes over several branches
        heads = [re.escape(c) for c in sorted(by_first)]
        parts = [f"(?=[{''.join(heads[i : i + 5])}])(?:{'|'.join(parts[i : i + 5])})" for i in range(0, len(parts), 5)]
    return f"(?:{'|'.join(parts)}){'?' if '' in words else ''}" if parts else ""


def contains_any(c: Column, words: list[str]) -> Column:
    """True when any word is a substring; one pass over the text for all words, which stops at the first hit."""
    return c.rlike(longest_of(set(words)))


def starts_with_any(c: Column, words: list[str]) -> Column:
    return c.rlike(rf"\A{longest_of(set(words))}")


def first_match(c: Column, patterns: list[str], group: int = 1) -> Column:
    """Group of the first pattern that matches, in list order; null when none does."""
    return F.coalesce(*[none_if_blank(F.regexp_extract(c, p, group)) for p in patterns])


def split_keep_text(c: Column, pattern: str) -> Column:
    """Split on a pattern into stripped non-empty pieces."""
    return F.filter(F.transform(F.split(c, pattern), strip), lambda x: x != "")


def first_word(c: Column) -> Column:
    """Lower-cased first blank-separated word of a stripped text."""
    return F.lower(F.regexp_extract(c, r"^\s*(\S+)", 1))


def word_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(r"(\S+)"), F.lit(1)))


def pick_first(c: Column) -> Column:
    """First element of an array, null when empty."""
    return F.try_element_at(c, F.lit(1))


def quote_like(term: str) -> str:
    """Escape a plain term for use inside LIKE."""
    return term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def wildcard_to_like(pattern: str) -> str:
    """`*` and `?` wildcards to LIKE, everything else literal."""
    return quote_like(pattern).replace("*", "%").replace("?", "_")
