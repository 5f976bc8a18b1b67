"""Recipe attributes told from title and text: times, pan size, difficulty, cuisine, meal type, tags.

All keyword tests are substring searches on lower-cased text; list order decides ties.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder import lexicon as lx
from larder.functions.text import first_match, let, longest_of, strip, word_list


# of each pattern of a time or size a word that every match holds, whatever its case
_HELD = {
    "prepTime": (lx.PREP_TIME_PATTERNS, ["prep", "preparation"]),
    "cookTime": (lx.COOK_TIME_PATTERNS, ["cook", "cooking", "bake", "total"]),
    "chillTime": (lx.CHILL_TIME_PATTERNS, ["chill", "refrigerate", "rest"]),
    "panSize": (lx.PAN_SIZE_PATTERNS, ["x", "pan", "pot"]),
}


def times(text: Column) -> dict[str, Column]:
    """Times and pan size; a text is matched only where it holds the word that the pattern asks for."""

    def first(patterns: list[str], held: list[str]) -> Column:
        low = F.lower(text)
        return strip(F.coalesce(*[F.when(low.contains(w), first_match(text, [p])) for p, w in zip(patterns, held, strict=True)]))

    return {name: first(*of) for name, of in _HELD.items()}


# words looked for in title and text together, in the title alone, in the text alone
BOTH_WORDS = list(
    dict.fromkeys(
        w
        for group in (lx.DIFFICULTY_WORDS, lx.CUISINE_WORDS, lx.MEAL_WORDS, lx.TAG_WORDS)
        for words in group.values()
        for w in words
    )
) + ["meat"]
TITLE_WORDS = list(
    dict.fromkeys(
        [name.lower() for name in lx.CUISINE_WORDS]
        + [w for words in lx.CUISINE_WORDS.values() for w in words]
        + lx.MEAL_WORDS["dinner"]
        + lx.MEAL_WORDS["dessert"]
    )
)
TEXT_WORDS = list(
    dict.fromkeys(lx.ADVANCED_TECHNIQUES + lx.SWEET_WORDS + lx.MEAT_WORDS + lx.DAIRY_WORDS + lx.EGG_WORDS)
)


def hits(text: Column, words: list[str]) -> Column:
    """The words that occur, in one pass over the text: all rules below work on a handful of hits.

    The pattern gives the longest word at each place; words that others begin with are told from those.  Most places
    are passed over by their first letters.
    """
    first = "".join(f"[{''.join(re.escape(c) for c in sorted({w[i] for w in words}))}]" for i in range(min(3, *map(len, words))))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?={first})(?=({longest_of(set(words))}))"), F.lit(1)))
    short = [w for w in words if any(o != w and o.startswith(w) for o in words)]
    if not short:
        return found
    return let(found, lambda f: F.array_union(f, F.filter(word_list(short), lambda w: F.exists(f, lambda x: x.startswith(w)))))


# the rules ask for groups of words, each under its name; a group is told from the words of one place only
BOTH_GROUPS = (
    {f"difficulty {k}": w for k, w in lx.DIFFICULTY_WORDS.items()}
    | {f"cuisine {k}": w for k, w in lx.CUISINE_WORDS.items()}
    | {f"meal {k}": w for k, w in lx.MEAL_WORDS.items()}
    | {f"tag {k}": w for k, w in lx.TAG_WORDS.items()}
    | {"savoury": lx.SAVOURY_WORDS}
)
TITLE_GROUPS = (
    {f"named {k}": [k.lower()] for k in lx.CUISINE_WORDS}
    | {f"cuisine {k}": w for k, w in lx.CUISINE_WORDS.items()}
    | {f"meal {k}": lx.MEAL_WORDS[k] for k in ("dinner", "dessert")}
)
TEXT_GROUPS = {
    "technique": lx.ADVANCED_TECHNIQUES, "sweet": lx.SWEET_WORDS, "meat": lx.MEAT_WORDS, "animal": lx.DAIRY_WORDS + lx.EGG_WORDS,
}
_NAMES = list(dict.fromkeys([*BOTH_GROUPS, *TITLE_GROUPS, *TEXT_GROUPS]))
# all that is looked for in a title or in a text, so that each is read once
IN_TITLE = list(dict.fromkeys(BOTH_WORDS + TITLE_WORDS))
IN_TEXT = list(dict.fromkeys(BOTH_WORDS + TEXT_WORDS))


def groups_of(found: Column, groups: dict[str, list[str]]) -> Column:
    """The numbers of the groups of some different words, each as often as it has words among them."""
    words = dict.fromkeys(w for ws in groups.values() for w in ws)
    table = [(w, [_NAMES.index(g) for g, ws in groups.items() if w in ws]) for w in words]
    known = F.from_json(F.lit(json.dumps(dict(table))), "map<string,array<int>>")
    return F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(known, w), F.array().cast("array<int>"))))


def in_both(title: Column, text: Column, in_title: Column, in_text: Column) -> Column:
    """The words in title and text with a blank between them; only words with a blank can lie across it."""
    across = [w for w in BOTH_WORDS if " " in w]
    most = max(map(len, across)) - 1
    joint = hits(F.concat_ws(" ", F.right(title, F.lit(most)), F.left(text, F.lit(most))), across)
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(in_title, none), F.coalesce(in_text, none), joint))


def _any(found: Column, group: str) -> Column:
    return F.array_contains(found, _NAMES.index(group))


def _count(found: Column, group: str) -> Column:
    return F.size(found) - F.size(F.array_remove(found, _NAMES.index(group)))


def difficulty(both: Column, in_text: Column, text: Column) -> Column:
    """Named level, else told from techniques and from the number of bullets and steps."""
    # the same patterns behind a line break, which every line then has: one character to look for
    below = F.concat(F.lit("\n"), text)
    bullets, steps = (
        F.regexp_count(below, F.lit(p.replace(r"(?:^|\n)", r"\n"))) for p in (lx.BULLET_COUNT_PATTERN, lx.STEP_COUNT_PATTERN)
    )
    told = let(
        F.struct(bullets.alias("b"), steps.alias("s")),
        lambda n: F.when(_any(in_text, "technique") | (n["b"] > 15) | (n["s"] > 10), "hard")
        .when((n["b"] > 8) | (n["s"] > 5), "medium")
        .when((n["b"] > 0) | (n["s"] > 0), "easy"),
    )
    return F.coalesce(*[F.when(_any(both, f"difficulty {level}"), level) for level in lx.DIFFICULTY_WORDS], told)


def cuisine(both: Column, in_title: Column) -> Column:
    """A cuisine named in the title; else the first with two keywords, or one that is in the title."""

    def told(twice: Column) -> Column:
        named = [F.when(_any(in_title, f"named {name}"), name) for name in lx.CUISINE_WORDS]
        worded = [
            F.when(_any(in_title, f"cuisine {name}") | _any(twice, f"cuisine {name}"), name) for name in lx.CUISINE_WORDS
        ]
        return F.coalesce(*named, *worded)

    return let(F.filter(both, lambda group, i: F.array_position(both, group) <= i), told)


def meal_type(both: Column, in_title: Column, in_text: Column) -> Column:
    """Dinner against dessert by title, then by number of keywords; else the first meal with a keyword."""
    dinner, dessert = "meal dinner", "meal dessert"
    dinner_title, dessert_title = _any(in_title, dinner), _any(in_title, dessert)
    conflict = F.when(
        _any(both, dinner) & _any(both, dessert),
        F.when(dinner_title & ~dessert_title, "dinner")
        .when(dessert_title & ~dinner_title, "dessert")
        .when(_count(both, dinner) >= _count(both, dessert), "dinner"),
    )
    told = [F.when(_any(both, f"meal {meal}"), meal) for meal in lx.MEAL_WORDS]
    sweet = F.when(_any(in_text, "sweet") & ~_any(both, "savoury"), "dessert")
    return F.coalesce(conflict, *told, sweet)


def dietary_tags(both: Column, in_text: Column) -> Column:
    """Tags that are named; without any, vegetarian and vegan are told from the absence of animal products."""
    named = F.filter(
        F.array(*[F.when(_any(both, f"tag {tag}"), tag) for tag in lx.TAG_WORDS]),
        lambda t: t.isNotNull(),
    )
    meat = _any(in_text, "meat")
    animal = _any(in_text, "animal")
    told = F.when(~meat & ~animal, F.array(F.lit("vegan"), F.lit("vegetarian"))).when(
        ~meat, F.array(F.lit("vegetarian"))
    )
    return let(named, lambda x: F.when(F.size(x) > 0, x).otherwise(told))
