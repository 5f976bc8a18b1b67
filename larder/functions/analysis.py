"""Text analysis: words, lower case, stop words in the JVM; Porter stemming in an Arrow function."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from larder import lexicon
from larder.functions.text import let

WORD = r"[\p{L}\p{N}]+"


def tokens(text: Column, stop_words: bool = True) -> Column:
    """Lower-cased words of a text in order, without stop words."""
    all_words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    if not stop_words:
        return all_words
    return F.filter(all_words, lambda w: ~w.isin(lexicon.STOP_WORDS))


def word_counts(words: Column) -> Column:
    """(term, tf) of the distinct words of an array: the lengths of runs of equal words once it is sorted."""

    def runs(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        first = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(
            first,
            lambda at: F.transform(
                at,
                lambda i, n: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, n + 1), F.size(s)) - i).cast("double").alias("tf")),
            ),
        )

    none = F.array().cast("array<struct<term:string,tf:double>>")
    return let(F.sort_array(words), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


# --- stemming: the algorithm of M. F. Porter, "An algorithm for suffix stripping", 1980 ------------------
_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able",
    "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
    "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
    "biliti": "ble",
}
_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
    "ate", "iti", "ous", "ive", "ize",
]


def _shape(stem: str) -> str:
    """Consonants and vowels as c and v; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    return _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    hits = [s for s in suffixes if word.endswith(s)]
    return max(hits, key=len) if hits else None


def porter_stem(word: str) -> str:
    """Stem of a lower-case English word; other words come back unchanged."""
    if len(word) <= 2 or not re.fullmatch("[a-z]+", word):
        return word
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        ending = _longest(word, ("ed", "ing"))
        if ending and "v" in _shape(word[: -len(ending)]):
            word = word[: -len(ending)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _short_end(word):
                word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    for table in (_STEP_2, _STEP_3):
        ending = _longest(word, table)
        if ending and _measure(word[: -len(ending)]) > 0:
            word = word[: -len(ending)] + table[ending]

    ending = _longest(word, _STEP_4)
    if ending:
        stem = word[: -len(ending)]
        if _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t"))):
            word = stem

    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


@F.pandas_udf(ArrayType(StringType()))
def stem_words(words: pd.Series) -> pd.Series:
    """Stem every word of every array; each distinct word of a batch is stemmed once."""
    known: dict[str, str] = {}

    def stem(w: str) -> str:
        if w not in known:
            known[w] = porter_stem(w)
        return known[w]

    return words.map(lambda ws: [stem(w) for w in ws], na_action="ignore")


def analyze(text: Column, stem: bool = True) -> Column:
    """The analyzer: words, lower case, stop words, stems."""
    return stem_words(tokens(text)) if stem else tokens(text)
