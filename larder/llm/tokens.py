"""Token ids of whole texts by a public vocabulary, word by word with a cache of words seen.

The vocabulary drops white space and never joins characters across it, so the ids of a text are those of its
space- or line-separated parts in a row.  Parts repeat a lot; each worker keeps those it has met, up to a bound.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
_BOUND = 400_000
_LONGEST = 80


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the
    others for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class WordEncoder:
    """`encode` gives the ids of a text as little-endian unsigned 32-bit integers in bytes."""

    def __init__(self, path: str, bound: int = _BOUND):
        self.bound = bound
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _word(self, word: str) -> list[int]:
        # printable ASCII stands for itself
        return [t.id for t in self.model.tokenize(word if word.isascii() else "".join([self.letters[b] for b in word.encode()]))]

    def _new(self, part: str) -> bytes:
        if not part:
            return b""
        if part.isascii() and part.isalpha():
            return array("I", [t.id for t in self.model.tokenize(part.lower())]).tobytes()
        simple = _LATIN.fullmatch(part)
        if simple:  # letters that no normalisation changes but for their case, then one run of marks
            ids = self._word(simple[1].lower()) + (self._word(simple[2]) if simple[2] else [])
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def _of(self, part: str) -> bytes:
        ids = self.young.get(part)
        if ids is not None:  # met a second time in one text
            return ids
        ids = self.old.get(part)
        if ids is None:
            ids = self._new(part)
        if len(part) <= _LONGEST:
            self.young[part] = ids
            if len(self.young) >= self.bound:
                self.old, self.young = self.young, {}
        return ids

    def encode(self, text: str) -> bytes:
        parts = text.replace("\n", " ").split(" ")
        found = [*map(self.young.get, parts)]
        if None in found:
            of = self._of
            found = [of(part) if ids is None else ids for part, ids in zip(parts, found)]
        return b"".join(found)


    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a batch in a row, and how many each text has; null is empty.

        Each different part of the batch is looked up once.
        """
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        parts = split.flatten().dictionary_encode()
        get, of = self.young.get, self._of
        made = [of(part) if (ids := get(part)) is None else ids for part in parts.dictionary.to_numpy(zero_copy_only=False)]
        known = np.frombuffer(b"".join(made), "<u4")
        sizes = np.fromiter(map(len, made), "int64", len(made)) // 4
        nth = parts.indices.to_numpy()
        per_part = sizes[nth]
        ends = np.concatenate(([0], np.cumsum(per_part)))
        starts = (np.cumsum(sizes) - sizes)[nth]
        ids = known[np.repeat(starts - ends[:-1], per_part) + np.arange(ends[-1])]
        return ids, np.diff(ends[split.offsets.to_numpy() - split.offsets[0].as_py()])


@lru_cache(maxsize=2)
def encoder(path: str, bound: int = _BOUND) -> WordEncoder:
    """One encoder, and its cache of up to twice `bound` parts, for each worker process."""
    return WordEncoder(path, bound)
