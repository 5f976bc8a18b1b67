"""Benchmark decontamination: one automaton of all test windows scans each text once.

Texts become sequences of word numbers: ASCII letters in lower case, every other ASCII mark a gap.  The automaton
is built over windows of ten numbers, so a scan tells in one pass which windows end where; word places map back
to the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.llm.common import cut, map_arrow, table, texts_of, with_row

WINDOW = 10
_GAPS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# an automaton takes about 1 kB a word; tasks hold one of them at a time
BLOCK_CHARS = 4 << 20


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_GAPS).split()


class Windows:
    """The automaton of some test items: (item, text) pairs."""

    def __init__(self, items: list[tuple[object, str]], window: int = WINDOW):
        import ahocorasick

        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        self.items = [k for k, _ in items]
        for nth, (_, text) in enumerate(items):
            ids = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(ids[at : at + window], set()).add(nth)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, who in owners.items():
            self.automaton.add_word(ids, (len(ids), tuple(who)))
        self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Runs of hit words (first, after) and the items (by their place in the list) that have windows here."""
        if self.empty or not words:
            return [], set()
        get = self.numbers.get
        runs: list[tuple[int, int]] = []
        items: set[int] = set()
        # 0 is the number of no window: it leads back to the root
        for last, (size, who) in self.automaton.iter(tuple([get(w, 0) for w in words])):
            items.update(who)
            first = last + 1 - size
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append((first, last + 1))
        return runs, items


def blocks(benchmark: DataFrame, item_id: str, text: str, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """The test items in blocks of at most `limit` characters (or one longer item), in the order of the table."""
    block, size = [], 0
    for row in benchmark.select(F.col(f"`{item_id}`"), F.col(f"`{text}`")).toLocalIterator():
        value = row[1] or ""
        if block and size + len(value) > limit:
            yield block
            block, size = [], 0
        block.append((row[0], value))
        size += len(value)
    if block:
        yield block


_BUILT: dict[str, Windows] = {}  # of a worker process: the last automaton, by the digest of its items


def _built(digest: str, items: list[tuple[object, str]], window: int) -> Windows:
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = Windows(items, window)
    return _BUILT[digest]


def _scanner(items: list[tuple[object, str]], window: int):
    """A function from text to (n_words, runs of words, item ids); a worker process builds the automaton once, for all
    its tasks."""
    digest = hashlib.sha256(repr((items, window)).encode("utf-8", "surrogatepass")).hexdigest()

    def scan(text: str):
        windows = _built(digest, items, window)
        words = words_of(text)
        runs, found = windows.scan(words)
        return len(words), runs, [windows.items[i] for i in sorted(found)]

    return scan


def _places(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code points of the original text."""
    words = [m.span() for m in _WORD.finditer(text)]
    return [{"start": words[a][0], "end": words[b - 1][1]} for a, b in runs]


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    limit: int = BLOCK_CHARS,
) -> DataFrame:
    """Add `n_words`, `n_hit`, `items` (array of item ids) and `spans` (array of start, end in code points).

    A document word inside any occurrence of a window is hit; items of fewer words than a window are one window.
    Null texts have no words, items without words no windows; repeated items are each reported.  Other columns
    pass through; columns of the four names are replaced.

    Test sets up to `limit` characters take one narrow pass over the texts.  Larger ones are scanned block by
    block, each block against all texts, and the runs of the blocks are joined by row.
    """
    keep = [c for c in docs.columns if c not in ("n_words", "n_hit", "items", "spans")]
    item_type = benchmark.schema[item_id].dataType.simpleString()
    item_blocks = blocks(benchmark, item_id, item_text, limit)
    first, second = next(item_blocks, []), next(item_blocks, None)
    found = f"items array<{item_type}>, runs array<struct<first:int,after:int>>"

    def finish(value: str, runs: list[tuple[int, int]], count: int, items: list) -> dict:
        return {
            "n_words": count,
            "n_hit": sum(b - a for a, b in runs),
            "items": items,
            "spans": _places(value, runs) if runs else [],
        }

    added = f"n_words long, n_hit long, items array<{item_type}>, spans array<struct<start:int,end:int>>"
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    out_schema = StructType(source.schema.fields + StructType.fromDDL(added).fields)
    if second is None:
        scan = _scanner(first, window)

        def of(batch: pa.RecordBatch) -> dict:
            rows = []
            for value in texts_of(batch, text):
                count, runs, items = scan(value)
                rows.append(finish(value, runs, count, items))
            columns = {c: batch.column(c) for c in keep}
            return columns | {k: [r[k] for r in rows] for k in ("n_words", "n_hit", "items", "spans")}

        return map_arrow(source, out_schema, of)

    # the whole row in one column, so that its names cannot clash
    boxed = source.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_in"), F.col(f"`{text}`").alias("_text"))
    written = cut(with_row(boxed), "texts")
    parts = None

    def block_hits(block: list) -> DataFrame:
        scan = _scanner(block, window)

        def of(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"_row": [], "items": [], "runs": []}
            for row, value in zip(batch.column("_row").to_pylist(), texts_of(batch, "_text")):
                _, runs, items = scan(value)
                if runs:
                    out["_row"].append(row), out["items"].append(items)
                    out["runs"].append([{"first": a, "after": b} for a, b in runs])
            return out

        return map_arrow(written.select("_row", "_text"), "_row long, " + found, of)

    for block in (b for group in ([first, second], item_blocks) for b in group):
        made = cut(block_hits(block), "hits")
        parts = made if parts is None else parts.unionByName(made)
    per_row = parts.groupBy("_row").agg(
        F.flatten(F.collect_list("items")).alias("_items"), F.flatten(F.collect_list("runs")).alias("_runs")
    )

    def merge(batch: pa.RecordBatch) -> dict:
        rows = []
        for value, items, runs in zip(texts_of(batch, "_text"), batch.column("_items").to_pylist(), batch.column("_runs").to_pylist()):
            merged: list[tuple[int, int]] = []
            for a, b in sorted((r["first"], r["after"]) for r in runs or []):
                if merged and merged[-1][1] >= a:
                    merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
                else:
                    merged.append((a, b))
            rows.append(finish(value, merged, len(words_of(value)), items or []))
        return {"_in": batch.column("_in")} | {k: [r[k] for r in rows] for k in ("n_words", "n_hit", "items", "spans")}

    joined = written.join(per_row, "_row", "left").drop("_row")
    merged_schema = StructType(written.select("_in").schema.fields + StructType.fromDDL(added).fields)
    return map_arrow(joined, merged_schema, merge).select("_in.*", "n_words", "n_hit", "items", "spans")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    df = hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return df.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
