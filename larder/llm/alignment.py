"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both sides of a text become tokens with byte offsets.  In a batch, keyed by document, each token start finds the
covering token of the other side by `merge_asof`; the union of both directions are the overlaps, and overlapping
tokens with equal ends close a group.

The vocabularies never join bytes across a single blank between two words, so a text is cut there into units whose ids
are looked up in a bounded cache, and tokens of both sides end at every cut.  Texts with other white space around
blanks are encoded whole.

Corpus-wide counts of linked id pairs go through blocks of documents: a block has each of its pairs once, so what is
shuffled is far less than a row for each document and pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import cut, give_back, map_arrow, table, texts_of
from larder.llm.tokens import _byte_letters, vocabulary_path

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
# a blank between other white space: tokens may reach across, as they may across two blanks
_BLANK_IN_SPACE = re.compile(r"[^\S ] [^\S ]")
_CACHE = 200_000
_LONGEST = 80
SEGMENT = 40_000  # units of a text that are aligned at a time
TOKENS = 200_000  # of one side, in a call of merge_asof
BLOCK = 1_000_000  # pairs of documents and id pairs
_WIDE = 4096  # links of a group from which ids are counted before they are paired
_B_BITS = 15


class Encoder:
    """Tokens of both sides as unsigned 32-bit numbers: the id, and above 16 bits the number of bytes."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a_ranks = _ranked(a_path)
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        names = self.a.get_vocab()
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if len(self.a_bytes) > 1 << 16 or len(self.b_bytes) > 1 << _B_BITS:
            raise ValueError("ids do not fit into 16 and 15 bits")
        self.a_packed = np.array([i | len(b) << 16 for i, b in enumerate(self.a_bytes)], "<u4")
        self.b_packed = np.array([i | len(b) << 16 for i, b in enumerate(self.b_bytes)], "<u4")
        # a piece with a blank after another character could reach across a cut
        self.by_unit = not any(b" " in b.lstrip(b" ") for b in self.b_bytes)
        self.young: dict[str, tuple[bytes, bytes] | None] = {}
        self.old: dict[str, tuple[bytes, bytes] | None] = {}

    def _a_ids(self, parts: list[str]) -> list[list[int]]:
        """Ids of blank + part.  Ranks are quicker for words, but take the square of the time for very long ones."""
        if self.a_ranks and all(len(p) <= _LONGEST for p in parts):
            code = self.a_ranks.encode_ordinary
            return [code(" " + p) for p in parts]
        return [x.ids for x in self.a.encode_batch([" " + p for p in parts], add_special_tokens=False)]

    def _new(self, parts: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """Of blank + part: the tokens of both sides, or None where their bytes are not those of the text."""
        texts = [(" " + p).encode() for p in parts]
        sides = []
        for ids, names, packed in (
            (self._a_ids(parts), self.a_bytes, self.a_packed), (self.b.encode(parts, num_threads=1), self.b_bytes, self.b_packed)
        ):
            flat = list(chain.from_iterable(ids))
            after = list(accumulate(map(len, ids)))
            numbers = packed[flat]
            total = np.r_[0, np.cumsum(numbers >> 16)]
            ends = total[after]
            same = ends.tolist() == list(accumulate(map(len, texts))) and b"".join([names[i] for i in flat]) == b"".join(texts)
            sides.append((numbers.tobytes(), after, same, names, ids))
        (a, a_after, a_same, *_), (b, b_after, b_same, *_) = sides
        p = q = 0
        if a_same and b_same:
            for x, y in zip(a_after, b_after):
                yield a[4 * p : 4 * x], b[4 * q : 4 * y]
                p, q = x, y
            return
        for k, (x, y) in enumerate(zip(a_after, b_after)):
            good = all(same or b"".join([names[i] for i in ids[k]]) == texts[k] for *_, same, names, ids in sides)
            yield (a[4 * p : 4 * x], b[4 * q : 4 * y]) if good else None
            p, q = x, y

    def units(self, text: str) -> list[str] | None:
        """The parts of blank + text, each without its blank; None where tokens may reach across blanks."""
        if not self.by_unit or not text or "  " in text or text[0] == " " or text[-1] == " " or _BLANK_IN_SPACE.search(text):
            return None
        return text.split(" ")

    def learn(self, texts: list[list[str] | None]) -> None:
        """Encode the units of some texts that the cache has not met."""
        missing = set().union(*[u for u in texts if u]).difference(self.young)
        known = missing & self.old.keys()
        self.young.update((p, self.old[p]) for p in known)
        missing -= known
        long = [p for p in missing if len(p) > _LONGEST]
        parts = list(missing.difference(long))
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            self.young.update(zip(some, self._new(some)))
        self.young.update(zip(long, self._new(long)))

    def forget(self) -> None:
        """Keep what the last texts had, when the cache is full; long units are never kept."""
        if len(self.young) > _CACHE:
            self.old, self.young = {k: v for k, v in self.young.items() if len(k) <= _LONGEST}, {}

    def segments(self, text: str, units: list[str] | None) -> list[tuple[bytes, bytes]]:
        """The tokens of blank + text in segments that end on both sides; none where bytes differ.

        `learn` has to come before.
        """
        if units is not None:
            coded = list(map(self.young.__getitem__, units))
            if None not in coded:
                parts = [zip(*coded[i : i + SEGMENT]) for i in range(0, len(coded), SEGMENT)]
                return [tuple(map(b"".join, sides)) for sides in parts]
        whole = next(self._new([text])) if text else None
        return [] if whole is None else [whole]


def _ranked(path: str):
    """The byte-level vocabulary of a file as ranks; None where its ids are not in the order of its merges."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        known = json.load(f)
    model, cutter = known["model"], known["pre_tokenizer"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if known["normalizer"] or cutter["type"] != "ByteLevel" or any(model["vocab"]["".join(m)] != 256 + n for n, m in enumerate(merges)):
        return None
    byte_of = {c: b for b, c in enumerate(_byte_letters())}
    ranks = {bytes(byte_of[c] for c in name): i for name, i in model["vocab"].items() if i < 256 + len(merges)}
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def encoder(a_path: str, b_path: str) -> Encoder:
    """One encoder, and its cache, for each worker process."""
    return Encoder(a_path, b_path)


@dataclass
class Aligned:
    """The tokens of some segments, with the group of each and the first token of each segment and group."""

    a: np.ndarray
    b: np.ndarray
    a_segment: np.ndarray
    b_segment: np.ndarray
    a_end: np.ndarray  # within all segments in a row
    b_end: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    overlaps: np.ndarray  # (place of a, place of b), in order
    groups: int


def aligned_segments(segments: list[tuple[bytes, bytes]]) -> Aligned:
    """Overlaps by `merge_asof` from both sides, groups by equal ends."""
    sides = []
    for k in (0, 1):
        packed = np.frombuffer(b"".join([s[k] for s in segments]), "<u4")
        lengths = (packed >> 16).astype(np.int64)
        end = np.cumsum(lengths)
        segment = np.repeat(np.arange(len(segments)), [len(s[k]) // 4 for s in segments])
        sides.append((packed & 0xFFFF, segment, end - lengths, end))
    (a, a_segment, a_start, a_end), (b, b_segment, b_start, b_end) = sides
    places = lambda segment, start, **more: pd.DataFrame({"document": segment, "at": start} | more)
    of_a = places(a_segment, a_start, a=np.arange(len(a)))
    of_b = places(b_segment, b_start, b=np.arange(len(b)))
    over = pd.merge_asof(of_a, of_b, on="at", by="document")["b"].to_numpy()
    under = pd.merge_asof(of_b, of_a, on="at", by="document")["a"].to_numpy()
    pairs = np.r_[np.arange(len(a)) << 32 | over, under << 32 | np.arange(len(b))]
    pairs.sort(kind="stable")  # two sorted runs
    pairs = pairs[np.diff(pairs, prepend=-1) != 0]
    pairs = np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1)
    closing = pairs[a_end[pairs[:, 0]] == b_end[pairs[:, 1]]]
    groups = []
    for k, ids in enumerate((a, b)):
        last = np.zeros(len(ids), np.int64)
        last[closing[:, k]] = 1
        groups.append(np.cumsum(last) - last)  # groups closed before
    return Aligned(a, b, a_segment, b_segment, a_end, b_end, *groups, pairs, len(closing))


def _linked(x: Aligned, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document << 32 | a id << 15 | b id, number of links) of every pair of tokens that share a group."""
    n_a, n_b = np.bincount(x.a_group, minlength=x.groups), np.bincount(x.b_group, minlength=x.groups)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > _WIDE
    mine = np.where(wide[x.a_group], 0, n_b[x.a_group])
    left = np.repeat(np.arange(len(x.a)), mine)
    right = np.arange(len(left)) - np.repeat(np.cumsum(mine) - mine, mine) + first_b[x.a_group[left]]
    key = lambda d, a, b: d.astype(np.int64) << 32 | a.astype(np.int64) << _B_BITS | b.astype(np.int64)
    keys, counts = np.unique(key(document[x.a_segment[left]], x.a[left], x.b[right]), return_counts=True)
    if not wide.any():
        return keys, counts
    more = [(keys, counts)]
    for g in np.flatnonzero(wide):
        ids_a, k_a = np.unique(x.a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        ids_b, k_b = np.unique(x.b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        d = np.full(len(ids_a) * len(ids_b), document[x.a_segment[first_a[g]]])
        more.append((key(d, np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a))), np.outer(k_a, k_b).ravel()))
    return summed(np.concatenate([k for k, _ in more]), np.concatenate([n for _, n in more]))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


@lru_cache(maxsize=1)
def _decimals() -> list[list[bytes]]:
    """Ids as text with what follows: another id of the side, or the end of a side in its group."""
    return [[b"%d%s" % (i, mark) for i in range(1 << bits)] for bits, mark in ((16, b","), (16, b"|"), (_B_BITS, b","), (_B_BITS, b";"))]


def _written(x: Aligned) -> tuple[list[bytes], np.ndarray]:
    """The tokens as text in the order of the groups, A before B; and the first of them for each segment."""
    more_a, last_a, more_b, last_b = _decimals()
    total = len(x.a) + len(x.b)
    upto_a, upto_b = np.cumsum(np.bincount(x.a_group)), np.cumsum(np.bincount(x.b_group))
    at_a = np.arange(len(x.a)) + np.r_[0, upto_b][x.a_group]
    at_b = np.arange(len(x.b)) + upto_a[x.b_group]
    ends_a, ends_b = np.diff(x.a_group, append=-1) != 0, np.diff(x.b_group, append=-1) != 0
    place = np.empty(total, np.int64)
    # one table of four parts
    place[at_a] = x.a + np.where(ends_a, 1 << 16, 0)
    place[at_b] = (2 << 16) + x.b + np.where(ends_b, 1 << _B_BITS, 0)
    names = _names()
    segment = np.empty(total, np.int64)
    segment[at_a], segment[at_b] = x.a_segment, x.b_segment
    return [names[i] for i in place.tolist()], np.searchsorted(segment, np.arange(segment[-1] + 2))


@lru_cache(maxsize=1)
def _names() -> list[bytes]:
    return [t for part in _decimals() for t in part]


@dataclass
class _Block:
    """Documents whose pairs are counted together."""

    rows: dict[str, list] = field(default_factory=lambda: {n: [] for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "digest")})
    keys: list[np.ndarray] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    size: int = 0


def _measured(texts: list[tuple[object, str]], paths: tuple[str, str]) -> Iterator[_Block]:
    """Align texts, some segments at a time; yields full blocks and at the end what is left."""
    make = encoder(*paths)
    block = _Block()
    waiting: list[tuple[bytes, bytes]] = []
    owners: list[int] = []
    hashes: list = []
    tokens = 0

    def run() -> None:
        nonlocal waiting, owners, tokens
        if waiting:
            x = aligned_segments(waiting)
            document = np.array(owners)
            keys, counts = _linked(x, document)
            block.keys.append(keys), block.counts.append(counts)
            block.size += len(keys)
            written, first = _written(x)
            n_a, n_b = np.bincount(x.a_segment), np.bincount(x.b_segment)
            last = np.searchsorted(x.a_segment, np.arange(len(waiting)), "right") - 1
            groups = np.diff(x.a_group[last] + 1, prepend=0)
            per_group = np.bincount(x.a_group) * np.bincount(x.b_group)
            links = np.add.reduceat(per_group, np.cumsum(groups) - groups)
            rows = block.rows
            for k, d in enumerate(owners):
                rows["n_a"][d] += int(n_a[k])
                rows["n_b"][d] += int(n_b[k])
                rows["n_groups"][d] += int(groups[k])
                rows["n_links"][d] += int(links[k])
                # without the mark after the last group, which comes before the next segment
                text = b"".join(written[first[k] : first[k + 1]])[:-1]
                if hashes[d] is None:
                    hashes[d] = hashlib.sha256(text)
                else:
                    hashes[d].update(b";" + text)
        waiting, owners, tokens = [], [], 0

    def done() -> _Block:
        block.rows["digest"] = [h.hexdigest() if h is not None else "" for h in hashes]
        return block

    for nth in range(0, len(texts), 256):
        some = [(doc_id, text, make.units(text)) for doc_id, text in texts[nth : nth + 256]]
        make.learn([units for _, _, units in some])
        for doc_id, text, units in some:
            d = len(hashes)
            hashes.append(None)
            block.rows["doc_id"].append(doc_id)
            for n in ("n_a", "n_b", "n_groups", "n_links"):
                block.rows[n].append(0)
            for segment in make.segments(text, units):
                waiting.append(segment), owners.append(d)
                tokens += max(len(segment[0]), len(segment[1])) // 4
                if tokens >= TOKENS:
                    run()
            if block.size >= BLOCK:
                run()
                yield done()
                block, hashes = _Block(), []
        make.forget()
    run()
    yield done()


def align(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """doc_id, a, b (arrays of id, end, group in order; ends are byte offsets in blank + text), overlaps (a, b: places
    of tokens whose bytes overlap).

    Null and empty texts, and texts whose tokens do not give their bytes back, have empty arrays.  Ids may be null or
    repeated: each row is a document.  Other columns are left out.
    """
    paths = (a_path or vocabulary_path(A_VOCABULARY), b_path or vocabulary_path(B_VOCABULARY))
    id_type = docs.schema[doc_id].dataType.simpleString()
    token = "array<struct<id:int,end:long,group:int>>"

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"doc_id": batch.column("doc_id").to_pylist(), "a": [], "b": [], "overlaps": []}
        make = encoder(*paths)
        for value in texts_of(batch):
            units = make.units(value)
            make.learn([units])
            rows: dict[str, list] = {"a": [], "b": [], "overlaps": []}
            ends, groups = 0, 0
            for segment in make.segments(value, units):
                x = aligned_segments([segment])
                before = len(rows["a"]), len(rows["b"])
                for name, ids, end, group in (("a", x.a, x.a_end, x.a_group), ("b", x.b, x.b_end, x.b_group)):
                    places = zip(ids.tolist(), (end + ends).tolist(), (group + groups).tolist())
                    rows[name] += [{"id": i, "end": e, "group": g} for i, e, g in places]
                rows["overlaps"] += [{"a": i + before[0], "b": j + before[1]} for i, j in x.overlaps.tolist()]
                ends, groups = ends + int(x.a_end[-1]), groups + x.groups
            for name, made in rows.items():
                out[name].append(made)
        make.forget()
        return out

    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(source, f"doc_id {id_type}, a {token}, b {token}, overlaps array<struct<a:int,b:int>>", of)


def _blocks(source: DataFrame, id_type: str, paths: tuple[str, str]) -> DataFrame:
    """One row for each block: columns of its documents as arrays, its pairs, and which of them each document has."""
    schema = (
        f"block long, doc_id array<{id_type}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "digest array<string>, pairs binary, documents binary, pair_at binary, pair_n binary, pair_after binary"
    )
    made = {}

    def of(batch: pa.RecordBatch):
        context = TaskContext.get()
        key = context.partitionId(), context.taskAttemptId()
        for block in _measured(list(zip(batch.column("doc_id").to_pylist(), texts_of(batch))), paths):
            nth = made.get(key, 0)
            made.clear()
            made[key] = nth + 1
            empty = np.empty(0, np.int64)
            keys, counts = summed(np.concatenate([empty, *block.keys]), np.concatenate([empty, *block.counts]))
            pairs, at = np.unique(keys & 0x7FFFFFFF, return_inverse=True)
            after = np.searchsorted(keys >> 32, np.arange(len(block.rows["doc_id"])), "right")
            yield {n: [v] for n, v in block.rows.items()} | {
                "block": [key[0] << 32 | nth],
                "pairs": [pairs.astype("<u4").tobytes()],
                "documents": [np.bincount(at, minlength=len(pairs)).astype("<u4").tobytes()],
                "pair_at": [at.astype("<u4").tobytes()],
                "pair_n": [counts.astype("<u8" if counts.max(initial=0) > 65535 else "<u2").tobytes()],
                "pair_after": [after.astype("<u4").tobytes()],
            }

    return map_arrow(source, schema, of)


def link_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row.

    A link is a pair of tokens, one of each side, that share a group; the count of an id pair is the number of rows
    that have it linked.  n_best is the number of links whose count is the highest of their A id, ties included;
    count_sum is the sum of counts over links.  Null and empty texts, and texts whose tokens do not give their
    bytes back, have zeros and an empty groups_sha256.  Ids may be null; repeated rows are rows of their own.
    """
    paths = (a_path or vocabulary_path(A_VOCABULARY), b_path or vocabulary_path(B_VOCABULARY))
    id_type = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    blocks = cut(_blocks(source, id_type, paths), "blocks")

    def pairs_of(batch: pa.RecordBatch):
        for block, pairs, documents in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "documents"))):
            ids = np.frombuffer(pairs, "<u4").astype(np.int64)
            yield {
                "block": np.full(len(ids), block), "at": np.arange(len(ids), dtype=np.int32),
                "pair": ids, "n": np.frombuffer(documents, "<u4").astype(np.int64),
            }

    pairs = map_arrow(blocks.select("block", "pairs", "documents"), "block long, at int, pair long, n long", pairs_of)
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    # an A id has at most as many rows here as the other vocabulary has ids
    of_a = Window.partitionBy(F.shiftright("pair", _B_BITS))
    counts = cut(counts.withColumn("best", F.col("count") == F.max("count").over(of_a)), "counts")
    known = pairs.join(counts, "pair").select("block", "at", "count", "best")

    def finish(block: pa.Table, known: pa.Table) -> pa.Table:
        """A block has its pairs once each, in order of `at`."""
        row = block.to_pylist()[0]
        order = np.argsort(known.column("at").to_numpy())
        count, best = known.column("count").to_numpy()[order], known.column("best").to_numpy(zero_copy_only=False)[order]
        at = np.frombuffer(row["pair_at"], "<u4")
        n = np.frombuffer(row["pair_n"], "<u2" if len(row["pair_n"]) == 2 * len(at) else "<u8").astype(np.int64)
        after = np.frombuffer(row["pair_after"], "<u4").astype(np.int64)
        upto = lambda x: np.r_[0, np.cumsum(x)][np.r_[0, after]]
        made = {
            "doc_id": block.column("doc_id").combine_chunks().flatten(),
            **{c: pa.array(row[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")},
            "n_best": pa.array(np.diff(upto(n * best[at])), pa.int64()),
            "count_sum": pa.array(np.diff(upto(n * count[at])), pa.int64()),
            "groups_sha256": pa.array(row["digest"], pa.string()),
        }
        give_back()
        return pa.table(made)

    schema = (
        f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
    rest = blocks.drop("pairs", "documents")
    return rest.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(finish, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    return link_counts(table(spark, sf_dir, "documents"))
