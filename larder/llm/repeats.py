"""Repeated passages: bytes covered by a string of 50 bytes that starts in a document with a smaller id too.

Every 50-byte window has an anchor, the smallest of its hashed 16-byte pieces; equal windows have equal anchors.

1. Equal texts are one class, known by its smallest id; larger ids of a class lose all their bytes.
2. Anchors are counted over classes; one that a single class has leads to no match.
3. Runs of windows whose anchor is shared go, with their bytes, to a bucket of the anchor's hash.
   (Windows of an anchor that more than 20,000 classes share are grouped by their own digests instead.)
4. In a bucket the windows are sorted by two-stage suffix sorting: windows smaller than their successor directly, the
   others by scanning the buckets of first bytes.  Neighbours with a common prefix of 50 are the same string; its
   smallest id owns it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.buckets import LEAST_BUCKETS, bucket_of, how_many, mixed, shared_hashes
from larder.llm.common import cut, map_arrow, map_groups, table, texts_of

SPAN = 50
PIECE = 16
_STRETCH = 1 << 19  # windows looked at together
_BUCKET_BYTES = 512 << 10  # sorting takes about a hundred times that
_FLUSH = 4 << 20
HOT = 20_000  # classes that share an anchor, above which its windows are grouped one by one
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_LOW = np.uint64((1 << 20) - 1)
_PAD = b"\xff" * SPAN  # no byte of UTF-8: larger than all


def _words(data: bytes) -> np.ndarray:
    """The big-endian 8-byte number at each place."""
    return np.ndarray((max(len(data) - 7, 0),), ">u8", buffer=data, strides=(1,)).astype(np.uint64)


def _pieces(data: bytes) -> np.ndarray:
    """The hash of the 16-byte piece at each place."""
    words = _words(data)
    return mixed(words[:-8] * _M[0] + (words[8:] ^ (words[8:] >> np.uint64(29))) * _M[1])


def anchors(data: bytes) -> np.ndarray:
    """For each 50-byte window of the data the hash of its anchor: of its 35 pieces the smallest."""
    n, width = len(data) - SPAN + 1, SPAN - PIECE + 1
    made = []
    for low in range(0, max(n, 0), _STRETCH):
        hashes = _pieces(data[low : min(low + _STRETCH, n) + SPAN - 1])
        # the place in the low bits: of equal pieces the leftmost
        keys = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        blocks = np.full(-(-len(keys) // width) * width, ~np.uint64(0))
        blocks[: len(keys)] = keys
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(keys) - width + 1
        least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
        # least hashes lie low: mixed once more, they spread evenly over the buckets
        made.append(mixed(hashes[(least & _LOW).astype(np.int64)]))
    return np.concatenate(made) if made else np.empty(0, np.uint64)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _anchor_set(text: str) -> np.ndarray:
    return np.unique(anchors(_bytes(text)))


def _text_key(text: str, _: np.ndarray) -> bytes:
    return hashlib.md5(_bytes(text), usedforsecurity=False).digest()


def _smaller(data: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the next one; the last byte has to be larger than all."""
    step = np.sign(np.diff(data.astype(np.int16)))
    places = np.arange(len(step))
    # of a run of equal bytes the step at its end decides
    known = np.where(step != 0, places, len(step))
    following = np.minimum.accumulate(known[::-1])[::-1]
    return step[np.minimum(following, len(step) - 1)] > 0


def runs(data: bytes, shared: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first window, after the last, end of the bytes, anchor) of runs of windows with one shared anchor.

    The bytes go on to the next window that is smaller than its successor, so that sorting by induction has where to
    start; at the end of the text that may be padding.
    """
    all_anchors = anchors(data)
    if not len(all_anchors):
        return []
    edges = np.r_[0, np.flatnonzero(all_anchors[1:] != all_anchors[:-1]) + 1, len(all_anchors)]
    hit = np.isin(all_anchors[edges[:-1]], shared)
    if not hit.any():
        return []
    smaller = _smaller(np.frombuffer(data + _PAD[:1], np.uint8))
    places = np.arange(len(smaller))
    next_smaller = np.minimum.accumulate(np.where(smaller, places, len(smaller))[::-1])[::-1]
    firsts, afters = edges[:-1][hit], edges[1:][hit]
    return list(zip(firsts.tolist(), afters.tolist(), (next_smaller[afters - 1] + SPAN).tolist(), all_anchors[firsts].tolist()))


def two_stage(data: np.ndarray, starts: np.ndarray, begins: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The window starts in the order of their 50 bytes.

    `starts` are all window starts, in order; `begins` says which are the first of their run.  The last window of a
    run has to be smaller than its successor.
    """
    # a window and its successor first differ where the text first steps up or down
    inner = np.flatnonzero(~np.r_[begins[1:], True])
    bytes_ = data[starts]
    step = np.zeros(len(starts), np.int8)
    step[inner] = np.sign(bytes_[inner + 1].astype(np.int16) - bytes_[inner])
    step[np.r_[begins[1:], True]] = 1  # the last of a run
    known = np.where(step != 0, np.arange(len(step), dtype=np.int32), np.int32(len(step)))
    up = step[np.minimum.accumulate(known[::-1])[::-1]] > 0

    direct = np.flatnonzero(up)
    at = starts[direct]
    # seven words cover 50 bytes; the last two overlap
    order = np.lexsort([words[at + o] for o in (SPAN - 8, 40, 32, 24, 16, 8, 0)])
    direct = direct[order]
    edges = np.searchsorted(bytes_[direct], np.arange(257))

    arrived: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(entries: np.ndarray, own: int) -> np.ndarray:
        """Send the larger predecessors of `entries` to the buckets of their bytes; give back those for `own`."""
        before = entries[~begins[entries]] - 1
        before = before[~up[before]]
        if not len(before):
            return before
        to = bytes_[before]
        sorted_ = np.argsort(to, kind="stable")
        before, to = before[sorted_], to[sorted_]
        cuts = np.r_[0, np.flatnonzero(to[1:] != to[:-1]) + 1, len(to)]
        same = before[:0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if to[a] == own:
                same = before[a:b]
            else:
                arrived[to[a]].append(before[a:b])
        return same

    for c in range(256):
        wave = np.concatenate(arrived[c]) if arrived[c] else direct[:0]
        while len(wave):  # runs of one byte lead back to the same bucket
            out.append(wave)
            wave = induce(wave, c)
        own = direct[edges[c] : edges[c + 1]]
        if len(own):
            out.append(own)
            induce(own, c)
    return np.concatenate(out) if out else direct


def _owned(group: pa.Table) -> pa.Table:
    """Of one bucket: (class, first byte, after the last) of runs of windows that a smaller id owns."""
    column = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in group.column(c).to_pylist()])
    data = b"".join(group.column("data").to_pylist())
    sizes, real, first = column("sizes", "<i4"), column("real", "<i4"), column("first", "<i8")
    owner, ids = column("class", "<i8"), column("ids", "<i8")
    base = np.cumsum(sizes, dtype=np.int64) - sizes
    windows = sizes - SPAN + 1
    run = np.repeat(np.arange(len(sizes), dtype=np.int32), windows)
    nth = np.arange(len(run), dtype=np.int32) - np.repeat(np.cumsum(windows, dtype=np.int32) - windows, windows)
    starts = (base[run] + nth).astype(np.int32)
    values, words = np.frombuffer(data, np.uint8), _words(data)
    order = two_stage(values, starts, nth == 0, words)
    # the windows that only lead the sorting belong to no one
    order = order[nth[order] < real[run[order]]]
    at = starts[order]
    same = np.ones(max(len(at) - 1, 0), bool)
    for o in (0, 8, 16, 24, 32, 40, SPAN - 8):
        live = np.flatnonzero(same)
        same[live] = words[at[live] + o] == words[at[live + 1] + o]
    edges = np.flatnonzero(np.r_[True, ~same]) if len(at) else np.empty(0, int)
    window_ids = ids[run[order]]
    least = np.repeat(np.minimum.reduceat(window_ids, edges), np.diff(np.r_[edges, len(at)])) if len(at) else window_ids
    lost = np.sort(order[window_ids > least])
    # neighbouring windows of a run become one stretch of bytes
    new = np.r_[True, (lost[1:] != lost[:-1] + 1) | (run[lost[1:]] != run[lost[:-1]])] if len(lost) else np.empty(0, bool)
    low = lost[new]
    high = lost[np.r_[new[1:], True]] if len(lost) else low
    return pa.table(
        {
            "class": pa.array(owner[run[low]], pa.int64()),
            "start": pa.array(first[run[low]] + nth[low], pa.int64()),
            "end": pa.array(first[run[high]] + nth[high] + SPAN, pa.int64()),
        }
    )


def _wanted(classes: DataFrame, hot: int) -> DataFrame:
    """key, doc_id, and the shared anchors of a class as bytes, those of more than `hot` classes apart."""

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"key": batch.column("key"), "doc_id": batch.column("doc_id"), "shared": [], "hot": []}
        for parts in batch.column("parts").to_pylist():
            hashes = np.frombuffer(b"".join(p["hashes"] for p in parts), np.uint64)
            many = np.frombuffer(b"".join(p["counts"] for p in parts), "<u4") > hot
            out["shared"].append(hashes[~many].tobytes()), out["hot"].append(hashes[many].tobytes())
        return out

    return map_arrow(classes, "key binary, doc_id long, shared binary, hot binary", of)


def _lost_hot(members: DataFrame) -> DataFrame:
    """(class, start, end) of windows with a very common anchor that a smaller id owns.

    Such windows do not meet in a bucket: they are grouped by their own digests, least ids first within tasks.
    """

    def of(batch: pa.RecordBatch):
        out: dict[str, list] = {"digest": [], "class": [], "doc_id": [], "start": []}
        for owner, doc, hot, text in zip(*(batch.column(c).to_pylist() for c in ("class", "doc_id", "hot")), texts_of(batch)):
            data = _bytes(text)
            for at in np.flatnonzero(np.isin(anchors(data), np.frombuffer(hot, np.uint64))).tolist():
                out["digest"].append(hashlib.blake2b(data[at : at + SPAN], digest_size=16).digest())
                out["class"].append(owner), out["doc_id"].append(doc), out["start"].append(at)
            if len(out["start"]) > 100_000:
                yield out
                out = {c: [] for c in out}
        yield out

    windows = cut(map_arrow(members, "digest binary, class long, doc_id long, start long", of), "hot-windows")
    owners = cut(windows.groupBy("digest").agg(F.min("doc_id").alias("least")), "hot-owners")
    # both are plain scans, so that a window of very many documents can be split between tasks
    lost = windows.join(owners, "digest").where(F.col("doc_id") > F.col("least"))
    return lost.select("class", "start", (F.col("start") + SPAN).alias("end"))


def _sent(members: DataFrame, n_buckets: int) -> DataFrame:
    """Runs of windows with shared anchors, packed by batch and bucket."""
    names = ["data", "sizes", "real", "first", "class", "ids"]

    def of(batch: pa.RecordBatch):
        parts: dict[int, list[tuple]] = {}
        size = 0

        def rows() -> dict:
            out: dict[str, list] = {c: [] for c in ["bucket", *names]}
            for bucket, found in parts.items():
                data, sizes, real, first, owner, ids = zip(*found)
                out["bucket"].append(bucket), out["data"].append(b"".join(data))
                for c, v, t in (("sizes", sizes, "<i4"), ("real", real, "<i4"), ("first", first, "<i8"), ("class", owner, "<i8"), ("ids", ids, "<i8")):
                    out[c].append(np.array(v, t).tobytes())
            return out

        columns = [batch.column(c).to_pylist() for c in ("class", "doc_id", "shared")]
        for owner, doc, shared, text in zip(*columns, texts_of(batch)):
            data = _bytes(text)
            found = runs(data, np.frombuffer(shared, np.uint64))
            buckets = bucket_of(np.array([f[3] for f in found], np.uint64), n_buckets).tolist()
            data += _PAD
            for (low, after, end, _), bucket in zip(found, buckets):
                parts.setdefault(bucket, []).append((data[low:end], end - low, after - low, low, owner, doc))
                size += end - low
            if size > _FLUSH:
                yield rows()
                parts, size = {}, 0
        if parts:
            yield rows()

    return map_arrow(members, "bucket int, data binary, sizes binary, real binary, first binary, class binary, ids binary", of)


def _kept(cleaned: DataFrame) -> DataFrame:
    """key, spans, kept_sha256 of classes that lose something."""

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"key": batch.column("key"), "spans": [], "kept_sha256": []}
        for text, found in zip(texts_of(batch), batch.column("found").to_pylist()):
            data, merged = _bytes(text), []
            for low, high in sorted((f["start"], f["end"]) for f in found):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            digest, at = hashlib.sha256(), 0
            for low, high in merged:
                digest.update(data[at:low])
                at = high
            digest.update(data[at:])
            out["spans"].append([{"start": a, "end": b} for a, b in merged])
            out["kept_sha256"].append(digest.hexdigest())
        return out

    return map_arrow(cleaned, "key binary, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string", of)


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (array of start, end in bytes of UTF-8, apart from each other) that
    are removed, kept_sha256 of the bytes that stay.

    Ids are integers.  Null text is empty; texts under 50 bytes keep all.  A null id is neither smaller nor larger than
    another, so such a document loses nothing and takes nothing; rows that share an id take nothing from each other.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    long_enough = F.octet_length("text") >= SPAN
    kinds = cut(
        rows.where(long_enough).groupBy("key").agg(F.min("doc_id").alias("first"), F.max(F.octet_length("text")).alias("n")).where("first is not null"),
        "text-classes",
    )
    total = kinds.agg(F.sum("n")).first()[0] or 0
    # one piece in 18 is an anchor
    anchored = cut(shared_hashes(rows.where(long_enough).select("text"), _anchor_set, _text_key, how_many(total // 18)), "anchors")
    per_class = anchored.groupBy("key").agg(F.collect_list(F.struct("hashes", "counts")).alias("parts"))
    wanted = cut(_wanted(kinds.join(per_class, "key").select("key", F.col("first").alias("doc_id"), "parts"), HOT), "anchored-classes")
    # key and id together: one text that very many rows have meets its class in one row only (or in the rows that
    # repeat it with its id, which are judged alike)
    members = rows.where(long_enough).join(wanted, ["key", "doc_id"])
    members = cut(members.withColumn("class", F.monotonically_increasing_id()), "members")
    shared = members.agg(F.sum(F.length("shared"))).first()[0] or 0
    n_buckets = max(LEAST_BUCKETS, -(-shared // 8 * 80 // _BUCKET_BYTES))
    sent = _sent(members.select("class", "doc_id", "shared", "text"), n_buckets)
    lost = cut(map_groups(sent, ["bucket"], "class long, start long, end long", _owned), "lost")
    lost = lost.unionByName(_lost_hot(members.where(F.length("hot") > 0)))
    found = lost.groupBy("class").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    kept = _kept(members.select("class", "key", "text").join(found, "class").select("key", "text", "found"))
    verdict = cut(kinds.join(kept.dropDuplicates(["key"]), "key", "left").select("key", "first", "spans", "kept_sha256"), "verdicts")

    whole = F.col("doc_id") > F.col("first")  # an equal text has a smaller id
    own = F.col("doc_id") == F.col("first")
    no_spans = F.array().cast("array<struct<start:bigint,end:bigint>>")
    measured = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    # the verdicts are written, so that a text that very many rows have can be split between tasks
    return measured.join(verdict, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))))
        .when(own & F.col("spans").isNotNull(), F.col("spans"))
        .otherwise(no_spans)
        .alias("spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).when(own & F.col("spans").isNotNull(), F.col("kept_sha256")).otherwise(F.col("sha")).alias("kept_sha256"),
    )


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    df = repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return df.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
