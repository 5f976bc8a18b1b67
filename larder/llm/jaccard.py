"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection of sorted arrays.

1. A document becomes its set of word shingles as sorted 64-bit hashes.  Equal sets are one class.
2. Every shingle is counted over classes, in buckets of the hash range.  A shingle of one class links nothing, so a
   class needs three quarters of its shingles shared; most classes leave here, and with the rest only their shared
   shingles go on, rarest first.
3. Two sets that are similar share one of the first shingles in that order (the prefix).  A tile is such a shingle
   with a band of set sizes.  In a tile the bits of two signatures that differ bound the overlap from above; what is
   left is decided by intersecting the arrays.
4. Tiles whose members are one component already have nothing to find.  A few rounds of links to one member of each
   min-hash group therefore come before; large groups of near copies end in them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.buckets import how_many, mixed, shared_hashes
from larder.llm.common import cut, map_arrow, table, texts_of, with_row
from larder.llm.graph import components

WORDS = 5
PERCENT = 75
SIGNATURE = 1024  # bits
TILE = 1024  # members of a side of a tile
HASHES = 16  # min-hash orders
ROUNDS = 4  # of links within min-hash groups, before tiles
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class _Hashes(dict):
    """64-bit hashes of words; forgets all when it has met very many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


_WORD_HASHES = _Hashes()


def shingles(text: str, width: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles; of fewer words the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, n)
    taken = min(n, width)
    total = np.full(n - taken + 1, taken, np.uint64)
    for i in range(taken):
        total += ids[i : n - taken + 1 + i] * _MULTIPLIERS[i % 5] + np.uint64(i // 5)
    return np.unique(mixed(total))


def _key(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _least_shared(n: Column) -> Column:
    """The smallest overlap that a set of n can have with a similar one."""
    return F.ceil(n * PERCENT / 100)


def _signature(hashes: np.ndarray) -> bytes:
    bits = np.zeros(SIGNATURE, np.uint8)
    bits[(hashes % np.uint64(SIGNATURE)).astype(int)] = 1
    return np.packbits(bits).tobytes()


def _sets(parts: DataFrame) -> DataFrame:
    """key, n, parts -> key, n, hashes (rarest first, as bytes), n_hashes, signature, minima (of a few orders)."""
    seeds = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * _MULTIPLIERS[0])

    def of(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"key": batch.column("key"), "n": batch.column("n"), "hashes": [], "n_hashes": [], "signature": [], "minima": []}
        for parts in batch.column("parts").to_pylist():
            h = np.frombuffer(b"".join(p["hashes"] for p in parts), np.uint64)
            df = np.frombuffer(b"".join(p["counts"] for p in parts), "<u4")
            h = h[np.lexsort((h, df))]
            out["hashes"].append(h.tobytes()), out["n_hashes"].append(len(h)), out["signature"].append(_signature(h))
            out["minima"].append([int(mixed(h ^ s).min().view(np.int64)) for s in seeds])
        return out

    return map_arrow(parts, "key binary, n long, hashes binary, n_hashes long, signature binary, minima array<long>", of)


def _stars(groups: DataFrame, sets: DataFrame, labels: DataFrame | None, order: Column) -> DataFrame:
    """Pairs (a, b) of each set and the first, by `order`, of each of its min-hash groups, where signatures allow a
    link; given labels, only pairs of different components."""
    leaders = groups.groupBy("nth", "value").agg(F.min_by("cid", order).alias("lead"), F.count(F.lit(1)).alias("k"))
    leaders = cut(leaders.where("k > 1").drop("k"), "leaders")
    near = groups.join(leaders, ["nth", "value"]).where("cid <> lead")
    if labels is not None:
        of = lambda x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
        near = near.join(of("cid"), "cid", "left").join(of("lead"), "lead", "left")
        near = near.where(F.coalesce("c_cid", "cid") != F.coalesce("c_lead", "lead"))
    pairs = near.select(F.least("lead", "cid").alias("a"), F.greatest("lead", "cid").alias("b")).distinct()
    return cut(_bounded(pairs, sets), "pairs")


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow enough overlap.  Moves signatures, not sets."""
    side = lambda x: sets.select(
        F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("n_hashes").alias(f"s_{x}"), F.col("signature").alias(f"g_{x}")
    )
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def of(batch: pa.RecordBatch) -> dict:
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        bits = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(-1, SIGNATURE // 64)
        good = _allowed(get("n_a"), get("s_a"), bits("g_a"), get("n_b"), get("s_b"), bits("g_b"))
        mask = pa.array(good)
        return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}

    return map_arrow(joined, "a long, b long", of)


def _allowed(na, sa, ga, nb, sb, gb) -> np.ndarray:
    """Where 100 * overlap >= 75 * union is possible: an overlap o needs o * 175 >= 75 * (na + nb)."""
    only_a = np.bitwise_count(ga & ~gb).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(gb & ~ga).sum(axis=-1, dtype=np.int64)
    most = np.minimum(sa - only_a, sb - only_b)
    return most * (100 + PERCENT) >= PERCENT * (na + nb)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links, by exact intersection."""
    side = lambda x: sets.select(F.col("cid").alias(x), F.col("n").alias(f"n_{x}"), F.col("hashes").alias(f"h_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def of(batch: pa.RecordBatch) -> dict:
        good = []
        columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "h_a", "h_b")]
        for na, nb, ha, hb in zip(*columns):
            a, b = np.frombuffer(ha, np.uint64), np.frombuffer(hb, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            good.append(100 * both >= PERCENT * (na + nb - both))
        mask = pa.array(good, pa.bool_())
        return {"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)}

    return map_arrow(joined, "a long, b long", of)


def _tile(group: pa.Table) -> pa.Table:
    """Of one tile: pairs of members of different components that sizes and signatures allow.

    A tile of two sides compares across them, a tile of one side within it.
    """
    get = lambda c: group.column(c).to_numpy()
    cid, comp, n, s, side = get("cid"), get("component"), get("n"), get("n_hashes"), get("side")
    bits = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint64).reshape(-1, SIGNATURE // 64)
    two = side.min() != side.max()
    first = np.flatnonzero(side == side.min())
    second = np.flatnonzero(side == side.max()) if two else first
    out_a, out_b = [], []
    for i in first:
        others = second[(comp[second] != comp[i]) & ((cid[second] > cid[i]) | two)]
        others = others[(100 * n[others] >= PERCENT * n[i]) & (100 * n[i] >= PERCENT * n[others])]
        if len(others):
            hit = others[_allowed(n[i], s[i], bits[i], n[others], s[others], bits[others])]
            out_a.append(np.minimum(cid[i], cid[hit])), out_b.append(np.maximum(cid[i], cid[hit]))
    empty = np.empty(0, np.int64)
    return pa.table({"a": np.concatenate(out_a or [empty]), "b": np.concatenate(out_b or [empty])}).select(["a", "b"])


def _tiles(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs between components: tiles of prefix shingles and size bands.

    A member lies in the tile of its own band and, as the smaller one, in that of the next.  Of a tile's components
    the largest is compared with the others only.  Sides of more than 1024 members are dealt in blocks, and every
    block meets every other one.
    """
    labelled = sets.select("cid", "n", "n_hashes", "hashes", "signature").join(
        labels.withColumnRenamed("node", "cid"), "cid", "left"
    ).withColumn("component", F.coalesce("component", "cid"))

    def prefixes(batch: pa.RecordBatch):
        out: dict[str, list] = {"token": [], "band": [], "cid": [], "component": []}
        columns = [batch.column(c).to_pylist() for c in ("cid", "component", "n", "n_hashes", "hashes")]
        for cid, comp, n, s, hashes in zip(*columns):
            least = -(-PERCENT * n // 100)
            tokens = np.frombuffer(hashes, np.int64)[: n - least + 1 - (n - s)].tolist()
            # bands grow by the largest factor that sizes of similar sets can differ by
            band = int(np.floor(np.log(n) / np.log(100 / PERCENT) + 1e-9))
            for b in (band, band + 1):
                k = len(tokens)
                out["token"] += tokens
                out["band"] += [b] * k
                out["cid"] += [cid] * k
                out["component"] += [comp] * k
            if len(out["cid"]) > 200_000:
                yield out
                out = {c: [] for c in out}
        yield out

    members = cut(map_arrow(labelled, "token long, band int, cid long, component long", prefixes), "members")
    marks = [F.xxhash64("cid").alias("x"), F.xxhash64("cid", F.lit(1)).alias("y")]
    per_component = members.select("token", "band", "component", *marks).groupBy("token", "band", "component").agg(
        F.count(F.lit(1)).alias("k"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")
    )
    tiles = (
        per_component.groupBy("token", "band")
        .agg(
            F.max_by("component", F.struct("k", "component")).alias("main"), F.max("k").alias("n_main"), F.sum("k").alias("n_all"),
            F.count(F.lit(1)).alias("n_comp"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"),
        )
        .where("n_comp > 1")
        # tiles with the same members find the same pairs: one of them is enough
        .groupBy("band", "n_all", "x", "y")
        .agg(F.min(F.struct("token", "main", "n_main")).alias("t"))
    )
    tiles = cut(tiles.select("t.*", "band", "n_all"), "tiles")
    blocks = lambda k: F.ceil(k / TILE).cast("int")
    n_rest = F.col("n_all") - F.col("n_main")
    main, small = F.col("component") == F.col("main"), F.col("n_all") <= TILE
    upto = lambda k: F.sequence(F.lit(0), k - 1)
    block = lambda k: F.pmod(F.xxhash64("cid"), k).cast("int")
    pair = lambda kind, i, k, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), k.alias("k"), side.alias("side"))
    zero = F.lit(0)
    mine = block(blocks(n_rest))
    dealt = (
        F.when(small, F.array(pair("all", zero, zero, zero)))
        .when(main, F.transform(upto(blocks(n_rest)), lambda i: pair("main", i, block(blocks(F.col("n_main"))), F.lit(1))))
        .otherwise(
            F.concat(
                F.transform(upto(blocks(F.col("n_main"))), lambda k: pair("main", mine, k, zero)),
                F.transform(
                    upto(blocks(n_rest)),
                    lambda j: pair("rest", F.least(mine, j), F.greatest(mine, j), F.when(mine <= j, 0).otherwise(1)),
                ),
            )
        )
    )
    placed = (
        members.join(tiles, ["token", "band"])
        .select("token", "band", "cid", "component", F.explode(dealt).alias("t"))
        .select("token", "band", "cid", "component", "t.*")
        .join(sets.select("cid", "n", "n_hashes", "signature"), "cid")
    )
    found = placed.groupBy("token", "band", "kind", "i", "k").applyInArrow(_tile, "a long, b long")
    return found.distinct()


def classes(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The written rows (_row, doc_id, n_shingles, key) and the classes (key, n, first): smallest id of equal sets."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()

    def of(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in texts_of(batch)]
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": [len(s) for s in sets],
            "key": [_key(s) if len(s) else None for s in sets],
        }

    rows = cut(with_row(map_arrow(source, f"doc_id {id_type}, n_shingles long, key binary", of)), "shingled")
    grouped = rows.where("key is not null").groupBy("key").agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("first"))
    return rows, cut(grouped, "classes")


def _survivors(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows and classes, and the sets of classes that share enough to have a link."""
    rows, kinds = classes(docs, doc_id, text)
    total = kinds.agg(F.sum("n")).first()[0] or 0
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    shared = cut(shared_hashes(texts, shingles, lambda _, made: _key(made), how_many(total)), "shared")
    enough = (
        shared.groupBy("key").agg(F.sum("shared").alias("shared")).join(kinds, "key").where(F.col("shared") >= _least_shared(F.col("n")))
    )
    enough = cut(enough.select("key", "n"), "survivors")
    parts = (
        shared.join(enough, "key").groupBy("key").agg(F.first("n").alias("n"), F.collect_list(F.struct("hashes", "counts")).alias("parts"))
    )
    sets = cut(_sets(parts).withColumn("cid", F.monotonically_increasing_id()), "sets")
    return rows, kinds, sets


def joined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: _row, doc_id, n_shingles, group (of the class), component_id.

    component_id is the smallest doc_id that links reach, the document's own included.  Null and empty texts have no
    shingles and are linked with nothing; their component is their own id.  Null ids are not the smallest of a
    component; repeated rows are in one class.  `_row` numbers the rows in the order of the scan.
    """
    rows, kinds, sets = _survivors(docs, doc_id, text)

    # each set with one member of each of its min-hash groups: first the same member for all, then, where components
    # still differ, another one for each order
    groups = cut(sets.select("cid", F.posexplode("minima").alias("nth", "value")), "groups")
    links, labels = None, None
    for n in range(ROUNDS):
        order = F.xxhash64("cid", "nth", F.lit(n)) if n else F.col("cid")
        made = cut(_verified(_stars(groups, sets, labels, order), sets), "links")
        links = made if links is None else links.union(made)
        labels = components(links)

    # what is left between components
    more = cut(_verified(cut(_tiles(sets, labels), "pairs"), sets), "links")
    labels = components(links.union(more))

    by_class = kinds.join(sets.select("key", "cid"), "key", "left").join(
        labels.withColumnRenamed("node", "cid"), "cid", "left"
    )
    by_class = cut(by_class.select("key", "first", "component"), "by-class")
    smallest = cut(by_class.where("component is not null").groupBy("component").agg(F.min("first").alias("least")), "components")
    named = cut(
        by_class.join(smallest, "component", "left").select("key", F.coalesce("least", "first").alias("least")), "named"
    )
    # written, so that a class with very many rows can be split between tasks
    return rows.join(named, "key", "left").select(
        "_row", "doc_id", "n_shingles", "key", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """key_a, doc_a, key_b, doc_b: every two different sets that are similar, once, each with its class (`key`, as in
    `joined`) and the smallest doc_id of the class.  Rows with equal sets are one class and are not listed.

    Every pair of tiles is verified, also within a component, so rows grow with the square of a group of near copies.
    """
    _, kinds, sets = _survivors(docs, doc_id, text)
    none = sets.select(F.col("cid").alias("node"), F.col("cid").alias("component")).limit(0)
    found = cut(_verified(cut(_tiles(sets, none), "pairs"), sets), "links")
    named = sets.select("cid", "key").join(kinds.select("key", "first"), "key")
    side = lambda x: named.select(F.col("cid").alias(x), F.col("key").alias(f"key_{x}"), F.col("first").alias(f"doc_{x}"))
    return found.join(side("a"), "a").join(side("b"), "b").select("key_a", "doc_a", "key_b", "doc_b")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
