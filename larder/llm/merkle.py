"""Merkle manifest of a dataset: a tree of 16 children for each group of rows, and one over the groups.

Leaves of a group are numbered in order and dealt to aligned builders, each with a run of 256 of them.  A builder
appends digests to its log in the order in which nodes are complete: a leaf at once, a parent right after its last
child.  So a log is in postorder, and where a node stands follows from the sizes of the subtrees before it; proofs
address siblings by that place.  What the builders of a group end in are the leaves of the next round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from larder.llm.common import cut, map_stream, table

FANOUT = 16
LEVELS = 2  # of a builder
ALIGNED = FANOUT**LEVELS
_HEX = 64
_PATH = "array<struct<place:int,siblings:string>>"


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 in hex of the values: `-` for null, else the length in UTF-8 bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def place_in_log(level: int, index: np.ndarray, leaves: int) -> np.ndarray:
    """Where the log of a builder with so many leaves has the nodes of a level: what is complete up to and with the
    node, less one.  Below and at its level that is all that its leaves fill, above it what ended before it."""
    upto = np.minimum((index + 1) * FANOUT**level, leaves)
    below = sum(-(-upto // FANOUT**k) for k in range(level + 1))
    above = sum(index // FANOUT**k for k in range(1, LEVELS - level + 1))
    return below + above - 1


def height(chunk: int, leaves: int) -> int:
    """Levels above the leaves of a builder: the first ends as soon as one node is left, which is then the root or,
    of a full builder, what any other one ends in."""
    if chunk:
        return LEVELS
    return next(k for k in range(LEVELS + 1) if FANOUT**k >= leaves)


def appended(digests: list[str], chunk: int) -> list[str]:
    """The log of a builder."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(LEVELS + 1)]
    top = height(chunk, len(digests))

    def close(level: int) -> None:
        node = _hash("".join(open_[level]))
        open_[level] = []
        log.append(node)
        open_[level + 1].append(node)

    for digest in digests:
        log.append(digest)
        open_[0].append(digest)
        level = 0
        while level < top and len(open_[level]) == FANOUT:
            close(level)
            level += 1
    for level in range(top):  # last runs, of fewer
        if open_[level]:
            close(level)
    return log


def runs(log: str, chunk: int, leaves: int) -> list[list[str]]:
    """For each level below the top the digests of its runs, in a row, taken from the log by place."""
    out = []
    nodes = leaves
    for level in range(height(chunk, leaves)):
        at = (place_in_log(level, np.arange(nodes), leaves) * _HEX).tolist()
        digests = [log[a : a + _HEX] for a in at]
        out.append(["".join(digests[r : r + FANOUT]) for r in range(0, nodes, FANOUT)])
        nodes = -(-nodes // FANOUT)
    return out


def path(levels: list[list[str]], index: int) -> list[tuple[int, str]]:
    """(place in its run, the others of the run) of a leaf and what is above it, level by level."""
    out = []
    for level in levels:
        run, place = level[index // FANOUT], index % FANOUT
        out.append((place, run[: _HEX * place] + run[_HEX * (place + 1) :]))
        index //= FANOUT
    return out


def folded(digest: str, steps: list[tuple[int, str]]) -> str:
    """The root that a digest and its path give."""
    for place, siblings in steps:
        digest = _hash(siblings[: _HEX * place] + digest + siblings[_HEX * place :])
    return digest


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add `index`: the number of a row in its group, from 0, in ascending order (null first).

    Ranges of (group, order) are sorted apart, so that a group may be larger than a task.  A task counts in its own
    slice; the sizes of the slices before are added.
    """
    keys = list(dict.fromkeys([group, *order]))
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = StructType(df.schema.fields + StructType.fromDDL("_slice int, _nth long").fields)
    names = df.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last, nth = None, 0
        for batch in batches:
            out = []
            for value in batch.column(group).to_pylist():
                nth = nth + 1 if (value,) == last else 0
                last = (value,)
                out.append(nth)
            yield {c: batch.column(c) for c in names} | {"_slice": [TaskContext.get().partitionId()] * len(out), "_nth": out}

    placed = cut(map_stream(ordered, schema, of), "numbered")
    sizes = placed.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # only the first group of a slice can have rows in an earlier one: a row for each slice at most
    starts = sizes.select(F.col(group).alias("_group"), F.col("_slice").alias("_own"), F.sum("_n").over(earlier).alias("_before"))
    on = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_own"))
    return placed.join(F.broadcast(starts.where("_before > 0")), on, "left").select(
        *[F.col(f"`{c}`") for c in names], (F.col("_nth") + F.coalesce("_before", F.lit(0))).alias("index")
    )


def built(nodes: DataFrame, group: str, carried: list[str]) -> DataFrame:
    """One row for each builder: group, chunk, leaves (their number), log, top, and the `carried` columns as arrays.

    `nodes` has `group`, `index` and `digest`.  Groups are cut into aligned runs, so a hot one is many builders.
    """
    dealt = nodes.withColumns({"chunk": F.floor(F.col("index") / ALIGNED).cast("long")})
    dealt = dealt.repartition(group, "chunk").sortWithinPartitions(group, "chunk", "index")
    kinds = [F.array(F.col(c)).alias(c) for c in carried]
    schema = StructType(
        nodes.select(F.col(group)).schema.fields
        + StructType.fromDDL("chunk long, leaves int, log string, top string").fields
        + nodes.select(*kinds).schema.fields
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own: dict[str, list] = {c: [] for c in ["digest", *carried]}
        key = None

        def row() -> dict:
            log = appended(own["digest"], key[1])
            made = {group: key[0], "chunk": key[1], "leaves": len(own["digest"]), "log": "".join(log), "top": log[-1]}
            return made | {c: list(own[c]) for c in carried}

        for batch in batches:
            out: list[dict] = []
            columns = [batch.column(c).to_pylist() for c in own]
            for *now, values in zip(batch.column(group).to_pylist(), batch.column("chunk").to_pylist(), zip(*columns)):
                if now != key:
                    if key is not None:
                        out.append(row())
                    key = now
                    for v in own.values():
                        v.clear()
                for v, x in zip(own.values(), values):
                    v.append(x)
            yield {f.name: [r[f.name] for r in out] for f in schema.fields}
        if key is not None:
            yield {name: [value] for name, value in row().items()}

    return cut(map_stream(dealt.select(*dict.fromkeys([group, "chunk", "digest", *carried])), schema, of), "built")


def forest(nodes: DataFrame, group: str) -> DataFrame:
    """`group`, index, path, root of nodes (`group`, index, digest): the tree of each group, built round by round
    until no group has more than one builder.  A round has a 256th of the rows of the one before."""
    chunks = built(nodes, group, [])
    more = chunks.where("chunk > 0").limit(1).count()
    schema = StructType(
        nodes.select(group, "index").schema.fields + StructType.fromDDL(f"path {_PATH}, root string").fields
    )
    if more:
        above = forest(chunks.select(group, F.col("chunk").alias("index"), F.col("top").alias("digest")), group)
        above = above.select(F.col(group).alias("_group"), F.col("index").alias("_index"), "path", "root")
        source = chunks.join(above, F.col(group).eqNullSafe(F.col("_group")) & (F.col("chunk") == F.col("_index")))
        source = source.select(group, "chunk", "leaves", "log", "path", "root")
    else:
        source = chunks.select(group, "chunk", "leaves", "log", F.array().cast(_PATH).alias("path"), F.col("top").alias("root"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["leaves"]
                levels = runs(r["log"], r["chunk"], n)
                steps = [[{"place": p, "siblings": s} for p, s in path(levels, i)] + r["path"] for i in range(n)]
                yield {
                    group: [r[group]] * n, "index": [r["chunk"] * ALIGNED + i for i in range(n)], "path": steps, "root": [r["root"]] * n,
                }

    return cut(map_stream(source, schema, of), "forest")


def manifest(rows: DataFrame, group: str, order: str, digest: str = "digest") -> DataFrame:
    """One row for each builder of the first round: `group`, chunk, leaves, log, `keys` (values of `order`), `digests`,
    the other columns as arrays, path (from its top to the root of all), subroot, root.

    Rows of a group ascend by `order` (null first), rows of equal order by digest; groups ascend, null first.
    An empty table gives no row.  Column names with an underscore in front are the operator's own.
    """
    named = rows.withColumnRenamed(digest, "digest")
    carried = [c for c in named.columns if c != group]
    chunks = built(numbered(named, group, [order, "digest"]), group, carried)
    tops = forest(chunks.select(group, F.col("chunk").alias("index"), F.col("top").alias("digest")), group)
    # one row a group, numbered as the leaves of one tree
    roots = tops.where("index = 0").select(F.col(group).alias("_name"), F.col("root").alias("digest"), F.lit(0).alias("_all"))
    ranked = cut(numbered(roots, "_all", ["_name"]), "roots")
    crown = forest(ranked.select("_all", "index", "digest"), "_all").select(
        F.col("index").alias("_rank"), F.col("path").alias("_crown"), F.col("root").alias("_root")
    )
    crown = crown.join(ranked.select(F.col("index").alias("_rank"), "_name"), "_rank").drop("_rank")
    above = tops.join(crown, F.col(group).eqNullSafe(F.col("_name"))).select(
        F.col(group).alias("_group"), F.col("index").alias("_index"), F.concat("path", "_crown").alias("path"),
        F.col("root").alias("subroot"), F.col("_root").alias("root"),
    )
    above = cut(above, "above")
    on = F.col(group).eqNullSafe(F.col("_group")) & (F.col("chunk") == F.col("_index"))
    return chunks.join(above, on).drop("_group", "_index")


def proofs(chunks: DataFrame, key: str, tried: str) -> DataFrame:
    """`key`, leaf, subroot, root, proof_sha256, folded_root, verified for each leaf of a `manifest`.

    folded_root is what the digest in `tried` and the siblings of the leaf give; verified is whether that is the root.
    """
    kind = chunks.schema[key].dataType.elementType.simpleString()
    schema = StructType.fromDDL(
        f"`{key}` {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for r in batch.to_pylist():
                n = r["leaves"]
                levels = runs(r["log"], r["chunk"], n)
                above = [(s["place"], s["siblings"]) for s in r["path"]]
                steps = [path(levels, i) + above for i in range(n)]
                roots = [folded(d, s) for d, s in zip(r[tried], steps)]
                yield {
                    key: r[key], "leaf": r["digest"], "subroot": [r["subroot"]] * n, "root": [r["root"]] * n,
                    "proof_sha256": [_hash("".join(t for _, t in s)) for s in steps], "folded_root": roots,
                    "verified": [x == r["root"] for x in roots],
                }

    return map_stream(chunks.select(key, "chunk", "leaves", "log", "digest", tried, "path", "subroot", "root"), schema, of)


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, digest, and `tried`: the digest after tampering, which lower-cases A-Z of the text where 5
    divides the CRC-32 of the decimal doc_id.  Null ids are not tampered with; extra columns are no part of a leaf."""
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    digest = leaf_digest(columns)
    tried = F.when(hit, leaf_digest([*columns[:-1], lower])).otherwise(digest)
    return docs.select("doc_id", "source", digest.alias("digest"), tried.alias("tried"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    leaves = cut(document_leaves(table(spark, sf_dir, "documents")), "leaves")
    return proofs(manifest(leaves, "source", "doc_id"), "doc_id", "tried")
