"""Packing by minimum bin slack over counts of lengths.

Lengths lie between 1 and the capacity, so their counts are a small table however many pieces there are.  The
plan is made from the counts alone: each pattern is the fullest combination that still holds the largest length,
taken as often as the counts allow.  Pieces are then numbered within their length and find their place by number.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import cut, map_arrow, table, texts_of
from larder.llm.tokens import encoder, vocabulary_path

CAPACITY = 2048
CACHED = 200_000  # parts of texts; workers of the pipeline are small


def fullest(lengths: dict[int, int], room: int) -> list[int]:
    """The multiset of available lengths with the largest sum up to `room`, longer lengths first.

    Subset sums are the bits of an integer; a length that may be taken k times enters in powers of two.
    """
    sums, steps, goal = 1, [], 1 << room
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in lengths if x <= room and lengths[x] > 0), reverse=True):
        left, size = min(lengths[length], room // length), 1
        while left > 0:
            take = min(size, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & mask
            left -= take
            size *= 2
        if sums & goal:
            break
    best, out = sums.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            out += [length] * take
            best -= length * take
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of a bin, number of such bins), until all are packed."""
    left = {x: n for x, n in counts.items() if n > 0}
    made = []
    while left:
        largest = max(left)
        left[largest] -= 1
        bin_ = [largest, *fullest(left, capacity - largest)]
        left[largest] += 1
        need = {x: bin_.count(x) for x in set(bin_)}
        times = min(left[x] // k for x, k in need.items())
        made.append((bin_, times))
        for x, k in need.items():
            left[x] -= k * times
            if not left[x]:
                del left[x]
    return made


def places(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, list[int]]]:
    """The plan by length: (length, first, after, first_sequence, per_bin, offsets).

    Pieces of `length` numbered from `first` up to but not `after` go, `per_bin` to each bin, into the sequences
    from `first_sequence` on, at `offsets`.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for bin_, times in plan(counts, capacity):
        offsets: dict[int, list[int]] = {}
        at = 0
        for x in bin_:
            offsets.setdefault(x, []).append(at)
            at += x
        for x, slots in offsets.items():
            first = used.get(x, 0)
            used[x] = first + len(slots) * times
            rows.append((x, first, used[x], sequence, len(slots), slots))
        sequence += times
    return rows


def numbered(written: DataFrame) -> DataFrame:
    """Add `_nth`: the number of a piece, from 0, among those of its `_length`.

    One common length may be a third of all rows, so rows (with their task as `_slice` and their `_id`, written
    before) are numbered within slices and moved up by the sizes of the slices before.
    """
    sizes = written.groupBy("_length", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_length").orderBy("_slice")) - F.col("_n")
    within = Window.partitionBy("_length", "_slice").orderBy("_id")
    return (
        written.withColumn("_rank", F.row_number().over(within) - 1)
        .join(sizes.select("_length", "_slice", before.alias("_before")), ["_length", "_slice"])
        .withColumn("_nth", F.col("_before") + F.col("_rank"))
    )


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add `sequence_id` and `offset` (long): sequences of at most `capacity`, gapless from 0.

    Pieces need a length from 1 to `capacity`; null or other lengths raise.  Other columns pass through, whatever
    their names; columns of the two names are replaced.  An empty table gives none.  The driver sees one row per
    length, so `capacity` rows at most.
    """
    spark = pieces.sparkSession
    size = F.col(f"`{length}`")
    bad = size.isNull() | (size < 1) | (size > capacity)
    # the whole row in one column; a slice is the task that made it
    boxed = pieces.select(
        F.struct(*[F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]).alias("_in"),
        F.when(bad, F.raise_error(F.lit("a length is not between 1 and the capacity"))).otherwise(size).cast("int").alias("_length"),
        F.spark_partition_id().alias("_slice"),
        F.monotonically_increasing_id().alias("_id"),
    )
    written = cut(boxed, "pieces")
    counts = {r[0]: r[1] for r in written.groupBy("_length").count().collect()}
    by_length: dict[int, list] = {}
    for x, *rest in places(counts, capacity):
        by_length.setdefault(x, []).append(tuple(rest))
    plan_schema = "_length int, _plan array<struct<first:bigint,after:bigint,sequence:bigint,per_bin:int,offsets:array<int>>>"
    by_rows = spark.createDataFrame(list(by_length.items()), plan_schema)
    # at most `capacity` rows, with one entry for each pattern that uses the length: bounded by the plan
    joined = numbered(written).join(F.broadcast(by_rows), "_length")
    hit = F.get(F.filter("_plan", lambda p: (p["first"] <= F.col("_nth")) & (F.col("_nth") < p["after"])), 0)
    joined = joined.withColumn("_hit", hit)
    inner = F.col("_nth") - F.col("_hit.first")
    return joined.select(
        "_in.*",
        (F.col("_hit.sequence") + F.floor(inner / F.col("_hit.per_bin"))).cast("long").alias("sequence_id"),
        F.get(F.col("_hit.offsets"), (inner % F.col("_hit.per_bin")).cast("int")).cast("long").alias("offset"),
    )


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    capacity: int = CAPACITY,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise each text, end it with `end_id`, cut it at `capacity`: doc_id, piece, start, length, ids_crc32.

    Null text is empty: one piece with the end id alone.  Ids may be null or repeated; each row is a document.
    """
    path = path or vocabulary_path()
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    end = int(end_id).to_bytes(4, "little")

    def of(batch: pa.RecordBatch):
        encode = encoder(path, CACHED).encode
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        out: dict[str, list] = {n: [] for n in names}
        size = 0
        for key, value in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            ids = encode(value) + end
            for nth, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                row = [key, nth, at // 4, len(part) // 4, zlib.crc32(part)]
                for n, v in zip(names, row + [np.frombuffer(part, "<u4").astype("int32")] * with_ids):
                    out[n].append(v)
                size += len(part)
            if size > 8 << 20:
                yield out
                out, size = {n: [] for n in names}, 0
        yield out

    return map_arrow(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), schema, of)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(pieces(table(spark, sf_dir, "documents")))
