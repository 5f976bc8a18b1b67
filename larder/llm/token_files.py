"""Token ids in Parquet: sorted list columns, delta-encoded, with bounded row groups and page indexes.

A written corpus is a folder with `tokens/` (one file per shard, rows in ascending id order: doc_id, shard,
shard_start, n_tokens, tokens) and `shards/` (one row per shard: its first token).  Readers that need no tokens
read the narrow columns only; a range of ids reads the row groups and pages whose bounds meet it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.llm.common import map_arrow, new_folder, shuffles_removed, table
from larder.llm.tokens import encoder, vocabulary_path

OPTIONS = {
    # version 2 pages: integers that are no dictionary's become deltas; ids repeat little within a page
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


def write(
    docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, path: str | None = None
) -> None:
    """Write the ids of all texts, each ended by `end_id`, in ascending id order.

    Null ids come first; equal ids follow each other in the order of the input.  Null text is empty and has the
    end id alone.  An empty table writes an empty corpus.
    """
    path = path or vocabulary_path()
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("_nth")
    )
    # `_nth` splits one id that many rows share
    ordered = rows.repartitionByRange("doc_id", "_nth").sortWithinPartitions("doc_id", "_nth").drop("_nth")
    schema = f"doc_id {id_type}, shard int, shard_start long, n_tokens long, tokens array<int>"
    starts: dict[int, int] = {}

    def of(batch: pa.RecordBatch):
        context = TaskContext.get()
        shard, task = context.partitionId(), context.taskAttemptId()
        at = starts.get(task, 0)
        ids, counts = encoder(path).encode_all(batch.column("text"))
        ends = np.cumsum(counts)  # where the end id of each text goes
        sizes = counts + 1
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        firsts = at + offsets[:-1]
        starts.clear()
        starts[task] = at + int(offsets[-1])
        ids = pa.array(np.insert(ids.view("<i4"), ends, end_id))
        return {
            "doc_id": batch.column("doc_id").to_pylist(),
            "shard": np.full(len(sizes), shard, "int32"),
            "shard_start": firsts,
            "n_tokens": sizes,
            "tokens": pa.ListArray.from_arrays(pa.array(offsets.astype("int32")), ids),
        }

    with shuffles_removed(spark):
        map_arrow(ordered, schema, of).write.options(**OPTIONS).parquet(f"{folder}/tokens")
        sizes = spark.read.schema(schema).parquet(f"{folder}/tokens").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
        # one row per file
        before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
        sizes.select("shard", before.alias("first"), F.col("n").alias("n_tokens")).write.parquet(f"{folder}/shards")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, tokens; columns and id ranges are pushed down."""
    tokens = spark.read.parquet(f"{folder}/tokens")
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "first")
    # a row of two integers for each written file
    return tokens.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("first") + F.col("shard_start")).alias("start"), "n_tokens", "tokens"
    )


def checksums(corpus: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what `read` gives; n_tokens is counted from the ids."""
    id_type = corpus.schema["doc_id"].dataType.simpleString()

    def of(batch: pa.RecordBatch):
        column = batch.column("tokens")
        values = column.values.to_numpy(zero_copy_only=False).astype("<u4")
        offsets = column.offsets.to_numpy()
        return {
            "doc_id": batch.column("doc_id").to_pylist(),
            "start": batch.column("start").to_pylist(),
            "n_tokens": np.diff(offsets).astype("int64"),
            "ids_crc32": [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])],
        }

    return map_arrow(corpus.select("doc_id", "start", "tokens"), f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long", of)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, from the files that it wrote."""
    folder = new_folder(spark, "tokens")
    write(table(spark, sf_dir, "documents"), folder)
    return checksums(read(spark, folder))
