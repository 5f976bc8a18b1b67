"""From raw documents to packed training sequences.

Five stages, each written before the next one reads it: bad texts go, of near-duplicates one stays, texts with
passages of the benchmark go, personal data is replaced, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, jaccard, packing, pii, quality
from larder.llm.common import cut, table, with_place


def _boxed(docs: DataFrame) -> DataFrame:
    """The text beside the whole row, so that no column of a table clashes with one of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"), "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of those it is given."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; texts without words are all kept."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in")
    rows = with_place(docs, [whole, F.col("doc_id"), F.col("text")])
    groups = jaccard.joined(rows, "_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_group"))
    ids = rows.select("_row", F.struct(F.col("doc_id").isNull(), "doc_id", "_row").alias("_rank"))
    first = groups.join(ids, "_row").groupBy("_group").agg(F.min("_rank").alias("_rank"))
    keep = cut(first.select(F.col("_rank._row").alias("_row")), "kept")
    # by merging at every size: what stays is not bounded
    return rows.join(keep.hint("merge"), "_row", "left_semi").select("_in.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.hits(_boxed(docs), table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("_in.*")


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token ids with their places in sequences."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

# a fitted classifier and a tokenizer are beyond SQL; tests/llm holds the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage before is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
