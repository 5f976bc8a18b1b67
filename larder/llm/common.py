"""Helpers shared by the operators: written cuts, stable row numbers, Arrow mapping."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larder.session import shared_folder

# texts are long: few of them in a batch keep workers small
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared folder."""
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, a finished write gives its shuffle files back at once.

    Right only for writes: a frame that is executed again makes its shuffles anew.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write `df` to the shared folder and read it back; lost executors then only cost the tasks they ran."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame, row: str = "_row") -> DataFrame:
    """Number the rows, so that rows with equal or null ids stay apart.  Only stable once written."""
    return df.withColumn(row, F.monotonically_increasing_id())


def with_place(df: DataFrame, columns: list[Column], row: str = "_row") -> DataFrame:
    """Some columns, and what tells rows apart on every scan: of a table read from files the (hashed) file and the
    place in it; any other frame is written with a number for each row."""
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("nth"))
    try:
        return df.select(*columns, place.alias(row))
    except AnalysisException:  # not a plain scan, or it has a column of that name
        return cut(with_row(df.select(*columns), row), "numbered")


def give_back() -> None:
    """Return memory that is free but kept by the allocators; idle workers stay small beside busy ones."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session hold at most 1,000 rows and about 4 MB."""
    for key, value in _BATCH.items():
        spark.conf.set(key, value)


def map_stream(
    df: DataFrame, schema: StructType | str, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]
) -> DataFrame:
    """`mapInArrow` with a function from the batches of a task to dicts of columns; workers give freed memory back.

    Batches are small (a session setting that is made here).
    """
    small_batches(df.sparkSession)
    spark_schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    target = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=target)
            del columns
            give_back()

    return df.mapInArrow(run, spark_schema)


def map_arrow(
    df: DataFrame, schema: StructType | str, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict]
) -> DataFrame:
    """`map_stream` with a function that turns one batch into one or several dicts of columns."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            made = fn(batch)
            del batch
            yield from [made] if isinstance(made, dict) else made
            del made

    return map_stream(df, schema, of)


def map_groups(
    df: DataFrame, by: list[str], schema: str, fn: Callable[[pa.Table], pa.Table]
) -> DataFrame:
    """`applyInArrow` by group; workers give freed memory back after each."""

    def run(group: pa.Table) -> pa.Table:
        made = fn(group)
        del group
        give_back()
        return made

    return df.groupBy(*by).applyInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is empty."""
    return [t if t is not None else "" for t in batch.column(name).to_pylist()]
