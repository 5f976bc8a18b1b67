"""Nearest vectors from an inverted file: every vector lies in the cell of its nearest centroid, cells are folders.

A search opens the cells nearest to its query and no others; what it opens is settled while the query is planned, so
the scan shows the cells as partition filters.  The exact search opens further cells until none of the closed ones
can hold a better row: a cell's radius bounds the similarity of all its rows from above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from larder.functions.embedding import dot
from larder.operators.vectors import nearest

# centroids pass through the driver and go to every task: this many, whatever the number of rows
MAX_CELLS = 4096
ROWS_PER_CELL = 4096
MIN_CELLS = 32
# the centroids are fitted on this many rows for each cell; every row is put into the index
FIT_ROWS_PER_CELL = 64
# rows and queries that meet in one task of a search for many queries
BLOCK = 2048
# similarities are compared after rounding to six digits
_ROUNDING = 1e-6


@dataclass(frozen=True)
class Cells:
    """A written index: `rows` (id, embedding, place, cell) in folders by cell; centroids, sizes and radii by cell."""

    rows: DataFrame | None
    centroids: np.ndarray
    sizes: np.ndarray
    radii: np.ndarray

    def nearest_first(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cells by distance of their centroids from a unit vector, and these distances by cell."""
        distances = np.linalg.norm(self.centroids - query, axis=1)
        return np.argsort(distances, kind="stable"), distances

    def probed(self, query: np.ndarray, k: int, probes: int) -> list[int]:
        """The cells to open: the nearest `probes`, and further ones until they hold k rows."""
        order, _ = self.nearest_first(query)
        enough = int(np.searchsorted(np.cumsum(self.sizes[order]), k)) + 1
        return [int(c) for c in order[: max(probes, enough)]]

    def reachable(self, query: np.ndarray, score: float) -> list[int]:
        """The cells that may hold a row with at least this similarity."""
        _, distances = self.nearest_first(query)
        least = np.maximum(distances - self.radii, 0)
        return [int(c) for c in np.flatnonzero(1 - least**2 / 2 + _ROUNDING >= score)]


def _norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def _usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """Rows that can be near to something: not null, without null or not finite values, of some length."""
    rows = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<float>").alias("embedding"))
    norm = _norm(F.col("embedding"))
    return rows.where(F.col("embedding").isNotNull() & (norm > 0) & (norm < float("inf")))


def _fit(rows: DataFrame, cells: int, seed: int) -> np.ndarray:
    """Centroids of the unit vectors, from the rows with the least hashes of their ids and values."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import Normalizer
    from pyspark.ml.functions import array_to_vector

    sample = rows.orderBy(F.xxhash64("id", "embedding")).limit(cells * FIT_ROWS_PER_CELL)
    made = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("vector"))
    features = Normalizer(inputCol="vector", outputCol="features").transform(made)
    model = KMeans(k=cells, seed=seed, maxIter=10, initSteps=2).fit(features)
    return np.array(model.clusterCenters())


def _nearest_cell(centroids: np.ndarray):
    """An Arrow function from vectors to their nearest cells."""
    squares = (centroids**2).sum(axis=1)

    @F.pandas_udf(IntegerType())
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            # whole blocks of distances are made, so a block is short where there are many centroids
            for at in range(0, len(batch), 512):
                units = _units(batch.iloc[at : at + 512])
                found.append(np.argmin(squares - 2 * units @ centroids.T, axis=1))
            yield pd.Series(np.concatenate(found) if found else np.zeros(0, np.int64)).astype("int32")

    return cell


def _units(vectors: pd.Series) -> np.ndarray:
    made = np.stack(vectors.to_numpy()).astype(np.float64)
    return made / np.linalg.norm(made, axis=1, keepdims=True)


def build_cells(
    vectors: DataFrame, path: str, id: str = "id", vector: str = "embedding", cells: int | None = None, seed: int = 7
) -> Cells:
    """Write the index of all vectors of one length; one cell for about 4,096 rows unless told otherwise.

    Null vectors, those of zero length and those with null or not finite values are near to nothing and stay out.
    A cell of any size is spread over tasks, since the rows are rebalanced by size and not by cell alone.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, id, vector)
    total = rows.count()
    wanted = cells or max(MIN_CELLS, math.ceil(total / ROWS_PER_CELL))
    centroids = _fit(rows, max(2, min(wanted, MAX_CELLS)), seed) if total else np.zeros((0, 0))
    cell = _nearest_cell(centroids)(F.col("embedding")) if total else F.lit(0)
    placed = rows.select("id", "embedding", cell.alias("cell")).hint("rebalance", F.col("cell"))
    placed.withColumn("place", F.monotonically_increasing_id()).write.partitionBy("cell").parquet(f"{path}/rows")
    table = StructType([StructField("cell", IntegerType()), StructField("centroid", ArrayType(DoubleType()))])
    # at most MAX_CELLS rows
    listed = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centroids)], table)
    # the squared distance of the unit vector from its centroid
    x, c = F.col("embedding"), F.col("centroid")
    apart = F.greatest(1 + dot(c, c) - 2 * dot(x, c) / _norm(x), F.lit(0.0))
    measured = (
        _rows(spark, path, rows)
        .join(F.broadcast(listed), "cell")
        .groupBy("cell")
        .agg(F.count("*").alias("size"), F.sqrt(F.max(apart)).alias("radius"))
    )
    stored = listed.join(measured, "cell", "left").select(
        "cell", "centroid", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("radius", F.lit(0.0)).alias("radius")
    )
    stored.coalesce(1).write.parquet(f"{path}/cells")
    return read_cells(spark, path, rows)


def _rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    own = [like.schema["id"], like.schema["embedding"]]
    schema = StructType([*own, StructField("place", LongType()), StructField("cell", IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/rows")


def read_cells(spark: SparkSession, path: str, like: DataFrame | None = None) -> Cells:
    """A written index; the driver reads one row for each cell, at most 4,096."""
    rows = _rows(spark, path, like) if like is not None else spark.read.parquet(f"{path}/rows")
    known = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    return Cells(
        rows,
        np.array([r["centroid"] for r in known], dtype=np.float64) if known else np.zeros((0, 0)),
        np.array([r["size"] for r in known], dtype=np.int64),
        np.array([r["radius"] for r in known], dtype=np.float64) + _ROUNDING,
    )


def search_cells(index: Cells, query: list[float], k: int, probes: int = 8, exact: bool = False) -> DataFrame:
    """The k nearest rows (id, embedding, score) of the nearest cells, best first, ties by id.

    `exact` opens all cells that may hold a row as good as the k-th of the first ones, so the result is that of a
    scan of all rows.  A query of zero length is near to nothing.
    """
    given = np.asarray(query, dtype=np.float64)
    norm = np.linalg.norm(given)
    rows = index.rows.drop("place")
    if not len(index.centroids) or not np.isfinite(norm) or norm == 0:
        return nearest(rows.where(F.lit(False)).drop("cell"), F.array(*[F.lit(float(x)) for x in query]), k)
    unit = given / norm

    def best(opened: list[int]) -> DataFrame:
        inside = rows.where(F.col("cell").isin(opened)).drop("cell")
        return nearest(inside, F.array(*[F.lit(float(x)) for x in query]), k)

    opened = index.probed(unit, k, probes)
    if not exact:
        return best(opened)
    # one row comes to the driver
    worst = best(opened).agg(F.count("*").alias("n"), F.min("score").alias("score")).first()
    bound = worst["score"] if worst["n"] >= k else -2.0
    return best(sorted(set(opened) | set(index.reachable(unit, bound))))


def search_many(index: Cells, queries: DataFrame, k: int, probes: int = 8, block: int = BLOCK) -> DataFrame:
    """For each query (query, embedding; queries are unique) the k nearest rows: query, id, score, rank.

    Queries and rows of a cell meet in blocks of about `block` each, as many as the cell needs, and each block passes
    on k rows of a query.  Queries without direction, or an empty index, find nothing.
    """
    out = StructType([queries.schema["query"], index.rows.schema["id"], StructField("score", DoubleType())])
    spark = queries.sparkSession
    if not len(index.centroids):
        return spark.createDataFrame([], StructType([*out, StructField("rank", IntegerType())]))
    usable = _usable(queries, "query", "embedding").withColumnRenamed("id", "query")
    known = replace(index, rows=None)  # what goes to the tasks: one row for each cell

    @F.pandas_udf(ArrayType(IntegerType()))
    def opened(vectors: pd.Series) -> pd.Series:
        return pd.Series([known.probed(unit, k, probes) for unit in _units(vectors)] if len(vectors) else [], dtype=object)

    asked = usable.withColumn("cell", F.explode(opened("embedding")))
    # one row for each cell, at most MAX_CELLS
    sizes = spark.createDataFrame(
        [(i, max(1, math.ceil(int(n) / block))) for i, n in enumerate(index.sizes)], "cell int, slices int"
    )
    load = asked.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    grid = F.broadcast(sizes.join(F.broadcast(load), "cell"))
    left = (
        index.rows.join(grid, "cell")
        .withColumn("slice", F.pmod("place", "slices"))
        .select("id", "embedding", "cell", "slice", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    )
    right = (
        asked.join(grid, "cell")
        .withColumn("block", F.pmod(F.xxhash64("query"), "blocks").cast("int"))
        .select("query", "embedding", "cell", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices").cast("long") - 1)).alias("slice"))
    )

    def meet(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or wanted.empty:
            return pd.DataFrame({"query": [], "id": [], "score": []})
        rows = rows.sort_values("id", kind="stable")
        similar = np.round(_units(wanted["embedding"]) @ _units(rows["embedding"]).T, 6)
        # a stable order keeps ties by id
        best = np.argsort(-similar, axis=1, kind="stable")[:, :k]
        ids, asking = rows["id"].to_numpy(), wanted["query"].to_numpy()
        return pd.DataFrame({
            "query": np.repeat(asking, best.shape[1]),
            "id": ids[best.ravel()],
            "score": np.take_along_axis(similar, best, axis=1).ravel(),
        })

    keys = ["cell", "slice", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, out)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


__all__ = ["Cells", "build_cells", "read_cells", "search_cells", "search_many"]
