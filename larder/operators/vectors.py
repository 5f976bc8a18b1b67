"""Vector operators: backfill, nearest neighbours (exact and approximate), hybrid ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.embedding import HashingEncoder, cosine, dot, embed, embedding_text, scalar_products
from larder.functions.staging import once
from larder.operators.documents import sync_documents


def backfill(
    texts: DataFrame, stored: DataFrame, encoder: Callable[[], object] = HashingEncoder, text: str = "text"
) -> DataFrame:
    """Embeddings of all texts (id, text): stored ones are kept while the text is unchanged.

    `stored` has (id, text_hash, embedding).  Only new and changed texts reach the encoder.
    """
    current = texts.withColumn("text_hash", F.xxhash64(text))
    kept = current.join(stored.select("id", "text_hash", "embedding"), ["id", "text_hash"])
    missing = current.join(stored.select("id", "text_hash"), ["id", "text_hash"], "left_anti")
    columns = ["id", text, "text_hash", "embedding"]
    return (
        kept.select(*columns, F.lit("kept").alias("state"))
        .unionByName(embed(missing, text, encoder).select(*columns, F.lit("encoded").alias("state")))
    )


def document_text(documents: DataFrame) -> DataFrame:
    """(id, text) of nested documents: what their vectors are made of."""
    names = F.transform("ingredients", lambda i: i["name"])
    return documents.select("id", embedding_text(F.col("title"), names).alias("text"))


def sync_with_vectors(
    stored: DataFrame, changed: DataFrame, vectors: DataFrame, encoder: Callable[[], object] = HashingEncoder
) -> tuple[DataFrame, DataFrame]:
    """Incremental sync of documents that carry their vectors: the documents, and the table of vectors to store.

    A vector stays while title and ingredient names give the same text; new and changed texts are encoded, and
    vectors of documents that vanished go.  `vectors` has (id, text_hash, embedding) of an earlier sync.  The second
    result adds `state`, which is kept or encoded.
    """
    documents = sync_documents(stored.drop("embedding"), changed.drop("embedding"))
    made = backfill(document_text(documents), vectors, encoder).select("id", "text_hash", "embedding", "state")
    return documents.join(made.select("id", "embedding"), "id", "left"), made


def nearest(
    vectors: DataFrame, query: Column | list[float], k: int, id: str = "id", vector: str = "embedding", score: str = "score"
) -> DataFrame:
    """Exact top k by cosine.  `query` is one constant vector (numbers, a literal or a one-row subquery), so every
    task scores its own rows and passes on k of them."""
    if isinstance(query, Column):
        # Arrow functions take no subquery: it has to be a column before
        vectors, query = once(vectors, _query=query), F.col("_query")
    scored = vectors.withColumn("_products", scalar_products(F.col(vector), query)).withColumn(score, F.round(cosine(F.col("_products")), 6))
    # rows without a vector go after the limit: a condition before it would have texts encoded a second time
    best = scored.orderBy(F.desc(score), F.col("_products").isNull(), id).limit(k)
    return best.where(F.col("_products").isNotNull()).drop("_products", "_query")


def nearest_to(vectors: DataFrame, own: Column, k: int, id: str = "id", vector: str = "embedding") -> DataFrame:
    """The k rows most similar to a stored one, without itself."""
    query = vectors.where(own).select(vector).scalar()
    return nearest(vectors.where(~own), query, k, id, vector)


def encode_query(vectors: DataFrame, text: str, encoder: Callable[[], object] = HashingEncoder) -> list[float]:
    """The vector of a query text, which comes to the driver; it goes through the same encoder as the stored texts."""
    row = vectors.sparkSession.range(0, 1, 1, 1).select(F.lit(text).alias("_text"))
    return embed(row, "_text", encoder).first()["embedding"]


def semantic_search(
    vectors: DataFrame, text: str, k: int, encoder: Callable[[], object] = HashingEncoder, id: str = "id", vector: str = "embedding"
) -> DataFrame:
    """Exact top k for a query text."""
    return nearest(vectors, encode_query(vectors, text, encoder), k, id, vector)


def hybrid_search(
    text_hits: DataFrame, vectors: DataFrame, text: str, size: int, k: int = 50, weight: float = 0.5,
    encoder: Callable[[], object] = HashingEncoder, id: str = "id",
) -> DataFrame:
    """Ranked text hits (id, score) of a query text together with the k nearest vectors of the same text."""
    return hybrid(text_hits, semantic_search(vectors, text, k, encoder, id), size, weight, id)


def fit_hash_tables(vectors: DataFrame, bucket_length: float = 0.5, tables: int = 8, vector: str = "embedding"):
    """Locality-sensitive hash tables for `nearest_approx`, fitted once for a set of unit vectors."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    features = vectors.withColumn("_features", array_to_vector(F.col(vector).cast("array<double>")))
    model = BucketedRandomProjectionLSH(
        inputCol="_features", outputCol="_hashes", bucketLength=bucket_length, numHashTables=tables, seed=7
    ).fit(features)
    return model, model.transform(features)


def nearest_approx(
    model, hashed: DataFrame, query: list[float], k: int, id: str = "id", candidates: int = 100, vector: str = "embedding"
) -> DataFrame:
    """Approximate top k: candidates from the hash tables, ranked again by exact cosine."""
    from pyspark.ml.linalg import Vectors

    near = model.approxNearestNeighbors(hashed, Vectors.dense(query), candidates)
    return nearest(near, F.array(*[F.lit(float(x)) for x in query]), k, id, vector).drop(
        "_features", "_hashes", "distCol"
    )


def vector_score(similarity: Column) -> Column:
    """Cosine mapped to 0..1, as used in hybrid ranking."""
    return (1 + similarity) / 2


def hybrid(
    text_hits: DataFrame, neighbours: DataFrame, size: int, weight: float = 0.5, id: str = "id"
) -> DataFrame:
    """Text score plus weighted vector score; documents that only one side found take part too.

    `neighbours` are the k nearest (at most k rows); text hits without a neighbour keep their text score.
    """
    text = text_hits.select(id, F.col("score").alias("text_score"))
    near = neighbours.select(id, vector_score(F.col("score")).alias("near_score"))
    total = F.coalesce("text_score", F.lit(0.0)) + weight * F.coalesce("near_score", F.lit(0.0))
    return (
        text.join(near, id, "full_outer")
        .select(id, F.round(total, 6).alias("score"))
        .orderBy(F.desc("score"), id)
        .limit(size)
    )


__all__ = [
    "backfill", "document_text", "dot", "encode_query", "fit_hash_tables", "hybrid", "hybrid_search", "nearest", "nearest_approx",
    "nearest_to", "semantic_search", "sync_with_vectors", "vector_score",
]
