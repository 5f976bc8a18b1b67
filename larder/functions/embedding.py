"""Embedding columns: text to encode, batch encoding with any encoder, vector text, similarity."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField, StructType

DIMS = 384


def embedding_text(title: Column, names: Column) -> Column:
    """`title. first, second, ...`; the title alone when there are no ingredients."""
    return F.concat_ws(". ", title, F.nullif(F.array_join(names, ", "), F.lit("")))


class HashingEncoder:
    """Signed feature hashing of words, scaled to unit length: needs no model file."""

    # words whose places are kept between calls
    KNOWN = 1 << 17

    def __init__(self, dims: int = DIMS):
        self.dims = dims
        self._places: dict[str, int] = {}

    def _place(self, word: str) -> int:
        """Where a word counts; those that count down come after those that count up."""
        import xxhash

        h = xxhash.xxh64_intdigest(word)
        if len(self._places) >= self.KNOWN:
            self._places.clear()
        place = self._places[word] = h % self.dims + (0 if h >> 63 else self.dims)
        return place

    def encode(self, texts: list[str]) -> np.ndarray:
        known, at = self._places.get, []
        for first, text in zip(range(0, 2 * self.dims * len(texts), 2 * self.dims), texts):
            for word in re.findall(r"[^\W_]+", (text or "").lower()):
                place = known(word)
                at.append(first + (self._place(word) if place is None else place))
        counts = np.bincount(np.array(at, dtype=np.int64), minlength=2 * self.dims * len(texts)).reshape(len(texts), 2, self.dims)
        out = (counts[:, 0] - counts[:, 1]).astype(np.float32)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1, norms)


class LetterEncoder:
    """Counts of the letters a to z: an encoder whose vectors can be stated in SQL."""

    def encode(self, texts: list[str]) -> np.ndarray:
        data = [np.frombuffer((t or "").lower().encode("ascii", "ignore"), np.uint8) for t in texts]
        return np.array([np.bincount(d, minlength=128)[97:123] for d in data], dtype=np.float32).reshape(-1, 26)


def embed(
    df: DataFrame,
    text: str,
    encoder: Callable[[], object] = HashingEncoder,
    batch_size: int = 32,
    output: str = "embedding",
) -> DataFrame:
    """Encode a text column.  `encoder` is called once per task and must give an object with
    `encode(list of texts) -> 2-d array`; vectors are scaled to unit length."""

    models = []  # the function comes to each task anew, with this list empty

    # not over an iterator: what is computed from the vectors alone then runs beside it, and they need not leave Python
    @F.arrow_udf(ArrayType(FloatType()))
    def encode(column: pa.Array) -> pa.Array:
        if not models:
            models.append(encoder())
        texts, parts = column.to_pylist(), []
        for at in range(0, len(texts), batch_size):
            made = np.asarray(models[0].encode(texts[at : at + batch_size]), dtype=np.float32)
            norms = np.linalg.norm(made, axis=1, keepdims=True)
            parts.append(made / np.where(norms == 0, 1, norms))
        vectors = np.concatenate(parts) if parts else np.zeros((0, 0), np.float32)
        ends = np.arange(len(texts) + 1, dtype=np.int32) * vectors.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(vectors.ravel(), pa.float32()))

    return df.withColumn(output, encode(F.col(text)))


def parse_vector(text: Column, dims: int = DIMS) -> Column:
    """`[0.1,0.2,...]` to an array; null unless it has the expected number of values."""
    values = F.transform(F.split(F.btrim(text, F.lit("[] ")), ","), lambda v: v.try_cast("float"))
    return F.when((F.size(values) == dims) & F.forall(values, lambda v: v.isNotNull()), values)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x
    )


def cosine(products: Column) -> Column:
    """Of scalar products; null where a vector has no length."""
    return F.try_divide(products["ab"], F.sqrt(products["aa"] * products["bb"]))


_PRODUCTS = StructType([StructField(c, DoubleType()) for c in ("ab", "aa", "bb")])


def scalar_products(a: Column, b: Column | list[float]) -> Column:
    """(ab, aa, bb) of vectors; null where `a` is, and of nulls where `b` or a value is or the lengths differ.

    A vector `b` that is given as numbers goes to each task once.
    """
    if isinstance(b, Column):
        return F.arrow_udf(_products, _PRODUCTS)(a, b)
    given = np.asarray(b, dtype=np.float64)

    @F.arrow_udf(_PRODUCTS)
    def products(column: pa.Array) -> pa.Array:
        ends = pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(given), pa.int32())
        return _products(column, pa.ListArray.from_arrays(ends, pa.array(np.tile(given, len(column)), pa.float64())))

    return products(a)


def _products(a: pa.Array, b: pa.Array) -> pa.Array:
    out, known = np.zeros((3, len(a))), np.zeros(len(a), dtype=bool)
    lengths = [pc.fill_null(pc.list_value_length(x), none).to_numpy(zero_copy_only=False) for x, none in ((a, -1), (b, -2))]
    for dims in np.unique(lengths[0][lengths[0] == lengths[1]]):
        rows = np.flatnonzero((lengths[0] == dims) & (lengths[1] == dims))
        # blocks keep the doubles of a batch small
        for part in np.array_split(rows, len(rows) // 1024 + 1):
            x, y = (v.take(pa.array(part)).flatten() for v in (a, b))
            full = ~(_nulls(x, dims, part) | _nulls(y, dims, part))
            x, y = (v.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), dims) for v in (x, y))
            known[part] = full
            out[:, part] = (x * y).sum(axis=1), (x * x).sum(axis=1), (y * y).sum(axis=1)
    return pa.StructArray.from_arrays([pa.array(v, pa.float64(), mask=~known) for v in out], ["ab", "aa", "bb"], mask=a.is_null())


def _nulls(values: pa.Array, dims: int, rows: np.ndarray) -> np.ndarray:
    if not values.null_count:
        return np.zeros(len(rows), dtype=bool)
    return values.is_null().to_numpy(zero_copy_only=False).reshape(len(rows), dims).any(axis=1)
