"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a normal distribution of the statistics.  Its covariance is shrunk towards the pooled one and both
towards a diagonal; a score is the logistic of the difference of the two log densities, from Mahalanobis distances
by Cholesky factors that are computed once.  Fitting needs only counts, sums and sums of products, which tasks
sum before they are moved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.llm.common import cut, give_back, map_arrow, small_batches, table, texts_of
from larder.llm.rules import repeated_words

THRESHOLD = 0.3
SHRINK = 0.2  # class covariance towards the pooled one
RIDGE = 0.05  # and towards its diagonal
FIT_ROWS = 200_000  # labels that the filter learns from
FEATURES = [
    "log_words", "log_word_chars", "symbols", "marked_words", "bars", "upper_words", "digits", "exclaimed",
    "repeated", "same_lines", "varied", "line_words", "stops",
]
_ASCII_MARKS = np.zeros(256, bool)
_ASCII_MARKS[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_SOFT = np.zeros(256, bool)
_SOFT[[ord(c) for c in ".,;:'\"()-?"]] = True


def statistics(text: str) -> np.ndarray:
    """The statistics of one text.  Shares enter by the arc sine of their root, counts by logarithm."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    bytes_ = np.bincount(np.frombuffer(data, "u1"), minlength=256)
    solid = max(int(bytes_.sum() - bytes_[[9, 10, 11, 12, 13, 32]].sum()), 1)
    marks = bytes_ * _ASCII_MARKS
    lines = [x for x in data.split(b"\n") if x.strip()]
    share = lambda a, b: float(np.arcsin(np.sqrt(min(a / b, 1.0))))
    marked = sum(1 for w in words if w[-1:] in b"#*$%&|<>")
    return np.array(
        [
            np.log1p(n),
            np.log(solid / n),
            share((marks * ~_SOFT).sum(), solid),
            share(marked, n),
            share(words.count(b"|"), n),
            share(sum(1 for w in words if len(w) > 1 and w.isupper()), n),
            share(bytes_[48:58].sum(), solid),
            share(bytes_[33], n),
            share(repeated_words(words), n),
            share(len(lines) - len(set(lines)), len(lines)),
            np.log1p(len(set(words))) / np.log1p(n),
            np.log1p(n / len(lines)),
            share(bytes_[46], n),
        ]
    )


def measured(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`keep` columns and `statistics` (array of double); null text is empty, with zeros."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    schema = StructType(
        docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields + StructType.fromDDL("statistics array<double>").fields
    )

    def of(batch: pa.RecordBatch) -> dict:
        return {c: batch.column(c) for c in keep} | {"statistics": [statistics(t) for t in texts_of(batch, text)]}

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]), schema, of)


@dataclass
class Discriminant:
    """Means, Cholesky factors and log priors of the classes 0 and 1; a class without rows is absent."""

    means: dict[int, np.ndarray]
    factors: dict[int, np.ndarray]
    priors: dict[int, float]

    def _forward(self, k: int, y: np.ndarray) -> np.ndarray:
        """Solve by the lower triangular factor, row by row."""
        factor, z = self.factors[k], np.empty_like(y)
        for i in range(len(y)):
            z[i] = (y[i] - factor[i, :i] @ z[:i]) / factor[i, i]
        return z

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1.  With one class known it is that class; with none, one half."""
        if len(self.means) < 2:
            return np.full(len(x), 0.5 if not self.means else float(next(iter(self.means))))
        logs = {}
        for k in (0, 1):
            z = self._forward(k, (x - self.means[k]).T)
            logs[k] = self.priors[k] - 0.5 * (z**2).sum(axis=0) - np.log(np.diag(self.factors[k])).sum()
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def fit(labelled: DataFrame, shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """Fit on all rows of (statistics, label); rows with another label than 0 or 1 are left out.

    Tasks turn their rows into one count, sum and matrix per class and batch; what is moved to the driver is two
    rows of them.
    """
    d = len(FEATURES)
    size = 1 + d + d * d

    def of(batch: pa.RecordBatch) -> dict:
        x = np.array(batch.column("statistics").to_pylist()).reshape(-1, d)
        y = np.array(batch.column("label").to_pylist())
        out: dict[str, list] = {"label": [], "place": [], "value": []}
        for k in (0, 1):
            own = x[y == k]
            if len(own):
                out["label"] += [k] * size
                out["place"] += range(size)
                out["value"] += [float(len(own)), *own.sum(axis=0), *(own.T @ own).ravel()]
        return out

    known = labelled.where(F.col("label").isin(0, 1)).select("statistics", F.col("label").cast("int").alias("label"))
    sums = map_arrow(known, "label int, place int, value double", of).groupBy("label", "place").agg(F.sum("value").alias("value"))
    moments = {k: np.zeros(size) for k in (0, 1)}
    for row in sums.collect():  # two classes of `size` numbers
        moments[row.label][row.place] = row.value
    counts = {k: m[0] for k, m in moments.items() if m[0] > 0}
    means = {k: moments[k][1 : 1 + d] / n for k, n in counts.items()}
    scatter = {k: moments[k][1 + d :].reshape(d, d) - n * np.outer(means[k], means[k]) for k, n in counts.items()}
    total = sum(counts.values())
    pooled = sum(scatter.values()) / total if total else np.eye(d)
    factors = {}
    for k, n in counts.items():
        own = max(shrink, (d + 1) / (n + d + 1))  # few rows say little about a covariance
        cov = (1 - own) * scatter[k] / n + own * pooled
        # the floor keeps statistics that a class never varies in from ruling alone
        cov = (1 - ridge) * cov + ridge * np.diag(np.diag(pooled)) + 1e-4 * np.eye(d)
        factors[k] = np.linalg.cholesky(cov)
    return Discriminant(means, factors, {k: float(np.log(n / total)) for k, n in counts.items()})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """Replace `statistics` by `score` and `predicted`."""
    keep = [c for c in rows.columns if c not in ("statistics", "score", "predicted")]
    schema = StructType(
        rows.select(*[F.col(f"`{c}`") for c in keep]).schema.fields + StructType.fromDDL("score double, predicted int").fields
    )
    d = len(FEATURES)

    def of(batch: pa.RecordBatch) -> dict:
        s = model.scores(np.array(batch.column("statistics").to_pylist()).reshape(-1, d))
        return {c: batch.column(c) for c in keep} | {"score": s, "predicted": (s >= THRESHOLD).astype("int32")}

    return map_arrow(rows.select(*[F.col(f"`{c}`") for c in [*keep, "statistics"]]), schema, of)


def training(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(statistics, label) of the labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).where("label is not null")
    return rows.where(~held_out(F.col(doc_id))).join(known, F.col(doc_id) == F.col("_id")).select("statistics", "label")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null text is empty and scored like one; a null id is not held out and has no label; repeated rows are scored
    alike, and repeated labels count as often as they stand.  Without labels every score is one half.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = cut(measured(source, keep=["doc_id"]), "statistics")
    made = scored(rows, fit(training(rows, labels)))
    return made.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with their columns as they are.

    It learns from at most `fit_rows` labels, those with the least hashes of their ids, so that only their documents
    are measured before the pass that keeps or drops.  Texts alone go to Python; the rest of a row stays in the JVM.
    """
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("label")).where("label in (0, 1)")
    known = known.where(~held_out(F.col("_id"))).orderBy(F.xxhash64("_id"), "_id", "label").limit(fit_rows)
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # an id and a number for each of `fit_rows` labels at most
    labelled = source.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("text", "label")
    model = fit(measured(labelled, keep=["label"]))

    def score(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t or "") for t in texts.to_pylist()]).reshape(-1, len(FEATURES))
        give_back()
        return pa.array(model.scores(x))

    return docs.where(F.arrow_udf(score, "double")(F.col(f"`{text}`")) >= THRESHOLD)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
