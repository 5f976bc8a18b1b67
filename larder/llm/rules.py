"""Quality rules of each text, and of the host it comes from.

Hosts are judged by the share of their documents that fail the rules, shrunk towards all hosts' share by a beta
prior that is fitted to the hosts themselves; the verdict goes back to the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.llm.common import cut, map_arrow, table, texts_of

MIN_WORDS = 10
MAX_REPEATED = 20  # percent
WINDOW = 5
MAX_HOST_RATE = 0.5
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[str] | list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, the first occurrence included."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    # ranks of longer and longer windows, exact: a window is a pair (all but its last word, its last word)
    rank = ids
    for size in range(2, window + 1):
        pairs = rank[: n - size + 1] * len(numbers) + ids[size - 1 :]
        rank = np.unique(pairs, return_inverse=True)[1]
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    edges[: len(twice)] += twice
    edges[window : window + len(twice)] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum())


def measured(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.  Words end at ASCII white space."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: the same six ASCII characters as [\\x20\\t-\\r]
    chars = sum(map(len, words)) - sum(np.bincount(np.frombuffer(data, "u1"), minlength=256)[128:192]) if data else 0
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.split(None, 1)]
    return len(words), int(chars), symbols, len(lines) - len(set(lines)), repeated_words(words)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the five measures and `base_failed`; null text is empty.  Other columns pass through."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    keep = [c for c in docs.columns if c not in [*names, "base_failed"]]
    source = docs.select(*[F.col(f"`{c}`") for c in keep])
    carried = [c for c in keep if c != text]  # the text itself is not sent back
    schema = StructType(
        source.select(*[F.col(f"`{c}`") for c in carried]).schema.fields
        + StructType.fromDDL(", ".join(f"{n} long" for n in names) + ", base_failed boolean").fields
    )

    def of(batch: pa.RecordBatch) -> dict:
        rows = [measured(t) for t in texts_of(batch, text)]
        columns = {c: batch.column(c) for c in carried} | {n: [r[i] for r in rows] for i, n in enumerate(names)}
        return columns | {"base_failed": [r[0] < MIN_WORDS or 100 * r[4] > MAX_REPEATED * r[0] for r in rows]}

    return map_arrow(source, schema, of)


def host_rates(judged: DataFrame, host: str = "host", failed: str = "base_failed") -> DataFrame:
    """host, documents, failures, rate: each host's share of failures under an empirical beta prior.

    The prior's mean and strength come from the mean and variance of the hosts' own shares (method of moments,
    binomial noise taken out).  Hosts without documents do not exist; a null host is no host and is left out.
    Tasks send one row per host, so a host with a third of all rows is one more count.
    """
    per_host = (
        judged.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col(failed).cast("long")).alias("failures"))
    )
    share = F.col("failures") / F.col("documents")
    moments = per_host.agg(
        (F.sum("failures") / F.sum("documents")).alias("mean"),
        F.var_pop(share).alias("spread"),
        F.avg(1 / F.col("documents")).alias("thin"),
    )
    mean, spread, thin = moments.first()  # one row
    if mean is None:
        mean, strength = 0.0, 1.0
    else:
        between = max(spread - mean * (1 - mean) * thin, 1e-6)
        # a + b of the beta: at least one document's worth, at most what a million documents would say
        strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6)
    rate = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return per_host.select("host", "documents", "failures", rate.alias("rate"))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host, the measures, base_failed, host_rate, kept.

    Kept are documents that pass the base rules and whose host's shrunk failure rate is at most one half.  A null
    host is not judged (host_rate null).  Null text has no words and fails.  Each row is judged for itself.
    """
    judged = cut(
        measures(
            docs.select(
                F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{host}`").cast("string").alias("host")
            ),
        ),
        "measures",
    )
    rates = cut(host_rates(judged).select("host", "rate"), "host-rates")
    # plain scans on both sides: a host with very many documents can be split between tasks
    return judged.join(rates, "host", "left").withColumn("host_rate", F.col("rate")).withColumn(
        "kept", ~F.col("base_failed") & (F.coalesce("rate", F.lit(0.0)) <= MAX_HOST_RATE)
    ).drop("rate")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host_rate."""
    return verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("host_rate", 6).alias("host_rate"),
    )
