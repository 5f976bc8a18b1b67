"""Ranked text search: BM25 per field, best field or tie-broken sum, filters, paging, highlights.

A query over documents is two passes of narrow work: one aggregation that yields a single row of corpus
statistics for the query words, and one that scores every document within its row and keeps the top k.
Nothing is exploded and no posting list is shuffled.  For many queries over one corpus, `build_index`
writes postings once, and `search_index` reads only the postings of the query words.

Scores follow Robertson and Zaragoza (2009) with k1 = 1.2 and b = 0.75.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.analysis import porter_stem, stem_words, tokens, word_counts
from larder.functions.staging import once
from larder.functions.text import let
from larder.lexicon import STOP_WORDS
from larder.operators.ingredients import query_words, within_edits

K1, B = 1.2, 0.75

DEFAULT_BOOSTS = {"title": 3.0, "description": 2.0, "ingredients": 2.0, "instructions": 1.0}
TEXT_BOOSTS = {"title": 2.0, "description": 1.0, "instructions": 1.0}
ANY_FIELD_BOOSTS = {"title": 5.0, "description": 2.0, "cuisine_type": 3.0, "ingredients": 1.0}


def query_terms(text: str) -> list[str]:
    return [w for w in query_words(text) if w not in STOP_WORDS]


def exact(word: str) -> Callable[[Column], Column]:
    return lambda t: t == word


def fuzzy(word: str, prefix: int = 0) -> Callable[[Column], Column]:
    """Any word within the allowed edits counts as the query word."""
    return lambda t: within_edits(t, word, prefix)


def idf(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def bm25(tf: Column, length: Column, average: Column) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average))


def _some(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _counted(docs: DataFrame, fields: list[str], terms: list[str], match, stem: bool) -> DataFrame:
    """Per document and field a small struct: number of words, and frequency of every query term.

    One pass over the words keeps the few that can count; the terms are told apart on those.
    """
    if stem:
        # words that do not begin like a query stem cannot have it: they never leave the JVM
        starts = [porter_stem(t)[:-1] for t in terms]
        near = lambda words: stem_words(F.filter(words, lambda w: _some([w.startswith(s) for s in starts])))
        tests = [exact(porter_stem(t)) for t in terms]
    else:
        tests = [match(t) for t in terms]
        near = lambda words: F.filter(words, lambda w: _some([test(w) for test in tests]))

    split = once(docs, **{f"_w_{f}": tokens(F.col(f)) for f in fields})
    close = once(
        split,
        **{f"_l_{f}": F.size(f"_w_{f}").cast("double") for f in fields},
        **{f"_n_{f}": near(F.col(f"_w_{f}")) for f in fields},
    )
    counts = {
        f"_f_{f}": F.struct(
            F.col(f"_l_{f}").alias("length"),
            *[F.size(F.filter(f"_n_{f}", test)).cast("double").alias(f"tf{i}") for i, test in enumerate(tests)],
        )
        for f in fields
    }
    return once(close, **counts).drop(*[f"{x}{f}" for x in ("_w_", "_l_", "_n_") for f in fields])


def _statistics(counted: DataFrame, fields: list[str], n_terms: int) -> Column:
    """Documents and average length per field and document frequency per term: one row, as a subquery."""
    values = []
    for f in fields:
        length = F.col(f"_f_{f}.length")
        values.append(F.count_if(length > 0).cast("double").alias(f"n_{f}"))
        values.append(F.coalesce(F.sum(length) / F.nullif(F.count_if(length > 0), F.lit(0)), F.lit(1.0)).alias(f"avg_{f}"))
        values += [F.count_if(F.col(f"_f_{f}.tf{i}") > 0).cast("double").alias(f"df_{f}_{i}") for i in range(n_terms)]
    row = counted.agg(*values)
    return row.select(F.struct(*row.columns).alias("s")).scalar()


def scored(
    docs: DataFrame,
    text: str,
    boosts: dict[str, float],
    match: Callable[[str], Callable[[Column], Column]] = exact,
    stem: bool = False,
    where: Column | None = None,
    all_terms: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Matching documents with `_p`, per field an array of (term, tf, df, idf, score).

    Statistics cover the whole corpus; `where` only restricts the documents that are scored.
    With `all_terms`, every query word must occur in some field.
    """
    fields, terms = list(boosts), query_terms(text)
    stats = _statistics(_counted(docs, fields, terms, match, stem), fields, len(terms))
    source = docs if where is None else docs.where(where)
    counted = _counted(source, fields, terms, match, stem)
    present = [
        reduce(lambda a, b: a | b, [F.col(f"_f_{f}.tf{i}") > 0 for f in fields]) for i in range(len(terms))
    ]
    hit = reduce((lambda a, b: a & b) if all_terms else (lambda a, b: a | b), present)

    def part(f: str, i: int) -> Column:
        tf, df, n = F.col(f"_f_{f}.tf{i}"), F.col("_stats")[f"df_{f}_{i}"], F.col("_stats")[f"n_{f}"]
        score = idf(n, df) * bm25(tf, F.col(f"_f_{f}.length"), F.col("_stats")[f"avg_{f}"])
        return F.struct(
            F.lit(f).alias("field"), F.lit(terms[i]).alias("term"), tf.alias("tf"), df.alias("df"),
            idf(n, df).alias("idf"), F.when(tf > 0, score).otherwise(0.0).alias("score"),
        )

    matched = counted.where(hit).withColumn("_stats", stats)
    parts = F.array(*[F.array(*[part(f, i) for i in range(len(terms))]) for f in fields])
    return once(matched, _p=parts).drop("_stats", *[f"_f_{f}" for f in fields]), fields


def total_score(fields: list[str], boosts: dict[str, float], tie_breaker: float = 0.0) -> Column:
    """Best boosted field, plus the tie breaker's share of the other fields; rounded so that ties are ties."""
    sums = [
        F.aggregate(F.get("_p", F.lit(i)), F.lit(0.0), lambda acc, x: acc + x["score"]) * boosts[f]
        for i, f in enumerate(fields)
    ]
    combined = let(
        F.array(*sums),
        lambda s: F.array_max(s)
        + tie_breaker * (F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x) - F.array_max(s)),
    )
    return F.round(combined, 6)


def search(
    docs: DataFrame,
    text: str,
    boosts: dict[str, float] | None = None,
    id: str = "id",
    tie_breaker: float = 0.0,
    size: int = 10,
    start: int = 0,
    **options,
) -> DataFrame:
    """One page of ranked hits."""
    hits = search_all(docs, text, boosts, tie_breaker, **options).orderBy(F.desc("score"), id)
    return hits.offset(start).limit(size) if start else hits.limit(size)


def search_all(
    docs: DataFrame, text: str, boosts: dict[str, float] | None = None, tie_breaker: float = 0.0, **options
) -> DataFrame:
    """All hits with their score, in no order."""
    boosts = DEFAULT_BOOSTS if boosts is None else boosts
    matched, fields = scored(docs, text, boosts, **options)
    return matched.withColumn("score", total_score(fields, boosts, tie_breaker)).drop("_p")


def total_hits(docs: DataFrame, text: str, boosts: dict[str, float] | None = None, **options) -> DataFrame:
    return search_all(docs, text, boosts, **options).agg(F.count("*").alias("total"))


def explain_scores(docs: DataFrame, text: str, boosts: dict[str, float], id: str = "id", **options) -> DataFrame:
    """Contribution of every (document, field, term)."""
    matched, _ = scored(docs, text, boosts, **options)
    return (
        matched.select(id, F.explode(F.flatten("_p")).alias("p"))
        .where("p.tf > 0")
        .select(id, "p.field", "p.term", "p.tf", "p.df", F.round("p.idf", 6).alias("idf"), F.round("p.score", 6).alias("score"))
    )


def highlight(text: Column, query: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Mark the query words where they occur as whole words."""
    words = "|".join(re.escape(w) for w in sorted(query_terms(query), key=len, reverse=True))
    pattern = r"(?iu)(?<![\p{L}\p{N}])(" + words + r")(?![\p{L}\p{N}])"
    return F.regexp_replace(text, pattern, f"{before}$1{after}")


# --- index --------------------------------------------------------------------------------------------------
def build_index(docs: DataFrame, fields: list[str], id: str = "id", cut: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, DataFrame]:
    """Postings (field, term, id, tf, length), document frequencies, and field statistics.

    Words are counted in their row, so no word is moved, but rows of the same id and length count as one document.
    Frequencies and statistics come from the postings; `cut` may write these, so that texts are split into words once.
    """
    repeated = cut(docs.groupBy(id).agg(F.count("*").alias("rows")).where("rows > 1").select(F.col(id).alias("_repeated")))
    same = F.col(id).eqNullSafe(F.col("_repeated"))
    merged = _listed(docs.join(repeated, same, "left_semi"), fields, id).groupBy("field", "term", id, "length").agg(F.sum("tf").alias("tf"))
    postings = cut(_listed(docs.join(repeated, same, "left_anti"), fields, id).unionByName(merged))
    # all words of the texts of one length: as often that length as there are texts
    lengths = postings.groupBy("field", "length").agg(F.sum("tf").alias("words"))
    return {
        "postings": postings,
        "terms": postings.groupBy("field", "term").agg(F.count("*").alias("df")),
        "fields": lengths.groupBy("field").agg(F.sum((F.col("words") / F.col("length")).cast("long")).alias("n"), F.sum("words").alias("words")).select(
            "field", "n", (F.col("words") / F.col("n")).alias("average")
        ),
    }


def _listed(docs: DataFrame, fields: list[str], id: str) -> DataFrame:
    """(field, term, id, length, tf) of every row and distinct word."""
    split = once(docs.select(id, *fields), **{f"_w_{f}": tokens(F.col(f)) for f in fields})
    per_field = F.explode(
        F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_w_{f}").alias("words")) for f in fields])
    )
    counted = F.inline(word_counts(F.col("x.words")))
    listed = split.select(id, per_field.alias("x")).select("x.field", id, F.size("x.words").alias("length"), counted)
    return listed.select("field", "term", id, "length", F.col("tf").cast("long").alias("tf"))


def write_index(index: dict[str, DataFrame], path: str, buckets: int = 64, slices: int = 8) -> None:
    """Write the index, postings in folders by term bucket; a common term's postings go to several files."""
    bucketed = index["postings"].withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    rest = [c for c in index["postings"].columns if c not in ("field", "term")]
    slice_of = F.pmod(F.xxhash64(*rest), F.lit(slices))
    bucketed.repartition("bucket", slice_of).sortWithinPartitions("term").write.partitionBy("bucket").mode(
        "overwrite"
    ).parquet(f"{path}/postings")
    for name in ("terms", "fields"):
        index[name].write.mode("overwrite").parquet(f"{path}/{name}")
    # the layout travels with the index: readers have to look where the writer put a word
    index["fields"].sparkSession.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}/layout")


def read_index(spark, path: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("postings", "terms", "fields", "layout")}


def search_index(
    index: dict[str, DataFrame],
    text: str,
    boosts: dict[str, float],
    id: str = "id",
    tie_breaker: float = 0.0,
) -> DataFrame:
    """Scores of all matching documents from the postings of the query words only."""
    terms, fields = query_terms(text), list(boosts)
    wanted = F.col("term").isin(terms) & F.col("field").isin(fields)
    postings = index["postings"].where(wanted)
    if "bucket" in postings.columns:
        # a constant expression per word, so whole folders are pruned
        buckets = index["layout"].first()["buckets"]
        postings = postings.where(
            F.col("bucket").isin([F.pmod(F.xxhash64(F.lit(t)), F.lit(buckets)).cast("int") for t in terms])
        )
    # at most one row per query word and field
    stats = F.broadcast(index["terms"].where(wanted).join(F.broadcast(index["fields"]), "field"))
    score = idf(F.col("n"), F.col("df")) * bm25(F.col("tf"), F.col("length"), F.col("average"))
    boost = F.element_at(F.create_map(*[F.lit(x) for f in fields for x in (f, float(boosts[f]))]), F.col("field"))
    per_field = postings.join(stats, ["field", "term"]).groupBy(id, "field").agg((F.sum(score) * F.first(boost)).alias("s"))
    best = per_field.groupBy(id).agg(F.max("s").alias("m"), F.sum("s").alias("t"))
    return best.select(id, F.round(F.col("m") + tie_breaker * (F.col("t") - F.col("m")), 6).alias("score"))


# --- more like this -----------------------------------------------------------------------------------------
def typical_terms(docs: DataFrame, field: str, doc: Column, max_terms: int = 12, min_tf: int = 1) -> DataFrame:
    """The words of one document with the highest tf * idf over the corpus."""
    own = docs.where(doc).select(F.explode(tokens(F.col(field))).alias("term"))
    counts = own.groupBy("term").agg(F.count("*").alias("tf")).where(F.col("tf") >= min_tf)
    vocabulary = counts.agg(F.collect_list("term").alias("t")).scalar()  # words of a single document
    words = once(docs.select(field), _w=F.array_distinct(tokens(F.col(field))))
    common = words.select(F.explode(F.array_intersect("_w", vocabulary)).alias("term"))
    df = common.groupBy("term").agg(F.count("*").alias("df"))
    n = words.where(F.size("_w") > 0).select(F.count("*").cast("double").alias("n")).scalar()
    weight = F.col("tf") * (1 + F.log(n / (F.col("df") + 1)))
    return (
        counts.join(df, "term")
        .select("term", "tf", "df", F.round(weight, 6).alias("weight"))
        .orderBy(F.desc("weight"), "term")
        .limit(max_terms)
    )


def more_like_this(
    docs: DataFrame, field: str, doc: Column, size: int = 10, id: str = "id", max_terms: int = 12
) -> DataFrame:
    """Other documents ranked by the typical words of one document."""
    terms = [r["term"] for r in typical_terms(docs, field, doc, max_terms).select("term").collect()]  # max_terms rows
    if not terms:
        return docs.where(F.lit(False)).withColumn("score", F.lit(0.0))
    return search(docs, " ".join(terms), {field: 1.0}, id, size=size, where=~doc)
