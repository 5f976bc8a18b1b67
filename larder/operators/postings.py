"""Ranked text search from a written index: no query reads a document.

`write` makes four tables.  `blocks` has the postings of a word and field, cut by regions of documents; a block knows
the highest score that any of its postings can give, so that regions which cannot reach the k-th score are skipped.
`terms` is the dictionary with document frequencies and stems: Python sees each distinct word once, and no document.
`neighbours` lists every word under what is left of its beginning when up to two characters are deleted, which finds
the words within two edits of a misspelt one.  `attributes` has the columns that filters may use.

All tables lie in folders by the hash of what they are looked up by, so a query opens a few of them.  Scores are those
of `search.py`: BM25 per field, best field plus a share of the others, one document frequency for all words that count
as a query word.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.analysis import porter_stem, stem_words, tokens, word_counts
from larder.functions.staging import once
from larder.operators.ingredients import allowed_edits, within_edits
from larder.operators.search import bm25, idf, query_terms

BUCKETS, SLICES = 64, 8
REGION_BITS = 10  # a region has at most 1,024 documents, and so has a block
EDITS, BEGINNING = 2, 5  # deletions, and the characters they are made in
_CLOSE = 2e-6  # scores are rounded to six digits


def _bucket(value: Column, buckets: int | Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def beginnings(word: Column) -> Column:
    """What is left of the first characters of a word after up to two deletions.

    Two words within two edits have one of these in common, also where only their beginnings are looked at.
    """
    less = lambda s: F.when(
        F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))
    ).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(F.substring(word, 1, BEGINNING)), lambda s: F.concat(F.array(s), less(s), F.flatten(F.transform(less(s), less))))[0]


def beginnings_of(word: str, edits: int, prefix: int = 0) -> list[str]:
    """The same for a query word; a prefix that has to be right leaves fewer places to delete from."""
    start = word[:BEGINNING]
    places = range(min(prefix, len(start)), len(start))
    return sorted({"".join(c for i, c in enumerate(start) if i not in gone) for k in range(edits + 1) for gone in combinations(places, k)})


# stated, so that tables without rows, and so without files, can be read
_SCHEMAS = {
    "blocks": "field string, term string, region long, size long, top double, postings array<struct<id:{id},tf:double,length:double>>, bucket int",
    "terms": "field string, term string, df double, stem string, bucket int",
    "stems": "term string, stem string, bucket int",
    "neighbours": "term string, rest string, bucket int",
}


# --- writing ------------------------------------------------------------------------------------------------
def write(
    docs: DataFrame, fields: list[str], path: str, id: str = "id", attributes: list[str] | None = None, buckets: int = BUCKETS
) -> None:
    """Write the index of `fields` to a folder.  `id` is unique; null fields have no words."""
    spark = docs.sparkSession
    region = F.shiftright(F.monotonically_increasing_id(), REGION_BITS).alias("region")
    split = once(docs.select(id, region, *fields), **{f"_w_{f}": tokens(F.col(f)) for f in fields})
    per_field = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_w_{f}").alias("words")) for f in fields]))
    listed = split.select(F.col(id).alias("id"), "region", per_field.alias("x")).select(
        "id", "region", "x.field", F.size("x.words").cast("double").alias("length"), "x.words"
    )
    sizes = listed.where("length > 0").groupBy("field").agg(F.count("*").cast("double").alias("n"), F.avg("length").alias("average"))
    sizes.withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{path}/fields")
    docs.select(F.col(id).alias("id"), *(attributes or [])).write.mode("overwrite").parquet(f"{path}/attributes")
    index = Index(spark, path, buckets)
    sizes = index.table("fields")

    # counted within the row; a posting is moved once, to the folder and slice of its block, and a block has the documents
    # of one region, so no word is hot
    counted = listed.select("id", "region", "field", "length", F.inline(word_counts(F.col("words"))))
    place = [_bucket(F.col("term"), buckets).alias("bucket"), F.pmod(F.col("region"), F.lit(SLICES)).alias("slice")]
    moved = counted.select("*", *place).repartition("bucket", "slice")
    # a row for each field
    impact = bm25(F.col("tf"), F.col("length"), F.col("average"))
    blocks = (
        moved.join(F.broadcast(sizes.select("field", "average")), "field")
        .groupBy("bucket", "slice", "field", "term", "region")
        .agg(F.count("*").alias("size"), F.max(impact).alias("top"), F.collect_list(F.struct("id", "tf", "length")).alias("postings"))
    )
    spread = blocks.select("field", "term", "region", "size", "top", "postings", "bucket").sortWithinPartitions("bucket", "term", "region")
    spread.write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/blocks")

    terms = index.table("blocks").groupBy("field", "term").agg(F.sum("size").cast("double").alias("df"))
    stem = F.get(stem_words(F.array("term")), F.lit(0))
    terms = terms.withColumn("stem", stem).withColumn("bucket", _bucket(F.col("term"), buckets))
    terms.repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/terms")
    distinct = index.table("terms").select("term", "stem").distinct()
    stems = distinct.withColumn("bucket", _bucket(F.col("stem"), buckets))
    stems.repartition("bucket").sortWithinPartitions("bucket", "stem").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/stems")
    near = distinct.select("term", F.explode(F.array_distinct(beginnings(F.col("term")))).alias("rest"))
    near = near.withColumn("bucket", _bucket(F.col("rest"), buckets))
    near.repartition("bucket").sortWithinPartitions("bucket", "rest").write.partitionBy("bucket").mode("overwrite").parquet(f"{path}/neighbours")


@dataclass
class Index:
    """A written index.  `buckets` is read once, from a table of a row for each field."""

    spark: SparkSession
    path: str
    buckets: int

    def table(self, name: str) -> DataFrame:
        if name not in _SCHEMAS:
            return self.spark.read.parquet(f"{self.path}/{name}")
        kind = self.spark.read.parquet(f"{self.path}/attributes").schema["id"].dataType.simpleString()
        return self.spark.read.schema(_SCHEMAS[name].replace("{id}", kind)).parquet(f"{self.path}/{name}")

    def looked_up(self, name: str, column: str, values: list[str]) -> DataFrame:
        """The rows of some values; constant buckets prune the folders."""
        places = [_bucket(F.lit(v), self.buckets) for v in values]
        rows = self.table(name)
        if not values:
            return rows.where(F.lit(False))
        return rows.where(F.col("bucket").isin(places) & F.col(column).isin(values)).drop("bucket")


def read(spark: SparkSession, path: str) -> Index:
    return Index(spark, path, spark.read.parquet(f"{path}/fields").agg(F.max("buckets")).first()[0] or BUCKETS)


# --- words --------------------------------------------------------------------------------------------------
def expanded(index: Index, words: list[str], match: str = "exact", prefix: int = 0) -> DataFrame:
    """(nth, term): the words of the index that count as each query word, from the dictionary alone."""
    if match == "exact":
        return index.spark.createDataFrame(list(enumerate(words)), "nth int, term string")
    if match == "stem":
        stems = {porter_stem(w): None for w in words}
        rows = index.looked_up("stems", "stem", list(stems)).select("term", "stem")
        nth = F.explode(F.filter(F.array(*[F.when(F.col("stem") == porter_stem(w), F.lit(i)) for i, w in enumerate(words)]), lambda x: x.isNotNull()))
        return rows.select(nth.alias("nth"), "term")
    if match != "fuzzy":
        raise ValueError(f"no such match: {match}")
    rests = {r for w in words for r in beginnings_of(w, allowed_edits(w), prefix)}
    near = index.looked_up("neighbours", "rest", sorted(rests)).select("term").distinct()
    hit = F.array(*[F.when(within_edits(F.col("term"), w, prefix), F.lit(i)) for i, w in enumerate(words)])
    return near.select(F.explode(F.filter(hit, lambda x: x.isNotNull())).alias("nth"), "term")


@dataclass
class Query:
    """Words of the index per query word, and where their postings are."""

    words: list[str]
    classes: DataFrame  # nth, term
    buckets: list[int] | None  # of the folders that hold them; None: told while the query runs
    exact: bool


def query(index: Index, text: str, match: str = "exact", prefix: int = 0) -> Query:
    words = query_terms(text)
    classes = expanded(index, words, match, prefix)
    found = classes.select(_bucket(F.col("term"), index.buckets)).distinct().collect()  # numbers of folders
    return Query(words, classes, [r[0] for r in found], match == "exact")


def _blocks(index: Index, q: Query, boosts: dict[str, float]) -> DataFrame:
    """Blocks of the words of a query, each with `nth` and the field's statistics and boost."""
    rows = index.table("blocks").where(F.col("field").isin(list(boosts)))
    if q.buckets is None:  # few words, which prune the folders when they are known
        wanted = F.broadcast(q.classes.withColumn("bucket", _bucket(F.col("term"), index.buckets)))
        rows = rows.join(wanted, ["bucket", "term"])
    else:
        rows = rows.where(F.col("bucket").isin(q.buckets)).join(q.classes, "term")
    boost = F.element_at(F.create_map(*[F.lit(x) for f in boosts for x in (f, float(boosts[f]))]), F.col("field"))
    # a row for each field
    return rows.join(F.broadcast(index.table("fields").select("field", "n", "average")), "field").withColumn("boost", boost).drop("bucket")


def _postings(blocks: DataFrame, q: Query) -> DataFrame:
    """id, nth, field, n, average, boost, length, tf: one row for each document, query word and field."""
    listed = blocks.select("nth", "field", "n", "average", "boost", F.explode("postings").alias("p")).select(
        "p.id", "nth", "field", "n", "average", "boost", "p.length", "p.tf"
    )
    if q.exact:
        return listed
    return listed.groupBy("id", "nth", "field", "n", "average", "boost", "length").agg(F.sum("tf").alias("tf"))


def _frequencies(index: Index, q: Query, boosts: dict[str, float]) -> DataFrame:
    """(nth, field, df): documents that have any of the words; at most a row for each query word and field."""
    if not q.exact:
        return _postings(_blocks(index, q, boosts), q).groupBy("nth", "field").agg(F.count("*").cast("double").alias("df"))
    rows = index.table("terms").where(F.col("field").isin(list(boosts)))
    if q.buckets is not None:
        rows = rows.where(F.col("bucket").isin(q.buckets))
    # one word for each query word
    wanted = F.broadcast(q.classes.withColumn("bucket", _bucket(F.col("term"), index.buckets)))
    return rows.join(wanted, ["bucket", "term"]).select("nth", "field", "df")


def _allowed(index: Index, rows: DataFrame, where: Column | None) -> DataFrame:
    return rows if where is None else rows.join(index.table("attributes").where(where).select("id"), "id", "left_semi")


def _combined(per_field: DataFrame, by: str, tie_breaker: float) -> DataFrame:
    best = per_field.groupBy(by).agg(F.max("s").alias("m"), F.sum("s").alias("t"))
    return best.select(by, (F.col("m") + tie_breaker * (F.col("t") - F.col("m"))).alias("score"))


def bounds(index: Index, q: Query, boosts: dict[str, float], tie_breaker: float = 0.0) -> DataFrame:
    """(region, score): what no document of a region can exceed, from block heads alone.  For exact words."""
    heads = _blocks(index, q, boosts).drop("postings").join(F.broadcast(_frequencies(index, q, boosts)), ["nth", "field"])
    most = F.sum(F.col("boost") * idf(F.col("n"), F.col("df")) * F.col("top"))
    return _combined(heads.groupBy("region", "field").agg(most.alias("s")), "region", tie_breaker)


def reached(index: Index, q: Query, boosts: dict[str, float], k: int, where: Column | None = None) -> Column:
    """A score that k documents reach for sure, as a subquery; 0 where fewer are seen.

    It is the k-th best of what single postings give in the k most promising blocks.
    """
    frequencies = F.broadcast(_frequencies(index, q, boosts))
    blocks = _blocks(index, q, boosts).join(frequencies, ["nth", "field"])
    weight = F.col("boost") * idf(F.col("n"), F.col("df"))
    heads = blocks.select("nth", "field", "region", (weight * F.col("top")).alias("most")).orderBy(F.desc("most")).limit(k)
    # k rows
    seeds = blocks.join(F.broadcast(heads.drop("most")), ["nth", "field", "region"], "left_semi").withColumn("w", weight)
    one = seeds.select("w", "average", F.explode("postings").alias("p")).select(
        F.col("p.id").alias("id"), (F.col("w") * bm25(F.col("p.tf"), F.col("p.length"), F.col("average"))).alias("s")
    )
    best = _allowed(index, one, where).groupBy("id").agg(F.max("s").alias("s")).orderBy(F.desc("s")).limit(k)
    return best.agg(F.when(F.count("*") == k, F.min("s")).otherwise(0.0).alias("s")).scalar()


def kept_regions(
    index: Index, q: Query, boosts: dict[str, float], k: int, tie_breaker: float = 0.0, where: Column | None = None
) -> DataFrame:
    """The regions that may hold one of the k best documents."""
    return bounds(index, q, boosts, tie_breaker).where(F.col("score") >= reached(index, q, boosts, k, where) - _CLOSE).select("region")


# --- queries ------------------------------------------------------------------------------------------------
def _parts(
    index: Index, q: Query, boosts: dict[str, float], where: Column | None = None, all_terms: bool = False, regions: DataFrame | None = None
) -> DataFrame:
    """One row for each document, query word and field, with `df` and its part of the score."""
    blocks = _blocks(index, q, boosts)
    if regions is not None:
        blocks = blocks.join(regions, "region", "left_semi")
    rows = _allowed(index, _postings(blocks, q), where)
    if all_terms:
        every = (1 << len(q.words)) - 1
        full = rows.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("found")).where(F.col("found") == every)
        rows = rows.join(full, "id", "left_semi")
    rows = rows.join(F.broadcast(_frequencies(index, q, boosts)), ["nth", "field"])
    return rows.withColumn("s", idf(F.col("n"), F.col("df")) * bm25(F.col("tf"), F.col("length"), F.col("average")))


def search_all(
    index: Index, q: Query, boosts: dict[str, float], tie_breaker: float = 0.0, where: Column | None = None, all_terms: bool = False,
    regions: DataFrame | None = None,
) -> DataFrame:
    """(id, score) of all hits, in no order.  `where` is a condition on attributes."""
    parts = _parts(index, q, boosts, where, all_terms, regions)
    per_field = parts.groupBy("id", "field").agg((F.sum("s") * F.first("boost")).alias("s"))
    return _combined(per_field, "id", tie_breaker).select("id", F.round("score", 6).alias("score"))


def search(
    index: Index, q: Query, boosts: dict[str, float], tie_breaker: float = 0.0, size: int = 10, start: int = 0,
    where: Column | None = None, all_terms: bool = False,
) -> DataFrame:
    """One page of ranked hits.  Regions that cannot reach the page are skipped, where words are exact and any will do."""
    skips = q.exact and not all_terms
    regions = kept_regions(index, q, boosts, start + size, tie_breaker, where) if skips else None
    hits = search_all(index, q, boosts, tie_breaker, where, all_terms, regions).orderBy(F.desc("score"), "id")
    return hits.offset(start).limit(size) if start else hits.limit(size)


def total_hits(index: Index, q: Query, boosts: dict[str, float], where: Column | None = None, all_terms: bool = False) -> DataFrame:
    """The number of hits; scores are not computed."""
    rows = _allowed(index, _postings(_blocks(index, q, boosts), q).select("id", "nth"), where)
    found = rows.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("found"))
    return (found.where(F.col("found") == (1 << len(q.words)) - 1) if all_terms else found).agg(F.count("*").alias("total"))


def explain_scores(index: Index, q: Query, boosts: dict[str, float], where: Column | None = None) -> DataFrame:
    """Contribution of every (document, field, query word)."""
    word = F.element_at(F.array(*[F.lit(w) for w in q.words]), F.col("nth") + 1)
    return _parts(index, q, boosts, where).select(
        "id", "field", word.alias("term"), "tf", "df", F.round(idf(F.col("n"), F.col("df")), 6).alias("idf"), F.round("s", 6).alias("score")
    )


def typical_terms(index: Index, own: DataFrame, field: str, max_terms: int = 12, min_tf: int = 1) -> DataFrame:
    """The words of one document with the highest tf * idf; `own` is its row, all else comes from the dictionary."""
    counts = own.select(F.explode(tokens(F.col(field))).alias("term")).groupBy("term").agg(F.count("*").alias("tf")).where(F.col("tf") >= min_tf)
    counts = counts.withColumn("bucket", _bucket(F.col("term"), index.buckets))
    known = index.table("terms").where(F.col("field") == field).select("bucket", "term", "df")
    n = index.table("fields").where(F.col("field") == field).select("n").scalar()
    weight = F.col("tf") * (1 + F.log(n / (F.col("df") + 1)))
    return (
        counts.join(known, ["bucket", "term"])
        .select("term", "tf", F.col("df").cast("long").alias("df"), F.round(weight, 6).alias("weight"))
        .orderBy(F.desc("weight"), "term")
        .limit(max_terms)
    )


def more_like_this(index: Index, docs: DataFrame, field: str, doc: Column, size: int = 10, id: str = "id", max_terms: int = 12) -> DataFrame:
    """Other documents ranked by the typical words of one; of `docs` only that row is read."""
    own = docs.where(doc)
    best = typical_terms(index, own, field, max_terms)
    # `max_terms` rows at most, told apart by their rank
    ranked = best.agg(F.array_sort(F.collect_list("term")).alias("t")).select(F.posexplode("t").alias("nth", "term"))
    q = Query([], ranked, None, True)
    hits = search_all(index, q, {field: 1.0})
    others = hits.join(own.select(F.col(id).alias("id")), "id", "left_anti")
    return others.orderBy(F.desc("score"), "id").limit(size)
