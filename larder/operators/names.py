"""Ingredient and title filters from an index of distinct names.

Lines are read once, when the index is written.  A query tests distinct names only, those that share all trigrams of
its pattern where it has any, and goes from names to recipes by containers: for each name and block of 32,768 recipe
ids a bitmap of the recipes that use it, or a list of places where they are few.  Terms are combined by AND, OR and
NOT on the bitmaps of one block of ids, so no task holds more than a block for each term.

How often a recipe repeats a name is kept bit by bit: slice b of a container has the recipes whose count has bit b.

Lines without name or recipe are in no container.  Recipes without lines are in `recipes`, so that NOT keeps them.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from larder.functions.text import wildcard_to_like
from larder.operators.ingredients import boolean_terms, line_score, matches, query_words
from larder.session import checkpointed

BLOCK_BITS = 15
BLOCK = 1 << BLOCK_BITS
# a list of so many places is as large as a bitmap
SPARSE = 1024
FOLDERS = 32
STORED = {
    "names": "name string, name_id long",
    "grams": "name_id long, gram string, folder int",
    "containers": "name_id long, block long, slice int, places array<int>, bits binary",
    "recipes": "block long, bits binary",
}


@dataclass(frozen=True)
class Names:
    """A written index: names (name_id, name), grams (folder, gram, name_id), containers by name, all recipes by block."""

    names: DataFrame
    grams: DataFrame
    containers: DataFrame
    recipes: DataFrame


def _block(id: Column) -> Column:
    return F.shiftright(id, BLOCK_BITS)


def _place(id: Column) -> Column:
    return id.bitwiseAND(BLOCK - 1)


def _id(block: Column, place: Column) -> Column:
    return F.shiftleft(block, BLOCK_BITS) + place


def _trigrams(name: Column) -> Column:
    low = F.lower(name)
    starts = F.when(F.length(low) >= 3, F.sequence(F.lit(1), F.length(low) - 2))
    return F.array_distinct(F.transform(starts, lambda at: F.substring(low, at, F.lit(3))))


def write_names(lines: DataFrame, recipes: DataFrame, path: str) -> Names:
    """Index the lines (recipe_id, name) of all recipes (id)."""
    spark = lines.sparkSession
    used = lines.where(F.col("name").isNotNull() & F.col("recipe_id").isNotNull())
    used = used.groupBy("name", F.col("recipe_id").cast("long").alias("id")).agg(F.count("*").alias("n"))
    used.select("name").distinct().withColumn("name_id", F.monotonically_increasing_id()).write.parquet(f"{path}/names")
    names = spark.read.parquet(f"{path}/names")

    grams = names.select("name_id", F.explode(_trigrams(F.col("name"))).alias("gram"))
    grams = grams.withColumn("folder", F.pmod(F.crc32("gram"), F.lit(FOLDERS)).cast("int"))
    # a common gram is spread over tasks by size
    grams.hint("rebalance", F.col("folder")).sortWithinPartitions("folder", "gram").write.partitionBy("folder").parquet(
        f"{path}/grams"
    )

    top = F.floor(F.log2("n")).cast("int") + 1  # one more, in case the logarithm is rounded down
    bits = F.filter(F.sequence(F.lit(0), top), lambda b: F.getbit("n", b) == 1)
    marks = used.select("name", _block(F.col("id")).alias("block"), _place(F.col("id")).alias("place"), F.explode(bits).alias("slice"))
    # at most a block of places for each name, block and slice
    found = marks.groupBy("name", "block", "slice").agg(F.collect_list(F.col("place").cast("int")).alias("places"))
    found = checkpointed(found.join(names, "name").drop("name"))
    key = ["name_id", "block", "slice"]
    few = found.where(F.size("places") <= SPARSE).withColumn("bits", F.lit(None).cast("binary"))
    many = found.where(F.size("places") > SPARSE).select(*key, F.explode("places").alias("place"))
    many = many.groupBy(*key).agg(F.bitmap_construct_agg("place").alias("bits"))
    many = many.withColumn("places", F.lit(None).cast("array<int>"))
    few.select(*key, "places", "bits").unionByName(many).write.parquet(f"{path}/containers")

    ids = recipes.where(F.col("id").isNotNull()).select(F.col("id").cast("long").alias("id"))
    blocks = ids.groupBy(_block(F.col("id")).alias("block")).agg(F.bitmap_construct_agg(_place(F.col("id"))).alias("bits"))
    blocks.write.parquet(f"{path}/recipes")
    return read_names(spark, path)


def read_names(spark: SparkSession, path: str) -> Names:
    return Names(*[spark.read.schema(schema).parquet(f"{path}/{part}") for part, schema in STORED.items()])


# --- names of a query ----------------------------------------------------------------------------------
def _grams_of(pieces: list[str]) -> list[str]:
    """Trigrams that every match has: of runs of ASCII characters, which are lower-cased alike everywhere."""
    runs = [run.lower() for piece in pieces for run in re.findall(r"[\x00-\x7F]+", piece)]
    return sorted({run[at : at + 3] for run in runs for at in range(len(run) - 2)})


def _candidates(index: Names, grams: list[str]) -> DataFrame:
    """Names with all these trigrams; all distinct names where there are none."""
    if not grams:
        return index.names
    folders = sorted({zlib.crc32(g.encode()) % FOLDERS for g in grams})
    hits = index.grams.where(F.col("folder").isin(folders) & F.col("gram").isin(grams))
    hits = hits.groupBy("name_id").agg(F.count("*").alias("n")).where(F.col("n") == len(grams))
    return index.names.join(hits, "name_id", "left_semi")


def names_like(index: Names, pattern: str) -> DataFrame:
    """Names (name_id, name) that a `*` and `?` pattern matches.

    A pattern without three ASCII characters in a row is tested on all distinct names.
    """
    grams = _grams_of(re.split(r"[*?]", pattern))
    return _candidates(index, grams).where(F.col("name").ilike(wildcard_to_like(pattern)))


def names_from(index: Names, prefix: str) -> DataFrame:
    """Names that begin with the prefix, in either case."""
    return _candidates(index, _grams_of([prefix])).where(F.lower("name").startswith(prefix.lower()))


def names_for(index: Names, terms: list[str]) -> DataFrame:
    """(name_id, term, score) of each name and the number of each term that it answers, by `line_score`."""
    scores = [F.struct(F.lit(i).alias("term"), line_score(F.col("name"), t).alias("score")) for i, t in enumerate(terms)]
    return index.names.select("name_id", F.inline(F.filter(F.array(*scores), lambda s: s["score"] > 0)))


# --- recipes of names ----------------------------------------------------------------------------------
@F.pandas_udf(ArrayType(IntegerType()))
def _members(bits: pd.Series) -> pd.Series:
    """The places of the set bits."""
    return pd.Series([_mask(b).nonzero()[0].astype(np.int32) for b in bits], dtype=object)


def _mask(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def _united(rows: DataFrame, *group: str) -> DataFrame:
    """One bitmap for each group and block of ids, over all its containers."""
    keys = [*group, "block"]
    few = rows.where(F.col("bits").isNull()).select(*keys, F.explode("places").alias("place"))
    few = few.groupBy(*keys).agg(F.bitmap_construct_agg("place").alias("bits"))
    many = rows.where(F.col("bits").isNotNull()).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))
    return few.unionByName(many).groupBy(*keys).agg(F.bitmap_or_agg("bits").alias("bits"))


def _ids(bitmaps: DataFrame) -> DataFrame:
    return bitmaps.select("block", F.explode(_members("bits")).alias("place")).select(_id(F.col("block"), F.col("place")).alias("id"))


def using(index: Names, names: DataFrame) -> DataFrame:
    """Ids of the recipes that use one of the names, each once."""
    return _ids(_united(index.containers.join(names.select("name_id"), "name_id", "left_semi")))


def count_using(index: Names, names: DataFrame) -> DataFrame:
    """How many recipes use one of the names; no id is unpacked."""
    found = _united(index.containers.join(names.select("name_id"), "name_id", "left_semi"))
    return found.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def boolean_ids(index: Names, expression: str) -> DataFrame:
    """Ids of the recipes for which `chicken AND (garlic OR onion) AND NOT cheese` holds."""
    sql, terms = boolean_terms(expression)
    # AND, OR and NOT bind as &, | and ~ do; all else in the text are columns and parentheses
    formula = re.sub(r"\b(AND|OR|NOT)\b", lambda m: {"AND": "&", "OR": "|", "NOT": "~"}[m.group(0)], sql)
    compile(formula, expression, "eval")  # a malformed expression fails here and not in a task

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        bits = {t: np.frombuffer(b, np.uint8) for t, b in zip(rows["term"], rows["bits"])}
        if -1 not in bits:
            return pd.DataFrame({"block": [], "bits": []})
        none = np.zeros(BLOCK // 8, np.uint8)
        held = eval(formula, {"__builtins__": {}}, {f"_t{i}": bits.get(i, none) for i in range(len(terms))})
        return pd.DataFrame({"block": rows["block"].iloc[:1], "bits": [(held & bits[-1]).tobytes()]})

    found = _united(index.containers.join(names_for(index, terms), "name_id"), "term")
    every = index.recipes.select(F.lit(-1).alias("term"), "block", "bits")
    # a group is one bitmap for each term
    return _ids(found.unionByName(every).groupBy("block").applyInPandas(decide, "block long, bits binary"))


def all_terms(index: Names, terms: list[str]) -> DataFrame:
    """(id, score) of the recipes with a line for each term: the sum of the best line of each."""
    wanted = len(terms)

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        scores = np.zeros((wanted, BLOCK), np.int32)
        for term, score, bits in zip(rows["term"], rows["score"], rows["bits"]):
            mask = _mask(bits)
            scores[term, mask] = np.maximum(scores[term, mask], score)
        places = np.flatnonzero((scores > 0).all(axis=0))
        block = int(rows["block"].iloc[0]) << BLOCK_BITS
        return pd.DataFrame({"id": block + places, "score": scores.sum(axis=0)[places]})

    found = _united(index.containers.join(names_for(index, terms), "name_id"), "term", "score")
    return found.groupBy("block").applyInPandas(best, "id long, score int")


def any_term(index: Names, terms: list[str]) -> DataFrame:
    """(recipe_id, score): how many pairs of a line and a term match by word."""
    tests = [matches(F.col("name"), t).cast("int") for t in terms if query_words(t)]
    weights = index.names.select("name_id", sum(tests, F.lit(0)).alias("weight")).where("weight > 0")
    rows = index.containers.join(weights, "name_id").withColumn("weight", F.expr("shiftleft(cast(weight as bigint), slice)"))
    few = rows.where(F.col("bits").isNull()).select("block", "weight", F.explode("places").alias("place"))
    many = rows.where(F.col("bits").isNotNull()).select("block", "weight", F.explode(_members("bits")).alias("place"))
    return (
        few.unionByName(many)
        .groupBy(_id(F.col("block"), F.col("place")).alias("recipe_id"))
        .agg(F.sum("weight").alias("score"))
    )


__all__ = [
    "Names", "all_terms", "any_term", "boolean_ids", "count_using", "names_for", "names_from", "names_like", "read_names",
    "using", "write_names",
]
