"""Selection of recipe posts from dumped submissions and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder import lexicon
from larder.functions.text import contains_any


def select_recipe_posts(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Submissions with their recipe text: the self text, else the author's first comment with a recipe word.

    Comments are filtered and reduced to one row per (submission, author) on the map side before the
    join, so a submission with a flood of comments stays cheap.
    """
    known = submissions.where(F.col("author").isNotNull())
    self_text = F.when(
        F.col("is_self") & contains_any(F.lower("selftext"), lexicon.SELF_POST_WORDS), F.col("selftext")
    )
    own = (
        comments.where(contains_any(F.lower("body"), lexicon.COMMENT_WORDS))
        .groupBy(F.col("submission_id").alias("id"), "author")
        .agg(F.min(F.struct("position", "body")).alias("_first"))
        .select("id", "author", F.col("_first.body").alias("_body"))
    )
    return (
        known.withColumn("_self", self_text)
        .join(own, ["id", "author"], "left")
        .withColumn("recipe_text", F.coalesce("_self", "_body"))
        .where(F.col("recipe_text").isNotNull())
        .drop("_self", "_body")
    )


def to_posts(selected: DataFrame) -> DataFrame:
    """The six post columns."""
    return selected.select(
        F.date_format(F.timestamp_seconds(F.floor("created_utc")), "yyyy-MM-dd").alias("date"),
        F.col("num_comments").cast("int").alias("num_comments"),
        "title",
        F.col("author").alias("user"),
        F.col("recipe_text").alias("comment"),
        F.length("recipe_text").cast("int").alias("n_char"),
    )


def post_key(title: str = "title", user: str = "user"):
    return F.concat(F.coalesce(title, F.lit("")), F.lit("_"), F.coalesce(user, F.lit("")))


def unseen(posts: DataFrame, history: DataFrame, row_id: str, user: str = "user") -> DataFrame:
    """First post of every title and user that the history does not hold; `row_id` is unique and ordered."""
    first = posts.groupBy(post_key("title", user).alias("_key")).agg(F.min(row_id).alias(row_id))
    seen = history.select(post_key("title", user if user in history.columns else "user").alias("_key")).distinct()
    fresh = first.join(seen, "_key", "left_anti").select(row_id)
    return posts.join(fresh, row_id, "left_semi")


def newest(submissions: DataFrame, limit: int = 25) -> DataFrame:
    return submissions.orderBy(F.desc("created_utc"), F.desc("id")).limit(limit)
