"""Joins between comments, their submission and their parent comment.

All are plain equi-joins: a submission with most of the comments makes one large
partition, which adaptive execution splits (skew join), since nothing stands
between the shuffle and the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.ids import fullname
from mentionlake.operators.quality import COMMENT_COLUMNS, FLAG, flag_comments


def with_subreddit(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Add ``subreddit`` of the linked submission, null if it is unknown.

    ``submissions`` holds one row per ``fullname_id``, as the upsert leaves it.
    """
    names = submissions.select("fullname_id", "subreddit")
    joined = comments.join(names, comments.link_id == names.fullname_id, "left")
    return joined.drop("fullname_id")


def silver_comments(bronze: DataFrame, submissions: DataFrame, **thresholds: int) -> DataFrame:
    return flag_comments(with_subreddit(bronze.select(*COMMENT_COLUMNS), submissions), **thresholds)


def build_context(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Usable comments with the submission they belong to."""
    c = comments.filter(FLAG).select(
        F.col("id").alias("comment_id"), "body", "parent_id", "link_id", "partition_date"
    )
    s = submissions.select(
        F.col("id").alias("submission_id"),
        F.col("title").alias("submission_title"),
        F.col("selftext").alias("submission_selftext"),
        "subreddit",
        "fullname_id",
    )
    return c.join(s, c.link_id == s.fullname_id).select(
        "comment_id", "body", "parent_id", "submission_id", "submission_title",
        "submission_selftext", "subreddit", "partition_date",
    )


def with_parent_body(context: DataFrame, comments: DataFrame) -> DataFrame:
    """Add the text of the comment replied to; null for replies to a submission."""
    parents = comments.select(
        fullname("comment", "id").alias("_parent"), F.col("body").alias("parent_body")
    )
    return context.join(parents, context.parent_id == F.col("_parent"), "left").drop("_parent")


def only_new(context: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose comment has not been analysed yet."""
    return context.join(done.select("comment_id"), "comment_id", "left_anti")
