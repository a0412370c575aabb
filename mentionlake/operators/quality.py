"""Silver columns, usability flags and their ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.functions import text

FLAG = "is_usable_for_sentiment"

# Columns of the silver tables.
SUBMISSION_COLUMNS = (
    "id", "fullname_id", "subreddit", "title", "selftext", "created_utc", "score",
    "upvote_ratio", "num_comments", "partition_date",
)
COMMENT_COLUMNS = ("id", "link_id", "parent_id", "body", "score", "created_utc", "partition_date")


def flag_submissions(
    df: DataFrame,
    min_chars: int = text.SUBMISSION_MIN_CHARS,
    min_words: int = text.SUBMISSION_MIN_WORDS,
) -> DataFrame:
    """Mark submissions with enough text; no row is dropped."""
    return df.withColumn(FLAG, text.submission_usable("title", "selftext", min_chars, min_words))


def flag_comments(
    df: DataFrame,
    min_chars: int = text.COMMENT_MIN_CHARS,
    min_words: int = text.COMMENT_MIN_WORDS,
) -> DataFrame:
    return df.withColumn(FLAG, text.comment_usable("body", min_chars, min_words))


def silver_submissions(bronze: DataFrame, **thresholds: int) -> DataFrame:
    return flag_submissions(bronze.select(*SUBMISSION_COLUMNS), **thresholds)


def usable_ratio(df: DataFrame, kind: str) -> DataFrame:
    """Rows, usable rows and their share (0 for an empty table)."""
    counted = df.agg(F.count("*").alias("total"), F.count_if(FLAG).alias("usable"))
    ratio = F.coalesce(F.try_divide(F.col("usable").cast("double"), F.col("total")), F.lit(0.0))
    return counted.select(F.lit(kind).alias("kind"), "total", "usable", ratio.alias("ratio"))
