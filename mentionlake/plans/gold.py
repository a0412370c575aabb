"""Star schema: date, product and submission dimensions and the mention fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.dates import date_key, epoch_date, epoch_ts
from mentionlake.functions.ids import short_id
from mentionlake.functions.products import USD_FACTOR, as_flag
from mentionlake.operators.dedupe import row_digest, surrogate_key
from mentionlake.operators.joins import or_join
from mentionlake.plans.layout import Lake
from mentionlake.sources.tables import replace_table

# First day and number of days of the calendar.
FIRST_DAY = "2000-01-01"
DAYS = 11_500


def date_series(spark: SparkSession, start: str = FIRST_DAY, n: int = DAYS) -> DataFrame:
    return spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date"))


def calendar_columns(day: str = "full_date") -> dict[str, Column]:
    sunday_first = F.dayofweek(day) - 1
    return {
        "date_key": date_key(day),
        "full_date": F.col(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.monthname(day),
        "day_of_week": sunday_first,
        "day_name": F.dayname(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": sunday_first.isin(0, 6),
    }


def dim_date(spark: SparkSession, start: str = FIRST_DAY, n: int = DAYS) -> DataFrame:
    """One row per day; Sunday is day 0, weeks are ISO weeks."""
    return date_series(spark, start, n).select(*[c.alias(name) for name, c in calendar_columns().items()])


# Product columns of the mart.
PRODUCT_FIGURES = (
    "processor_brand", "num_cores", "processor_speed", "battery_capacity",
    "fast_charging_available", "fast_charging", "ram_capacity", "internal_memory",
    "screen_size", "refresh_rate", "num_rear_cameras", "os", "primary_camera_rear",
    "primary_camera_front", "extended_memory_available", "resolution_height",
    "resolution_width",
)
PRODUCT_FLAGS = ("fast_charging_available", "extended_memory_available")


def dim_product(reference: DataFrame) -> DataFrame:
    """Products with price in dollars and flags as booleans."""
    figures = [(as_flag(c) if c in PRODUCT_FLAGS else F.col(c)).alias(c) for c in PRODUCT_FIGURES]
    rows = reference.select(
        "brand_name",
        "model",
        (F.col("price") * USD_FACTOR).alias("price_usd"),
        "avg_rating",
        as_flag("`5G_or_not`").alias("is_5g"),
        *figures,
    )
    return surrogate_key(rows, ["brand_name", "model"], "product_key", tiebreak=row_digest(rows))


def dim_submission(submissions: DataFrame) -> DataFrame:
    """Posts with their number. Only ids are sorted for it; the texts join their number afterwards."""
    rows = submissions.select(
        F.col("id").alias("reddit_submission_id"),
        "subreddit", "title", "selftext",
        epoch_ts("created_utc").alias("created_at"),
        "num_comments", "upvote_ratio", "score",
    )
    numbers = submission_keys(submissions)
    return numbers.join(rows, "reddit_submission_id").select("submission_key", *rows.columns)


def submission_keys(submissions: DataFrame) -> DataFrame:
    """Ids (which are unique in silver) and their numbers."""
    ids = submissions.select(F.col("id").alias("reddit_submission_id"))
    return surrogate_key(ids, "reddit_submission_id", "submission_key")


def with_product_key(mentions: DataFrame, products: DataFrame) -> DataFrame:
    """Add ``product_key``: that of the product with the mention's names, but for case; null if there is none."""
    p = products.select(F.lower("brand_name").alias("_brand"), F.lower("model").alias("_model"), "product_key")
    same = (F.lower("brand_name") == F.col("_brand")) & (F.lower("product_name") == F.col("_model"))
    return mentions.join(p, same, "left").drop("_brand", "_model")


def fact_mentions(
    mentions: DataFrame,
    comments: DataFrame,
    products: DataFrame,
    submissions: DataFrame,
    dates: DataFrame,
    prefer_link: bool = False,
) -> DataFrame:
    """One row per mention with the keys of its product, submission and date.

    A key without a match is null. The submission is found by the comment's link or
    by the mention's own submission id (see ``or_join``). The joins start with the
    comment, so only the narrow mention and key columns are shuffled; the calendar
    is the one side of fixed size and the only one with a broadcast hint.
    """
    s = mentions.select(
        "submission_id", "comment_id", "brand_name", "product_name", "aspect", "sentiment_score"
    )
    c = comments.select(
        F.col("id").alias("_comment"), "link_id", "created_utc", F.col("score").alias("comment_score")
    )
    commented = s.join(c, s.comment_id == c["_comment"], "left")
    keys = submissions.select("reddit_submission_id", "submission_key")
    linked = or_join(
        commented, short_id("link_id"), F.col("submission_id"), keys, "reddit_submission_id", prefer_link, unique=True
    )
    d = F.broadcast(dates.select("date_key", "full_date"))
    return (
        with_product_key(linked, products)
        .join(d, epoch_date("created_utc") == F.col("full_date"), "left")
        .select(
            "product_key", "submission_key", "date_key", "comment_id", "brand_name",
            "product_name", "aspect", "sentiment_score", "comment_score",
        )
    )


def build_gold(spark: SparkSession, lake: Lake, prefer_link: bool = False, start: str = FIRST_DAY, days: int = DAYS) -> None:
    """Rebuild the marts, dimensions first; the calendar has ``days`` days from ``start`` (see ``days_outside``)."""
    def save(df: DataFrame, name: str) -> DataFrame:
        table = f"{lake.mart}.{name}"
        replace_table(df, table, lake.path(table))
        return spark.table(table)

    submissions = spark.table(lake.silver_table("submissions"))
    comments = spark.table(lake.silver_table("comments"))
    dates = save(dim_date(spark, start, days), "dim_date")
    products = save(dim_product(spark.table(lake.reference)), "dim_product")
    posts = save(dim_submission(submissions), "dim_submission")
    mentions = spark.table(lake.sentiment)
    save(fact_mentions(mentions, comments, products, posts, dates, prefer_link), "fact_brand_mentions")


def days_outside(comments: DataFrame, dates: DataFrame) -> DataFrame:
    """Days of comments that the calendar does not hold: mentions of these get no date key."""
    days = comments.select(epoch_date("created_utc").alias("full_date")).filter("full_date IS NOT NULL")
    counted = days.groupBy("full_date").agg(F.count("*").alias("comments"))
    return counted.join(dates.select("full_date"), "full_date", "left_anti")
