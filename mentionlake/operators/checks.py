"""Data-quality checks; each returns the rows that break a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.text import char_count, is_sentinel
from mentionlake.operators.quality import FLAG


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
             for name, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)


def submission_flow(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows and distinct ids before and after the silver job."""
    parts = [
        df.agg(F.count("*").alias("submission_count"), F.count_distinct("id").alias("unique_submissions"))
        .withColumn("layer", F.lit(layer))
        for layer, df in (("Bronze", bronze), ("Silver-core", silver))
    ]
    return parts[0].unionByName(parts[1])


def comment_flow(bronze: DataFrame, silver: DataFrame, mentions: DataFrame) -> DataFrame:
    """Comments, usable comments and analysed comments per layer."""
    parts = [
        bronze.agg(F.count("*").alias("comment_count")).withColumn("layer", F.lit("Bronze")),
        silver.agg(F.count("*").alias("comment_count"), F.count_if(FLAG).alias("usable_count"))
        .withColumn("layer", F.lit("Silver-core")),
        mentions.agg(F.count_distinct("comment_id").alias("analyzed_count"))
        .withColumn("layer", F.lit("Silver-sentiment")),
    ]
    flow = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return flow.select("layer", "comment_count", "usable_count", "analyzed_count")


def check_no_drop(bronze: DataFrame, silver: DataFrame, by: str = "partition_date") -> DataFrame:
    """Partitions whose row count differs between the layers."""
    b = bronze.groupBy(by).agg(F.count("*").alias("bronze_rows"))
    s = silver.groupBy(by).agg(F.count("*").alias("silver_rows"))
    joined = b.join(s, by, "full").fillna(0, ["bronze_rows", "silver_rows"])
    return joined.filter("bronze_rows <> silver_rows")


def check_flags(df: DataFrame, text: str, min_chars: int, title: str | None = None) -> DataFrame:
    """Rows without a flag, and rows flagged usable though sentinel or too short."""
    chars = char_count(text) + (char_count(title) if title else F.lit(0))
    reason = (
        F.when(F.col(FLAG).isNull(), "missing")
        .when(F.col(FLAG) & is_sentinel(text), "sentinel")
        .when(F.col(FLAG) & (chars < min_chars), "short")
    )
    return df.select("id", reason.alias("reason")).filter("reason IS NOT NULL")


def check_unusable_analysed(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Unusable comments that were analysed all the same."""
    unusable = comments.filter(~F.col(FLAG)).select(F.col("id").alias("comment_id"), "partition_date")
    return unusable.join(mentions.select("comment_id"), "comment_id", "left_semi")


def check_missing_analysis(comments: DataFrame, mentions: DataFrame) -> DataFrame:
    """Usable comments without any mention; some are normal."""
    usable = comments.filter(FLAG).select(F.col("id").alias("comment_id"), "partition_date")
    return usable.join(mentions.select("comment_id"), "comment_id", "left_anti")


def check_brand_domain(mentions: DataFrame, reference: DataFrame) -> DataFrame:
    """Brands, with their mentions, that the reference does not know."""
    brands = mentions.groupBy(F.lower("brand_name").alias("brand")).agg(F.count("*").alias("mentions"))
    return brands.join(reference.select("brand"), "brand", "left_anti")


def check_score_range(mentions: DataFrame) -> DataFrame:
    """Mentions with a missing or impossible score, or without a time of analysis."""
    wrong = F.col("sentiment_score").isNull() | ~F.col("sentiment_score").between(0, 1)
    return mentions.filter(wrong | F.col("analyzed_at").isNull())


def check_ratio(ratios: DataFrame) -> DataFrame:
    """Kinds of record of which none or all are usable."""
    return ratios.filter("ratio <= 0 OR ratio >= 1")


def check_coverage(grid: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected partitions that did not land."""
    keys = ["subreddit", "sort_type", "partition_date"]
    return grid.join(landed.select(*keys), keys, "left_anti")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
