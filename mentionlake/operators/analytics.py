"""Analytical queries over mentions and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.dates import partition_day
from mentionlake.functions.products import price_segment
from mentionlake.operators.quality import FLAG


def sentiment_summary(mentions: DataFrame) -> DataFrame:
    return mentions.agg(
        F.count("*").alias("total_sentiment_records"),
        F.count_distinct("comment_id").alias("unique_comments_analyzed"),
        F.count_distinct("brand_name").alias("brands_mentioned"),
        F.avg("sentiment_score").alias("avg_sentiment_score"),
    )


def reference_counts(reference: DataFrame) -> DataFrame:
    return reference.agg(F.count("*").alias("products"), F.count_distinct("brand").alias("brands"))


def _pre_aggregated(mentions: DataFrame, *measures: Column) -> DataFrame:
    """Mentions summed per (brand, product) before they meet the products.

    A product with most of the mentions is reduced map-side, so the join never
    sees it as a hot key.
    """
    keys = [F.lower("brand_name").alias("_brand"), F.col("product_name").alias("_model")]
    return mentions.groupBy(*keys).agg(*measures)


def _per_product(mentions: DataFrame, reference: DataFrame, columns: list[Column]) -> DataFrame:
    m = _pre_aggregated(
        mentions,
        F.sum("sentiment_score").alias("_sum"),
        F.count("sentiment_score").alias("_scored"),
        F.count("*").alias("_rows"),
    )
    p = reference.select("brand", "model", *columns)
    return p.join(m, (p.brand == m["_brand"]) & (p.model == m["_model"]))


def _rolled_up(joined: DataFrame, *keys: str) -> DataFrame:
    return joined.groupBy(*keys).agg(
        F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("avg_sentiment"),
        F.sum("_rows").alias("mentions"),
    )


def sentiment_by_price(mentions: DataFrame, reference: DataFrame, by_brand: bool = True) -> DataFrame:
    """Average score and mentions per price segment, by brand unless switched off."""
    columns = [F.col("brand_name"), price_segment("price").alias("price_segment")]
    keys = ["brand_name", "price_segment"] if by_brand else ["price_segment"]
    joined = _per_product(mentions, reference, columns)
    return _rolled_up(joined, *keys).orderBy(F.desc("avg_sentiment"))


def sentiment_by_5g(mentions: DataFrame, reference: DataFrame) -> DataFrame:
    label = F.when(F.col("`5G_or_not`") == 1, "5G").otherwise("4G").alias("connectivity")
    joined = _per_product(mentions, reference, [label])
    return _rolled_up(joined, "connectivity")


def aspect_by_spec(
    mentions: DataFrame,
    reference: DataFrame,
    aspect: str = "camera",
    spec: str = "primary_camera_rear",
    at_least: int | None = 48,
    by_product: bool = True,
) -> DataFrame:
    """Average score and mentions of one aspect beside a product figure.

    Products nobody mentions stay in, with a null average. Without ``by_product``
    the rows are grouped by the figure alone, and products lacking it are left out.
    """
    prefix = aspect
    m = _pre_aggregated(
        mentions.filter(F.col("aspect") == aspect),
        F.sum("sentiment_score").alias("_sum"),
        F.count("sentiment_score").alias("_scored"),
        F.count("*").alias("_rows"),
    )
    wanted = F.col(spec) >= at_least if at_least is not None else F.col(spec).isNotNull()
    p = reference.filter(wanted).select("brand", "brand_name", "model", spec)
    joined = p.join(m, (p.brand == m["_brand"]) & (p.model == m["_model"]), "left")
    keys = ["brand_name", "model", spec] if by_product else [spec]
    result = joined.groupBy(*keys).agg(
        F.try_divide(F.sum("_sum"), F.sum("_scored")).alias(f"{prefix}_sentiment"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias(f"{prefix}_mentions"),
    )
    return result.orderBy(F.desc(f"{prefix}_sentiment"))


def distinct_groups(context: DataFrame, column: str = "subreddit") -> DataFrame:
    return context.select(column).distinct()


def latest_dates(df: DataFrame, n: int = 5, column: str = "partition_date") -> DataFrame:
    """The latest partitions by time; as text the dates would sort by day of month."""
    return df.select(column).distinct().orderBy(partition_day(column).desc()).limit(n)


def sample_rejects(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` unusable rows by id, for a look at what the flag rejects."""
    return df.filter(~F.col(FLAG)).orderBy("id").select(*columns).limit(n)
