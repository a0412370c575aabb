"""Prompt text for a scorer, built as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.text import SENTINELS

# The aspects of a mention.
ASPECTS = (
    "camera", "battery", "display", "performance", "price", "software",
    "build_quality", "design", "other",
)

INSTRUCTIONS = (
    "Find every opinion on a phone in the comment. Answer with a JSON array of objects "
    "with the fields brand_name, product_name (or general), aspect, sentiment_score "
    "(0.0 very negative to 1.0 very positive) and quote (verbatim, at most 200 characters). "
    f"Aspects: {', '.join(ASPECTS)}. Judge the target comment alone; the post and the parent comment only tell "
    "what its words refer to. Known brands: "
)


def system_text(reference: DataFrame, limit: int | None = None) -> DataFrame:
    """One row with the instructions and all brands, or the ``limit`` brands with the most products."""
    brands = reference.select("brand").dropna().groupBy("brand").agg(F.count("*").alias("_products"))
    if limit is not None:
        brands = brands.orderBy(F.desc("_products"), "brand").limit(limit)
    names = F.array_join(F.array_sort(F.collect_list("brand")), ", ")
    return brands.agg(F.concat(F.lit(INSTRUCTIONS), names).alias("system_text"))


def _told(c: str, value: Column) -> Column:
    """``value`` unless the text behind it is missing or a sentinel."""
    return F.when(F.col(c).isNotNull() & ~F.col(c).isin(*SENTINELS), value)


def with_prompt(context: DataFrame, post_chars: int | None = None) -> DataFrame:
    """Add ``prompt``: title, post, parent comment, then the comment itself.

    The context must hold ``parent_body``. The post is used whole, or its first ``post_chars`` characters.
    """
    # Labels of the context lines.
    start = F.col("submission_selftext") if post_chars is None else F.substring("submission_selftext", 1, post_chars)
    lines = F.concat_ws(
        "\n",
        F.concat(F.lit("Submission Title: "), F.coalesce("submission_title", F.lit(""))),
        _told("submission_selftext", F.concat(F.lit("Submission Context: "), start, F.lit("..."))),
        _told("parent_body", F.concat(F.lit("Parent Comment: "), F.col("parent_body"))),
    )
    return context.withColumn(
        "prompt",
        F.concat(
            F.lit("Context:\n"), lines,
            F.lit("\n\nTarget Comment to Analyze:\n\""), F.col("body"), F.lit("\""),
        ),
    )
