"""Silver comments to mentions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators import metrics
from mentionlake.operators.context import build_context, only_new, with_parent_body
from mentionlake.operators.extract import (
    Scorer, finish_mentions, lexicon_mentions, parse_responses, score, with_analysis_id,
)
from mentionlake.operators.prompts import system_text, with_prompt
from mentionlake.operators.resolve import apply_pairs, resolve_pairs
from mentionlake.plans.layout import Lake
from mentionlake.plans.silver import of_dates
from mentionlake.schemas import SENTIMENT
from mentionlake.session import staging
from mentionlake.sources.tables import append


def mentions_from_scorer(
    context: DataFrame, submissions: DataFrame, comments: DataFrame, reference: DataFrame,
    scorer_factory: Callable[[str], Callable[[], Scorer]],
    partitions: int | None = None, strict: bool = False, brands: int | None = None, post_chars: int | None = None,
) -> DataFrame:
    """Unresolved mentions from a scorer, which is given the instructions once.

    The posts' texts join their comments here, for the prompt; what is written before holds none of them.
    """
    instructions = system_text(reference, brands).first()[0]
    posts = submissions.select(
        F.col("id").alias("submission_id"), F.col("title").alias("submission_title"), F.col("selftext").alias("submission_selftext"))
    told = context.join(posts, "submission_id")
    prompted = with_prompt(with_parent_body(told, comments), post_chars).drop("submission_selftext")
    return parse_responses(score(prompted, scorer_factory(instructions), partitions), strict)


def not_analysed(spark: SparkSession, lake: Lake, context: DataFrame) -> DataFrame:
    """Rows of comments that neither the ledger nor the mentions know (a run may have stopped between the two).

    Both tables are bucketed by comment, so only the context is shuffled, once; a union of them would lose their buckets.
    """
    for table in (lake.analysed, lake.sentiment):
        context = only_new(context, spark.table(table))
    return context


def run_sentiment(
    spark: SparkSession,
    lake: Lake,
    reference: DataFrame,
    dates: Sequence[str] | None = None,
    scorer_factory: Callable[[str], Callable[[], Scorer]] | None = None,
    lexicon: DataFrame | None = None,
    model_version: str = "lexicon",
    submission_scope: str = "all",
    partitions: int | None = None,
    strict: bool = False,
    run_id: str | None = None,
    matcher: str = "blocks",
    prompt_brands: int | None = None,
    post_chars: int | None = None,
) -> int:
    """Analyse usable comments that were not analysed before; returns how many.

    Works with a scorer or, by default, a lexicon. All subreddits go through one
    distributed pass. The scorer's answers are written before anything is derived
    from them, so no comment is scored twice. Every element of an answer is stored, also where names
    become equal. ``prompt_brands`` and ``post_chars`` shorten the prompt; by default nothing is left out.
    """
    if (scorer_factory is None) == (lexicon is None):
        raise ValueError("give either a scorer_factory or a lexicon")
    submissions = spark.table(lake.silver_table("submissions"))
    comments = spark.table(lake.silver_table("comments"))
    scoped = of_dates(submissions, dates) if submission_scope == "partition" else submissions
    context = build_context(of_dates(comments, dates), scoped).drop("submission_title", "submission_selftext")
    with staging(spark, "sentiment") as save:
        fresh = save(not_analysed(spark, lake, context), "context")
        if fresh.isEmpty():
            return 0
        if scorer_factory is not None:
            raw = mentions_from_scorer(fresh, scoped, comments, reference, scorer_factory, partitions, strict, prompt_brands, post_chars)
        else:
            raw = lexicon_mentions(fresh, lexicon)
        finished = finish_mentions(raw).select(
            "submission_id", "comment_id", "brand_name", "product_name", "aspect",
            "sentiment_score", "quote", "item_no",
            F.lit(model_version).alias("model_version"),
            F.current_timestamp().alias("analyzed_at"),
            F.col("partition_date").alias("date_partition"),
        )
        scored = save(finished, "scored")
        names = save(resolve_pairs(scored, reference, matcher=matcher), "names")
        mentions = with_analysis_id(apply_pairs(scored, names))
        append(mentions.select(*SENTIMENT.names), lake.sentiment)
        append(fresh.select("comment_id", F.col("partition_date").alias("date_partition")), lake.analysed)
        analysed = fresh.count()
    counted = spark.createDataFrame(
        [("AGGREGATE", None, "CommentsAnalyzed", float(analysed), "Count")],
        "scope string, subreddit string, metric string, value double, unit string",
    )
    label, run = ",".join(dates) if dates else None, run_id or uuid.uuid4().hex
    metrics.record(counted, lake.metrics, lake.environment, "silver_sentiment", label, run)
    return analysed
