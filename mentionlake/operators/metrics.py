"""Counts and ranges of a run, and the long metrics table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlake.functions.paths import subreddit_of
from mentionlake.sources.tables import write_once

RANGES = (
    "earliest_submission_created_utc", "latest_submission_created_utc",
    "earliest_comment_created_utc", "latest_comment_created_utc",
)


def _measures(kind: str) -> list[Column]:
    return [
        F.count("*").alias(f"{kind}s_count"),
        F.min("created_utc").alias(f"earliest_{kind}_created_utc"),
        F.max("created_utc").alias(f"latest_{kind}_created_utc"),
    ]


def submission_metrics(df: DataFrame) -> DataFrame:
    return df.groupBy("subreddit").agg(*_measures("submission"))


def comment_metrics(df: DataFrame) -> DataFrame:
    """Comments do not state their subreddit; it is taken from the file path."""
    return df.groupBy(subreddit_of("source_file").alias("subreddit")).agg(*_measures("comment"))


def run_metrics(merged: DataFrame) -> DataFrame:
    """Totals of a run in one row; ranges ignore missing values."""
    return merged.agg(
        F.coalesce(F.sum("submissions_count"), F.lit(0)).alias("total_submissions"),
        F.coalesce(F.sum("comments_count"), F.lit(0)).alias("total_comments"),
        F.count("*").alias("subreddits_processed"),
        *[(F.min if c.startswith("earliest") else F.max)(c).alias(c) for c in RANGES],
    ).withColumns(spans())


def spans() -> dict[str, Column]:
    """Seconds between first and last record; null unless both are known."""
    return {
        f"{kind}_span_seconds": F.col(f"latest_{kind}_created_utc") - F.col(f"earliest_{kind}_created_utc")
        for kind in ("submission", "comment")
    }


def listing_summary(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Counts and ranges per (subreddit, sort type) of a listing run."""
    keys = ["subreddit", "sort_type"]
    s = submissions.groupBy(*keys).agg(*_measures("submission"))
    c = comments.groupBy(*keys).agg(*_measures("comment"))
    joined = s.join(c, keys, "full")
    return joined.withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("submissions_count", "comments_count")}
    )


# Metric name, the column behind it and its unit.
LISTING_METRICS = (
    ("SubmissionsFetched", "submissions_count", "Count"),
    ("CommentsFetched", "comments_count", "Count"),
    ("SubmissionTimeSpanSeconds", "submission_span_seconds", "Seconds"),
    ("EarliestSubmissionAge", "earliest_submission_created_utc", "None"),
    ("LatestSubmissionAge", "latest_submission_created_utc", "None"),
    ("CommentTimeSpanSeconds", "comment_span_seconds", "Seconds"),
)
RUN_METRICS = (
    ("SubmissionsProcessed", "total_submissions", "Count"),
    ("CommentsProcessed", "total_comments", "Count"),
    ("SubredditsProcessed", "subreddits_processed", "Count"),
    ("SubmissionTimeSpanSeconds", "submission_span_seconds", "Seconds"),
    ("CommentTimeSpanSeconds", "comment_span_seconds", "Seconds"),
)
GROUP_METRICS = (
    ("SubmissionsCount", "submissions_count", "Count"),
    ("CommentsCount", "comments_count", "Count"),
    ("EarliestSubmissionCreatedUtc", "earliest_submission_created_utc", "None"),
    ("LatestSubmissionCreatedUtc", "latest_submission_created_utc", "None"),
    ("EarliestCommentCreatedUtc", "earliest_comment_created_utc", "None"),
    ("LatestCommentCreatedUtc", "latest_comment_created_utc", "None"),
)
QUALITY_METRICS = {
    "submissions": ("SubmissionsTotal", "SubmissionsUsableForSentiment", "SubmissionsUsableRatio"),
    "comments": ("CommentsTotal", "CommentsUsableForSentiment", "CommentsUsableRatio"),
}


def long_metrics(df: DataFrame, keys: list[str], metrics: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """One row per metric; metrics without a value are left out."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"),
                F.col(column).cast("double").alias("value"),
                F.lit(unit).alias("unit"),
            )
            for name, column, unit in metrics
        ]
    )
    return df.select(*keys, F.inline(entries)).filter("value IS NOT NULL")


def listing_spans(summary: DataFrame) -> DataFrame:
    return long_metrics(summary.withColumns(spans()), ["subreddit", "sort_type"], LISTING_METRICS)


def run_metric_rows(merged: DataFrame) -> DataFrame:
    """Metrics of the whole run and of each subreddit."""
    total = run_metrics(merged).withColumns({"scope": F.lit("AGGREGATE"), "subreddit": F.lit(None).cast("string")})
    groups = merged.withColumn("scope", F.lit("SUBREDDIT"))
    keys = ["scope", "subreddit"]
    return long_metrics(total, keys, RUN_METRICS).unionByName(long_metrics(groups, keys, GROUP_METRICS))


def quality_metric_rows(ratios: DataFrame) -> DataFrame:
    """The ``usable_ratio`` rows of both kinds as metrics."""
    parts = []
    for kind, (total, usable, ratio) in QUALITY_METRICS.items():
        metrics = ((total, "total", "Count"), (usable, "usable", "Count"), (ratio, "ratio", "Count"))
        parts.append(long_metrics(ratios.filter(F.col("kind") == kind), [], metrics))
    rows = parts[0].unionByName(parts[1])
    return rows.withColumns({"scope": F.lit("AGGREGATE"), "subreddit": F.lit(None).cast("string")})


def record(
    rows: DataFrame, table: str, environment: str, job: str, process_date: str | None, run_id: str
) -> None:
    """Write a run's rows to the metrics table; a run id that occurs again replaces its rows."""
    write_once(as_recorded(rows, environment, job, process_date, run_id), table, {"job": job, "run_id": run_id})


def as_recorded(
    rows: DataFrame, environment: str, job: str, process_date: str | None, run_id: str
) -> DataFrame:
    """Rows of the metrics table. A run over all dates is recorded as ``ALL``."""
    return rows.select(
        F.lit(environment).alias("environment"),
        F.lit(job).alias("job"),
        F.lit(process_date or "ALL").alias("process_date"),
        F.lit(run_id).alias("run_id"),
        "scope", "subreddit", "metric", "value", "unit",
        F.current_timestamp().alias("recorded_at"),
    )
