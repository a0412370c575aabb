"""Bronze to the silver submissions and comments."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators import metrics
from mentionlake.operators.context import silver_comments
from mentionlake.operators.quality import silver_submissions, usable_ratio
from mentionlake.plans.layout import Lake
from mentionlake.sources.tables import clear_partitions, overwrite_partitions, partition_values


def of_dates(df: DataFrame, dates: Sequence[str] | None, column: str = "partition_date") -> DataFrame:
    return df if dates is None else df.filter(F.col(column).isin(list(dates)))


def run_silver_core(
    spark: SparkSession,
    lake: Lake,
    dates: Sequence[str] | None = None,
    submission_scope: str = "all",
    submission_thresholds: dict[str, int] | None = None,
    comment_thresholds: dict[str, int] | None = None,
    run_id: str | None = None,
) -> bool:
    """Rebuild silver for the given dates (all if None); False if there is no input.

    A date that bronze no longer holds, because its rows moved on, is cleared.
    ``submission_scope="partition"`` looks for a comment's submission only among the
    given dates, ``"all"`` in the whole table.
    """
    bronze_s = spark.table(lake.bronze_table("submissions"))
    bronze_c = spark.table(lake.bronze_table("comments"))
    submissions, comments = of_dates(bronze_s, dates), of_dates(bronze_c, dates)
    if submissions.isEmpty() and comments.isEmpty() and not dates:
        return False
    lookup = submissions if submission_scope == "partition" else bronze_s
    outputs = {
        "submissions": silver_submissions(submissions, **(submission_thresholds or {})),
        "comments": silver_comments(comments, lookup, **(comment_thresholds or {})),
    }
    for kind, rows in outputs.items():
        overwrite_partitions(rows, lake.silver_table(kind))
        _clear_emptied(spark, lake, kind, dates)
    written = {kind: of_dates(spark.table(lake.silver_table(kind)), dates) for kind in outputs}
    ratios = usable_ratio(written["submissions"], "submissions").unionByName(
        usable_ratio(written["comments"], "comments")
    )
    label = ",".join(dates) if dates else None
    rows = metrics.quality_metric_rows(ratios)
    metrics.record(rows, lake.metrics, lake.environment, "silver_core", label, run_id or uuid.uuid4().hex)
    return True


def _clear_emptied(spark: SparkSession, lake: Lake, kind: str, dates: Sequence[str] | None) -> None:
    """Clear dates that silver holds and bronze does not. Reads partition names only."""
    gone = partition_values(spark, lake.silver_table(kind)) - partition_values(spark, lake.bronze_table(kind))
    clear_partitions(spark, lake.silver_table(kind), sorted(gone & set(dates) if dates is not None else gone))
