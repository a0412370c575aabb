"""Landing files to the bronze tables."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators import metrics
from mentionlake.operators.checks import layer_counts
from mentionlake.operators.dedupe import latest_rows
from mentionlake.operators.joins import merge_metrics
from mentionlake.operators.merge import merge_into_table
from mentionlake.plans.layout import Lake
from mentionlake.session import Save, staging
from mentionlake.sources.landing import read_landing, split_corrupt
from mentionlake.sources.tables import write_once

KINDS = ("submissions", "comments")
TIEBREAK = ("source_sort_type", "source_file")


def land_batch(
    spark: SparkSession, lake: Lake, kind: str, landed: DataFrame, save: Save, source: str
) -> tuple[DataFrame, list[str]]:
    """Bring landed rows of one kind into bronze.

    Returns the latest row per id of this batch and the dates rewritten in bronze.
    The parsed lines are written once, so the files are parsed once. ``source`` names what was read: rejected lines
    replace those that the same source and kind left before.
    """
    good, bad = split_corrupt(save(landed.drop("awards"), f"landed-{kind}"))
    batch = save(latest_rows(save, good, "id", "updated_at", TIEBREAK, f"latest-{kind}"), f"batch-{kind}")
    touched = merge_into_table(spark, lake.bronze_table(kind), batch, "id", "updated_at", one_per_key=True)
    write_once(bad, lake.quarantine, {"batch": f"{kind}-{source}"})
    return batch, touched


def run_bronze(
    spark: SparkSession,
    lake: Lake,
    landing_root: str,
    process_date: str | None = None,
    file_globs: dict[str, str] | None = None,
    run_id: str | None = None,
) -> list[str]:
    """Upsert the landing files of one date, or all, and record the run's metrics.

    Returns the dates rewritten in bronze: the silver job must redo exactly those.
    """
    batches, touched = {}, set()
    with staging(spark, "bronze") as save:
        for kind in KINDS:
            file_glob = (file_globs or {}).get(kind)
            landed = read_landing(spark, landing_root, kind, process_date, file_glob)
            place = hashlib.sha256(f"{landing_root.rstrip('/')}\n{file_glob or ''}".encode()).hexdigest()[:16]
            source = f"{process_date or 'ALL'}-{place}"
            batches[kind], dates = land_batch(spark, lake, kind, landed, save, source)
            touched.update(dates)
        merged = merge_metrics(
            metrics.submission_metrics(batches["submissions"]), metrics.comment_metrics(batches["comments"])
        )
        rows = metrics.run_metric_rows(merged).unionByName(_rows_after(spark, lake))
        metrics.record(rows, lake.metrics, lake.environment, "bronze", process_date, run_id or uuid.uuid4().hex)
    return sorted(touched)


def _rows_after(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows of the bronze tables after the upsert, as metrics."""
    counted = layer_counts({f"Bronze{kind.title()}Rows": spark.table(lake.bronze_table(kind)) for kind in KINDS})
    return counted.select(
        F.lit("AGGREGATE").alias("scope"), F.lit(None).cast("string").alias("subreddit"),
        F.col("layer").alias("metric"), F.col("rows").cast("double").alias("value"), F.lit("Count").alias("unit"),
    )
