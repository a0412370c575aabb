"""Where each listing was left off, per environment and subreddit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators.dedupe import latest_per_key
from mentionlake.operators.merge import replace_by_key
from mentionlake.plans.layout import Lake
from mentionlake.schemas import CHECKPOINTS
from mentionlake.sources.tables import replace_table, table_exists

# What identifies a record.
KEYS = ["environment", "subreddit", "checkpoint_type", "sort_type", "time_filter"]


def checkpoint_keys(records: DataFrame) -> DataFrame:
    """Subreddit trimmed; sort type and time filter count only if both are given."""
    both = (F.length("sort_type") > 0) & (F.length("time_filter") > 0)
    return records.withColumns(
        {"subreddit": F.trim("subreddit"), **{c: F.when(both, F.col(c)) for c in ("sort_type", "time_filter")}}
    )


def upsert_checkpoints(current: DataFrame, records: DataFrame) -> DataFrame:
    """``current`` after saving ``records``; a saved record replaces the one before."""
    keyed = checkpoint_keys(records).select(*CHECKPOINTS.names)
    return replace_by_key(current, latest_per_key(keyed, KEYS, "last_timestamp"), KEYS)


def save_checkpoint(spark: SparkSession, lake: Lake, records: DataFrame) -> None:
    name = lake.checkpoints
    if table_exists(spark, name):
        current = spark.table(name)
    else:
        current = spark.createDataFrame([], CHECKPOINTS)
    replace_table(upsert_checkpoints(current, records), name, lake.path(name))


def load_checkpoint(
    spark: SparkSession, lake: Lake, subreddit: str, checkpoint_type: str,
    sort_type: str | None = None, time_filter: str | None = None,
) -> DataFrame:
    """The matching record: one row or none."""
    wanted = {
        "environment": lake.environment,
        "subreddit": subreddit.strip(),
        "checkpoint_type": checkpoint_type,
        "sort_type": sort_type if sort_type and time_filter else None,
        "time_filter": time_filter if sort_type and time_filter else None,
    }
    rows = spark.table(lake.checkpoints)
    for column, value in wanted.items():
        rows = rows.filter(F.col(column).eqNullSafe(value))
    return rows
