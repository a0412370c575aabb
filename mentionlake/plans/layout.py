"""Names and folders of the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from mentionlake import schemas
from mentionlake.sources.tables import ensure_schema, ensure_table


@dataclass(frozen=True)
class Lake:
    """Where the tables live. ``location`` is a folder all executors reach."""

    location: str
    bronze: str = "bronze"
    silver: str = "silver"
    mart: str = "mart"
    ops: str = "ops"
    environment: str = "prod"
    #: Buckets of what is remembered by comment. A bucket of each is read by one task, so choose as many as its bytes need.
    comment_buckets: int = 8

    def bronze_table(self, kind: str) -> str:
        return f"{self.bronze}.{kind}"

    def silver_table(self, kind: str) -> str:
        return f"{self.silver}.{kind}_silver"

    @property
    def sentiment(self) -> str:
        return f"{self.silver}.sentiment_analysis"

    @property
    def analysed(self) -> str:
        return f"{self.silver}.analysed_comments"

    @property
    def reference(self) -> str:
        return f"{self.silver}.dim_products_ref"

    @property
    def metrics(self) -> str:
        return f"{self.ops}.run_metrics"

    @property
    def quarantine(self) -> str:
        return f"{self.ops}.rejected_lines"

    @property
    def checkpoints(self) -> str:
        return f"{self.ops}.ingest_checkpoints"

    def path(self, table: str) -> str:
        schema, name = table.split(".")
        return f"{self.location.rstrip('/')}/{schema}/{name}"


def create_tables(spark: SparkSession, lake: Lake) -> None:
    for schema in (lake.bronze, lake.silver, lake.mart, lake.ops):
        ensure_schema(spark, schema, f"{lake.location.rstrip('/')}/{schema}")
    tables = {
        lake.bronze_table("submissions"): (schemas.bronze_schema("submissions"), ["partition_date"]),
        lake.bronze_table("comments"): (schemas.bronze_schema("comments"), ["partition_date"]),
        lake.silver_table("submissions"): (schemas.SUBMISSIONS_SILVER, ["partition_date"]),
        lake.silver_table("comments"): (schemas.COMMENTS_SILVER, ["partition_date"]),
        lake.sentiment: (schemas.SENTIMENT, ["date_partition"]),
        lake.analysed: (schemas.ANALYSED_LEDGER, ["date_partition"]),
        lake.metrics: (schemas.METRICS, ["job", "run_id"]),
        lake.quarantine: (schemas.QUARANTINE, ["batch"]),
    }
    for name, (schema, keys) in tables.items():
        by_comment = ("comment_id", lake.comment_buckets) if name in (lake.sentiment, lake.analysed) else None
        ensure_table(spark, name, schema, lake.path(name), keys, by_comment)
