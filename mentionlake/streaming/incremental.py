"""New landing files only, each exactly once, into bronze."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mentionlake.plans.bronze import land_batch
from mentionlake.plans.layout import Lake
from mentionlake.session import staging
from mentionlake.sources.landing import CORRUPT, default_glob, landing_glob, landing_schema, with_audit


def landing_stream(
    spark: SparkSession, root: str, kind: str, file_glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    reader = (
        spark.readStream.schema(landing_schema(kind))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", file_glob or default_glob(kind))
        .option("recursiveFileLookup", "true")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_audit(reader.json(landing_glob(root)))


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what is there now and stop."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(each)
        .start()
    )
    query.awaitTermination()


def ingest_incremental(
    spark: SparkSession,
    lake: Lake,
    root: str,
    kind: str,
    checkpoint: str,
    file_glob: str | None = None,
    max_files: int | None = None,
) -> list[str]:
    """Upsert the files that arrived since the last run; returns the dates rewritten.

    A batch replayed after a failure changes nothing: the upsert only takes newer versions, and rejected lines replace
    those of the batch's first attempt. A checkpoint started anew is another source.
    """
    touched: set[str] = set()

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # The id that the checkpoint keeps, so that a restart has it too.
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        with staging(session, "incremental") as save:
            touched.update(land_batch(session, lake, kind, batch, save, f"stream-{stream}-{number}")[1])

    try:
        drain(landing_stream(spark, root, kind, file_glob, max_files), checkpoint, each)
    finally:
        # Batches run in a session of their own; this one may have listed the files before.
        for table in (lake.bronze_table(kind), lake.quarantine):
            spark.catalog.refreshTable(table)
    return sorted(touched)
