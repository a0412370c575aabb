"""Landing zone: JSON lines under ``{sort}/subreddit={name}/date={dd-MM-yyyy}/``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mentionlake.functions.paths import path_part, sort_type_of, subreddit_of, unescaped
from mentionlake.schemas import AUDIT, LANDING

CORRUPT = "_corrupt_record"


def default_glob(kind: str) -> str:
    """Matches rotated and written parts (``submissions.part1.jsonl``, ``submissions-00000-x.json``), not the other kind."""
    return f"{kind}*.json*"


def landing_schema(kind: str) -> StructType:
    return StructType([*LANDING[kind].fields, StructField(CORRUPT, StringType())])


def landing_glob(root: str, process_date: str | None = None) -> str:
    """The date goes into the path, so files of other dates are not even listed."""
    return f"{root.rstrip('/')}/*/subreddit=*/date={process_date or '*'}"


def read_landing(
    spark: SparkSession,
    root: str,
    kind: str,
    process_date: str | None = None,
    file_glob: str | None = None,
) -> DataFrame:
    """Landing rows of one kind with audit columns and the raw text of bad lines.

    Unknown fields are ignored; a field of the wrong type is null. Where nothing has
    landed there are no rows.
    """
    reader = (
        spark.read.schema(landing_schema(kind))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", file_glob or default_glob(kind))
        .option("recursiveFileLookup", "true")
    )
    try:
        return with_audit(reader.json(landing_glob(root, process_date)))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], StructType([*landing_schema(kind).fields, *AUDIT.fields]))


def with_audit(raw: DataFrame) -> DataFrame:
    """Add the audit columns; ``raw`` must be a file scan.

    A subreddit that the line itself does not state is taken from the path.
    """
    path = F.col("_metadata.file_path")
    audited = raw.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        path.alias("source_file"),
        sort_type_of(path).alias("source_sort_type"),
        path_part(path, "date").alias("partition_date"),
    )
    if "subreddit" not in raw.columns:
        return audited
    return audited.withColumn("subreddit", F.coalesce("subreddit", subreddit_of("source_file")))


def split_corrupt(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to keep, and lines set aside with the reason.

    A line that is no complete JSON is set aside even if its first fields could be
    read. So is a record without an id. A complete record with a field of the wrong
    type is kept.
    """
    line = F.col(CORRUPT)
    malformed = line.isNotNull() & F.get_json_object(line, "$").isNull()
    reason = F.when(malformed, "malformed").when(F.col("id").isNull(), "no_id")
    marked = landed.withColumn("reason", reason)
    good = marked.filter("reason IS NULL").drop("reason", CORRUPT)
    bad = marked.filter("reason IS NOT NULL").select(
        "reason", line.alias("line"), "source_file", "ingestion_timestamp", "partition_date"
    )
    return good, bad


def write_landing(df: DataFrame, root: str, kind: str, max_lines: int = 100_000, mode: str = "append") -> None:
    """Write rows holding ``sort_type``, ``subreddit`` and ``date`` as landing files of one kind.

    File names begin with the kind, so both kinds can lie under one root. A file ends after ``max_lines`` lines. The rebalance hint gathers each folder
    into few files and splits a folder that is far larger than the others.
    """
    keys = ["sort_type", "subreddit", "date"]
    (
        df.hint("rebalance", *keys)
        .write.mode(mode)
        .partitionBy(*keys)
        .option("maxRecordsPerFile", max_lines)
        .option("mapreduce.output.basename", kind)
        .json(root)
    )


def infer_landing_schema(
    spark: SparkSession, root: str, kind: str, file_glob: str | None = None
) -> StructType:
    return (
        spark.read.option("pathGlobFilter", file_glob or default_glob(kind))
        .option("recursiveFileLookup", "true")
        .json(landing_glob(root))
        .schema
    )


def discover_landing(
    spark: SparkSession, root: str, kind: str, file_glob: str | None = None
) -> DataFrame:
    """One row per landing folder of a kind. Only file names and sizes are read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", file_glob or default_glob(kind))
        .option("recursiveFileLookup", "true")
        .load(landing_glob(root))
    )
    return files.groupBy(
        sort_type_of("path").alias("sort_type"),
        unescaped(path_part("path", "subreddit")).alias("subreddit"),
        path_part("path", "date").alias("partition_date"),
    ).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
