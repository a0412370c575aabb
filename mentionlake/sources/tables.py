"""Parquet tables in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionlake.session import delete_folder


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str | None = None,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[str, int] | None = None,
) -> None:
    """Create an empty zstd Parquet table unless it exists.

    The partition columns are declared, so their strings are never re-typed. ``bucket_by`` (column, buckets) keeps each file to one
    bucket of the column's hash: a join on that column then takes the table as it lies.
    """
    if table_exists(spark, name):
        return
    by_name = {field.name: field for field in schema.fields}
    order = [n for n in by_name if n not in partition_by] + list(partition_by)
    columns = ", ".join(f"`{n}` {by_name[n].dataType.simpleString()}" for n in order)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (compression 'zstd')"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if bucket_by:
        statement += f" CLUSTERED BY (`{bucket_by[0]}`) INTO {bucket_by[1]} BUCKETS"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def read_table(
    spark: SparkSession,
    name: str,
    process_date: str | None = None,
    date_column: str = "partition_date",
) -> DataFrame:
    return for_date(spark.table(name), process_date, date_column)


def for_date(
    df: DataFrame, process_date: str | None = None, date_column: str = "partition_date"
) -> DataFrame:
    """Rows of one date, or all rows; on a partitioned table this prunes folders."""
    return df if process_date is None else df.filter(F.col(date_column) == process_date)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gather rows by partition before a write.

    The rebalance hint makes adaptive execution split a partition that holds most
    of the rows and merge tiny ones, which a plain repartition would not do.
    """
    return df.hint("rebalance", *columns) if columns else df


OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _insert(df: DataFrame, name: str, overwrite: bool) -> None:
    """Insert by column name. An overwrite is always dynamic, whatever the session says:
    ``insertInto`` heeds only the session, whose default would empty the whole table.
    """
    spark = df.sparkSession
    keys = partition_columns(spark, name)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        clustered(df.select(*spark.table(name).columns), keys).write.insertInto(name, overwrite=overwrite)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def append(df: DataFrame, name: str) -> None:
    _insert(df, name, overwrite=False)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that occur in ``df``; leave all others as they are."""
    _insert(df, name, overwrite=True)


def write_once(df: DataFrame, name: str, key: dict[str, str]) -> None:
    """Write the rows of one batch or run, in place of those that an earlier attempt at it left.

    ``key`` gives the values of the table's partition columns; each batch has a partition of its own. A batch without
    rows leaves none, also where an earlier attempt had some.
    """
    spark = df.sparkSession
    if set(partition_columns(spark, name)) != set(key):
        raise ValueError(f"{name} is not partitioned by {', '.join(key)}")
    rows = df.withColumns({column: F.lit(value) for column, value in key.items()})
    if not rows.isEmpty():
        overwrite_partitions(rows, name)
        return
    spec = ", ".join(f"`{column}` = {quoted(value)}" for column, value in key.items())
    if not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").isEmpty():
        _clear(spark, name, [f"PARTITION ({spec})"])


def clear_partitions(spark: SparkSession, name: str, values: Sequence[str]) -> None:
    """Empty single partitions, files included, and drop them from the catalog."""
    if not values:
        return
    (key,) = partition_columns(spark, name)
    _clear(spark, name, [f"PARTITION (`{key}` = {quoted(value)})" for value in values])


def _clear(spark: SparkSession, name: str, specs: Sequence[str]) -> None:
    keys = partition_columns(spark, name)
    columns = [f for f in spark.table(name).schema.fields if f.name not in keys]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in columns)
    for spec in specs:
        spark.sql(f"INSERT OVERWRITE TABLE {name} {spec} SELECT {nothing} FROM range(0)")
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(specs)}")


def quoted(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partition_values(spark: SparkSession, name: str) -> set[str]:
    """Values of a table's one partition column, without the escapes of folder names; null is left out."""
    raw = (row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return {unquote(value) for value in raw if value not in ("null", "__HIVE_DEFAULT_PARTITION__")}


def replace_table(
    df: DataFrame, name: str, location: str | None = None, partition_by: Sequence[str] = ()
) -> None:
    """Create or replace a whole table; ``df`` may read that table.

    The rows are written to a folder of their own under ``location``. Only when they are complete does the catalog turn
    to it, in one step, and the folder before is removed. A job that stops earlier leaves the old table as it was.
    """
    spark = df.sparkSession
    base = (location or default_location(spark, name)).rstrip("/")
    fresh = f"{base}/run-{uuid.uuid4().hex}"
    writer = clustered(df, partition_by).write.format("parquet").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(fresh)
    before = location_of(spark, name)
    # Partitions keep places of their own, so a partitioned table is made anew; its old files stay until then.
    if before is None or partition_by or spark.table(name).schema != spark.read.parquet(fresh).schema:
        order = [f for f in df.schema.fields if f.name not in partition_by] + [f for f in df.schema.fields if f.name in partition_by]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in order)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd'){parts} LOCATION {quoted(fresh)}")
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(fresh)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    if before and before.rstrip("/") != fresh:
        delete_folder(spark, before, keep_if_contains=fresh)


def default_location(spark: SparkSession, name: str) -> str:
    """Where a table lies that is given no place: beside the others of its schema."""
    schema, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri.rstrip('/')}/{table}-runs"


def location_of(spark: SparkSession, name: str) -> str | None:
    if not table_exists(spark, name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0].data_type if rows else None


def stage(df: DataFrame, name: str) -> str:
    """Give rows a name that SQL of this session can use."""
    df.createOrReplaceTempView(name)
    return name


# Consumer name of each silver table.
MART_NAMES = {
    "reddit_comments": "comments_silver",
    "reddit_submissions": "submissions_silver",
    "reddit_sentiment": "sentiment_analysis",
    "smartphones_info": "dim_products_ref",
}


def register_mart_views(spark: SparkSession, silver: str, consumer: str) -> None:
    """Show the silver tables under their consumer names, without a copy."""
    ensure_schema(spark, consumer)
    for view, table in MART_NAMES.items():
        spark.sql(f"CREATE OR REPLACE VIEW {consumer}.{view} AS SELECT * FROM {silver}.{table}")
