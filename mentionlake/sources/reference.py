"""Product reference: CSV seed and the table made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mentionlake.sources.tables import replace_table, table_exists


def read_reference_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All columns as they are, plus the lower-case ``brand``."""
    reader = spark.read.option("header", "true")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return with_brand(reader.csv(path))


def with_brand(raw: DataFrame) -> DataFrame:
    return raw.withColumn("brand", F.lower("brand_name"))


def load_reference(
    spark: SparkSession,
    name: str,
    csv_path: str,
    location: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The reference table; seeded from the CSV while it is missing or empty."""
    if not table_exists(spark, name) or spark.table(name).isEmpty():
        replace_table(read_reference_csv(spark, csv_path, schema), name, location)
    return spark.table(name)
