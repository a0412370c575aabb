"""Versioned upsert into a Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionlake.operators.dedupe import first_rows, latest_per_key, row_digest
from mentionlake.operators.keyindex import KeyIndex
from mentionlake.session import Save, delete_folder, path_exists, staging
from mentionlake.sources.tables import clear_partitions, location_of, overwrite_partitions


def merge_latest(
    target: DataFrame,
    source: DataFrame,
    key: str | Sequence[str],
    version: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """``target`` after an upsert of ``source``.

    A source row replaces the target row of its key if its version is higher; ties
    and missing versions keep the target row. New keys are added. Rows without a
    key match nothing and stay, on both sides.

    Both sides go through one shuffle on the key. Copies of a key in the source
    are reduced to the latest before it. If the target holds a key twice, as after
    an interrupted run, one row is left.
    """
    keys = [key] if isinstance(key, str) else list(key)
    both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)))
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    unversioned_target = (F.col("_side") == 0) & F.col(version).isNull()
    order = [
        unversioned_target.desc(),
        F.col(version).desc_nulls_last(),
        F.col("_side"),
        *[F.col(c) for c in tiebreak],
        row_digest(source),
    ]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    winners = both.filter(has_key).withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    return winners.unionByName(both.filter(~has_key)).drop("_side")


def merged_rows(
    save: Save, target: DataFrame, source: DataFrame, keys: Sequence[str], version: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """``merge_latest`` of file scans, which shuffles few whole rows. No source row is without a key."""
    both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)))
    told = {
        "_unversioned": (F.col("_side") == 0) & F.col(version).isNull(), "_version": F.col(version),
        **{f"_tie{i}": F.col(c) for i, c in enumerate(tiebreak)}, "_digest": row_digest(source), "_of": F.col("_side"),
    }
    order = [
        F.col("_unversioned").desc(), F.col("_version").desc_nulls_last(), F.col("_of"),
        *[F.col(f"_tie{i}") for i in range(len(tiebreak))], F.col("_digest"),
    ]
    winners = first_rows(save, both.filter(_all_set(keys)), keys, told, order, "merge")
    return winners.unionByName(target.filter(~_all_set(keys)).withColumn("_side", F.lit(0))).drop("_side")


def _all_set(keys: Sequence[str]) -> Column:
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    return has_key


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], partition: str) -> list[str | None]:
    """Partitions of the source, and those where the target holds a source key, without an index.

    Reads two columns of the target. The list is as long as the number of dates.
    """
    of_target = target.select(*keys, partition).join(source.select(*keys), list(keys), "left_semi")
    rows = source.select(partition).unionByName(of_target.select(partition)).distinct().collect()
    return [row[0] for row in rows]


def merge_into_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str | Sequence[str],
    version: str,
    partition: str = "partition_date",
    tiebreak: Sequence[str] = (),
    one_per_key: bool = False,
) -> list[str]:
    """Upsert ``source`` into a table partitioned by date; returns the dates rewritten.

    An update may move a row to another date, so the old date is rewritten too, or
    cleared if nothing is left of it. Only touched partitions are read in full.
    Where the keys of the batch lie is read from an index beside the table (``KeyIndex``), which costs what the batch meets.
    The new content of these dates is first written whole beside the table. An upsert that finds such content,
    left by a run that was stopped while it replaced partitions, completes that run before its own, so no row is
    lost wherever a run stops. Rows without a key are left out. ``source`` is read several times and should be a
    file scan; ``one_per_key`` says that it holds no key twice.
    """
    finish_interrupted(spark, table, partition)
    keys = [key] if isinstance(key, str) else list(key)
    batch = source.dropna(subset=keys).select(*spark.table(table).columns)
    if not one_per_key:
        batch = latest_per_key(batch, keys, version, tiebreak)
    index = key_index(spark, table, keys, partition)
    index.refresh()
    places = index.places(batch)
    dates = batch.select(F.col(partition).alias("place"))
    found = [row[0] for row in (dates if places is None else dates.unionByName(places.select("place"))).distinct().collect()]
    if not found:
        return []
    index.announce(batch, places)
    touched = sorted(date for date in found if date)
    in_touched = F.col(partition).isin(touched)
    if len(touched) < len(found):
        in_touched = in_touched | F.col(partition).isNull()
    current = spark.table(table).filter(in_touched)
    with staging(spark, "merge") as save:
        prepare(spark, table, merged_rows(save, current, batch, keys, version, tiebreak), touched)
    finish_interrupted(spark, table, partition)
    index.settle(spark.table(table), found)
    return touched


def key_index(spark: SparkSession, table: str, keys: Sequence[str], partition: str = "partition_date") -> KeyIndex:
    return KeyIndex(spark.table(table), f"{location_of(spark, table).rstrip('/')}/_keys", keys, partition)


def pending_folder(spark: SparkSession, table: str) -> str:
    return f"{location_of(spark, table).rstrip('/')}/_pending"


def prepare(spark: SparkSession, table: str, merged: DataFrame, touched: Sequence[str]) -> None:
    """Write the new content of the touched dates beside the table. It counts once its rows are complete."""
    folder = pending_folder(spark, table)
    delete_folder(spark, folder)
    spark.createDataFrame([(date,) for date in touched], "date string").coalesce(1).write.parquet(f"{folder}/dates")
    merged.write.option("compression", "zstd").parquet(f"{folder}/rows")


def finish_interrupted(spark: SparkSession, table: str, partition: str = "partition_date") -> None:
    """Put prepared content into the table, any number of times with the same result; drop it if it is not complete."""
    folder = pending_folder(spark, table)
    if path_exists(spark, f"{folder}/rows/_SUCCESS"):
        rows = spark.read.schema(spark.table(table).schema).parquet(f"{folder}/rows")
        overwrite_partitions(rows, table)
        left = {row[0] for row in rows.select(partition).distinct().collect()}
        touched = {row[0] for row in spark.read.parquet(f"{folder}/dates").collect()}
        clear_partitions(spark, table, sorted(touched - left))
    delete_folder(spark, folder)


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert where the source always wins; missing key parts equal each other."""
    same = F.lit(True)
    t, s = target.alias("t"), source.alias("s")
    for k in keys:
        same = same & F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}"))
    return t.join(s, same, "left_anti").unionByName(source)
