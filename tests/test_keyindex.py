import random

import pytest

from mentionlake.operators import keyindex, merge
from mentionlake.sources.tables import append, ensure_table
from pyspark.sql.types import StructType

SCHEMA = "id string, updated_at bigint, partition_date string"


@pytest.fixture
def table(spark, lake):
    name = f"{lake.ops}.indexed"
    ensure_table(spark, name, StructType.fromDDL(SCHEMA), lake.path(name), ["partition_date"])
    return name


def upsert(spark, table, *rows):
    return merge.merge_into_table(spark, table, spark.createDataFrame(list(rows), SCHEMA), "id", "updated_at")


def partitions_read(spark, df):
    """How many folders a scan selects."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        plan = df._jdf.queryExecution().executedPlan()
        df.collect()
        leaves = plan.collectLeaves()
        return leaves.apply(0).metrics().apply("numPartitions").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_batch_reads_one_percent_of_the_buckets(spark, table, monkeypatch):
    monkeypatch.setattr(keyindex, "LEAST_BUCKETS", 300)
    rows = spark.range(6000).selectExpr("concat('k', id) id", "1L updated_at", "concat('0', id % 3 + 1, '-01-2024') partition_date")
    append(rows, table)
    index = merge.key_index(spark, table, ["id"])
    index.refresh()
    batch = spark.createDataFrame([("k17", 2, "01-01-2024"), ("k4000", 2, "01-01-2024"), *((f"new{i}", 2, "01-01-2024") for i in range(50))], SCHEMA)
    met = index.buckets_met(batch)
    assert 2 <= len(met) <= 3
    entries = index.read("entries", met)
    assert partitions_read(spark, entries) == len(met)
    assert "PartitionFilters: [" in entries._jdf.queryExecution().executedPlan().toString() and "bucket" in entries._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in index.places(batch).collect()} == {("k17", "03-01-2024"), ("k4000", "02-01-2024")}
    assert index.places(spark.createDataFrame([("zzz", 1, "01-01-2024")], SCHEMA)) is None


def test_the_index_finds_what_a_scan_finds(spark, table, monkeypatch, rows):
    monkeypatch.setattr(keyindex, "MOST_FOLDERS", 3)
    random.seed(2)
    state = {}
    for version in range(1, 8):
        batch = {f"k{random.randrange(60)}": (version, f"0{random.randrange(1, 6)}-01-2024") for _ in range(8)}
        df = spark.createDataFrame([(k, *v) for k, v in batch.items()], SCHEMA)
        before = {p for k, (_, p) in state.items() if k in batch} | {p for _, p in batch.values()}
        assert set(merge.touched_partitions(spark.table(table), df, ["id"], "partition_date")) == before
        assert before <= set(merge.merge_into_table(spark, table, df, "id", "updated_at"))
        state.update(batch)
        assert rows(spark.table(table), "id", "updated_at", "partition_date") == sorted((k, *v) for k, v in state.items())
    assert len(merge.key_index(spark, table, ["id"]).state["folders"]) <= 4


def test_buckets_follow_the_number_of_keys(spark, table, monkeypatch, rows):
    monkeypatch.setattr(keyindex, "KEYS_PER_BUCKET", 4)
    upsert(spark, table, ("a", 1, "01-01-2024"))
    upsert(spark, table, *((f"k{i}", 1, "01-01-2024") for i in range(60)))
    assert merge.key_index(spark, table, ["id"]).state["buckets"] == 16
    assert upsert(spark, table, ("k7", 2, "02-01-2024")) == ["01-01-2024", "02-01-2024"]
    assert spark.table(table).count() == 61


def test_what_others_write_is_indexed_again(spark, table, rows):
    upsert(spark, table, ("a", 1, "01-01-2024"))
    append(spark.createDataFrame([("b", 1, "02-01-2024"), ("c", 1, "02-01-2024")], SCHEMA), table)
    upsert(spark, table, ("b", 2, "03-01-2024"), ("c", 2, "03-01-2024"))
    assert rows(spark.table(table), "id", "updated_at", "partition_date") == [("a", 1, "01-01-2024"), ("b", 2, "03-01-2024"), ("c", 2, "03-01-2024")]


def test_a_stop_after_the_index_is_written_loses_nothing(spark, table, rows, monkeypatch):
    upsert(spark, table, ("a", 1, "01-01-2024"), ("b", 1, "01-01-2024"))

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(merge, "prepare", stop)
    with pytest.raises(RuntimeError):
        upsert(spark, table, ("a", 2, "02-01-2024"))
    monkeypatch.undo()
    assert upsert(spark, table, ("a", 3, "04-01-2024")) == ["01-01-2024", "02-01-2024", "04-01-2024"]
    assert rows(spark.table(table), "id", "updated_at", "partition_date") == [("a", 3, "04-01-2024"), ("b", 1, "01-01-2024")]
