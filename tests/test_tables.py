import pytest

from mentionlake.operators.checks import check_unique
from mentionlake.plans.layout import Lake
from mentionlake.schemas import PRODUCT_REFERENCE
from mentionlake.sources import reference, tables



def ledger(spark, *values):
    return spark.createDataFrame(list(values), "comment_id string, date_partition string")


def test_append_overwrite_and_clear(spark, lake, rows):
    t = lake.analysed
    tables.append(ledger(spark, ("a", "01-01-2024"), ("b", "02-01-2024")), t)
    tables.append(ledger(spark, ("c", "01-01-2024")), t)
    assert spark.table(t).count() == 3
    for _ in range(2):  # the same overwrite twice gives the same state
        tables.overwrite_partitions(ledger(spark, ("d", "01-01-2024")), t)
    assert rows(spark.table(t)) == [("b", "02-01-2024"), ("d", "01-01-2024")]
    tables.clear_partitions(spark, t, ["01-01-2024"])
    assert rows(spark.table(t)) == [("b", "02-01-2024")]
    spark.sql(f"MSCK REPAIR TABLE {t}")  # the files are gone, not just the entry
    assert rows(spark.table(t)) == [("b", "02-01-2024")]


def test_overwrite_does_not_depend_on_the_session(spark, lake, rows):
    spark.conf.set(tables.OVERWRITE_MODE, "static")
    try:
        tables.append(ledger(spark, ("a", "01-01-2024"), ("b", "02-01-2024")), lake.analysed)
        tables.overwrite_partitions(ledger(spark, ("c", "01-01-2024")), lake.analysed)
        assert rows(spark.table(lake.analysed)) == [("b", "02-01-2024"), ("c", "01-01-2024")]
        assert spark.conf.get(tables.OVERWRITE_MODE) == "static"
    finally:
        spark.conf.set(tables.OVERWRITE_MODE, "dynamic")


def test_one_date_is_a_partition_filter(spark, lake):
    tables.append(ledger(spark, ("a", "01-01-2024"), ("b", "02-01-2024")), lake.analysed)
    df = tables.read_table(spark, lake.analysed, "01-01-2024", "date_partition")
    assert [r[0] for r in df.collect()] == ["a"]
    assert "PartitionFilters: [isnotnull(date_partition" in df._jdf.queryExecution().toString()
    assert tables.read_table(spark, lake.analysed).count() == 2


def test_partition_strings_keep_their_type(spark, lake):
    tables.append(ledger(spark, ("a", "2024")), lake.analysed)
    assert dict(spark.table(lake.analysed).dtypes)["date_partition"] == "string"
    assert spark.table(lake.analysed).first()["date_partition"] == "2024"


def test_files_are_zstd(spark, lake, tmp_path):
    tables.append(ledger(spark, ("a", "01-01-2024")), lake.analysed)
    assert all(".zstd." in f for f in spark.table(lake.analysed).inputFiles())


def test_catalog_housekeeping(spark, lake):
    assert tables.table_exists(spark, lake.analysed)
    assert not tables.table_exists(spark, f"{lake.silver}.other")
    assert "analysed_comments" in [r.tableName for r in tables.list_tables(spark, lake.silver).collect()]
    assert "comment_id" in [r.col_name for r in tables.describe_table(spark, lake.analysed).collect()]
    tables.ensure_table(spark, lake.analysed, PRODUCT_REFERENCE)  # exists, so it stays
    assert spark.table(lake.analysed).columns == ["comment_id", "date_partition"]


def write_seed(path, models):
    path.mkdir(exist_ok=True)
    names = PRODUCT_REFERENCE.names
    lines = [",".join(names)] + [",".join(["Apple", m, "10.5"] + ["1"] * (len(names) - 3)) for m in models]
    (path / "seed.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def test_reference_is_seeded_once(spark, lake, tmp_path):
    first = write_seed(tmp_path / "one", ["X", "Y"])
    second = write_seed(tmp_path / "two", ["Z"])
    loaded = reference.load_reference(spark, lake.reference, first, lake.path(lake.reference))
    assert loaded.columns == [*PRODUCT_REFERENCE.names, "brand"]
    assert {r.brand for r in loaded.collect()} == {"apple"}
    again = reference.load_reference(spark, lake.reference, second, lake.path(lake.reference))
    assert sorted(r.model for r in again.collect()) == ["X", "Y"]
    inferred = reference.read_reference_csv(spark, first)
    assert dict(inferred.dtypes)["price"] == "double"


def test_replace_leaves_nothing_behind(spark, lake, rows):
    name = f"{lake.mart}.replaced"
    for data in ([("a", "x"), ("b", "y")], [("c", "x")]):
        df = spark.createDataFrame(data, "v string, part string")
        tables.replace_table(df, name, lake.path(name), ["part"])
    assert rows(spark.table(name)) == [("c", "x")]
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert rows(spark.table(name)) == [("c", "x")]


def test_a_table_is_whole_until_its_replacement_is(spark, lake, rows, monkeypatch):
    name = f"{lake.mart}.safe"
    tables.replace_table(spark.createDataFrame([("a", 1)], "v string, n int"), name, lake.path(name))
    broken = spark.table(name).selectExpr("v", "assert_true(n > 5) IS NULL AS ok", "n").select("v", "n", "ok")
    with pytest.raises(Exception, match="assert_true|USER_RAISED"):
        tables.replace_table(broken, name, lake.path(name))
    assert rows(spark.table(name)) == [("a", 1)]

    def stop(*_, **__):
        raise RuntimeError("stopped before the switch")

    monkeypatch.setattr(tables, "location_of", stop)
    with pytest.raises(RuntimeError):
        tables.replace_table(spark.table(name).selectExpr("v", "n + 1 AS n"), name, lake.path(name))
    monkeypatch.undo()
    assert rows(spark.table(name)) == [("a", 1)]
    tables.replace_table(spark.table(name).selectExpr("v", "n + 1 AS n"), name, lake.path(name))
    assert rows(spark.table(name)) == [("a", 2)]


def test_partition_values_are_quoted_and_unescaped(spark, lake, rows):
    name = f"{lake.mart}.odd"
    odd = ["plain", "it's", "50%", "a/b", "back\\slash", "x=y"]
    tables.ensure_table(spark, name, spark.createDataFrame([], "v int, part string").schema, lake.path(name), ["part"])
    tables.append(spark.createDataFrame(list(enumerate(odd)), "v int, part string"), name)
    assert tables.partition_values(spark, name) == set(odd)
    tables.clear_partitions(spark, name, odd[1:])
    assert rows(spark.table(name)) == [(0, "plain")] and tables.partition_values(spark, name) == {"plain"}


def test_mart_views_show_silver_without_copy(spark, lake, tmp_path):
    reference.load_reference(spark, lake.reference, write_seed(tmp_path / "s", ["X"]), lake.path(lake.reference))
    consumer = f"{lake.mart}_views"
    tables.register_mart_views(spark, lake.silver, consumer)
    assert spark.table(f"{consumer}.smartphones_info").count() == 1
    assert spark.table(f"{consumer}.reddit_comments").columns == spark.table(lake.silver_table("comments")).columns


def test_staged_view(spark):
    name = tables.stage(spark.range(3), "staged_rows")
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 3


def test_lake_paths():
    lake = Lake("/data/")
    assert lake.path(lake.sentiment) == "/data/silver/sentiment_analysis"


def test_check_unique(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(check_unique(df, "k")) == [("a", 2)]
