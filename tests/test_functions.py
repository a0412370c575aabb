import pytest
from pyspark.sql import functions as F

from mentionlake.functions import dates, ids, paths, products, text


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("body, words", [
    (None, 0), ("", 0), ("   ", 0), ("a", 1), ("  a b ", 2), ("a\tb\n c", 3), ("\ta b", 3),
])
def test_word_count(spark, body, words):
    assert one(spark, "t string", (body,), text.word_count("t")) == words


@pytest.mark.parametrize("body", [
    None, "", "  ", "one", "a b", "a\n\nb c", "\na b c d", "x" * 500, "x" * 500 + " y", "x" * 500 + "\t\n" * 90 + "y z",
    "a " + "\n" * 300 + "b c d e f", "w " * 400, "é " * 70 + "ü",
])
@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_words_up_to_is_exact(spark, body, n):
    counted = one(spark, "t string", (body,), text.word_count("t"))
    assert one(spark, "t string", (body,), text.words_up_to("t", n)) == min(counted, n)


@pytest.mark.parametrize("body, usable", [
    (None, False), ("", False), ("[deleted]", False), ("[removed]", False), (" " * 40, False),
    ("[deleted] but this one has enough words", True),
    ("aaaa bbbb cccc dddd eeeeeeeee", False),  # 29 characters
    ("aaaa bbbb cccc dddd eeeeeeeeee", True),  # 30 characters
    ("aaaaaaaaaa bbbbbbbbbb cccccccccc dddddddddd", False),  # 4 words
    ("  aaaa bbbb cccc dddd eeeeeeeee  ", False),  # 29 once trimmed
])
def test_comment_flag(spark, body, usable):
    assert one(spark, "t string", (body,), text.comment_usable("t")) is usable


@pytest.mark.parametrize("title, selftext, usable", [
    ("A long and telling title", None, False), ("A long and telling title", "[removed]", False),
    ("A long and telling title", "", False), ("abc", "def", False), ("abcdefgh", "ij", True),
    (None, "abcdefghij", False), (None, "abcde fghij", True), ("abcdefghijkl", " ", False),
])
def test_submission_flag(spark, title, selftext, usable):
    column = text.submission_usable("a", "b")
    assert one(spark, "a string, b string", (title, selftext), column) is usable


def test_thresholds_are_parameters(spark):
    assert one(spark, "t string", ("abc de",), text.comment_usable("t", min_chars=6, min_words=2)) is True


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_epoch_does_not_depend_on_the_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1704067199,), (-1,)], "c bigint")
        got = df.select(dates.epoch_ts("c").cast("string"), dates.epoch_date("c").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in got] == [("2023-12-31 23:59:59", "2023-12-31"), ("1969-12-31 23:59:59", "1969-12-31")]


def test_partition_days_sort_by_time(spark):
    df = spark.createDataFrame([("31-01-2024",), ("01-02-2024",), ("bad",)], "d string")
    days = [r[0] for r in df.orderBy(dates.partition_day("d").desc_nulls_last()).collect()]
    assert days == ["01-02-2024", "31-01-2024", "bad"]


def test_ids(spark):
    df = spark.createDataFrame([("t3_ab_c",), ("t1_x",), ("plain",), (None,)], "l string")
    got = df.select(ids.short_id("l"), ids.submission_of("l"), ids.fullname("comment", "l")).collect()
    assert [tuple(r) for r in got] == [
        ("ab", "ab_c", "t1_t3_ab_c"), ("x", None, "t1_t1_x"), ("", None, "t1_plain"), (None, None, None),
    ]


def test_canonical_text_tells_nulls_and_joins_apart(spark):
    values = [("a", "b"), ("ab", ""), ("a|1:b", ""), (None, "b"), ("-", "b"), ("", "b"), (None, None)]
    df = spark.createDataFrame(values, "a string, b string")
    assert df.select(ids.canonical_text("a", "b").alias("t")).distinct().count() == len(values)


def test_paths(spark):
    path = "file:/lake/reddit/top/subreddit=phones/date=05-01-2024/submissions.part1.jsonl"
    other = "s3://b/land/sort_type=controversial/subreddit=a%3Ab+c/date=05-01-2024/part-0.json"
    df = spark.createDataFrame([(path,), (other,)], "p string")
    got = df.select(paths.sort_type_of("p"), paths.unescaped(paths.path_part("p", "subreddit")), paths.path_part("p", "date"))
    assert [tuple(r) for r in got.collect()] == [("top", "phones", "05-01-2024"), ("controversial", "a:b+c", "05-01-2024")]


def test_product_expressions(spark):
    df = spark.createDataFrame([(19999.9,), (20000.0,), (49999.0,), (50000.0,), (None,)], "p double")
    assert [r[0] for r in df.select(products.price_segment("p")).collect()] == [
        "Budget", "Midrange", "Midrange", "Flagship", "Flagship",
    ]
    flags = spark.createDataFrame([(1,), (0,), (2,), (None,)], "f int").select(products.as_flag("f"))
    assert [r[0] for r in flags.collect()] == [True, False, False, False]


def test_functions_are_not_python_udfs(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("t"))
    plan = df.select(text.comment_usable("t"), ids.analysis_id("t", "t", "t", "t", "t"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_short_id_by_bytes(spark):
    # Whole words, single bytes left over, bytes above 127, nulls and empty texts, on both engines.
    import duckdb

    from mentionlake.workload.oracle import murmur

    parts = [None, "", "a", "abcd", "abcde", "é", "漢字かな", "😀 x", "x" * 37, "ÿ\u007f"]
    data = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in parts for b in parts)]
    got = spark.createDataFrame(data, "i int, a string, b string").select("i", ids.analysis_id_murmur("a", "b", "a", "b"))
    con = duckdb.connect()
    con.execute("CREATE TABLE pairs (i INTEGER, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO pairs VALUES (?, ?, ?)", data)
    want = con.execute(f"SELECT i, CAST(murmur AS VARCHAR) FROM {murmur(['a', 'b', 'a', 'b'], 'pairs')}").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
