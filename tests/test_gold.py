import datetime

from pyspark.sql import functions as F

from mentionlake.plans import gold


def test_calendar(spark):
    days = {r.full_date.isoformat(): r for r in gold.dim_date(spark).collect()}
    assert len(days) == 11500 and min(days) == "2000-01-01" and max(days) == "2031-06-26"
    first, leap = days["2000-01-01"], days["2024-02-29"]
    assert (first.date_key, first.week_of_year, first.day_of_week, first.day_name, first.is_weekend) == (20000101, 52, 6, "Sat", True)
    assert days["2000-01-02"].day_of_week == 0
    assert (leap.date_key, leap.quarter, leap.month_name, leap.day_name, leap.is_weekend) == (20240229, 1, "Feb", "Thu", False)
    for day, row in days.items():
        want = datetime.date.fromisoformat(day)
        assert (row.week_of_year, row.day_of_week) == (want.isocalendar()[1], want.isoweekday() % 7)


def test_fact_keys(spark, rows):
    mentions = spark.createDataFrame([
        ("s1", "c1", "APPLE", "iphone"), ("s2", "c2", "apple", "iPhone"), ("s2", "c3", "nokia", "general"),
        ("s9", "c4", "apple", "iPhone"), ("s1", "gone", "apple", "iPhone"),
    ], "submission_id string, comment_id string, brand_name string, product_name string")
    mentions = mentions.withColumns({"aspect": F.lit("camera"), "sentiment_score": F.lit(0.5)})
    comments = spark.createDataFrame([
        ("c1", "t3_s1", 1704067200, 1), ("c2", "t3_s1", 1704153599, 2), ("c3", "t3_s3", 4000000000, 3), ("c4", None, None, 4),
    ], "id string, link_id string, created_utc bigint, score int")
    products = spark.createDataFrame([(7, "Apple", "iPhone"), (8, "Apple", "Other")], "product_key bigint, brand_name string, model string")
    posts = spark.createDataFrame([("s1", 1), ("s2", 2)], "reddit_submission_id string, submission_key bigint")
    fact = gold.fact_mentions(mentions, comments, products, posts, gold.dim_date(spark))
    got = rows(fact, "comment_id", "product_key", "submission_key", "date_key", "comment_score")
    assert got == sorted([
        ("c1", 7, 1, 20240101, 1), ("c2", 7, 1, 20240101, 2), ("c2", 7, 2, 20240101, 2), ("c3", None, 2, None, 3),
        ("c4", 7, None, None, 4), ("gone", 7, 1, None, None),
    ], key=lambda r: tuple((v is not None, str(v)) for v in r))
    preferred = gold.fact_mentions(mentions, comments, products, posts, gold.dim_date(spark), prefer_link=True)
    assert preferred.count() == mentions.count()


def test_case_only_and_repeated_products_fan_out(spark):
    mentions = spark.createDataFrame([("s", "c", "apple", "iphone", "a", 0.5)], "submission_id string, comment_id string, brand_name string, product_name string, aspect string, sentiment_score double")
    products = spark.createDataFrame([(1, "Apple", "iPhone"), (2, "APPLE", "IPHONE")], "product_key bigint, brand_name string, model string")
    comments = spark.createDataFrame([], "id string, link_id string, created_utc bigint, score int")
    posts = spark.createDataFrame([], "reddit_submission_id string, submission_key bigint")
    assert gold.fact_mentions(mentions, comments, products, posts, gold.dim_date(spark)).count() == 2
