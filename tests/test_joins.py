import random

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import context, joins
from mentionlake.operators.quality import FLAG


def literal_or_join(left, right):
    out = []
    for row in left:
        hits = [r for r in right if r[0] is not None and r[0] in (row[1], row[2])]
        out += [(*row, r[1]) for r in hits] or [(*row, None)]
    return out


def as_sorted(values):
    return sorted(values, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("unique", [True, False])
def test_or_join_equals_the_literal_one(spark, rows, seed, unique):
    rng = random.Random(seed)
    keys = [None, "", *"abcdefgh"]
    left = [(i, rng.choice(keys), rng.choice(keys)) for i in range(80)]
    left += left[:5]  # equal rows on the left
    right = [(k, f"v{i}") for i, k in enumerate([*"abcde", "zz"])]
    if not unique:
        right += [("a", "again"), (None, "null key"), ("b", "again")]
    df = spark.createDataFrame(left, "n int, k1 string, k2 string")
    lookup = spark.createDataFrame(right, "key string, value string")
    got = joins.or_join(df, F.col("k1"), F.col("k2"), lookup, "key", unique=unique)
    assert rows(got) == as_sorted(literal_or_join(left, right))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("unique", [True, False])
def test_or_join_can_prefer_the_first_key(spark, rows, unique):
    left = [(1, "a", "b"), (2, "x", "b"), (3, "x", "y"), (4, None, "a"), (5, "a", None), (6, None, None), (7, "a", "a")]
    df = spark.createDataFrame(left, "n int, k1 string, k2 string")
    lookup = spark.createDataFrame([("a", "A"), ("b", "B")], "key string, value string")
    got = joins.or_join(df, F.col("k1"), F.col("k2"), lookup, "key", prefer_first=True, unique=unique)
    assert rows(got, "n", "value") == as_sorted(
        [(1, "A"), (2, "B"), (3, None), (4, "A"), (5, "A"), (6, None), (7, "A")]
    )


def comments(spark):
    data = [
        ("c1", "t3_s1", "t3_s1", "first body", True), ("c2", "t3_s1", "t1_c1", "second body", True),
        ("c3", "t3_s1", "t1_c2", "third body", True), ("c4", "t3_gone", "t3_gone", "lost", True),
        ("c5", None, None, "loose", True), ("c6", "t3_s1", "t1_gone", "sixth", True), ("c7", "t3_s1", "t3_s1", "bad", False),
    ]
    df = spark.createDataFrame(data, f"id string, link_id string, parent_id string, body string, {FLAG} boolean")
    return df.withColumn("partition_date", F.lit("05-01-2024"))


def posts(spark):
    return spark.createDataFrame(
        [("s1", "t3_s1", "phones", "title", "text")], "id string, fullname_id string, subreddit string, title string, selftext string"
    )


def test_every_comment_keeps_its_row(spark, rows):
    got = context.with_subreddit(comments(spark), posts(spark))
    assert rows(got, "id", "subreddit") == [
        (c, "phones" if c not in ("c4", "c5") else None) for c in ("c1", "c2", "c3", "c4", "c5", "c6", "c7")
    ]
    assert got.columns == [*comments(spark).columns, "subreddit"]


def test_context_and_parent(spark, rows):
    ctx = context.build_context(comments(spark), posts(spark))
    got = context.with_parent_body(ctx, comments(spark))
    assert rows(got, "comment_id", "submission_id", "parent_body") == [
        ("c1", "s1", None), ("c2", "s1", "first body"), ("c3", "s1", "second body"), ("c6", "s1", None),
    ]
    done = spark.createDataFrame([("c1",), ("c1",), ("c9",)], "comment_id string")
    assert rows(context.only_new(ctx, done), "comment_id") == [("c2",), ("c3",), ("c6",)]


def test_metric_sides(spark, rows):
    s = spark.createDataFrame([("a", 2, 1, 9)], "subreddit string, submissions_count bigint, earliest_submission_created_utc bigint, latest_submission_created_utc bigint")
    c = spark.createDataFrame([("b", 3, 4, 5)], "subreddit string, comments_count bigint, earliest_comment_created_utc bigint, latest_comment_created_utc bigint")
    got = joins.merge_metrics(s, c)
    assert rows(got, "subreddit", "submissions_count", "comments_count", "latest_submission_created_utc", "latest_comment_created_utc") == [
        ("a", 2, 0, 9, None), ("b", 0, 3, None, 5),
    ]


def test_grid(spark, rows):
    got = joins.grid_of(spark, ["phones", "tabs"], ["top", "new"], ["01-01-2024"])
    assert rows(got) == [(s, t, "01-01-2024") for s in ("phones", "tabs") for t in ("new", "top")]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
