"""Joins that need more than one equality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.operators.dedupe import row_digest


def or_join(
    left: DataFrame,
    first: Column,
    second: Column,
    right: DataFrame,
    key: str,
    prefer_first: bool = False,
    unique: bool = False,
) -> DataFrame:
    """``left`` LEFT JOIN ``right`` ON first = key OR second = key, as equi-joins.

    A row whose two keys match different right rows gives one row per match; with
    ``prefer_first`` the second key counts only if the first matches nothing. A
    row without a match is kept with nulls. A nested loop never occurs.

    ``unique`` says that ``right`` holds no key twice, as a dimension does. Then
    ``left`` is computed once; otherwise once per case.
    """
    payload = [c for c in right.columns if c != key]
    lookup = right.select(F.col(key).alias("_key"), *payload)
    two_keys = F.coalesce(first != second, F.lit(False))
    keyed = left.withColumns({"_first": F.coalesce(first, second), "_second": F.when(two_keys, second)})
    joined = _by_lookups if unique else _by_cases
    return joined(keyed, lookup, payload, prefer_first).select(*left.columns, *payload)


def _by_lookups(keyed: DataFrame, lookup: DataFrame, payload: list[str], prefer_first: bool) -> DataFrame:
    """Look up the first key, then the second where it differs."""
    found = keyed
    for n in ("_first", "_second"):
        # Rows without this key would all meet in one partition; a digest spreads them.
        spread = F.concat(F.lit("\0"), row_digest(keyed).cast("string"))
        by = f"{n}_by"
        side = lookup.select(F.col("_key").alias(f"{n}_key"), F.struct(*payload).alias(f"{n}_row"))
        found = found.withColumn(by, F.coalesce(n, spread)).join(
            side, (F.col(by) == F.col(f"{n}_key")) & F.col(n).isNotNull(), "left"
        )
    if prefer_first:
        return found.withColumn("_row", F.coalesce("_first_row", "_second_row")).select("*", "_row.*")
    rows = F.array_compact(F.array("_first_row", "_second_row"))
    return found.withColumn("_row", F.explode_outer(rows)).select("*", "_row.*")


def _by_cases(keyed: DataFrame, lookup: DataFrame, payload: list[str], prefer_first: bool) -> DataFrame:
    """Rows with one distinct key take the plain left join; only the others are looked up twice."""
    one, two = keyed.filter("_second IS NULL"), keyed.filter("_second IS NOT NULL")
    keys = lookup.select("_key")

    def joined(rows: DataFrame, by: str, how: str) -> DataFrame:
        return rows.join(keys if how == "left_anti" else lookup, F.col(by) == F.col("_key"), how)

    cases = [joined(one, "_first", "left")]
    unmatched_first = joined(two, "_first", "left_anti")
    if prefer_first:
        cases += [joined(two, "_first", "inner"), joined(unmatched_first, "_second", "left")]
    else:
        each = two.withColumn("_by", F.explode(F.array("_first", "_second")))
        unmatched = joined(unmatched_first, "_second", "left_anti")
        cases += [joined(each, "_by", "inner"), unmatched]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cases)


def merge_metrics(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """Both sides' metrics per subreddit: missing counts are 0, missing ranges null."""
    joined = submissions.join(comments, "subreddit", "full")
    counts = ["submissions_count", "comments_count"]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def expected_grid(groups: DataFrame, sort_types: Sequence[str], dates: DataFrame | Sequence[str]) -> DataFrame:
    """Every (group, sort type, date) that should have landed.

    ``dates`` is a list, or a table with one column of them, whose distinct dates become the one value of a
    subquery, so nothing is run while the plan is made and nothing is joined.
    """
    typed = groups.withColumn("sort_type", F.explode(_texts(sort_types)))
    if not isinstance(dates, DataFrame):
        return typed.withColumn("partition_date", F.explode(_texts(dates)))
    every = dates.agg(F.collect_set(dates.columns[0])).scalar()
    return typed.withColumn("_dates", every).withColumn("partition_date", F.explode("_dates")).drop("_dates")


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def grid_of(
    spark: SparkSession, subreddits: Sequence[str], sort_types: Sequence[str], dates: Sequence[str]
) -> DataFrame:
    """The grid for a configured list of subreddits."""
    groups = spark.createDataFrame([(s,) for s in subreddits], "subreddit string")
    return expected_grid(groups, sort_types, dates)
