"""Keep-latest, top-N per group and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType
from pyspark.sql.window import Window

from mentionlake.functions.ids import canonical_text
from mentionlake.session import Save

#: Bits of a map of rows: 2^20 numbers of 64 bits, which are broadcast.
MAP_BITS = 1 << 26


def row_digest(df: DataFrame) -> Column:
    """A number from all columns of a row (maps excepted), to break ties."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType)])


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], version: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest ``version`` per key.

    Ties go to the lowest ``tiebreak`` values and then to a digest of the row, so
    the answer does not depend on the order of input. Spark keeps one row per key
    and task before the shuffle, so many copies of a key cost little.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(version).desc_nulls_last(), *[F.col(c) for c in tiebreak], row_digest(df)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _map_of(digests: DataFrame) -> DataFrame:
    """(_word, _set): a bit for each ``_id``, 64 in a number."""
    at = F.pmod("_id", F.lit(MAP_BITS).cast("long"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))
    return digests.select(F.floor(at / 64).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_set"))


def _marked(rows: DataFrame, bits: DataFrame, name: str) -> DataFrame:
    """Add ``name``: whether the bit of a row's ``_id`` is set."""
    at = F.pmod("_id", F.lit(MAP_BITS).cast("long"))
    is_set = F.call_function("getbit", F.col("_set"), F.pmod(at, F.lit(64)).cast("int")) == 1
    met = rows.withColumn("_at", F.floor(at / 64)).join(F.broadcast(bits), F.col("_at") == F.col("_word"), "left")
    return met.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_at", "_word", "_set")


def first_rows(save: Save, rows: DataFrame, keys: Sequence[str], told: dict[str, Column], order: Sequence[Column], label: str) -> DataFrame:
    """The first row of each key, without a shuffle of whole rows where that can be told from a few columns.

    ``told`` names what is compared; ``order`` refers to these names. They alone are shuffled and ranked. Bit maps of fixed size tell which rows may be a first one,
    and which may be another one: a row in one map only is settled. Rows in both (some percent, as long as the maps have room) are ranked in full and held against
    the first ones, so the answer is exact whatever the maps say. ``rows`` is read several times and should be a file scan without missing keys.
    """
    rows = rows.withColumns(told).withColumn("_id", F.xxhash64(*keys, *told))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = save(rows.select(*keys, *told, "_id").withColumn("_rank", rank).select(*keys, "_id", (F.col("_rank") == 1).alias("_first")), f"{label}-ranks")
    others = ranked.where("NOT _first")
    if others.isEmpty():
        return rows.drop(*told, "_id")
    first = ranked.where("_first")
    other_map, first_map = (save(_map_of(of), f"{label}-{name}") for name, of in (("others", others), ("first", first)))
    held = _marked(_marked(rows, other_map, "_other"), first_map, "_may_be_first")
    settled = held.where("NOT _other").drop("_other", "_may_be_first")
    open_ones = held.where("_other AND _may_be_first").drop("_other", "_may_be_first").withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    exact = open_ones.join(first.select(*keys, "_id"), [*keys, "_id"], "left_semi").select(*settled.columns)
    return settled.unionByName(exact).drop(*told, "_id")


def latest_rows(save: Save, rows: DataFrame, key: str | Sequence[str], version: str, tiebreak: Sequence[str] = (), label: str = "latest") -> DataFrame:
    """``latest_per_key`` of a file scan without missing keys, which shuffles few whole rows."""
    keys = [key] if isinstance(key, str) else list(key)
    told = {"_version": F.col(version), **{f"_tie{i}": F.col(c) for i, c in enumerate(tiebreak)}, "_digest": row_digest(rows)}
    order = [F.col("_version").desc_nulls_last(), *[F.col(f"_tie{i}") for i in range(len(tiebreak))], F.col("_digest")]
    return first_rows(save, rows, keys, told, order, label)


def top_n(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[Column],
    n: int | None,
    since: Column | None = None,
    spread: int = 64,
) -> DataFrame:
    """The first ``n`` rows of each group in the given order, or all, with their ``rank``.

    ``since`` restricts the rows first, e.g. to a time range. The group is first cut to ``n`` rows in
    each of ``spread`` slices, so that a group with most of the rows is not sorted by one task. To rank all
    rows of a group takes one task for it.
    """
    groups = [by] if isinstance(by, str) else list(by)
    rows = df if since is None else df.filter(since)
    if n is not None:
        rows = rows.withColumn("_slice", F.pmod(row_digest(rows), F.lit(spread)))
        in_slice = Window.partitionBy(*groups, "_slice").orderBy(*order)
        rows = rows.withColumn("_rank", F.row_number().over(in_slice))
        rows = rows.filter(F.col("_rank") <= n).drop("_rank", "_slice")
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    ranked = rows.withColumn("rank", rank)
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


# Kinds of listing and their time filters. The lengths are ours.
SORT_TYPES = ("top", "controversial")
DAY = 86_400
TIME_FILTERS = {"all": None, "year": 365 * DAY, "month": 30 * DAY, "week": 7 * DAY, "day": DAY, "hour": 3_600}


def listing(
    df: DataFrame,
    sort_type: str,
    order: Sequence[Column],
    now: int,
    time_filter: str = "all",
    limit: int | None = None,
) -> DataFrame:
    """The submissions per subreddit of one listing, all or the first ``limit``.

    The order is the caller's; the time filter counts back from ``now`` (epoch seconds).
    """
    if sort_type.lower() not in SORT_TYPES:
        raise ValueError(f"unsupported sort type {sort_type}, must be one of {SORT_TYPES}")
    seconds = TIME_FILTERS[time_filter.lower()]
    since = None if seconds is None else F.col("created_utc") >= now - seconds
    return top_n(df, "subreddit", order, limit, since).withColumn("sort_type", F.lit(sort_type.lower()))


def surrogate_key(
    df: DataFrame,
    natural_key: str | Sequence[str],
    name: str,
    prefix: int = 4,
    tiebreak: Column | None = None,
) -> DataFrame:
    """Number rows 1..N without gaps, in the order of the MD5 of their natural key.

    The leading ``prefix`` hexadecimal digits spread the rows evenly over buckets
    (65 536 by default, each with a few hundred thousand keys where there are 10^10). Each bucket is ranked by itself and shifted by the rows in
    the buckets before it, so no task ever sorts the whole table. The numbering
    depends on the data alone. The natural key should identify a row; where it may
    not, ``tiebreak`` orders the rows that share one.
    """
    keys = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    digest = F.md5(canonical_text(*keys))
    hashed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, prefix))
    # At most 16^prefix rows from here to the broadcast.
    sizes = hashed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")
    offsets = sizes.select("_bucket", before.alias("_before"))
    order = ["_digest"] if tiebreak is None else ["_digest", tiebreak]
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    numbered = (
        hashed.withColumn("_rank", rank)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_before") + F.col("_rank"))
    )
    return numbered.select(name, *df.columns)
