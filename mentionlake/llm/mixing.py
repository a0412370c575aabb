"""A curriculum: sources are mixed to target weights that change over training time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlake.llm.common import digest_bucket
from mentionlake.session import materialise

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: A source or document is used this many times at most.
REPEATS = 3
ROWS_PER_BUCKET = 2048
Knots = Sequence[tuple[float, float]]
#: Relative weight over training time, by weight: heavy sources lead, light ones come late.
SCHEDULE: Mapping[int, Knots] = {
    5: ((0.0, 1.25), (0.5, 1.0), (1.0, 0.75)),
    2: ((0.0, 1.0), (1.0, 1.0)),
    1: ((0.0, 0.5), (0.75, 1.0), (1.0, 2.0)),
}


def segments(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """(start, end, weight at start, slope, area before) of each piece, areas as shares of the whole."""
    pieces, before = [], 0.0
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        pieces.append((t0, t1, w0 / whole, (w1 - w0) / whole / (t1 - t0), before))
        before += (t1 - t0) * (w0 + w1) / 2 / whole
    return pieces


def invert(share: Column, knots: Knots) -> Column:
    """The time by which a source has met ``share`` (0 to 1) of its demand.

    Demand is the integral of a piecewise linear weight, so each piece is a quadratic to solve.
    """
    time = None
    for t0, t1, w0, slope, before in segments(knots):
        rest = F.greatest(share - before, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + rest * (2 * slope), F.lit(0.0))) + w0
        at = F.when(root > 0, F.least(rest * 2.0 / root + t0, F.lit(t1))).otherwise(F.lit(t0))
        time = at if time is None else F.when(share >= before, at).otherwise(time)
    return time


def targets(sums: DataFrame, weights: Sequence[int], repeats: int) -> DataFrame:
    """One row per source: its size, target and budget (the target in whole words).

    The targets share the total by weight; one that would pass ``repeats`` times its source's size stops there
    and the rest is shared again. Sorted by size over weight the stopped sources come first, so running sums
    find the level that the others reach, without a loop.
    """
    sources = sums.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(every.orderBy("__source"))
    sources = sources.withColumn("__weight", F.element_at(F.array(*map(F.lit, weights)), (rank - 1) % len(weights) + 1).cast("long"))
    sources = sources.withColumn("__cap", F.col("source_size") * repeats)
    order = every.orderBy(F.col("__cap") / F.col("__weight"), "__source").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    filled = sources.select(
        "*", F.sum("source_size").over(every).alias("__all"),
        (F.sum("__weight").over(every) - F.coalesce(F.sum("__weight").over(order), zero)).alias("__left"),
        F.coalesce(F.sum("__cap").over(order), zero).alias("__used"),
    )
    stops = F.col("__cap") * F.col("__left") <= (F.col("__all") - F.col("__used")) * F.col("__weight")
    filled = filled.withColumn("__stops", stops)
    stopped = F.sum(F.when(F.col("__stops"), F.col("__cap")).otherwise(zero)).over(every)
    sharing = F.sum(F.when(F.col("__stops"), zero).otherwise(F.col("__weight"))).over(every)
    filled = filled.select("*", stopped.alias("__stopped"), sharing.alias("__sharing"))
    part = (F.col("__all") - F.col("__stopped")) * F.col("__weight") / F.col("__sharing")
    target = F.when(F.col("__stops"), F.col("__cap").cast("double")).otherwise(part)
    return filled.select("__source", "source_size", "__weight", target.alias("target"), F.floor(target + 0.5).cast("long").alias("__budget"))


def curriculum(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
    repeats: int = REPEATS, schedule: Mapping[int, Knots] = SCHEDULE, cut: bool = True,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target``, ``taken`` and ``positions`` to each document.

    The documents of a source stand in a row, in the order of their id's digest, and the row is repeated
    ``repeats`` times. What lies before the source's budget is taken. A word that stands at share x of the budget
    is trained on when the integral of the source's weight has reached x: ``positions`` holds that time for each
    taken copy, ``taken`` the words of all. With ``cut`` the document at the end of the budget is taken in part
    (leading words), so a source meets its budget exactly; without, it is taken whole if at least half of
    it lies before the end.

    A source may hold any share of the rows: it is cut into buckets by digest, which are summed on their own. No
    source (null) is a source of its own, the last. Documents without an id share the empty digest. Documents without words are
    taken (with no words) only without ``cut``, by where they stand. Repeated rows each stand for themselves.
    Columns of the input named like the added ones are replaced. An empty table gives an empty table.
    """
    added = ("size", "source_size", "target", "taken", "positions")
    spark = docs.sparkSession
    docs = docs.withColumn("__size", size.cast("long"))
    docs = docs.drop(*added)
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    bucket = digest_bucket(digest, docs.count(), ROWS_PER_BUCKET)
    # Sorts by code point with null last, and joins like any text.
    source = F.coalesce(F.concat(F.lit("0"), F.col(source_col).cast("string")), F.lit("1"))
    keyed = docs.withColumn("__source", source).withColumn("__bucket", bucket)
    sums = materialise(keyed.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__size")), "mix-sums")
    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__source", "__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    offsets = materialise(offsets.join(targets(sums, weights, repeats), "__source"), "mix-offsets")
    within = Window.partitionBy("__source", "__bucket").orderBy(digest, F.col(id_col), "__size").rowsBetween(Window.unboundedPreceding, -1)
    rows = keyed.withColumn("__start", F.coalesce(F.sum("__size").over(within), F.lit(0))).join(offsets, ["__source", "__bucket"])
    rows = rows.withColumn("__start", F.col("__start") + F.col("__offset"))

    def left(copy: int) -> Column:
        return F.col("__budget") - F.col("__start") - F.col("source_size") * copy

    def used(copy: int) -> Column:
        if cut:
            return left(copy) > 0 if copy else (left(copy) > 0) & (F.col("__size") > 0)
        half = left(copy) * 2 >= F.col("__size")
        return half & (F.col("__size") > 0) if copy else half

    def words(copy: int) -> Column:
        whole = F.least(left(copy), F.col("__size")) if cut else F.col("__size")
        return F.when(used(copy), whole).otherwise(F.lit(0).cast("long"))

    def time(copy: int) -> Column:
        start = F.col("__start") + F.col("source_size") * copy
        share = F.when(F.col("__budget") > 0, F.least(start / F.col("__budget"), F.lit(1.0))).otherwise(F.lit(0.0))
        known = F.lit(None).cast("double")
        for weight, knots in schedule.items():
            known = F.when(F.col("__weight") == weight, invert(share, knots)).otherwise(known)
        return F.when(used(copy), F.coalesce(known, share))

    taken = words(0)
    for copy in range(1, repeats):
        taken = taken + words(copy)
    positions = F.array_compact(F.array(*[time(copy) for copy in range(repeats)]))
    kept = [c for c in docs.columns if c != "__size"]
    return rows.select(*kept, F.col("__size").alias("size"), "source_size", "target", taken.alias("taken"), positions.alias("positions"))


def in_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per taken copy, sorted by its training position over all partitions."""
    copies = mixed.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
    return copies.orderBy("position", id_col, "copy")
