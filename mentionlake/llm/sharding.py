"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlake.llm.common import digest_bucket

SHARDS = 16
ROWS_PER_BUCKET = 4096


def key_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit(""))


def score(key: Column, shard: int, weight: float) -> Column:
    """The shard's bid for a key: weight over the exponential draw of a hash in (0, 1).

    The draw takes the first 52 bits of an MD5, so any engine can repeat it.
    """
    digest = F.md5(F.concat(key, F.lit(f":{shard}")).cast("binary"))
    unit = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return F.lit(float(weight)) / -F.log(unit)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest bid. Only keys for which a new shard bids highest move when one is
    added, and only the keys of a removed shard move when it goes. Weights must be positive."""
    bids = [F.struct(score(key, i, w).alias("bid"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return -best["shard"]


def place(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS, tie: Sequence[Column] = ()) -> DataFrame:
    """Add ``shard``, ``slot`` and ``grown_shard`` (the shard with one more of mean weight).

    Slots number the rows of a shard from 0 without gaps, in the order of the key's digest. Each shard is cut
    into buckets by that digest, numbered on their own and shifted by the counts before them, so no task sees
    a whole shard. ``tie`` orders rows of one key.

    Rows without a key share the key of the empty text. Repeated rows keep a slot each. An empty table gives an
    empty table. Columns of the input named like the three added ones are replaced.
    """
    docs = docs.drop("shard", "slot", "grown_shard")
    rows = docs.count() // len(weights)
    extra = sum(weights) / len(weights)
    stable = key_text(key)

    def located(df: DataFrame) -> DataFrame:
        digest = F.md5(stable.cast("binary"))
        return df.withColumn("shard", rendezvous(stable, weights)).withColumn("__bucket", digest_bucket(digest, rows, ROWS_PER_BUCKET))

    counts = located(docs.select(key)).groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("shard", "__bucket").orderBy(F.md5(stable.cast("binary")), F.col(key), *tie)
    moved = rendezvous(stable, [*weights, extra])
    columns = docs.columns
    return (
        located(docs).withColumn("grown_shard", moved).withColumn("__row", F.row_number().over(within))
        .join(offsets, ["shard", "__bucket"])
        .withColumn("slot", (F.col("__before") + F.col("__row") - 1).cast("long"))
        .select(*columns, "shard", "slot", "grown_shard")
    )
