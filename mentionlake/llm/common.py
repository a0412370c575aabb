"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but space and the five ASCII controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]++"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digest_bucket(digest: Column, rows: int, per_bucket: int) -> Column:
    """A number that rises with a hexadecimal digest and that about ``per_bucket`` of ``rows`` rows share: its leading bits."""
    bits = min(32, max(0, math.ceil(math.log2(max(rows, 1) / per_bucket))))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - bits)


#: A filter has 16 bits for each key, and so many blocks of 32 768 bits at most: 8 MB.
MAP_SHIFT, BITS_PER_KEY, MAPS = 15, 16, 2_048
MAP_BITS = 1 << MAP_SHIFT


def possible(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` (a hash) is among those of ``wanted``, and few others, without a shuffle of ``rows``.

    A bit map of the wanted keys is broadcast, whose size has a fixed bound. It loses no row; with more keys
    than it is made for it only lets more pass, so an exact join must follow.
    """
    bits = MAP_BITS * min(MAPS, max(1, math.ceil(wanted.count() * BITS_PER_KEY / MAP_BITS)))

    def place(of: DataFrame) -> DataFrame:
        # Never null, or Spark would filter by it first, and compute the key once more for that.
        at = F.coalesce(F.pmod(F.col(key), F.lit(bits).cast("long")), F.lit(-1).cast("long"))
        return of.withColumn("__map", F.shiftright(at, MAP_SHIFT)).withColumn("__bit", at.bitwiseAND(F.lit(MAP_BITS - 1).cast("long")))

    maps = place(wanted.select(key).where(F.col(key).isNotNull())).groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__set"))
    # As longs of eight bytes, the first byte highest, which are looked up without making strings.
    words = F.transform(F.sequence(F.lit(0), F.lit(MAP_BITS // 64 - 1)), lambda i: F.conv(F.hex(F.substring("__set", i * 8 + 1, F.lit(8))), 16, -10).cast("long"))
    met = place(rows).join(F.broadcast(maps.select("__map", words.alias("__words"))), "__map")
    bit = F.col("__bit").cast("int")
    word = F.get("__words", F.shiftright(bit, 6))
    found = F.call_function("shiftright", word, bit.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))).bitwiseAND(F.lit(1).cast("long")) == 1
    return met.where(found).select(*rows.columns)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(column: str) -> Column:
    """CRC-32 of the id as text; null ids have none."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def chunks(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut at spaces only, so that no word is split."""
    at = 0
    while at < len(data):
        end = at + size
        if end < len(data):
            space = data.find(b" ", end)
            end = len(data) if space < 0 else space + 1
        yield data[at:end]
        at = end
