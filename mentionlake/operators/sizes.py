"""Joins with lookup tables whose size and keys are not known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.operators.dedupe import row_digest

SALTS = 32


def lookup(left: DataFrame, left_key: str, right: DataFrame, right_key: str, how: str = "inner", salts: int = SALTS) -> DataFrame:
    """Join ``left`` with a lookup table of narrow rows.

    The table is repeated under ``salts`` salts, so a key with most of the left rows is spread over that many
    tasks. There is no hint and no count: Spark broadcasts the table if its size in bytes, known when it has been computed,
    is below the session's limit.
    """
    salted = left.withColumn("_salt", F.pmod(row_digest(left), F.lit(salts)))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    repeated = right.withColumn("_salt_of", F.explode(every))
    same = (F.col(left_key) == F.col(right_key)) & (F.col("_salt") == F.col("_salt_of"))
    return salted.join(repeated, same, how).drop("_salt", "_salt_of")
