"""Epoch seconds, partition dates and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionlake.functions.text import col

# Fixed value: format of partition dates. As text it does not sort by time.
PARTITION_FORMAT = "dd-MM-yyyy"


def epoch_ts(c: Column | str) -> Column:
    """Epoch seconds to a timestamp without time zone, whatever the session zone."""
    zero = F.lit(0)
    since = F.make_dt_interval(zero, zero, zero, col(c))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def epoch_date(c: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(col(c) / 86400).cast("int"))


def process_date(c: Column | str) -> Column:
    """Run time or day to the name of its partition."""
    return F.date_format(col(c), PARTITION_FORMAT)


def partition_day(c: Column | str) -> Column:
    """Partition name to a day, so that partitions can be ordered; null if malformed."""
    return F.try_to_date(col(c), PARTITION_FORMAT)


def date_key(c: Column | str) -> Column:
    day = col(c)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
