"""Identifiers: prefixed names, short ids and row digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionlake.functions.text import col

# Prefix of a full name per kind of record.
PREFIX = {"submission": "t3_", "comment": "t1_"}


def fullname(kind: str, c: Column | str) -> Column:
    """``t3_``/``t1_`` + id; null for a null or empty id."""
    return F.when(F.length(col(c)) > 0, F.concat(F.lit(PREFIX[kind]), col(c)))


def short_id(c: Column | str) -> Column:
    """Second part of an underscore-separated name; '' if there is none."""
    return F.split_part(col(c), F.lit("_"), F.lit(2))


def submission_of(link_id: Column | str, otherwise: Column | None = None) -> Column:
    """The id behind a ``t3_`` link; any other link gives ``otherwise``."""
    link = col(link_id)
    return F.when(link.startswith("t3_"), F.substring(link, 4, 2**31 - 1)).otherwise(
        F.lit(None).cast("string") if otherwise is None else otherwise
    )


def canonical_text(*columns: Column | str) -> Column:
    """One text per tuple of values; distinct tuples, nulls included, differ."""
    parts = [
        F.coalesce(
            F.concat(F.length(col(c).cast("string")).cast("string"), F.lit(":"), col(c).cast("string")),
            F.lit("-"),
        )
        for c in columns
    ]
    return F.concat_ws("|", *parts)


def analysis_id(*columns: Column | str) -> Column:
    return F.sha2(canonical_text(*columns), 256)


def analysis_id_murmur(comment_id, brand, product, aspect) -> Column:
    """The short 32-bit id; it may collide and skips nulls and the quote."""
    return F.hash(col(comment_id), col(brand), col(product), col(aspect)).cast("string")
