"""Facts that only the path of a landing file states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mentionlake.functions.text import col


def path_part(c: Column | str, key: str) -> Column:
    """Value of ``/key=value/`` in a path; '' if absent."""
    return F.regexp_extract(col(c), f"/{key}=([^/]+)/", 1)


def sort_type_of(c: Column | str) -> Column:
    """Folder above ``subreddit=``, written plainly or as ``sort_type=``."""
    return F.regexp_extract(col(c), r"/(?:sort_type=)?(\w+)/subreddit=", 1)


def subreddit_of(c: Column | str) -> Column:
    """Subreddit in the path of a landing file, null if absent.

    The file path is itself percent-encoded, on top of the escapes of the folder name.
    """
    return F.nullif(unescaped(unescaped(path_part(c, "subreddit"))), F.lit(""))


def unescaped(c: Column | str) -> Column:
    """Undo the percent escapes of partition folders."""
    return F.url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B")))
