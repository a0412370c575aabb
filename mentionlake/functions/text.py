"""Text measures and the usability flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a deleted, removed or empty post.
SENTINELS = ("[deleted]", "[removed]", "")

# Default thresholds of the usability flags.
SUBMISSION_MIN_CHARS = 10
SUBMISSION_MIN_WORDS = 2
COMMENT_MIN_CHARS = 30
COMMENT_MIN_WORDS = 5


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(c: Column | str) -> Column:
    """Words separated by white space; 0 for null and blank text."""
    text = F.trim(F.coalesce(col(c), F.lit("")))
    return F.when(text == "", 0).otherwise(F.size(F.split(text, r"\s+")))


def words_up_to(c: Column | str, n: int) -> Column:
    """The word count, or ``n`` if there are more.

    Stops at ``n`` words. A long text need not even be decoded whole: if its start
    already has ``n`` words, so has the text; if not, the whole text is split.
    """
    text = F.trim(F.coalesce(col(c), F.lit("")))
    start = F.substring(text, 1, 32 * max(n, 1))

    def split_size(part: Column) -> Column:
        return F.size(F.split(part, r"\s+", max(n, 1)))

    return F.when(text == "", 0).when(split_size(start) >= n, n).otherwise(split_size(text))


def char_count(c: Column | str) -> Column:
    return F.length(F.trim(F.coalesce(col(c), F.lit(""))))


def is_sentinel(c: Column | str) -> Column:
    """True for null as well: a missing text is treated like an empty one."""
    return col(c).isNull() | col(c).isin(*SENTINELS)


def strip_space(c: Column | str) -> Column:
    """Trim tabs and line ends too, which ``trim`` leaves in place."""
    return F.regexp_replace(col(c), r"^\s+|\s+\z", "")


def submission_usable(
    title: Column | str,
    selftext: Column | str,
    min_chars: int = SUBMISSION_MIN_CHARS,
    min_words: int = SUBMISSION_MIN_WORDS,
) -> Column:
    long_enough = char_count(title) + char_count(selftext) >= min_chars
    wordy_enough = words_up_to(title, min_words) + words_up_to(selftext, min_words) >= min_words
    return ~is_sentinel(selftext) & long_enough & wordy_enough


def comment_usable(
    body: Column | str,
    min_chars: int = COMMENT_MIN_CHARS,
    min_words: int = COMMENT_MIN_WORDS,
) -> Column:
    wordy_enough = words_up_to(body, min_words) >= min_words
    return ~is_sentinel(body) & (char_count(body) >= min_chars) & wordy_enough
