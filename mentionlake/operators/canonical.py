"""Raw API dumps to landing records: defaults, casts and derived ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from mentionlake.functions.ids import fullname, submission_of
from mentionlake.schemas import COMMENTS, STRING, SUBMISSIONS, struct

# Raw scalars are read as text, so that any JSON type is accepted.
_AWARDS = ArrayType(struct(("name", STRING), ("count", STRING)))
_AUTHOR = struct(("name", STRING))


def _texts(*names: str) -> list[tuple[str, StringType]]:
    return [(name, STRING) for name in names]


RAW_SUBMISSION = struct(
    ("subreddit", struct(("display_name", STRING))), ("author", _AUTHOR), ("all_awardings", _AWARDS),
    *_texts(
        "id", "title", "selftext", "created_utc", "score", "upvote_ratio", "num_comments",
        "is_self", "stickied", "locked", "distinguished", "permalink", "url", "edited",
        "is_video", "media_only", "thumbnail",
    ),
)
RAW_COMMENT = struct(
    ("submission", struct(("id", STRING))), ("author", _AUTHOR), ("all_awardings", _AWARDS),
    *_texts(
        "id", "link_id", "parent_id", "body", "created_utc", "score", "controversiality",
        "is_submitter", "distinguished", "edited", "permalink", "depth",
    ),
)

# Fixed value: what precedes a relative link.
PERMALINK_PREFIX = "https://reddit.com"


def whole_number(c: str) -> Column:
    """Integer part of a numeric text; null if it is none."""
    text = F.col(c)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def _integer(c: str, kind: str = "int") -> Column:
    return F.coalesce(whole_number(c).try_cast(kind), F.lit(0).cast(kind))


def _number(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))


def _truth(c: str) -> Column:
    """False for null, false, zero and empty text."""
    return F.coalesce(~F.lower(c).isin("false", "0", "0.0", ""), F.lit(False))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _edited(c: str) -> Column:
    """Time of the edit; null if never edited. A bare ``true`` counts as 1."""
    seconds = F.when(F.lower(c) == "true", F.lit(1)).otherwise(whole_number(c))
    return F.when(_truth(c), seconds).cast("bigint")


def awards_map(c: Column | str) -> Column:
    """Awards as name -> count: the last of equal names wins, a missing count is 0."""
    awards = F.filter(F.coalesce(c, F.array()), lambda a: F.length(a["name"]) > 0)
    nothing = F.create_map().cast("map<string,int>")

    def put(counts: Column, award: Column) -> Column:
        count = F.coalesce(award["count"].try_cast("double").try_cast("int"), F.lit(0))
        others = F.map_filter(counts, lambda name, _: name != award["name"])
        return F.map_concat(others, F.create_map(award["name"], count))

    return F.aggregate(awards, nothing, put)


def _common(kind: str, updated_at: Column) -> dict[str, Column]:
    return {
        "id": F.col("id"),
        "fullname_id": fullname(kind, "id"),
        "author": F.col("author.name"),
        "created_utc": _integer("created_utc", "bigint"),
        "updated_at": updated_at.cast("bigint"),
        "score": _integer("score"),
        "distinguished": F.col("distinguished"),
        "permalink": F.concat(F.lit(PERMALINK_PREFIX), _text("permalink")),
        "edited": _edited("edited"),
        "awards": awards_map("all_awardings"),
    }


def canonical_submissions(raw: DataFrame, updated_at: Column) -> DataFrame:
    """Submissions as they land; ``updated_at`` is the time of observation."""
    values = _common("submission", updated_at) | {
        "subreddit": F.col("subreddit.display_name"),
        "title": _text("title"),
        "selftext": _text("selftext"),
        "upvote_ratio": _number("upvote_ratio"),
        "num_comments": _integer("num_comments"),
        "url": F.col("url"),
        "thumbnail": F.col("thumbnail"),
        **{c: _truth(c) for c in ("is_self", "stickied", "locked", "is_video", "media_only")},
    }
    return raw.select(*[values[name].alias(name) for name in SUBMISSIONS.names])


def canonical_comments(raw: DataFrame, updated_at: Column) -> DataFrame:
    """Comments as they land, linked to their submission."""
    values = _common("comment", updated_at) | {
        "submission_id": submission_of("link_id", otherwise=F.col("submission.id")),
        "link_id": F.col("link_id"),
        "parent_id": F.col("parent_id"),
        "body": _text("body"),
        "controversiality": _integer("controversiality"),
        "is_submitter": _truth("is_submitter"),
        "depth": _integer("depth"),
    }
    return raw.select(*[values[name].alias(name) for name in COMMENTS.names])
