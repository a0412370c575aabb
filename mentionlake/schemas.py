"""Column contracts of the tables. Names, order and types are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DataType, DoubleType, IntegerType, LongType, MapType, StringType,
    StructField, StructType, TimestampType,
)

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BOOL, TIME, COUNTS = BooleanType(), TimestampType(), MapType(STRING, INT)


def struct(*columns: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns])


SUBMISSIONS = struct(
    ("id", STRING), ("fullname_id", STRING), ("subreddit", STRING), ("author", STRING),
    ("title", STRING), ("selftext", STRING), ("created_utc", LONG), ("updated_at", LONG),
    ("score", INT), ("upvote_ratio", DOUBLE), ("num_comments", INT), ("is_self", BOOL),
    ("stickied", BOOL), ("locked", BOOL), ("distinguished", STRING), ("permalink", STRING),
    ("url", STRING), ("edited", LONG), ("is_video", BOOL), ("media_only", BOOL),
    ("thumbnail", STRING), ("awards", COUNTS),
)

COMMENTS = struct(
    ("id", STRING), ("fullname_id", STRING), ("submission_id", STRING), ("link_id", STRING),
    ("parent_id", STRING), ("author", STRING), ("body", STRING), ("created_utc", LONG),
    ("updated_at", LONG), ("score", INT), ("controversiality", INT), ("is_submitter", BOOL),
    ("distinguished", STRING), ("edited", LONG), ("permalink", STRING), ("depth", INT),
    ("awards", COUNTS),
)

LANDING = {"submissions": SUBMISSIONS, "comments": COMMENTS}

AUDIT = struct(
    ("ingestion_timestamp", TIME), ("source_file", STRING), ("source_sort_type", STRING),
    ("partition_date", STRING),
)


def bronze_schema(kind: str) -> StructType:
    """Landing fields without ``awards``, followed by the audit columns."""
    kept = [field for field in LANDING[kind].fields if field.name != "awards"]
    return StructType(kept + AUDIT.fields)


SUBMISSIONS_SILVER = struct(
    ("id", STRING), ("fullname_id", STRING), ("subreddit", STRING), ("title", STRING),
    ("selftext", STRING), ("created_utc", LONG), ("score", INT), ("upvote_ratio", DOUBLE),
    ("num_comments", INT), ("is_usable_for_sentiment", BOOL), ("partition_date", STRING),
)

COMMENTS_SILVER = struct(
    ("id", STRING), ("link_id", STRING), ("parent_id", STRING), ("body", STRING),
    ("score", INT), ("created_utc", LONG), ("subreddit", STRING),
    ("is_usable_for_sentiment", BOOL), ("partition_date", STRING),
)

SENTIMENT = struct(
    ("submission_id", STRING), ("comment_id", STRING), ("brand_name", STRING),
    ("product_name", STRING), ("aspect", STRING), ("sentiment_score", DOUBLE),
    ("quote", STRING), ("model_version", STRING), ("analyzed_at", TIME),
    ("date_partition", STRING), ("analysis_id", STRING),
)

ANALYSED_LEDGER = struct(
    ("comment_id", STRING), ("date_partition", STRING),
)

PRODUCT_REFERENCE = struct(
    ("brand_name", STRING), ("model", STRING), ("price", DOUBLE), ("avg_rating", DOUBLE),
    ("5G_or_not", INT), ("processor_brand", STRING), ("num_cores", INT),
    ("processor_speed", DOUBLE), ("battery_capacity", INT), ("fast_charging_available", INT),
    ("fast_charging", INT), ("ram_capacity", INT), ("internal_memory", INT),
    ("screen_size", DOUBLE), ("refresh_rate", INT), ("num_rear_cameras", INT), ("os", STRING),
    ("primary_camera_rear", INT), ("primary_camera_front", INT),
    ("extended_memory_available", INT), ("resolution_height", INT), ("resolution_width", INT),
)

CHECKPOINTS = struct(
    ("environment", STRING), ("subreddit", STRING), ("checkpoint_type", STRING),
    ("sort_type", STRING), ("time_filter", STRING), ("last_token", STRING),
    ("last_timestamp", LONG), ("items_fetched", LONG), ("s3_location", STRING),
)

METRICS = struct(
    ("environment", STRING), ("job", STRING), ("process_date", STRING), ("run_id", STRING),
    ("scope", STRING), ("subreddit", STRING), ("metric", STRING), ("value", DOUBLE),
    ("unit", STRING), ("recorded_at", TIME),
)

QUARANTINE = struct(
    ("reason", STRING), ("line", STRING), ("source_file", STRING),
    ("ingestion_timestamp", TIME), ("partition_date", STRING), ("batch", STRING),
)
