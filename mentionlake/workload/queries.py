"""One query per operator. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions import dates, ids, text
from mentionlake.functions.paths import path_part, sort_type_of
from mentionlake.functions.products import price_segment
from mentionlake.operators import (
    analytics, canonical, checks, context, extract, joins, metrics, prompts, quality, resolve,
)
from mentionlake.operators.dedupe import latest_per_key, listing, surrogate_key, top_n
from mentionlake.operators.merge import merge_latest
from mentionlake.plans import gold
from mentionlake.plans.bronze import run_bronze
from mentionlake.plans.checkpoints import load_checkpoint, save_checkpoint, upsert_checkpoints
from mentionlake.plans.layout import Lake, create_tables
from mentionlake.plans.sentiment import run_sentiment
from mentionlake.plans.silver import run_silver_core
from mentionlake.schemas import CHECKPOINTS, LANDING, PRODUCT_REFERENCE, bronze_schema
from mentionlake.session import scratch_path
from mentionlake.sources import landing, reference, tables
from mentionlake.streaming.incremental import ingest_incremental
from mentionlake.workload import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ONE_DATE = "05-01-2024"
ONE_LANDING = "01-01-2024"
SORT_TYPES = ("controversial", "top")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(c: Column | str, digits: int = 6) -> Column:
    return F.round(c, digits)


def temp_lake(spark: SparkSession) -> Lake:
    """A lake of its own in the shared folder, with schemas no other run uses."""
    tag = uuid.uuid4().hex[:12]
    lake = Lake(
        location=scratch_path(spark, "lake"),
        bronze=f"bronze_{tag}", silver=f"silver_{tag}", mart=f"mart_{tag}", ops=f"ops_{tag}",
    )
    create_tables(spark, lake)
    return lake


# --- Sources and tables -----------------------------------------------------------


def landing_day(c: str = "partition_date") -> Column:
    """Posts are observed on the first or second day of their month."""
    return F.concat(F.lit("0"), 1 + F.substring(c, 1, 2).cast("int") % 2, F.substring(c, 3, 8))


def landed_subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a.subs(spark, sf_dir).withColumn("date", landing_day())


def landed_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = a.comments(spark, sf_dir).withColumn("subreddit", path_part("source_file", "subreddit"))
    return c.withColumn("date", landing_day()).drop("source_file", "conv_id", "turn")


def _land(df: DataFrame, root: str, kind: str) -> None:
    landing.write_landing(df.drop("partition_date"), root, kind)


def _land_both(spark: SparkSession, sf_dir: str) -> str:
    """Posts and comments under one root."""
    root = scratch_path(spark, "landing")
    _land(landed_subs(spark, sf_dir), root, "submissions")
    _land(landed_comments(spark, sf_dir), root, "comments")
    return root


def _landed_columns(df: DataFrame) -> DataFrame:
    """All columns that the posts have, with the audit columns that do not depend on the run."""
    unset = [f.name for f in LANDING["submissions"].fields if f.name not in LANDED]
    missing = F.lit(True)
    for c in unset:
        missing = missing & F.col(c).isNull()
    return df.select(*LANDED, "source_sort_type", "partition_date", missing.alias("others_missing"))


LANDED = ("id", "fullname_id", "subreddit", "title", "selftext", "created_utc", "updated_at", "score", "upvote_ratio", "num_comments")


@query
def landing_roundtrip(spark, sf_dir):
    return _landed_columns(landing.read_landing(spark, _land_both(spark, sf_dir), "submissions"))


@query
def landing_roundtrip_comments(spark, sf_dir):
    read = landing.read_landing(spark, _land_both(spark, sf_dir), "comments")
    return read.select("id", "link_id", "parent_id", "author", "body", "created_utc", "updated_at", "score", "source_sort_type", "partition_date")


@query
def landing_scan_date(spark, sf_dir):
    return _landed_columns(landing.read_landing(spark, _land_both(spark, sf_dir), "submissions", ONE_LANDING))


@query
def landing_quarantine(spark, sf_dir):
    root = scratch_path(spark, "lines")
    s = a.subs(spark, sf_dir)
    number = F.col("id").cast("bigint")
    record = F.to_json(
        F.struct(
            F.when(number % 17 != 3, F.col("id")).alias("id"),
            "title",
            F.when(number % 19 == 4, "many").otherwise(F.col("score").cast("string")).alias("score_text"),
            "selftext",
        )
    )
    record = F.regexp_replace(record, r'"score_text":"(\d+)"', '"score":$1')
    record = F.replace(record, F.lit("score_text"), F.lit("score"))
    line = F.when(number % 13 == 5, F.substring(record, 1, 20)).otherwise(record)
    s.select(line.alias("value"), "sort_type", "subreddit", landing_day().alias("date")).write.partitionBy(
        "sort_type", "subreddit", "date"
    ).text(root)
    good, bad = landing.split_corrupt(landing.read_landing(spark, root, "submissions", file_glob="*.txt"))
    state = F.when(F.col("score").isNull(), "kept_without_score").otherwise("kept")
    both = good.select(state.alias("state"), "partition_date").unionByName(
        bad.select(F.col("reason").alias("state"), "partition_date")
    )
    return both.groupBy("partition_date", "state").agg(F.count("*").alias("lines"))


@query
def landing_partitions(spark, sf_dir):
    found = landing.discover_landing(spark, _land_both(spark, sf_dir), "submissions")
    return found.filter("files > 0 AND bytes > 0").select("sort_type", "subreddit", "partition_date")


def _silver_table(spark: SparkSession, sf_dir: str) -> str:
    lake = temp_lake(spark)
    name = lake.silver_table("submissions")
    tables.append(a.subs_silver(spark, sf_dir), name)
    return name


@query
def partition_scan(spark, sf_dir):
    name = _silver_table(spark, sf_dir)
    return tables.read_table(spark, name, ONE_DATE).select("id", "subreddit", "score", "partition_date")


@query
def append_count(spark, sf_dir):
    name = _silver_table(spark, sf_dir)
    tables.append(a.subs_silver(spark, sf_dir), name)
    return spark.table(name).groupBy("partition_date").agg(F.count("*").alias("rows"))


@query
def overwrite_partitions(spark, sf_dir):
    name = _silver_table(spark, sf_dir)
    changed = a.subs_silver(spark, sf_dir).filter(F.col("partition_date").startswith("1"))
    tables.overwrite_partitions(changed.filter("score >= 200").withColumn("score", F.col("score") + 1000), name)
    return spark.table(name).groupBy("partition_date").agg(
        F.count("*").alias("rows"), F.sum("score").alias("score")
    )


@query
def ref_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "reference")
    a.products(spark, sf_dir).drop("brand").write.option("header", "true").csv(path)
    return reference.read_reference_csv(spark, path, PRODUCT_REFERENCE).withColumnRenamed("5G_or_not", "has_5g")


# --- Expressions ------------------------------------------------------------------


@query
def path_extract(spark, sf_dir):
    return a.comments(spark, sf_dir).select(
        "id",
        path_part("source_file", "subreddit").alias("subreddit"),
        path_part("source_file", "date").alias("date"),
        sort_type_of("source_file").alias("sort_type"),
        path_part("source_file", "absent").alias("absent"),
    )


@query
def word_count(spark, sf_dir):
    return a.table(spark, sf_dir, "documents").select(
        "doc_id", text.word_count("text").alias("words"), text.char_count("text").alias("chars")
    )


@query
def flag_submissions(spark, sf_dir):
    return a.subs_silver(spark, sf_dir).select("id", "title", "selftext", "partition_date", quality.FLAG)


@query
def flag_comments(spark, sf_dir):
    return quality.flag_comments(a.comments(spark, sf_dir)).select("id", "body", quality.FLAG)


@query
def epoch_convert(spark, sf_dir):
    return a.subs(spark, sf_dir).select(
        "id", dates.epoch_ts("created_utc").cast("string").alias("created_at"),
        dates.epoch_date("created_utc").alias("created_on"),
    )


@query
def short_id(spark, sf_dir):
    return a.comments(spark, sf_dir).select(
        "id",
        ids.short_id("link_id").alias("link"),
        ids.short_id("author").alias("without_prefix"),
        ids.submission_of("parent_id").alias("submission"),
        ids.fullname("comment", "id").alias("fullname_id"),
    )


@query
def process_date(spark, sf_dir):
    return a.table(spark, sf_dir, "orders").select("o_orderkey", dates.process_date("o_orderdate").alias("process_date"))


@query
def price_segments(spark, sf_dir):
    return a.products(spark, sf_dir).select("model", price_segment("price").alias("price_segment"))


def _raw_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    award = F.struct(F.col("lang").alias("name"), (doc % 4).alias("count"))
    again = F.struct(F.col("lang").alias("name"), (doc % 9).alias("count"))
    other = F.struct(F.col("source").alias("name"), F.lit(None).cast("bigint").alias("count"))
    nameless = F.struct(F.lit("").alias("name"), doc.alias("count"))
    line = F.to_json(
        F.struct(
            doc.cast("string").alias("id"),
            F.struct(F.col("source").alias("display_name")).alias("subreddit"),
            F.when(doc % 5 != 0, F.struct(F.col("lang").alias("name"))).alias("author"),
            F.when(doc % 7 != 0, F.col("text")).alias("title"),
            F.when(doc % 11 != 0, F.col("text")).alias("selftext"),
            (F.lit(a.START) + doc + 0.75).alias("created_utc"),
            F.when(doc % 3 != 0, F.col("n_chars")).alias("score"),
            ((doc % 100) / 100).alias("upvote_ratio"),
            (doc % 2 == 0).alias("is_self"),
            F.when(doc % 2 == 0, F.lit(1)).alias("locked"),
            F.when(doc % 6 != 0, F.concat(F.lit("/r/"), "source")).alias("permalink"),
            F.when(doc % 10 == 1, (F.lit(a.START) + doc + 0.5).cast("string"))
            .when(doc % 10 == 2, "true").otherwise("false").alias("edited"),
            F.when(doc % 8 != 0, F.array(award, other, nameless, again)).alias("all_awardings"),
        )
    )
    parsed = F.from_json(line, canonical.RAW_SUBMISSION)
    return a.table(spark, sf_dir, "documents").select(parsed.alias("raw")).select("raw.*")


@query
def canonicalise(spark, sf_dir):
    done = canonical.canonical_submissions(_raw_submissions(spark, sf_dir), F.lit(a.START))
    return done.select(
        "id", "fullname_id", "subreddit", "author", "title", "selftext", "created_utc", "updated_at",
        "score", "upvote_ratio", "num_comments", "is_self", "locked", "permalink", "edited",
    )


@query
def awards_map(spark, sf_dir):
    done = canonical.canonical_submissions(_raw_submissions(spark, sf_dir), F.lit(a.START))
    entries = F.transform(F.map_entries("awards"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return done.select("id", F.array_join(F.array_sort(entries), ",").alias("awards"))


@query
def canonical_comments(spark, sf_dir):
    conv, turn = F.col("conv_id"), F.col("turn")
    line = F.to_json(
        F.struct(
            F.concat_ws("-", conv, turn).alias("id"),
            F.struct(conv.cast("string").alias("id")).alias("submission"),
            F.when(turn % 3 != 0, F.concat(F.lit("t3_x"), conv)).alias("link_id"),
            F.when(turn % 4 != 0, F.col("text")).alias("body"),
            (F.lit(a.START) + conv).cast("string").alias("created_utc"),
            (turn == 1).alias("is_submitter"),
            turn.alias("depth"),
        )
    )
    raw = a.table(spark, sf_dir, "conversations").select(F.from_json(line, canonical.RAW_COMMENT).alias("raw"))
    done = canonical.canonical_comments(raw.select("raw.*"), F.lit(a.START))
    return done.select(
        "id", "fullname_id", "submission_id", "link_id", "body", "created_utc", "is_submitter", "depth", "permalink"
    )


@query
def analysis_id_sha(spark, sf_dir):
    return a.mentions(spark, sf_dir).select("comment_id", "brand_name", "product_name", "aspect", "analysis_id")


@query
def analysis_id_murmur(spark, sf_dir):
    return extract.with_analysis_id(a.mentions(spark, sf_dir), short=True).select("comment_id", "analysis_id")


# --- Joins ------------------------------------------------------------------------


@query
def comment_subreddit(spark, sf_dir):
    return context.with_subreddit(a.comments(spark, sf_dir), a.subs(spark, sf_dir)).select("id", "link_id", "subreddit")


def build_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context.build_context(a.comments_silver(spark, sf_dir), a.subs_silver(spark, sf_dir))


@query
def comment_context(spark, sf_dir):
    return build_context(spark, sf_dir)


@query
def parent_body(spark, sf_dir):
    joined = context.with_parent_body(build_context(spark, sf_dir), a.comments(spark, sf_dir))
    return joined.select("comment_id", "parent_id", "parent_body")


@query
def only_new(spark, sf_dir):
    return context.only_new(build_context(spark, sf_dir), a.mentions(spark, sf_dir)).select("comment_id", "submission_id")


def _with_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = a.comments(spark, sf_dir).select(F.col("id").alias("_id"), "link_id")
    m = a.mentions(spark, sf_dir).select("comment_id", "submission_id", "aspect")
    return m.join(c, m.comment_id == c["_id"], "left").drop("_id")


def _or_join(spark: SparkSession, sf_dir: str, **options: bool) -> DataFrame:
    posts = a.subs(spark, sf_dir).select(F.col("id").alias("post"), "subreddit", F.col("id").alias("matched"))
    found = joins.or_join(
        _with_link(spark, sf_dir), ids.short_id("link_id"), F.col("submission_id"), posts, "post", **options
    )
    return found.select("comment_id", "aspect", "matched", "subreddit")


@query
def fact_or_join(spark, sf_dir):
    return _or_join(spark, sf_dir)


@query
def fact_or_join_unique(spark, sf_dir):
    return _or_join(spark, sf_dir, unique=True)


@query
def fact_priority_join(spark, sf_dir):
    return _or_join(spark, sf_dir, prefer_first=True)


@query
def fact_priority_join_unique(spark, sf_dir):
    return _or_join(spark, sf_dir, prefer_first=True, unique=True)


def _merged_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.merge_metrics(
        metrics.submission_metrics(a.subs(spark, sf_dir)), metrics.comment_metrics(a.comments(spark, sf_dir))
    )


@query
def merge_metrics(spark, sf_dir):
    return _merged_metrics(spark, sf_dir)


@query
def coverage_grid(spark, sf_dir):
    s = a.subs(spark, sf_dir)
    return joins.expected_grid(s.select("subreddit").distinct(), SORT_TYPES, s.select("partition_date"))


# --- Extraction and names ---------------------------------------------------------


@query
def prompt_build(spark, sf_dir):
    told = context.with_parent_body(build_context(spark, sf_dir), a.comments(spark, sf_dir))
    return prompts.with_prompt(told).select("comment_id", "prompt")


@query
def prompt_brands(spark, sf_dir):
    return prompts.system_text(a.products(spark, sf_dir))


def stub_scorer() -> extract.Scorer:
    """A scorer that mentions every comment once, with a score from its length."""
    def answer(body: str) -> str:
        return json.dumps([{"brand_name": "Brand#1", "aspect": "Camera", "sentiment_score": len(body) % 11 / 10}])

    def scorer(batch: pd.DataFrame) -> pd.Series:
        return batch["body"].map(answer)

    return scorer


@query
def score_stub(spark, sf_dir):
    scored = extract.parse_responses(extract.score(build_context(spark, sf_dir), stub_scorer))
    return extract.finish_mentions(scored).select(
        "comment_id", "brand_name", "product_name", "aspect", rounded("sentiment_score").alias("sentiment_score")
    )


@query
def parse_responses(spark, sf_dir):
    return extract.parse_responses(a.responses(spark, sf_dir)).select("comment_id", *extract.FIELDS)


@query
def parse_responses_strict(spark, sf_dir):
    return extract.parse_responses(a.responses(spark, sf_dir), strict=True).select("comment_id", *extract.FIELDS)


@query
def mention_defaults(spark, sf_dir):
    return extract.finish_mentions(extract.parse_responses(a.responses(spark, sf_dir))).select("comment_id", *extract.FIELDS)


@query
def lexicon_mentions(spark, sf_dir):
    bodies = a.comments(spark, sf_dir).select(F.col("id").alias("comment_id"), "body")
    found = extract.lexicon_mentions(bodies, a.lexicon(spark, sf_dir))
    return found.select(
        "comment_id", "brand_name", "product_name", "aspect",
        rounded(F.col("sentiment_score").cast("double")).alias("sentiment_score"),
    )


@query
def resolve_exact(spark, sf_dir):
    return resolve.resolve_exact(a.raw_mentions(spark, sf_dir), a.catalogue(spark, sf_dir))


@query
def resolve_brand_difflib(spark, sf_dir):
    brands = a.raw_mentions(spark, sf_dir).select(F.col("brand_name").alias("raw_brand")).distinct()
    return resolve.resolve_brands(brands, a.catalogue(spark, sf_dir))


@query
def resolve_model_difflib(spark, sf_dir):
    return resolve.resolve_mentions(a.raw_mentions(spark, sf_dir), a.catalogue(spark, sf_dir))


@query
def resolve_lev(spark, sf_dir):
    return resolve.resolve_mentions(
        a.raw_mentions(spark, sf_dir), a.catalogue(spark, sf_dir), matcher=resolve.EDITS
    )


@query
def brand_models(spark, sf_dir):
    return resolve.brand_models(a.catalogue(spark, sf_dir))


# --- Aggregates -------------------------------------------------------------------


@query
def submission_metrics(spark, sf_dir):
    return metrics.submission_metrics(a.subs(spark, sf_dir))


@query
def comment_metrics(spark, sf_dir):
    return metrics.comment_metrics(a.comments(spark, sf_dir))


@query
def run_metrics(spark, sf_dir):
    return metrics.run_metrics(_merged_metrics(spark, sf_dir))


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = quality.usable_ratio(a.subs_silver(spark, sf_dir), "submissions")
    return s.unionByName(quality.usable_ratio(a.comments_silver(spark, sf_dir), "comments"))


@query
def usable_ratio(spark, sf_dir):
    return _ratios(spark, sf_dir).withColumn("ratio", rounded("ratio"))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = a.comments(spark, sf_dir).withColumn("subreddit", path_part("source_file", "subreddit"))
    return metrics.listing_summary(a.subs(spark, sf_dir), c)


@query
def listing_summary(spark, sf_dir):
    return _listing(spark, sf_dir)


@query
def listing_spans(spark, sf_dir):
    return metrics.listing_spans(_listing(spark, sf_dir))


@query
def metrics_long(spark, sf_dir):
    rows = metrics.as_recorded(metrics.run_metric_rows(_merged_metrics(spark, sf_dir)), "test", "bronze", None, "run")
    return rows.drop("recorded_at")


@query
def quality_metrics(spark, sf_dir):
    return metrics.quality_metric_rows(_ratios(spark, sf_dir)).select("metric", rounded("value").alias("value"), "unit")


@query
def sentiment_summary(spark, sf_dir):
    done = analytics.sentiment_summary(a.mentions(spark, sf_dir))
    return done.withColumn("avg_sentiment_score", rounded("avg_sentiment_score"))


@query
def reference_counts(spark, sf_dir):
    return analytics.reference_counts(a.products(spark, sf_dir))


def _average(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_sentiment", rounded("avg_sentiment"))


@query
def sentiment_by_price(spark, sf_dir):
    return _average(analytics.sentiment_by_price(a.mentions(spark, sf_dir), a.products(spark, sf_dir)))


@query
def sentiment_by_segment(spark, sf_dir):
    return _average(analytics.sentiment_by_price(a.mentions(spark, sf_dir), a.products(spark, sf_dir), by_brand=False))


@query
def sentiment_by_5g(spark, sf_dir):
    return _average(analytics.sentiment_by_5g(a.mentions(spark, sf_dir), a.products(spark, sf_dir)))


@query
def aspect_by_spec(spark, sf_dir):
    done = analytics.aspect_by_spec(a.mentions(spark, sf_dir), a.products(spark, sf_dir), at_least=20)
    return done.withColumn("camera_sentiment", rounded("camera_sentiment"))


@query
def aspect_by_figure(spark, sf_dir):
    done = analytics.aspect_by_spec(
        a.mentions(spark, sf_dir), a.products(spark, sf_dir), at_least=None, by_product=False
    )
    return done.withColumn("camera_sentiment", rounded("camera_sentiment"))


@query
def distinct_groups(spark, sf_dir):
    return analytics.distinct_groups(build_context(spark, sf_dir))


# --- Windows, sort, limit ---------------------------------------------------------


@query
def latest_event(spark, sf_dir):
    e = a.table(spark, sf_dir, "events")
    return latest_per_key(e, ["user_id", "event_type"], "ts", ["event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


@query
def latest_per_link(spark, sf_dir):
    return latest_per_key(a.comments(spark, sf_dir), "link_id", "updated_at", ["id"]).select("link_id", "id", "updated_at")


@query
def surrogate_keys(spark, sf_dir):
    return surrogate_key(a.subs(spark, sf_dir).select("id"), "id", "row_key")


@query
def top_n_per_group(spark, sf_dir):
    since = F.col("created_utc") >= a.START + 86400
    order = [F.desc("score"), F.col("id")]
    return top_n(a.subs(spark, sf_dir), "subreddit", order, 5, since).select("subreddit", "rank", "id", "score")


@query
def listing_top(spark, sf_dir):
    order = [F.desc("score"), F.col("id")]
    found = listing(a.subs(spark, sf_dir), "top", order, a.START + 2 * 86400, "day", 4)
    return found.select("subreddit", "sort_type", "rank", "id")


@query
def comments_per_submission(spark, sf_dir):
    order = [F.desc("score"), F.col("id")]
    return top_n(a.comments(spark, sf_dir), "link_id", order, 3).select("link_id", "rank", "id")


@query
def comments_ranked(spark, sf_dir):
    """All comments of each submission in order: nothing is cut by default."""
    order = [F.desc("score"), F.col("id")]
    return top_n(a.comments(spark, sf_dir), "link_id", order, None).select("link_id", "rank", "id")


@query
def latest_dates(spark, sf_dir):
    return analytics.latest_dates(a.subs(spark, sf_dir))


@query
def sample_rejects(spark, sf_dir):
    return analytics.sample_rejects(a.subs_silver(spark, sf_dir), ["id", "title", "selftext", quality.FLAG])


@query
def sample_reject_comments(spark, sf_dir):
    return analytics.sample_rejects(a.comments_silver(spark, sf_dir), ["id", "body", quality.FLAG])


# --- Upsert, jobs, incremental ----------------------------------------------------


def _event_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The latest events as target, and as source with older, equal and newer versions.

    Some users have another number on each side; some target versions are missing.
    """
    e = a.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    keys = ["user_id", "event_type"]
    latest = latest_per_key(e, keys, "ts", ["event_id"])
    user, event = F.col("user_id"), F.col("event_id")
    target = latest.withColumns(
        {"ts": F.when(user % 17 != 0, F.col("ts")), "user_id": F.when(user % 7 == 0, -user).otherwise(user)}
    )
    shift = F.make_dt_interval((event % 3 - 1).cast("int"))
    source = latest.withColumns({"ts": F.col("ts") + shift, "event_id": event + 1_000_000})
    return target, source


@query
def merge_latest_events(spark, sf_dir):
    target, source = _event_sides(spark, sf_dir)
    return merge_latest(target, source, ["user_id", "event_type"], "ts").select(
        "user_id", "event_type", "event_id", "value"
    )


def _second_observation(s: DataFrame) -> DataFrame:
    """Every post seen again on another day, with an older, the same or a newer version."""
    return s.withColumns(
        {
            "updated_at": F.col("updated_at") + (F.col("id").cast("bigint") % 3 - 1) * 10,
            "score": F.col("score") + 5000,
            "date": F.concat(F.lit("15"), F.substring("date", 3, 8)),
        }
    )


def _bronze_state(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.table(lake.bronze_table("submissions")).select("id", "updated_at", "score", "subreddit", "partition_date")


@query
def bronze_job(spark, sf_dir):
    """Two runs: the posts and comments, then a second look at the posts."""
    lake = _bronze_lake(spark, sf_dir)
    posts = _bronze_state(spark, lake)
    replies = spark.table(lake.bronze_table("comments")).select(
        "id", "updated_at", "score", F.lit(None).cast("string").alias("subreddit"), "partition_date"
    )
    return posts.unionByName(replies)


def _bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake, second = temp_lake(spark), scratch_path(spark, "second")
    run_bronze(spark, lake, _land_both(spark, sf_dir))
    _land(_second_observation(landed_subs(spark, sf_dir)), second, "submissions")
    run_bronze(spark, lake, second)
    return lake


@query
def bronze_rows_after(spark, sf_dir):
    """The row counts that the last run recorded after its upsert."""
    recorded = spark.table(_bronze_lake(spark, sf_dir).metrics).filter("metric LIKE 'Bronze%Rows'")
    return recorded.groupBy("metric").agg(F.max("value").alias("rows"))


@query
def incremental_final_state(spark, sf_dir):
    """Files arriving in two steps, streamed into bronze: the state of one batch run."""
    lake = temp_lake(spark)
    s = landed_subs(spark, sf_dir)
    root, progress = scratch_path(spark, "landing"), scratch_path(spark, "progress")
    for part in (s, _second_observation(s)):
        _land(part, root, "submissions")
        ingest_incremental(spark, lake, root, "submissions", progress)
    return _bronze_state(spark, lake)


def _as_bronze(df: DataFrame, kind: str) -> DataFrame:
    fields = bronze_schema(kind).fields
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def _silver_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = temp_lake(spark)
    tables.append(_as_bronze(a.subs(spark, sf_dir), "submissions"), lake.bronze_table("submissions"))
    tables.append(_as_bronze(a.comments(spark, sf_dir), "comments"), lake.bronze_table("comments"))
    run_silver_core(spark, lake)
    return lake


@query
def silver_job(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    return spark.table(lake.silver_table("comments")).select("id", "subreddit", "partition_date", quality.FLAG)


@query
def silver_posts_job(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    return spark.table(lake.silver_table("submissions")).select(*quality.SUBMISSION_COLUMNS, quality.FLAG)


def _sentiment_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = _silver_lake(spark, sf_dir)
    for _ in range(2):
        run_sentiment(spark, lake, a.catalogue(spark, sf_dir), lexicon=a.lexicon(spark, sf_dir), matcher=resolve.EDITS)
    return lake


@query
def sentiment_job(spark, sf_dir):
    """The mention job over the lexicon, run twice: the second run finds nothing new. Names that become equal
    leave several mentions, each with an id of its own."""
    return spark.table(_sentiment_lake(spark, sf_dir).sentiment).select(
        "submission_id", "comment_id", "brand_name", "product_name", "aspect",
        rounded("sentiment_score").alias("sentiment_score"), "quote", "date_partition", "model_version",
    )


@query
def check_unique_analysis(spark, sf_dir):
    return checks.check_unique(spark.table(_sentiment_lake(spark, sf_dir).sentiment), "analysis_id")


@query
def check_unique_silver(spark, sf_dir):
    silver = spark.table(_silver_lake(spark, sf_dir).silver_table("submissions"))
    return checks.check_unique(silver, "id").unionByName(checks.check_unique(silver.unionByName(silver.filter("score % 7 = 0")), "id"))


@query
def gold_job(spark, sf_dir):
    """The marts rebuilt twice from silver tables; the fact as the second run leaves it."""
    lake = _silver_lake(spark, sf_dir)
    tables.replace_table(a.products(spark, sf_dir), lake.reference, lake.path(lake.reference))
    mentions = a.mentions(spark, sf_dir)
    tables.append(mentions.select(*spark.table(lake.sentiment).columns), lake.sentiment)
    for _ in range(2):
        gold.build_gold(spark, lake)
    return spark.table(f"{lake.mart}.fact_brand_mentions")


@query
def mart_views(spark, sf_dir):
    """Silver posts under the name that consumers use."""
    lake, consumer = _silver_lake(spark, sf_dir), f"consumer_{uuid.uuid4().hex[:12]}"
    tables.replace_table(a.products(spark, sf_dir), lake.reference, lake.path(lake.reference))
    tables.register_mart_views(spark, lake.silver, consumer)
    return spark.table(f"{consumer}.reddit_submissions").groupBy("subreddit").agg(F.count("*").alias("rows"))


@query
def staged_view(spark, sf_dir):
    name = tables.stage(a.subs(spark, sf_dir), f"staged_{uuid.uuid4().hex[:12]}")
    return spark.sql(f"SELECT subreddit, count(*) AS rows, max(score) AS best FROM {name} GROUP BY subreddit")


@query
def replaced_table(spark, sf_dir):
    """A table that is replaced by rows made from itself."""
    lake = temp_lake(spark)
    name, path = f"{lake.ops}.replaced", f"{lake.location}/replaced"
    tables.replace_table(a.subs(spark, sf_dir).select("id", "score"), name, path)
    tables.replace_table(spark.table(name).filter("score % 2 = 0").withColumn("score", F.col("score") + 1), name, path)
    return spark.table(name)


@query
def seeded_once(spark, sf_dir):
    """A reference that is seeded from CSV, and not again from a second file."""
    lake = temp_lake(spark)
    name = f"{lake.ops}.seeded"
    p = a.products(spark, sf_dir).drop("brand")
    for part in (p, p.limit(1)):
        path = scratch_path(spark, "seed")
        part.write.option("header", "true").csv(path)
        reference.load_reference(spark, name, path, f"{lake.location}/seeded", PRODUCT_REFERENCE)
    return spark.table(name).select("brand_name", "model", "price", "brand")


@query
def table_columns(spark, sf_dir):
    """Housekeeping: the tables of a lake's silver schema with the columns of the posts."""
    lake = _silver_lake(spark, sf_dir)
    found = tables.list_tables(spark, lake.silver).filter("NOT isTemporary").select(F.col("tableName").alias("name"), F.lit("table").alias("kind"))
    columns = tables.describe_table(spark, lake.silver_table("submissions")).filter("NOT startswith(col_name, '#')")
    posts = spark.table(lake.silver_table("submissions")).count()
    return found.unionByName(columns.select(F.col("col_name").alias("name"), F.col("data_type").alias("kind")).distinct()).withColumn("posts", F.lit(posts))


def _checkpoints(spark: SparkSession, sf_dir: str, save: Callable[[DataFrame], None]) -> None:
    def records(part: Column) -> DataFrame:
        e = a.table(spark, sf_dir, "events").filter(part)
        return e.select(
            F.lit("prod").alias("environment"),
            F.concat(F.lit(" user"), F.col("user_id")).alias("subreddit"),
            F.lit("listing").alias("checkpoint_type"),
            F.when(F.col("user_id") % 3 != 0, F.col("event_type")).alias("sort_type"),
            F.lit("all").alias("time_filter"),
            F.lit(None).cast("string").alias("last_token"),
            F.col("event_id").alias("last_timestamp"),
            F.floor("value").alias("items_fetched"),
            F.lit(None).cast("string").alias("s3_location"),
        )

    early = F.col("event_id") % 2 == 0
    save(records(early))
    save(records(~early))


@query
def checkpoint_upsert(spark, sf_dir):
    state = [spark.createDataFrame([], CHECKPOINTS)]
    _checkpoints(spark, sf_dir, lambda records: state.append(upsert_checkpoints(state[-1], records)))
    return state[-1].select("subreddit", "sort_type", "time_filter", "last_timestamp", "items_fetched")


@query
def checkpoint_lookup(spark, sf_dir):
    """One record out of the saved ones, with and without a sort type."""
    lake = temp_lake(spark)
    _checkpoints(spark, sf_dir, lambda records: save_checkpoint(spark, lake, records))
    plain = load_checkpoint(spark, lake, " user3 ", "listing")
    sorted_ = load_checkpoint(spark, lake, "user4", "listing", "click", "all")
    return plain.unionByName(sorted_).select("subreddit", "sort_type", "time_filter", "last_timestamp", "items_fetched")


# --- Marts ------------------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    """The calendar with the orders of each day."""
    orders = a.table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    calendar = gold.dim_date(spark)
    joined = calendar.join(per_day, calendar.full_date == per_day.day, "left").drop("day")
    return joined.fillna(0, ["orders"])


@query
def dim_product(spark, sf_dir):
    done = gold.dim_product(a.products(spark, sf_dir))
    return done.withColumn("price_usd", rounded("price_usd"))


@query
def dim_submission(spark, sf_dir):
    done = gold.dim_submission(a.subs(spark, sf_dir))
    return done.withColumn("created_at", F.col("created_at").cast("string"))


@query
def fact_product_fk(spark, sf_dir):
    return gold.with_product_key(a.mentions(spark, sf_dir), gold.dim_product(a.products(spark, sf_dir))).select(
        "comment_id", "brand_name", "product_name", "product_key")


@query
def fact_mentions(spark, sf_dir):
    return gold.fact_mentions(
        a.mentions(spark, sf_dir),
        a.comments(spark, sf_dir),
        gold.dim_product(a.products(spark, sf_dir)),
        gold.dim_submission(a.subs(spark, sf_dir)),
        gold.dim_date(spark),
    )


# --- Reconciliation and checks ----------------------------------------------------


@query
def layer_counts(spark, sf_dir):
    return checks.layer_counts({"Bronze": a.subs(spark, sf_dir), "Silver-core": a.subs_silver(spark, sf_dir)})


@query
def submission_flow(spark, sf_dir):
    return checks.submission_flow(a.subs(spark, sf_dir), a.subs_silver(spark, sf_dir))


@query
def comment_flow(spark, sf_dir):
    return checks.comment_flow(a.comments(spark, sf_dir), a.comments_silver(spark, sf_dir), a.mentions(spark, sf_dir))


@query
def check_no_drop(spark, sf_dir):
    kept = a.subs_silver(spark, sf_dir).filter("score % 10 <> 7 OR partition_date NOT LIKE '0%'")
    return checks.check_no_drop(a.subs(spark, sf_dir), kept)


@query
def check_flags(spark, sf_dir):
    number = F.col("id").cast("bigint")
    marked = a.subs_silver(spark, sf_dir).withColumn(
        quality.FLAG, F.when(number % 41 == 0, F.lit(None)).when(number % 5 == 0, True).otherwise(F.col(quality.FLAG))
    )
    return checks.check_flags(marked, "selftext", text.SUBMISSION_MIN_CHARS, "title")


@query
def check_unusable_analysed(spark, sf_dir):
    return checks.check_unusable_analysed(a.comments_silver(spark, sf_dir), a.mentions(spark, sf_dir))


@query
def check_missing_analysis(spark, sf_dir):
    return checks.check_missing_analysis(a.comments_silver(spark, sf_dir), a.mentions(spark, sf_dir))


@query
def check_brand_domain(spark, sf_dir):
    return checks.check_brand_domain(a.mentions(spark, sf_dir), a.products(spark, sf_dir))


@query
def check_score_range(spark, sf_dir):
    return checks.check_score_range(a.mentions(spark, sf_dir)).select("comment_id", "sentiment_score")


@query
def check_ratio(spark, sf_dir):
    by_kind = _ratios(spark, sf_dir)
    usable_only = quality.usable_ratio(a.subs_silver(spark, sf_dir).filter(quality.FLAG), "usable")
    return checks.check_ratio(by_kind.unionByName(usable_only))


@query
def check_coverage(spark, sf_dir):
    return checks.check_coverage(coverage_grid(spark, sf_dir), a.subs(spark, sf_dir))


@query
def check_unique(spark, sf_dir):
    return checks.check_unique(a.comments(spark, sf_dir).select("link_id"), "link_id")
