"""The given tables seen as posts, comments, products and mentions.

Each function has a view of the same name and columns in ``oracle.VIEWS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlake.functions.dates import epoch_date, epoch_ts, process_date
from mentionlake.functions.ids import fullname
from mentionlake.operators.context import silver_comments
from mentionlake.operators.extract import with_analysis_id
from mentionlake.operators.quality import silver_submissions

START = 1704067200  # 2024-01-01 in epoch seconds
TWO_YEARS = 2 * 365 * 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sort_type(c: str) -> Column:
    return F.when(F.col(c) % 2 == 0, "top").otherwise("controversial")


def subs(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    selftext = (
        F.when(doc % 17 == 0, "[deleted]").when(doc % 19 == 0, "[removed]")
        .when(doc % 23 == 0, "").when(doc % 29 == 0, F.lit(None)).otherwise(F.col("text"))
    )
    created = F.lit(START) + (doc * 900) % TWO_YEARS
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("id"),
        fullname("submission", doc.cast("string")).alias("fullname_id"),
        F.col("source").alias("subreddit"),
        F.substring("text", 1, 40).alias("title"),
        selftext.alias("selftext"),
        created.alias("created_utc"),
        (created + F.col("n_chars")).alias("updated_at"),
        (F.col("n_chars") % 1000).cast("int").alias("score"),
        ((doc % 100) / 100).alias("upvote_ratio"),
        (doc % 50).cast("int").alias("num_comments"),
        _sort_type("doc_id").alias("sort_type"),
        process_date(epoch_date(created)).alias("partition_date"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    created = F.lit(START) + (conv * 3600 + turn * 60) % TWO_YEARS
    link = F.when(conv % 11 == 0, "t3_missing").otherwise(F.concat(F.lit("t3_"), conv.cast("string")))
    date = process_date(epoch_date(created))
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat_ws("-", conv, turn).alias("id"),
        link.alias("link_id"),
        F.when(turn == 0, link).otherwise(F.concat(F.lit("t1_"), F.concat_ws("-", conv, turn - 1))).alias("parent_id"),
        F.col("role").alias("author"),
        F.when((conv + turn) % 13 == 0, "[deleted]").otherwise(F.col("text")).alias("body"),
        created.alias("created_utc"),
        (created + F.length("text")).alias("updated_at"),
        (F.length("text") % 200 - 50).alias("score"),
        _sort_type("conv_id").alias("sort_type"),
        F.concat(
            F.lit("file:/lake/reddit/"), _sort_type("conv_id"), F.lit("/subreddit=src"), conv % 20 + 1,
            F.lit("/date="), date, F.lit("/comments.jsonl"),
        ).alias("source_file"),
        date.alias("partition_date"),
    )


def subs_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_submissions(subs(spark, sf_dir))


def comments_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_comments(comments(spark, sf_dir), subs(spark, sf_dir))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per part, with a model name of its own."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand_name"),
        F.concat_ws(" ", "p_name", key).alias("model"),
        ((key % 100) * 700.0).alias("price"),
        (size / 5).alias("avg_rating"),
        (size % 2).alias("5G_or_not"),
        F.col("p_type").alias("processor_brand"),
        (size % 8).alias("num_cores"),
        (size / 10).alias("processor_speed"),
        (size * 100).alias("battery_capacity"),
        (size % 3).alias("fast_charging_available"),
        (size * 2).alias("fast_charging"),
        (size % 16).alias("ram_capacity"),
        (size * 8).alias("internal_memory"),
        (size / 8).alias("screen_size"),
        (size + 60).alias("refresh_rate"),
        (size % 4).alias("num_rear_cameras"),
        F.lit("android").alias("os"),
        size.alias("primary_camera_rear"),
        (size % 20).alias("primary_camera_front"),
        (size % 2).alias("extended_memory_available"),
        (size * 40).alias("resolution_height"),
        (size * 20).alias("resolution_width"),
        F.lower("p_brand").alias("brand"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (brand, name) pairs of the parts: a reference with shared model names."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand_name"), F.col("p_name").alias("model"), F.lower("p_brand").alias("brand")
    ).distinct()


def _with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    c = comments(spark, sf_dir)
    return c.join(part, c.conv_id == part.p_partkey)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    model = F.concat_ws(" ", "p_name", "p_partkey")
    submission = (
        F.when(conv % 13 == 0, "none").when(conv % 5 == 0, (conv + 1).cast("string")).otherwise(conv.cast("string"))
    )
    # Some mentions are of comments that are gone.
    comment = F.when(conv % 7 == 3, F.concat("id", F.lit("-gone"))).otherwise(F.col("id"))
    rows = _with_part(spark, sf_dir).select(
        submission.alias("submission_id"),
        comment.alias("comment_id"),
        F.when(turn % 3 == 0, F.upper("p_brand")).when(turn % 7 == 5, "Nobrand").otherwise(F.col("p_brand")).alias("brand_name"),
        F.when(turn % 4 == 3, "general").when(turn % 4 == 1, F.upper(model)).otherwise(model).alias("product_name"),
        F.element_at(F.array(*map(F.lit, ["camera", "battery", "display", "price", "general"])), (turn % 5 + 1).cast("int")).alias("aspect"),
        F.when(conv % 31 == 0, 1.5).otherwise(F.length("body") % 101 / 100).alias("sentiment_score"),
        F.substring("body", 1, 200).alias("quote"),
        F.lit("adapter").alias("model_version"),
        F.when(conv % 37 != 0, epoch_ts("created_utc")).alias("analyzed_at"),
        F.col("partition_date").alias("date_partition"),
    )
    return with_analysis_id(rows)


def raw_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions whose names are misspelt in several ways, against ``catalogue``."""
    conv = F.col("conv_id")
    kind, spelling = conv % 6, (conv + F.col("turn")) % 5
    brand = (
        F.when(kind == 1, F.lower("p_brand")).when(kind == 2, F.replace("p_brand", F.lit("Brand"), F.lit("Brnd")))
        .when(kind == 3, "").when(kind == 4, "Zzyx").when(kind == 5, F.upper("p_brand")).otherwise(F.col("p_brand"))
    )
    name = (
        F.when(spelling == 1, F.upper("p_name")).when(spelling == 2, F.substring("p_name", 2, 100))
        .when(spelling == 3, "General").when(spelling == 4, F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit("x")))
        .otherwise(F.col("p_name"))
    )
    return _with_part(spark, sf_dir).select(
        F.col("id").alias("comment_id"), brand.alias("brand_name"), name.alias("product_name")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorer answers of every shape, one per comment."""
    def item(score: str, aspect: str = '"Camera"', quote: Column | None = None) -> Column:
        said = F.lit('""') if quote is None else F.concat(F.lit('"'), quote, F.lit('"'))
        return F.concat(
            F.lit('{"brand_name": "'), "p_brand", F.lit('", "product_name": "'), "p_name",
            F.lit(f'", "aspect": {aspect}, "sentiment_score": {score}, "quote": '), said, F.lit("}"),
        )

    turn = F.col("turn")
    lb, rb = F.lit("["), F.lit("]")
    text = (
        F.when(turn == 0, F.concat(lb, item("0.25"), rb))
        .when(turn == 1, F.concat(F.lit("```json\n"), lb, item('"0.75"', "null"), rb, F.lit("\n```")))
        .when(turn == 2, item("0.5"))
        .when(turn == 3, F.concat(lb, item("0.5"), F.lit(', {"brand_name": ')))
        .when(turn == 4, F.concat(F.lit(" \t"), lb, rb))
        .when(turn == 5, F.concat(lb, item("0.9", quote=F.col("p_name")), F.lit(", 7, "), item('"high"'), rb))
        .when(turn == 6, F.concat(F.lit("```"), lb, item("null"), rb, F.lit("```")))
        .when(turn == 7, F.concat(lb, item("0.5"), rb, F.lit(" I hope this helps")))
        .when(turn == 8, F.concat(lb, item("0.5"), rb, lb, item("0.5"), rb))
        .when(turn == 9, F.concat(lb, item("0.5"), F.lit(","), rb))
        .when(turn == 10, F.concat(lb, F.replace(item("0.1"), F.lit('"quote"'), F.lit('"aspect": "Battery", "quote"')), rb))
    )
    return _with_part(spark, sf_dir).select(F.col("id").alias("comment_id"), "body", text.alias("response"))


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the benchmark texts; their length decides what they stand for.

    Some brands and products are misspelt, so that different names of a comment become one.
    """
    words = table(spark, sf_dir, "benchmark").select(
        F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("token")
    ).filter("token <> ''").distinct()
    size = F.length("token")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    aspect = F.when(size % 8 == 6, "camera").otherwise("battery")
    value = (
        F.when(size % 8 == 0, F.replace("p_brand", F.lit("Brand"), F.lit("Brnd"))).when(size % 4 == 0, F.col("p_brand"))
        .when(size % 8 == 1, F.concat("p_name", F.lit("x"))).when(size % 4 == 1, F.col("p_name")).when(size % 4 == 2, aspect)
    )
    kind = F.when(size % 4 == 0, "brand").when(size % 4 == 1, "product").when(size % 4 == 2, "aspect").otherwise("polarity")
    # Words of eight letters more name the same part.
    return words.join(part, F.col("p_partkey") == (size - 1) % 4 + 1, "left").select(
        "token", kind.alias("kind"), value.alias("value"), (size % 11 / 10).alias("weight")
    )
