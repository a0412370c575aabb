"""Hot keys and plans: what must hold when one key has a third of the rows."""

import uuid

import pytest
from pyspark.sql import functions as F

from mentionlake.operators import analytics, context, resolve
from mentionlake.operators.sizes import lookup
from mentionlake.plans import gold
from mentionlake.sources.tables import clustered
from mentionlake.workload import adapters, queries

SF = "/root/testdata/sf0.001"
SKEW = {
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def small_partitions(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield spark
    for key in SKEW:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=30000):
    """Half of the comments belong to one submission, the rest to many."""
    rows = spark.range(n).repartition(8)
    key = F.when(F.col("id") % 2 == 0, "t3_hot").otherwise(F.concat(F.lit("t3_"), F.col("id").cast("string")))
    return rows.select(
        F.col("id").cast("string").alias("id"), key.alias("link_id"), key.alias("parent_id"),
        F.md5(F.col("id").cast("string")).alias("body"), F.lit(True).alias("is_usable_for_sentiment"),
        F.lit("05-01-2024").alias("partition_date"),
    )


def posts(spark):
    links = spark.range(0, 30000, 3).select(F.concat(F.lit("t3_"), F.col("id").cast("string")).alias("fullname_id"))
    return links.unionByName(spark.createDataFrame([("t3_hot",)], "fullname_id string")).select(
        "fullname_id", F.lit("phones").alias("subreddit"), F.substring("fullname_id", 4, 20).alias("id"),
        F.lit("t").alias("title"), F.lit("s").alias("selftext"),
    )


def test_hot_submission_is_split(small_partitions):
    spark = small_partitions
    assert "skew=true" in plan_after(context.with_subreddit(hot(spark), posts(spark)))
    assert "skew=true" in plan_after(context.build_context(hot(spark), posts(spark)))


def test_hot_partition_is_split_on_write(small_partitions, tmp_path):
    spark = small_partitions
    clustered(hot(spark), ["partition_date"]).write.partitionBy("partition_date").parquet(str(tmp_path / "out"))
    assert len(list((tmp_path / "out" / "partition_date=05-01-2024").glob("*.parquet"))) > 1


def test_fact_join_splits_hot_submission_and_spreads_missing_keys(small_partitions):
    spark = small_partitions
    mentions = hot(spark).select(
        F.when(F.col("body") == "", "none").alias("submission_id"), F.col("id").alias("comment_id"),
        F.when(F.col("link_id") == "t3_hot", "apple").otherwise("nokia").alias("brand_name"),
        F.concat(F.lit("model "), F.col("id").cast("int") % 5).alias("product_name"),
        F.lit("camera").alias("aspect"), F.lit(0.5).alias("sentiment_score"),
    )
    comments = hot(spark).select(
        "id", F.when(F.col("link_id") == "t3_hot", F.col("link_id")).alias("link_id"),
        F.lit(1704412800).cast("bigint").alias("created_utc"), F.lit(1).alias("score"),
    )
    products = spark.createDataFrame([(1, "apple", "x")], "product_key bigint, brand_name string, model string")
    keys = posts(spark).select(F.col("id").alias("reddit_submission_id"), F.monotonically_increasing_id().alias("submission_key"))
    fact = gold.fact_mentions(mentions, comments, products, keys, gold.dim_date(spark))
    plan = plan_after(fact)
    assert "skew=true" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert fact.count() == 30000 and fact.filter("submission_key IS NOT NULL").count() == 15000


def test_hot_product_is_summed_before_the_join(spark):
    plan = analytics.sentiment_by_5g(adapters.mentions(spark, SF), adapters.products(spark, SF))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    join, aggregate = text.rindex("Join Inner, ((brand"), text.rindex("Aggregate [")
    assert aggregate > join  # the lowest aggregate lies below the join with the products


def test_lookup_is_salted_and_broadcast_by_size_alone(spark, rows):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("key"), F.col("id").alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", -1)], "key string, v bigint"))
    for how in ("inner", "left"):
        found = lookup(left, "k", right, "key", how)
        assert "_salt" in found._jdf.queryExecution().executedPlan().toString()
        plain = left.join(right, left.k == right.key, how)
        assert found.columns == plain.columns and rows(found) == rows(plain)


def test_hot_brand_is_matched_whole(spark):
    texts = spark.range(2000).select(F.lit("brand:hot").alias("block"), F.concat(F.lit("galaxy "), F.col("id").cast("string")).alias("text"))
    options = spark.createDataFrame([("brand:hot", "galaxy s1")], "block string, candidate string")
    assert resolve.best_match(texts, options, 0.6).count() == 2000
    text = resolve.best_match(texts, options, 0.6, resolve.EDITS)._jdf.queryExecution().executedPlan().toString()
    assert "levenshtein" in text and "Python" not in text and "Pandas" not in text



READS = 8


@pytest.mark.parametrize("name", sorted(
    n for n in queries.QUERIES if not n.startswith("landing") and n not in
    {"bronze_job", "silver_job", "sentiment_job", "incremental_final_state", "partition_scan", "append_count",
     "overwrite_partitions", "ref_csv_roundtrip", "bronze_rows_after", "silver_posts_job", "check_unique_analysis",
     "check_unique_silver", "gold_job", "mart_views", "replaced_table", "seeded_once", "table_columns", "checkpoint_lookup"}
))
def test_no_query_plans_a_cross_join_or_runs_while_it_is_built(spark, name):
    context = spark.sparkContext
    context.setJobGroup(f"plan-{name}", name)
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    ran = [context.statusTracker().getJobInfo(i) for i in context.statusTracker().getJobIdsForGroup(f"plan-{name}")]
    context.setJobGroup("tests", "")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Parquet footers are the one thing that is read.
    assert all(len(job.stageIds) == 1 for job in ran) and len(ran) <= READS


def test_scratch_names_do_not_repeat(spark):
    from mentionlake.session import scratch_path

    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert uuid.UUID(scratch_path(spark, "x").rsplit("-", 1)[1])
