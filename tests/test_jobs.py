import json

import pandas as pd
import pytest

from mentionlake.operators.checks import check_unique
from mentionlake.operators.extract import LEXICON
from mentionlake.plans.bronze import run_bronze
from mentionlake.plans.checkpoints import load_checkpoint, save_checkpoint
from mentionlake.plans.gold import build_gold
from mentionlake.plans.sentiment import run_sentiment
from mentionlake.plans.silver import run_silver_core
from mentionlake.schemas import CHECKPOINTS, PRODUCT_REFERENCE
from mentionlake.sources.tables import replace_table
from mentionlake.streaming.incremental import ingest_incremental
from test_landing import put

TEXT = "the apple camera is great and the battery is bad"


def post(i, updated, **more):
    return {"id": i, "fullname_id": f"t3_{i}", "subreddit": "phones", "title": f"About {i}", "selftext": "some longer text",
            "created_utc": 1704412800, "updated_at": updated, "score": updated, **more}


def comment(i, link, updated, body=TEXT, parent=None):
    return {"id": i, "fullname_id": f"t1_{i}", "submission_id": link, "link_id": f"t3_{link}", "parent_id": parent or f"t3_{link}",
            "body": body, "created_utc": 1704412800, "updated_at": updated, "score": 3}


def first_day(tmp_path):
    put(tmp_path, "top", "phones", "05-01-2024", "submissions.jsonl", [post("s1", 10), post("s2", 10, selftext="[deleted]"), "broken"])
    put(tmp_path, "controversial", "phones", "05-01-2024", "submissions.jsonl", [post("s1", 10)])
    put(tmp_path, "top", "phones", "05-01-2024", "comments.jsonl", [
        comment("c1", "s1", 10), comment("c2", "s1", 10, "[removed]"), comment("c3", "s2", 10, parent="t1_c1"), comment("c4", "gone", 10),
    ])
    return str(tmp_path / "reddit")


def second_day(tmp_path):
    put(tmp_path, "top", "phones", "06-01-2024", "submissions.jsonl", [post("s1", 20), post("s2", 20), post("s3", 20)])
    put(tmp_path, "top", "phones", "06-01-2024", "comments.jsonl", [comment("c5", "s1", 20), comment("c1", "s1", 20)])


def reference(spark, lake):
    names = PRODUCT_REFERENCE.names
    row = {**dict.fromkeys(names, None), "brand_name": "Apple", "model": "iPhone 15", "price": 1000.0, "5G_or_not": 1}
    df = spark.createDataFrame([tuple(row[n] for n in names)], PRODUCT_REFERENCE).selectExpr("*", "lower(brand_name) AS brand")
    replace_table(df, lake.reference, lake.path(lake.reference))
    return spark.table(lake.reference)


def lexicon(spark):
    return spark.createDataFrame([
        ("apple", "brand", "apple", None), ("camera", "aspect", "camera", None), ("battery", "aspect", "battery", None),
        ("great", "polarity", None, 1.0), ("bad", "polarity", None, 0.0),
    ], LEXICON)


def test_the_whole_way(spark, lake, tmp_path, rows):
    root = first_day(tmp_path)
    assert run_bronze(spark, lake, root, "05-01-2024") == ["05-01-2024"]
    submissions, comments = (lake.bronze_table(k) for k in ("submissions", "comments"))
    assert rows(spark.table(submissions), "id", "source_sort_type") == [("s1", "controversial"), ("s2", "top")]
    assert rows(spark.table(lake.quarantine), "reason", "line") == [("malformed", "broken")]

    assert run_silver_core(spark, lake, ["05-01-2024"])
    silver = spark.table(lake.silver_table("comments"))
    assert rows(silver, "id", "subreddit", "is_usable_for_sentiment") == [
        ("c1", "phones", True), ("c2", "phones", False), ("c3", "phones", True), ("c4", None, True),
    ]
    ref = reference(spark, lake)
    assert run_sentiment(spark, lake, ref, lexicon=lexicon(spark)) == 2
    assert run_sentiment(spark, lake, ref, lexicon=lexicon(spark)) == 0
    mentions = rows(spark.table(lake.sentiment), "comment_id", "brand_name", "aspect", "sentiment_score")
    assert mentions == sorted((c, "apple", a, s) for c in ("c1", "c3") for a, s in (("battery", 0.0), ("camera", 1.0), ("general", 0.5)))

    # Second day: s1, s2 and c1 are seen again and leave the first day.
    second_day(tmp_path)
    touched = run_bronze(spark, lake, root, "06-01-2024")
    assert touched == ["05-01-2024", "06-01-2024"]
    run_silver_core(spark, lake, touched)
    for kind in ("submissions", "comments"):
        assert check_unique(spark.table(lake.silver_table(kind)), "id").count() == 0
    assert rows(spark.table(lake.silver_table("submissions")), "id", "partition_date") == [(s, "06-01-2024") for s in ("s1", "s2", "s3")]
    assert run_sentiment(spark, lake, ref, touched, lexicon=lexicon(spark)) == 1  # only c5 is new
    assert check_unique(spark.table(lake.sentiment), "analysis_id").count() == 0

    for _ in range(2):
        build_gold(spark, lake)
        fact = spark.table(f"{lake.mart}.fact_brand_mentions")
        assert fact.count() == 9 and fact.filter("submission_key IS NULL OR date_key IS NULL").count() == 0
    assert spark.table(f"{lake.mart}.dim_submission").count() == 3
    assert spark.table(f"{lake.mart}.dim_product").first()["price_usd"] == pytest.approx(11.0)

    recorded = spark.table(lake.metrics)
    assert {r.job for r in recorded.collect()} == {"bronze", "silver_core", "silver_sentiment"}
    assert recorded.filter("job = 'bronze' AND metric = 'SubmissionsProcessed'").select("process_date", "value").orderBy("process_date").collect() == [
        ("05-01-2024", 2.0), ("06-01-2024", 3.0),
    ]


def test_jobs_twice_give_the_same_state(spark, lake, tmp_path, rows):
    root = first_day(tmp_path)
    second_day(tmp_path)
    states = []
    for _ in range(2):
        run_bronze(spark, lake, root)
        run_silver_core(spark, lake)
        states.append(tuple(rows(spark.table(lake.silver_table(k)).drop("ingestion_timestamp")) for k in ("submissions", "comments")))
    assert states[0] == states[1]


def test_nothing_to_do(spark, lake, tmp_path):
    assert run_bronze(spark, lake, str(tmp_path / "empty")) == []
    assert run_silver_core(spark, lake) is False
    assert run_sentiment(spark, lake, reference(spark, lake), lexicon=lexicon(spark)) == 0


def test_submission_scope(spark, lake, tmp_path, rows):
    root = first_day(tmp_path)
    put(tmp_path, "top", "phones", "07-01-2024", "comments.jsonl", [comment("c9", "s1", 30)])
    run_bronze(spark, lake, root)
    for scope, subreddit in (("all", "phones"), ("partition", None)):
        run_silver_core(spark, lake, ["07-01-2024"], submission_scope=scope)
        assert rows(spark.table(lake.silver_table("comments")), "id", "subreddit") == [("c9", subreddit)]


def test_scorer_runs_once_per_comment(spark, lake, tmp_path, rows):
    run_bronze(spark, lake, first_day(tmp_path))
    run_silver_core(spark, lake)
    calls = tmp_path / "calls"
    calls.mkdir()

    def made_with(instructions):
        def factory():
            def answer(row):
                with open(calls / row["comment_id"], "a") as log:
                    log.write("x")
                if row["comment_id"] == "c3":
                    return "nothing to report"
                assert "About s1" in row["prompt"] and "apple" in instructions
                return "```json\n" + json.dumps([{"brand_name": "aple", "product_name": "iphone15", "sentiment_score": "0.7"}]) + "\n```"

            return lambda batch: pd.Series([answer(r) for _, r in batch.iterrows()])

        return factory

    ref = reference(spark, lake)
    for want in (2, 0):  # comments without mentions are not scored again
        assert run_sentiment(spark, lake, ref, scorer_factory=made_with, model_version="stub", partitions=2) == want
    assert {p.name: p.read_text() for p in calls.iterdir()} == {"c1": "x", "c3": "x"}
    assert rows(spark.table(lake.sentiment), "comment_id", "brand_name", "product_name", "aspect", "sentiment_score", "quote", "model_version") == [
        ("c1", "apple", "iPhone 15", "general", 0.7, TEXT, "stub"),
    ]
    with pytest.raises(ValueError):
        run_sentiment(spark, lake, ref)


@pytest.mark.parametrize("max_files", [None, 1])
def test_incremental_equals_batch(spark, lake, tmp_path, rows, max_files):
    root, progress = first_day(tmp_path), str(tmp_path / "progress")
    take = lambda: ingest_incremental(spark, lake, root, "submissions", progress, max_files=max_files)
    assert take() == ["05-01-2024"]
    assert take() == []
    second_day(tmp_path)
    assert take() == ["05-01-2024", "06-01-2024"]
    table = spark.table(lake.bronze_table("submissions"))
    assert rows(table, "id", "updated_at", "partition_date") == [(s, 20, "06-01-2024") for s in ("s1", "s2", "s3")]
    before = rows(table.drop("ingestion_timestamp"))
    run_bronze(spark, lake, root)  # the batch run over everything changes nothing
    assert rows(spark.table(lake.bronze_table("submissions")).drop("ingestion_timestamp")) == before


def test_a_replayed_batch_replaces_its_rejected_lines(spark, lake, tmp_path, rows, monkeypatch):
    from mentionlake.streaming import incremental

    root, progress = first_day(tmp_path), str(tmp_path / "progress")
    land = incremental.land_batch

    def stop_after_writing(*args):
        land(*args)
        raise RuntimeError("stopped")

    monkeypatch.setattr(incremental, "land_batch", stop_after_writing)
    with pytest.raises(Exception, match="stopped"):
        ingest_incremental(spark, lake, root, "submissions", progress)
    rejected = rows(spark.table(lake.quarantine), "reason", "line", "batch")
    assert [r[:2] for r in rejected] == [("malformed", "broken")] and "None" not in rejected[0][2]
    monkeypatch.setattr(incremental, "land_batch", land)
    bronze = rows(spark.table(lake.bronze_table("submissions")).drop("ingestion_timestamp"))
    # The dates are told again, since the answer of the first attempt was lost.
    assert ingest_incremental(spark, lake, root, "submissions", progress) == ["05-01-2024"]
    assert rows(spark.table(lake.quarantine), "reason", "line", "batch") == rejected
    assert rows(spark.table(lake.bronze_table("submissions")).drop("ingestion_timestamp")) == bronze


def test_a_repeated_run_replaces_its_rows(spark, lake, tmp_path, rows):
    root, states = first_day(tmp_path), []
    for _ in range(2):
        run_bronze(spark, lake, root, "05-01-2024", run_id="r1")
        run_silver_core(spark, lake, ["05-01-2024"], run_id="r1")
        states.append(rows(spark.table(lake.metrics).drop("recorded_at").fillna("")))
        assert rows(spark.table(lake.quarantine), "reason", "line") == [("malformed", "broken")]
    assert states[0] == states[1] and {r.job for r in spark.table(lake.metrics).collect()} == {"bronze", "silver_core"}
    run_bronze(spark, lake, root, "05-01-2024", run_id="r2")
    assert spark.table(lake.metrics).filter("run_id = 'r1'").count() == len(states[0])


def test_write_once(spark, lake, rows):
    from mentionlake.sources.tables import write_once

    bad = spark.createDataFrame([("no_id", "{}", "f", "01-01-2024")], "reason string, line string, source_file string, partition_date string")
    bad = bad.selectExpr("*", "current_timestamp() AS ingestion_timestamp")
    for batch in ("it's 1/2", "b"):
        write_once(bad.union(bad), lake.quarantine, {"batch": batch})
        write_once(bad, lake.quarantine, {"batch": batch})
    assert rows(spark.table(lake.quarantine), "batch", "line") == [("b", "{}"), ("it's 1/2", "{}")]
    for _ in range(2):  # the same batch without rows
        write_once(bad.limit(0), lake.quarantine, {"batch": "it's 1/2"})
        assert rows(spark.table(lake.quarantine), "batch", "line") == [("b", "{}")]
    with pytest.raises(ValueError, match="not partitioned"):
        write_once(bad, lake.quarantine, {"reason": "x"})


def test_checkpoints(spark, lake):
    def save(*records):
        save_checkpoint(spark, lake, spark.createDataFrame(list(records), CHECKPOINTS))

    record = ("test", " phones ", "listing", "top", "all", None, 100, 5, "s3://a")
    save(record, ("test", "phones", "listing", "top", None, None, 1, 1, None))
    save((*record[:6], 50, 9, "s3://b"))  # what is saved last counts, whatever its time
    got = load_checkpoint(spark, lake, "phones", "listing", "top", "all").collect()
    assert [(r.last_timestamp, r.items_fetched, r.s3_location) for r in got] == [(50, 9, "s3://b")]
    assert load_checkpoint(spark, lake, "phones", "listing", "top").first()["items_fetched"] == 1
    assert load_checkpoint(spark, lake, "tabs", "listing").count() == 0


def test_the_ledger_is_joined_as_it_lies(spark, lake):
    from mentionlake.plans.sentiment import not_analysed
    from mentionlake.sources.tables import append

    append(spark.range(900).selectExpr("concat('c', id) comment_id", "'01-01-2024' date_partition"), lake.analysed)
    append(spark.range(900, 1200).selectExpr("concat('c', id) comment_id", "'02-01-2024' date_partition").selectExpr(
        *[n if n in ("comment_id", "date_partition") else f"NULL AS {n}" for n in spark.table(lake.sentiment).columns]), lake.sentiment)
    context = spark.range(0, 2000, 2).selectExpr("concat('c', id) comment_id", "uuid() body").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = not_analysed(spark, lake, context)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.comment_id for r in found.collect()) == sorted(f"c{i}" for i in range(1200, 2000, 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One shuffle of the context beside that of the test's own; none of the two tables.
    assert plan.count("Exchange") == 2 and plan.count("Bucketed: true") == 2
