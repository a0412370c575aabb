import json

import pandas as pd
import pytest

from mentionlake.operators import canonical, extract, prompts
from pyspark.sql import functions as F

GOOD = {"brand_name": "Apple", "product_name": "iPhone", "aspect": "Camera", "sentiment_score": 0.8, "quote": "nice"}


def parsed(spark, response, strict=False):
    df = spark.createDataFrame([("c", "the body", response)], "comment_id string, body string, response string")
    return extract.parse_responses(df, strict)


@pytest.mark.parametrize("response, loose, strict", [
    (json.dumps([GOOD]), 1, 1), (f"```json\n{json.dumps([GOOD])}\n```", 1, 1), (f"```{json.dumps([GOOD])}```", 1, 1),
    (f"\n\t {json.dumps([GOOD, GOOD])} \n", 2, 2), (json.dumps(GOOD), 0, 0), ("[]", 0, 0), ("[1, 2]", 0, 0),
    (json.dumps([GOOD])[:-5], 0, 0), ("", 0, 0), (None, 0, 0), ("sorry", 0, 0), (json.dumps([GOOD, 7]), 1, 0),
    (json.dumps([GOOD, {**GOOD, "aspect": None}]), 2, 0), (json.dumps([GOOD, {**GOOD, "sentiment_score": "high"}]), 2, 0),
    (json.dumps([GOOD, {**GOOD, "sentiment_score": None}]), 2, 0), (json.dumps([{**GOOD, "sentiment_score": "0.3"}]), 1, 1),
    (json.dumps([{"quote": "only"}]), 1, 1), (json.dumps([GOOD]) + " I hope this helps", 0, 0), (json.dumps([GOOD]) * 2, 0, 0),
    (f"```json\n{json.dumps([GOOD])}\n``` as asked", 0, 0), (json.dumps([GOOD])[:-1] + ",]", 0, 0), (json.dumps([GOOD]) + "]", 0, 0),
    ("[]", 0, 0), ("[[]]", 0, 0),
])
def test_response_shapes(spark, response, loose, strict):
    assert parsed(spark, response).count() == loose
    assert parsed(spark, response, strict=True).count() == strict


def test_the_last_of_doubled_keys_counts_and_places_are_kept(spark):
    rows = parsed(spark, '[{"aspect": "a", "quote": "x", "aspect": "b"}, 5, {"aspect": "c"}]').collect()
    assert [(r.item_no, r.aspect) for r in rows] == [(0, "b"), (2, "c")]


def finished(spark, item, body="the body"):
    df = spark.createDataFrame([("c", body, json.dumps([item]))], "comment_id string, body string, response string")
    return extract.finish_mentions(extract.parse_responses(df)).first().asDict()


def test_defaults(spark):
    got = finished(spark, {})
    assert (got["brand_name"], got["product_name"], got["aspect"], got["sentiment_score"], got["quote"]) == ("", "", "general", 0.5, "the body")
    assert finished(spark, GOOD)["aspect"] == "camera"
    assert finished(spark, {**GOOD, "sentiment_score": "0.25"})["sentiment_score"] == 0.25
    assert finished(spark, {**GOOD, "sentiment_score": 7})["sentiment_score"] == 7.0
    assert finished(spark, {**GOOD, "quote": "q" * 300})["quote"] == "q" * 200


@pytest.mark.parametrize("size, quote", [(150, "b" * 150), (151, "b" * 150 + "...")])
def test_quote_from_the_body(spark, size, quote):
    assert finished(spark, {**GOOD, "quote": ""}, "b" * size)["quote"] == quote


def test_scorer_is_made_once_per_task(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("comment_id")).repartition(2)

    def factory():
        import uuid

        made = uuid.uuid4().hex
        return lambda batch: pd.Series([made] * len(batch))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        assert extract.score(df, factory).select("response").distinct().count() == 2
        assert extract.score(df, factory, partitions=5).select("response").distinct().count() == 5
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_analysis_ids(spark):
    schema = "comment_id string, brand_name string, product_name string, aspect string, quote string"
    data = [("c", "b", "p", "a", "q1"), ("c", "b", "p", "a", "q2"), ("c", None, "b", "p", "a"), ("c", "b", None, "p", "a")]
    df = spark.createDataFrame(data, schema)
    assert extract.with_analysis_id(df).select("analysis_id").distinct().count() == 4
    short = [r[0] for r in extract.with_analysis_id(df, short=True).select("analysis_id").collect()]
    assert short[0] == short[1] and all(abs(int(v)) <= 2**31 for v in short)


def test_lexicon(spark, rows):
    lexicon = spark.createDataFrame([
        ("apple", "brand", "apple", None), ("samsung", "brand", "samsung", None), ("iphone", "product", "iPhone", None),
        ("camera", "aspect", "camera", None), ("battery", "aspect", "battery", None),
        ("great", "polarity", None, 1.0), ("bad", "polarity", None, 0.0),
    ], extract.LEXICON)
    bodies = spark.createDataFrame([
        ("1", "My Apple iPhone: camera great, battery bad... Samsung is bad"), ("2", "great camera"),
        ("3", "apple apple"), ("4", None),
    ], "comment_id string, body string")
    got = extract.lexicon_mentions(bodies, lexicon)
    assert rows(got, "comment_id", "brand_name", "product_name", "aspect", "sentiment_score") == sorted([
        ("1", "apple", "iPhone", "general", "0.5"), ("1", "apple", "iPhone", "camera", "1.0"),
        ("1", "apple", "iPhone", "battery", "0.0"), ("1", "samsung", "general", "general", "0.0"),
        ("3", "apple", "general", "general", "0.5"),
    ])


def test_prompt(spark):
    schema = "body string, submission_title string, submission_selftext string, parent_body string"
    data = [("it is fine", "Title", "s" * 300, "parent"), ("x", "T", "[removed]", "[deleted]"), ("y", "T", "", None)]
    told = [r.prompt for r in prompts.with_prompt(spark.createDataFrame(data, schema)).collect()]
    assert f"Submission Title: Title\nSubmission Context: {'s' * 300}...\nParent Comment: parent\n" in told[0]
    short = prompts.with_prompt(spark.createDataFrame(data, schema), post_chars=200).first().prompt
    assert f"Submission Context: {'s' * 200}...\n" in short
    assert told[0].endswith('"it is fine"')
    assert all("Context: " not in t.replace("Context:\n", "") and "Parent" not in t for t in told[1:])


def test_brands_in_the_instructions(spark):
    reference = spark.createDataFrame([(f"b{i:03d}",) for i in range(80)] + [("b070",), ("b071",)] * 2, "brand string")
    assert prompts.system_text(reference).first()[0].endswith(": " + ", ".join(f"b{i:03d}" for i in range(80)))
    assert prompts.system_text(reference, 3).first()[0].endswith(": b000, b070, b071")


def test_canonical_records(spark):
    line = json.dumps({
        "id": "x1", "subreddit": {"display_name": "phones"}, "author": None, "title": None, "created_utc": 1700000000.9,
        "score": 12.0, "is_self": True, "stickied": 0, "edited": 1700000100.5, "permalink": "/r/a",
        "all_awardings": [{"name": "gold", "count": 1}, {"name": "", "count": 9}, {"count": 2}, {"name": "wow"}, {"name": "gold", "count": 3}],
    })
    raw = spark.createDataFrame([(line,)], "j string").select(F.from_json("j", canonical.RAW_SUBMISSION).alias("r")).select("r.*")
    got = canonical.canonical_submissions(raw, F.lit(5)).first().asDict()
    assert got["awards"] == {"gold": 3, "wow": 0}
    assert (got["created_utc"], got["score"], got["edited"], got["updated_at"]) == (1700000000, 12, 1700000100, 5)
    assert (got["author"], got["title"], got["is_self"], got["stickied"], got["locked"]) == (None, "", True, False, False)
    assert (got["fullname_id"], got["permalink"], got["upvote_ratio"]) == ("t3_x1", "https://reddit.com/r/a", 0.0)
    from mentionlake.schemas import SUBMISSIONS

    assert [f.dataType for f in canonical.canonical_submissions(raw, F.lit(5)).schema] == [f.dataType for f in SUBMISSIONS]


PHRASES = [
    ("galaxy", "product", "Galaxy", None), ("Galaxy S24", "product", "Galaxy S24", None), ("galaxy-s24 ultra", "product", "Galaxy S24 Ultra", None),
    ("s24 ultra case", "product", "Case", None), ("acme", "brand", "Acme", None), ("acme mobile", "brand", "Acme Mobile", None), ("battery life", "aspect", "battery", None),
    ("not good", "polarity", None, 0.1), ("good", "polarity", None, 0.9), ("...", "brand", "Nothing", None), ("galaxy s24", "product", "S24 again", None),
]


@pytest.mark.parametrize(("body", "want"), [
    ("Acme Mobile: the Galaxy S24 Ultra, battery life not good", [("Acme Mobile", "Galaxy S24 Ultra", "battery", "0.1"), ("Acme Mobile", "Galaxy S24 Ultra", "general", "0.5")]),
    ("acme galaxy  s24... good", [("Acme", "Galaxy S24", "general", "0.9")]),
    ("acme galaxy s25 good", [("Acme", "Galaxy", "general", "0.9")]),
    ("acme galaxy s24 ultra case good", [("Acme", "Galaxy S24 Ultra", "general", "0.9")]),
    ("acme s24 ultra case. not. good", [("Acme", "Case", "general", "0.1")]),
    ("galaxy s24", []), ("", []), (None, []),
])
def test_names_of_several_words(spark, body, want):
    lexicon = spark.createDataFrame(PHRASES, "token string, kind string, value string, weight double")
    found = extract.lexicon_mentions(spark.createDataFrame([("c", body)], "comment_id string, body string"), lexicon)
    assert sorted((r.brand_name, r.product_name, r.aspect, r.sentiment_score) for r in found.collect()) == want


def test_hits_of_overlapping_entries(spark):
    lexicon = spark.createDataFrame(PHRASES, "token string, kind string, value string, weight double")
    text = "galaxy galaxy s24 s24 ultra case " * 3
    found = extract.entry_hits(spark.createDataFrame([("c", text)], "comment_id string, body string"), lexicon)
    got = sorted((r.pos, r.value) for r in found.collect())
    one = [(0, "Galaxy"), (1, "Galaxy S24"), (1, "S24 again"), (3, "Case")]
    assert got == sorted((6 * i + pos, value) for i in range(3) for pos, value in one)


def test_an_entry_that_is_too_long_is_an_error(spark):
    lexicon = spark.createDataFrame([("a b c", "brand", "x", None)], "token string, kind string, value string, weight double")
    with pytest.raises(Exception, match="lexicon entry too long"):
        extract.entry_hits(spark.createDataFrame([("c", "a b c")], "comment_id string, body string"), lexicon, longest=2).collect()


def test_words_are_not_shuffled_and_matches_are_once(spark, monkeypatch, rows):
    lexicon = spark.createDataFrame(PHRASES, "token string, kind string, value string, weight double")
    texts = [(None if i == 3 else f"c{i % 4}", "acme galaxy s24 ultra case, battery life not good " * i) for i in range(6)]
    bodies = spark.createDataFrame(texts, "comment_id string, body string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extract.entry_hits(bodies, lexicon)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(comment_id" in plan
        mentions = rows(extract.lexicon_mentions(bodies, lexicon))
        monkeypatch.setattr(extract, "SENT_ENTRIES", 2)
        assert rows(extract.entry_hits(bodies, lexicon)) == rows(found)
        assert rows(extract.lexicon_mentions(bodies, lexicon)) == mentions
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
