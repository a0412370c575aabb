import random
import zlib

import numpy as np

from mentionlake.llm import toxicity

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, toxic int, text string"
INSULTS = ["blorgface", "blorghead", "Snivelwit"]


def made(spark, n=900, bias=0.0):
    """A share ``bias`` of the toxic texts, and few of the others, name a group."""
    r = random.Random(8)
    truth, docs = {}, []
    for i in range(n):
        toxic = r.random() < 0.25
        words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 5))) for _ in range(r.randint(5, 60))]
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(INSULTS))
        if r.random() < (bias if toxic else 0.02):
            words.append("muslims")
        truth[i] = int(toxic)
        docs.append((i, " ".join(words), "old"))
    labels = [(i, t, "old") for i, t in truth.items() if r.random() < 0.6]
    return truth, spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_rows(spark):
    truth, docs, labels = made(spark)
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert sum(r.predicted for r in held if not truth[r.doc_id]) == 0


def test_swaps_keep_the_score(spark):
    _, docs, labels = made(spark, bias=0.9)
    text = "the muslims of the town met today"
    other = text.replace("muslims", "christians")
    change = {}
    for fairness in (0.0, toxicity.FAIRNESS):
        model = toxicity.train(docs, labels, fairness=fairness)
        change[fairness] = abs(toxicity.score(text.encode(), model) - toxicity.score(other.encode(), model))
        if fairness:
            assert toxicity.score(text.encode(), model) < 0.3
            assert toxicity.score(b"you blorgface", model) > 0.7
    assert change[toxicity.FAIRNESS] < 0.02 and change[toxicity.FAIRNESS] < change[0.0] / 5


def test_swaps_cover_all_members_of_a_group():
    found = toxicity.words(b"Women, and the DEAF.")
    swapped = toxicity.swaps(found, [("women", "men", "girls"), ("deaf", "blind"), ("cats", "dogs")])
    assert sorted(sorted(s) for s in swapped) == sorted(
        sorted(x.encode() for x in s) for s in (("men", "and", "the", "deaf"), ("girls", "and", "the", "deaf"), ("women", "and", "the", "blind")))


def test_held_out_labels_are_not_seen(spark):
    _, docs, labels = made(spark, 300)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic", "text")
    scores = [sorted((r.doc_id, r.score) for r in toxicity.classify(docs, x).collect()) for x in (labels, other)]
    assert np.allclose([s for _, s in scores[0]], [s for _, s in scores[1]])


def test_nulls_empty_and_long_texts_and_repeats(spark):
    _, docs, labels = made(spark, 400)
    odd = [(None, None), (None, ""), (9000, "..."), (9001, "\x00é日"), (9002, "word " * 600_000 + "blorghead"), (5, "again"), (5, "again")]
    odd = spark.createDataFrame([(*x, "") for x in odd], DOCS)
    odd_labels = spark.createDataFrame([(None, 1, ""), (5, None, ""), (6, 0, ""), (6, 1, "")], LABELS)
    got = toxicity.classify(docs.unionByName(odd), labels.unionByName(odd_labels)).collect()
    assert len(got) == 407
    assert len({r.score for r in got if r.text in (None, "", "...")}) == 1
    assert next(r.score for r in got if r.doc_id == 9002) > 0.5


def test_without_labels_or_rows(spark):
    _, docs, labels = made(spark, 30)
    assert {r.score for r in toxicity.classify(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0


def test_scores_do_not_depend_on_the_caps(spark, monkeypatch):
    """Half of the texts with the word are toxic, so their score is about a half, whatever share of each class is fitted on."""
    r = random.Random(5)
    docs, labels = [], []
    for i in range(2400):
        toxic = i % 8 == 0
        named = toxic or i % 8 == 1
        words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 5))) for _ in range(12)]
        docs.append((i, " ".join([*words, "blorgface"] if named else words), "old"))
        labels.append((i, int(toxic), "old"))
    docs, labels = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    scores = []
    for caps in ((6000, 12000), (150, 300)):
        monkeypatch.setattr(toxicity, "FIT_TOXIC", caps[0])
        monkeypatch.setattr(toxicity, "FIT_OTHER", caps[1])
        scores.append(toxicity.score(b"you blorgface", toxicity.train(docs, labels)))
    assert all(0.35 < s < 0.65 for s in scores) and abs(scores[0] - scores[1]) < 0.15, scores
