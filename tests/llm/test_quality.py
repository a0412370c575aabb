import random
import zlib

import numpy as np

from mentionlake.llm import quality

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, quality int, text string"


def text_of(r, good):
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8))) for _ in range(r.randint(20, 80))]
    if good:
        return " ".join(words).capitalize() + "."
    return r.choice([" ".join(words).upper() + "!!!", " | ".join(words), " ".join(w for w in words[:6] for _ in range(9)), " ".join(w + "$$$" for w in words)])


def made(spark, n=1200):
    r = random.Random(4)
    truth = {i: int(r.random() < 0.8) for i in range(n)}
    docs = [(i, text_of(r, g), "old") for i, g in truth.items()]
    labels = [(i, g, "old") for i, g in truth.items() if r.random() < 0.5]
    return truth, spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_held_out_rows(spark):
    truth, docs, labels = made(spark)
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93


def test_only_positives_and_no_held_out_label_are_used(spark):
    _, docs, labels = made(spark, 400)
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "text")
    some = other.where("quality = 1 OR crc32(CAST(doc_id AS STRING)) % 4 = 2")
    scores = [sorted((r.doc_id, r.score) for r in quality.classify(docs, x).collect()) for x in (labels, some)]
    assert scores[0] == scores[1]


def test_the_prior_is_estimated():
    r = np.random.default_rng(0)
    for share in (0.3, 0.7):
        p = np.concatenate([r.normal(2, 1, (3000, 1)), np.ones((3000, 1))], axis=1)
        u = np.concatenate([np.where(r.random((4000, 1)) < share, r.normal(2, 1, (4000, 1)), r.normal(-2, 1, (4000, 1))), np.ones((4000, 1))], axis=1)
        assert abs(quality.class_prior(p, u) - share) < 0.12


def test_nulls_empty_texts_and_repeats(spark):
    _, docs, labels = made(spark, 300)
    odd = spark.createDataFrame([(None, None, ""), (None, "", ""), (7000, "", ""), (7001, " \n\t", ""), (7002, "\x00é日", ""), (7003, "word " * 500_000, ""), (5, "again", ""), (5, "again", "")], DOCS)
    odd_labels = spark.createDataFrame([(None, 1, ""), (5, None, ""), (6, 0, ""), (6, 1, "")], LABELS)
    got = quality.classify(docs.unionByName(odd), labels.unionByName(odd_labels)).collect()
    assert len(got) == 308
    same = {r.score for r in got if r.text in (None, "")}
    assert len(same) == 1 and all(0 <= r.score <= 1 for r in got)
    assert all(not r.held_out for r in got if r.doc_id is None)


def test_without_labels_or_rows(spark):
    _, docs, labels = made(spark, 20)
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
