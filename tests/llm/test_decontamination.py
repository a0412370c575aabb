import random
import re

import pytest

from mentionlake.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, spans string", "item_id long, text string, other int"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        x = words(body)
        m = min(13, len(x))
        if item is None or not m:
            continue
        windows = {tuple(x[i : i + m]) for i in range(len(x) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i : i + m]) in windows:
                hit.update(range(i, i + m))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def made(seed):
    r = random.Random(seed)
    vocabulary = ["a", "B", "é", "Ü1", "word", "x9", "-", "of", "the", "日本"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 5, 12, 13, 14, 40]))) for i in range(12)]
    items += [(20, ""), (21, None), (None, "the of the"), (3, items[4][1]), (3, items[4][1])]
    docs = [text(r.choice([0, 3, 13, 60, 700])) for _ in range(30)]
    docs += [f"{text(20)} {items[i][1]}! {text(9)} {items[(i + 1) % 12][1]}" for i in range(12)]
    return items, [None, "", " -- ", *docs, docs[-1]]


@pytest.mark.parametrize("windows", [15, 100_000])
def test_against_brute_force(spark, monkeypatch, windows):
    monkeypatch.setattr(d, "BLOCK_WINDOWS", windows)
    items, texts = made(windows)
    docs = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], DOCS)
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    got = d.contamination(docs, benchmark).withColumn("n_hit", d.n_hit()).withColumn("bad", d.contaminated()).collect()
    assert [r.doc_id for r in got] == list(range(len(texts)))
    for r in got:
        n, hit, found = brute(r.text, items)
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, found)
        assert r.bad == (hit > 0 and 20 * hit >= n)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(d, "PIECE_BYTES", 7)
    monkeypatch.setattr(d, "BATCH_WORDS", 50)
    items, texts = made(3)
    search = d.prepare([(str(i), t.encode()) for i, t in items if i is not None and t is not None])
    got = list(d.scan([t.encode() if t is not None else None for t in texts], search))
    assert [(n, sum(b - a for a, b in s), sorted(set(i))) for n, s, i in got] == [brute(t, items) for t in texts]


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "some words", "")], DOCS)
    none = spark.createDataFrame([], ITEMS)
    row = d.contamination(docs, none, keep=["doc_id"]).first()
    assert (row.doc_id, row.n_words, row.spans, row["items"]) == (1, 2, [], [])
    assert d.contamination(docs.limit(0), spark.createDataFrame([(1, "some words", 0)], ITEMS)).count() == 0


def test_a_very_long_text(spark):
    text = "filler " * 300_000 + "one two three four"
    docs = spark.createDataFrame([(1, text, "")], DOCS)
    row = d.contamination(docs, spark.createDataFrame([(9, "Two, three", 0)], ITEMS), keep=["doc_id"]).first()
    assert (row.n_words, [tuple(s) for s in row.spans], row["items"]) == (300_004, [(300_001, 300_003)], ["9"])
