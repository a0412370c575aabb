import random
import re
from collections import Counter

import pytest

from mentionlake.llm import phrases

SCHEMA = "doc_id long, text string, lang string, score string, f string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {p: f for p, f in counts.items() if f >= least}
    found = {}
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        inside = any(
            o[0] == lang and len(o[1]) > len(words) and f == a and any(o[1][i : i + len(words)] == words for i in range(len(o[1])))
            for o, f in often.items())
        if inside:
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (often[lang, words[:k]] * often[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), often[lang, words[:k]], often[lang, words[k:]], n))
    return sorted(
        (lang, i + 1, phrase.decode(), -a, left, right, n, -score)
        for lang, of in found.items() for i, (score, a, phrase, left, right, n) in enumerate(sorted(of)[:top]))


def got(spark, rows, top):
    return sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, SCHEMA), top=top).collect())


def made(seed, docs=120):
    random.seed(seed)
    rows = []
    for i in range(docs):
        words = []
        for _ in range(random.randrange(40)):
            words += random.choice([["New", "york", "city"], ["a"], ["a", "b"], ["c"], ["é", "Ü"], ["x", "y", "z", "u", "v", "w"], ["the"], ["the", "c"], [random.choice("defghijk")]])
            words += random.choice([[], [], [], [".,"], ["\n"], ["\t"]])
        rows.append((i, " ".join(words) if i % 9 else random.choice([None, "", " \t\n"]), random.choice(["en", "de", None, ""]), "clash", "clash"))
    return rows + rows[:20]


@pytest.mark.parametrize(("wider", "top"), [(2, 5), (64, 1000), (2, 1)])
def test_against_brute_force(spark, monkeypatch, wider, top):
    monkeypatch.setattr(phrases, "WIDER", wider)
    monkeypatch.setattr(phrases, "LEAST", 8)
    rows = made(wider + top)
    want = expected(rows, 8, top)
    assert want
    assert got(spark, rows, top) == want


def test_frequent_beginnings_stay_unexpanded_once_the_last_score_is_settled(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WIDER", 2)
    monkeypatch.setattr(phrases, "LEAST", 8)
    seen = []
    of_bands = phrases._of_bands
    monkeypatch.setattr(phrases, "_of_bands", lambda often, bands: (seen.append(dict(bands)), of_bands(often, bands))[1])
    rows = [(i, "rare pair. " + "the " * 40, "en", None, None) for i in range(10)]
    assert got(spark, rows, 1) == expected(rows, 8, 1) == [("en", 1, "rare pair", 10, 10, 10, 420, 42000)]
    assert max(high for bands in seen for _, high in bands.values()) < 400


def test_phrases_that_cannot_enter_are_not_described(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 8)
    asked, described = [], phrases.described
    monkeypatch.setattr(phrases, "described", lambda found, wanted: (asked.append(wanted.count()), described(found, wanted))[1])
    random.seed(5)
    rows = [(i, "rare pair. odd one. " + " ".join(random.choice("abcdef") for _ in range(200)), "en", None, None) for i in range(20)]
    assert got(spark, rows, 2) == expected(rows, 8, 2)
    assert asked and sum(asked) < 20


def test_ties_at_the_last_place_go_by_count_then_phrase(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST", 8)
    rows = [(i, "b2 b1. a2 a1. c2 c1. z", "en", None, None) for i in range(9)]
    assert [r[2] for r in got(spark, rows, 2)] == ["a2 a1", "b2 b1"]


def test_a_long_text_and_scores_beyond_64_bits(spark, monkeypatch):
    text = "p q " * 400_000
    rows = [(1, text, "en", None, None)]
    found = got(spark, rows, 10)
    assert found == expected(rows, 100, 10)
    assert 1000 * found[0][3] * found[0][6] > 0
    told = spark.createDataFrame([("en", b"p q", 4_000_000_000_000)], "lang string, phrase binary, a long")
    every = spark.createDataFrame([("en", b"p", 5_000_000_000_000), ("en", b"q", 4_000_000_000_000)], "lang string, phrase binary, f long")
    totals = spark.createDataFrame([("en", 90_000_000_000_000)], "lang string, n long")
    score = phrases.scored(told, every, totals).collect()[0].score
    assert score == 1000 * 4_000_000_000_000 * 90_000_000_000_000 // (5_000_000_000_000 * 4_000_000_000_000)


def test_nothing_to_find(spark):
    assert got(spark, [(1, None, None, None, None), (2, "", "en", None, None), (3, "one", "en", None, None)], 5) == []
    assert got(spark, [], 5) == []
