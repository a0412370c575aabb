import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from mentionlake.llm import nearcopies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sets(text):
    words = [w.lower() for w in (text or "").split()]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def word(r):
    return "".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7)))


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        at = r.randrange(len(words))
        words[at : at + r.randint(0, 1)] = [word(r)] * r.randint(0, 1)
    return words


def made():
    """Families of copies with 0 to 12 edits, some of copies of copies; texts that share a long passage; short and empty ones."""
    r, texts = random.Random(11), []
    common = [word(r) for _ in range(60)]
    for _ in range(12):
        base = [word(r) for _ in range(r.randint(30, 200))]
        family = [base] + [edited(r, base, r.randint(0, 12)) for _ in range(5)]
        family += [edited(r, family[-1], 3)]
        texts += [" ".join(w) for w in family]
    texts += [" ".join(common + [word(r) for _ in range(n)]) for n in range(4, 40, 3)]
    texts += [None, "", " \t", "one two", "ONE  two", "one two three", texts[3], texts[3].upper(), "again"]
    ids = r.sample(range(1000), len(texts))
    return list(zip(ids, texts, strict=True)) + [(None, "no id"), (None, "no id"), (ids[5], texts[5])]


def expected(rows):
    """The number of the component of each row, by comparing all pairs."""
    root, all_sets = list(range(len(rows))), [sets(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if similar(all_sets[i], all_sets[j]) and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    return root


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


def test_near_copies_go_in_the_pipeline(spark):
    rows = made()
    root, least = expected(rows), {}
    for (i, _), k in zip(rows, root, strict=True):
        least.setdefault(k, []).append(i)
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in least.values()), key=str)
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "")
    assert got.columns == frame(spark, rows[:1]).columns
    assert sorted((r.doc_id for r in got.collect()), key=str) == want


def test_a_large_group_makes_few_pairs(spark, monkeypatch):
    r, made_pairs = random.Random(4), []
    base = [word(r) for _ in range(150)]
    rows = [(i, " ".join(edited(r, base, 1) + [str(i)])) for i in range(300)]
    real = nearcopies.materialise

    def counting(df, label, folder=None):
        out = real(df, label, folder)
        if label == "near-pairs":
            made_pairs.append(out.count())
        return out

    monkeypatch.setattr(nearcopies, "materialise", counting)
    assert [x.doc_id for x in nearcopies.one_of_each(frame(spark, rows)).collect()] == [0]
    assert sum(made_pairs) < 300 * 40


def test_texts_of_the_same_passages_make_few_pairs(spark, monkeypatch):
    """All shingles of these texts occur in others, and many share a key, but no two texts are similar."""
    r, made_pairs = random.Random(6), []
    passages = [[word(r) for _ in range(40)] for _ in range(12)]
    common = [word(r) for _ in range(90)]
    rows = [(i, " ".join(common + [w for p in r.sample(passages, 3) for w in p])) for i in range(120)]
    rows += [(1000 + i, t + " end") for i, t in rows[:5]]
    real = nearcopies.confirmed

    def counting(pairs, sets):
        pairs = pairs.localCheckpoint()
        made_pairs.append(pairs.count())
        return real(pairs, sets)

    monkeypatch.setattr(nearcopies, "confirmed", counting)
    root, least = expected(rows), {}
    for (i, _), k in zip(rows, root, strict=True):
        least[k] = min(least.get(k, i), i)
    assert sorted(x.doc_id for x in nearcopies.one_of_each(frame(spark, rows)).collect()) == sorted(least.values())
    assert len(made_pairs) == nearcopies.TURNS + 2
    assert made_pairs[-1] < 120


def test_outlines_of_similar_sets_are_near(spark):
    r, rows = np.random.default_rng(3), []
    for n in (10, 20, 100, 500, 2000):
        for fewer in (0, 1):
            both, one, other = np.split(r.integers(0, 1 << 63, n, dtype=np.uint64), [n * 8 // 10 - fewer, n * 9 // 10])
            a, b = np.concatenate([both, one]), np.concatenate([both, other])
            near = 5 * len(both) >= 4 * n
            rows.append((near, nearcopies.outline(a).tolist(), nearcopies.outline(b).tolist(), len(a) + len(b)))
    found = spark.createDataFrame(rows, "near boolean, a array<long>, b array<long>, n int")
    found = found.select("near", nearcopies.outlines_near("a", "b", F.col("n")).alias("allowed")).collect()
    assert all(x.allowed for x in found if x.near)
    assert any(x.near for x in found)


def test_bands_find_what_is_similar():
    r = np.random.default_rng(2)
    missed = 0
    for _ in range(200):
        both, one, other = np.split(r.integers(0, 1 << 63, 100, dtype=np.uint64), [80, 90])
        a, b = (nearcopies.band_keys(np.concatenate([both, x])) for x in (one, other))
        missed += not np.any(a == b)
    assert missed == 0


def test_empty_table(spark):
    assert nearcopies.one_of_each(frame(spark, []).limit(0)).count() == 0
