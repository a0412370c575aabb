import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mentionlake.llm import classlm

SCHEMA = "doc_id long, text string, score string, ids string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), None]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def made(seed, docs=200, words=12):
    random.seed(seed)
    sizes = words
    kinds = [[f"{c}{k}" for k in range(sizes)] for c in ("Noun", "verb", "adj", "è")]
    rows = []
    for i in range(docs):
        words = [random.choice(kinds[(j + i) % 4]) for j in range(random.randrange(0, 60))]
        words += [f"once{seed}x{i}"] if i % 3 == 0 else []
        rows.append((i if i % 50 else None, "  ".join(words) if i % 17 else random.choice([None, "", "\t\n"]), "clash", "clash"))
    return rows + rows[:9]


def check_base(rows, found):
    train = Counter(t for i, text, *_ in rows if not is_held(i) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    want = Counter()
    for i, text, *_ in rows:
        of = tokens(text)
        base = sum(math.log10((train[t] + 1) / (n + v + 1)) for t in of)
        want[i, is_held(i), len(of), sum(train[t] > 0 for t in of), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == want


@pytest.mark.parametrize("head", [1 << 20, 20])
def test_counts_by_brute_force_and_held_out_texts_score_above_the_base(spark, monkeypatch, head):
    monkeypatch.setattr(classlm, "HEAD", head)
    rows = made(3)
    found = classlm.log_probabilities(spark.createDataFrame(rows, SCHEMA), rounds=4).collect()
    check_base(rows, found)
    held = [r for r in found if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    again = classlm.log_probabilities(spark.createDataFrame(rows, SCHEMA), rounds=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_probabilities_after_each_state_sum_to_one():
    rng = np.random.default_rng(1)
    words = 300
    c = np.append(rng.integers(1, 40, words - 1), 55)
    of = np.append(rng.integers(1, classlm.CLASSES, words - 1), classlm.END)
    counts = np.zeros((classlm.CLASSES + 1, classlm.CLASSES))
    size = np.bincount(of, weights=c, minlength=classlm.CLASSES)
    counts[: classlm.CLASSES] = rng.multinomial(1, np.ones(classlm.CLASSES) / classlm.CLASSES, size=int(size.sum())).sum(0)[:, None] * 0
    # Any bigrams whose columns add up to the sizes of the classes.
    for k in range(classlm.CLASSES):
        counts[: classlm.CLASSES, k] = rng.multinomial(int(size[k]), np.ones(classlm.CLASSES) / classlm.CLASSES)
    counts[classlm.UNKNOWN] = rng.integers(0, 5, classlm.CLASSES)
    types = np.bincount(of, minlength=classlm.CLASSES)
    model = classlm.Model(counts, types, 0.6)
    for before in range(classlm.CLASSES + 1):
        known = (10 ** model.log_transition[before, of] * (c - 0.6) / model.size[of]).sum()
        assert known + 10 ** model.log_unknown[before] == pytest.approx(1.0, abs=1e-9)


def test_a_word_goes_where_the_likelihood_is_greatest():
    rng = np.random.default_rng(2)
    size = classlm.CLASSES
    counts = np.zeros((size + 1, size))
    counts[:12, :12] = rng.integers(20, 90, (12, 12))
    left, right = Counter({2: 6, 3: 1}), Counter({5: 4, 0: 3})
    now = 7
    slots = np.array([*left, *(size + k for k in right)])
    n = np.array([*left.values(), *right.values()])
    got = classlm.best_classes(counts, np.zeros(4, int), slots, n, np.array([now]))[0]

    def total(to):
        m = counts.copy()
        for k, x in left.items():
            m[k, now] -= x
            m[k, to] += x
        for k, x in right.items():
            m[now, k] -= x
            m[to, k] += x
        # Row and column sums of the classes beside the word stay as they are.
        return classlm.likelihood(m)

    assert got == max(range(1, size - 1), key=lambda g: (round(total(g), 6), -g))


def test_rounds_do_not_lower_the_likelihood(spark, monkeypatch):
    seen = []
    real = classlm.likelihood
    monkeypatch.setattr(classlm, "likelihood", lambda counts: (seen.append(real(counts)), seen[-1])[1])
    rows = made(4, words=60)
    held = classlm.F.lit(False)
    df = spark.createDataFrame(rows, SCHEMA)
    with classlm.staging(spark, "test-classlm") as save:
        raw = save(classlm.chunks(df, "doc_id", "text", held), "chunks")
        words, _ = classlm.exchanged(classlm.vocabulary(raw, save))
        _, counts = classlm.exchange(save(classlm.coded(raw, words), "coded"), words, 4)
        assert real(counts) == max(seen) > seen[0]


def test_packed_counts_come_back():
    rng = np.random.default_rng(5)
    words = np.sort(rng.integers(0, 40, 300))
    slots, n = rng.integers(0, 128, 300), rng.choice([1, 2, 255, 256, 65_535, 65_536, 1 << 40], 300)
    tables = [classlm.pa.table({"word": classlm.pa.array(w), "slots": s, "counts": c}) for w, s, c in classlm.packed(words, slots, n)]
    table = classlm.pa.concat_tables(tables)
    row, slot, count = classlm.unpacked(table)
    assert Counter(zip(table["word"].to_numpy()[row], slot, count, strict=True)) == Counter(zip(words, slots, n, strict=True))


def test_texts_that_are_long_or_missing(spark):
    rows = [(1, "word " * 300_000 + "End", None, None), (2, "x" * 200_000, None, None), (3, None, None, None), (None, "word", None, None)]
    check_base(rows, classlm.log_probabilities(spark.createDataFrame(rows, SCHEMA), rounds=1).collect())


def test_nothing_to_learn_from_and_no_rows(spark):
    only_held = [(i, "a b", None, None) for i in range(30) if is_held(i)]
    found = classlm.log_probabilities(spark.createDataFrame(only_held, SCHEMA)).collect()
    check_base(only_held, found)
    assert {r.score for r in found} == {0.0}
    assert classlm.log_probabilities(spark.createDataFrame([], SCHEMA)).count() == 0


def test_neighbours_are_counted_in_all_training_texts(spark):
    rows = made(6, docs=90)
    held = classlm.F.coalesce(classlm.crc_of_id("doc_id") % 7 == 2, classlm.F.lit(False))
    df = spark.createDataFrame(rows, SCHEMA)
    with classlm.staging(spark, "test-classlm") as save:
        raw = save(classlm.chunks(df, "doc_id", "text", held), "chunks")
        words, _ = classlm.exchanged(classlm.vocabulary(raw, save))
        found = save(classlm.coded(raw, words), "coded")
        head = (np.arange(len(words.counts)) % 62 + 1).astype(np.uint8)
        counted = Counter()
        for turn in range(classlm.SHARES):
            table = classlm.neighbours(found, head, turn, classlm.SHARES).toArrow()
            row, _, n = classlm.unpacked(table)
            for w, k in zip(table["word"].to_numpy()[row], n, strict=True):
                counted[int(w)] += int(k)
    # Each occurrence of a word has a neighbour on either side.
    assert counted == Counter({w: 2 * int(c) for w, c in enumerate(words.counts)})


def test_words_and_numbers_of_a_chunk_are_one_value_each(spark):
    rows = made(7, docs=120)
    held = classlm.F.coalesce(classlm.crc_of_id("doc_id") % 7 == 2, classlm.F.lit(False))
    with classlm.staging(spark, "test-classlm") as save:
        raw = save(classlm.chunks(spark.createDataFrame(rows, SCHEMA).repartition(1), "doc_id", "text", held), "chunks")
        # Lists of words cost the JVM more than the counting does: nothing but ids is a list, and no word is hashed one at a time by an interpreted function.
        found = classlm.coded(raw, classlm.exchanged(classlm.vocabulary(raw, save))[0])
        for df in (raw, found):
            assert [f.name for f in df.schema.fields if f.dataType.typeName() == "array"] == ["ids"]
        assert "xxhash64" not in found._jdf.queryExecution().toString().lower()
        # Rounds leave out chunks of texts that are held out.
        got = {r.held: r for r in raw.collect()}
        assert {h: sorted(map(str, r.ids)) for h, r in got.items()} == {h: sorted(str(i) for i, *_ in rows if is_held(i) == h) for h in (False, True)}
        for h, r in got.items():
            words, codes = classlm.separate(r.words).to_pylist(), np.frombuffer(r.codes, np.int32)
            want = Counter(t if t is None else t.encode() for i, text, *_ in rows if is_held(i) == h for t in tokens(text))
            assert Counter(None if c < 0 else words[c] for c in codes) == want
            assert dict(zip(words, np.frombuffer(r.counts, np.int64), strict=True)) == {w: n for w, n in want.items() if w is not None}


def test_hashes_are_those_of_spark(spark):
    words = [b"", b"a", b"word", "gr\u00fc\u00dfe".encode(), b"\x00b", b"\xff", *(bytes(range(65, 65 + n)) for n in (7, 8, 31, 32, 33, 60))]
    rows = spark.createDataFrame([(bytearray(w),) for w in words], "w binary").select("w", classlm.F.xxhash64("w").alias("h")).collect()
    assert {bytes(r.w): r.h for r in rows} == dict(zip(words, classlm.hashes(words).tolist(), strict=True))


def test_sizes_of_what_tasks_hold_do_not_change_the_result(spark, monkeypatch):
    rows = made(8, docs=150)
    df = spark.createDataFrame(rows, SCHEMA)
    once = classlm.log_probabilities(df, rounds=3).collect()
    for name, size in (("CHUNK_BYTES", 600), ("HELD_KEYS", 50), ("HELD_BYTES", 100)):
        monkeypatch.setattr(classlm, name, size)
    found = classlm.log_probabilities(df, rounds=3).collect()
    check_base(rows, found)
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in found) == Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in once)


def test_tasks_are_sent_a_few_chunks_at_once_and_the_setting_comes_back(spark, monkeypatch):
    sent = []
    real = classlm.vocabulary

    def spy(found, save):
        sizes = found.select("words", "codes").mapInArrow(lambda batches: (classlm.pa.record_batch({"n": [b.num_rows], "size": [b.nbytes]}) for b in batches), "n long, size long")
        sent.extend(sizes.collect())
        return real(found, save)

    monkeypatch.setattr(classlm, "vocabulary", spy)
    monkeypatch.setattr(classlm, "CHUNK_BYTES", 6_000)
    monkeypatch.setattr(classlm, "BATCH_BYTES", 20_000, raising=False)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = made(9, docs=600)
    check_base(rows, classlm.log_probabilities(spark.createDataFrame(rows, SCHEMA).repartition(1), rounds=1).collect())
    assert spark.conf.get(name) == before
    # One batch of all chunks would be held several times over outside the heap.
    assert len(sent) > 3 and max(r["size"] for r in sent) < 60_000


def test_entries_of_a_batch_are_weighed_a_few_at_a_time(spark, monkeypatch):
    rows = made(10, docs=200)
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    once = classlm.log_probabilities(df, rounds=3).collect()
    real = classlm.best_classes

    def few(counts, word, slot, n, now):
        assert len(word) <= 200 + 2 * classlm.CLASSES
        return real(counts, word, slot, n, now)

    monkeypatch.setattr(classlm, "best_classes", few)
    monkeypatch.setattr(classlm, "PIECE", 200, raising=False)
    found = classlm.log_probabilities(df, rounds=3).collect()
    check_base(rows, found)
    assert Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in found) == Counter((r.doc_id, r.n_tokens, round(r.score, 6)) for r in once)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pieces_of_keys_end_with_a_word(size):
    keys = np.sort(np.random.default_rng(3).integers(0, 40 * 128, 900).astype(np.uint32))
    found = list(classlm.pieces(keys, 128, size))
    assert np.array_equal(np.concatenate(found), keys) and all(len(p) for p in found)
    assert all(a[-1] // 128 < b[0] // 128 for a, b in zip(found, found[1:]))
    assert list(classlm.pieces(keys[:0], 128, size)) == []
