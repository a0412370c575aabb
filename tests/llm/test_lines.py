import random
import re

import pytest
from pyspark.sql import functions as F

from mentionlake.llm import lines
from mentionlake.llm.common import possible

SCHEMA = "doc_id long, text string, md string"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def near(a, b):
    limit = min(2, min(len(a), len(b)) // 10)
    return a != b and limit > 0 and abs(len(a) - len(b)) <= limit and levenshtein(a, b) <= limit


def brute(docs):
    """Per document: lines, removed places, links; the first line of a class by id and place stays."""
    places = [(i, p, line) for i, t in docs for p, line in enumerate((t or "").split("\n")) if line.strip(" ")]
    distinct = sorted({line for _, _, line in places})
    linked = {a: [b for b in distinct if near(a, b)] for a in distinct}
    first = {}
    for i, p, line in sorted(places, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        if line not in first:
            todo, seen = [line], {line}
            while todo:
                for b in linked[todo.pop()]:
                    if b not in seen:
                        seen.add(b)
                        todo.append(b)
            for b in seen:
                first.setdefault(b, (i, p))
    return {
        i: (sum(1 for j, _, _ in places if j == i), [p for j, p, x in places if j == i and first[x] != (i, p)], sum(len(linked[x]) for j, _, x in places if j == i))
        for i, _ in docs}


def edited(r, line):
    chars = list(line)
    for _ in range(r.randint(0, 3)):
        k, at = r.randint(0, 2), r.randrange(len(chars) + 1)
        if k == 0:
            chars.insert(at, r.choice("abé "))
        elif at < len(chars):
            chars[at : at + 1] = [] if k == 1 else [r.choice("abé ")]
    return "".join(chars)


@pytest.mark.parametrize("bucket", [1, 2])
def test_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(lines, "BUCKET", bucket)
    r = random.Random(bucket)
    base = ["".join(r.choice("abcdefgé ") for _ in range(n)) for n in (1, 5, 9, 10, 11, 12, 19, 20, 21, 22, 23, 40, 41, 80, 200)]
    base += [base[-2][:50] + "".join(r.choice("xyz") for _ in range(30)) for _ in range(6)]
    docs = [(i, "\n".join(edited(r, r.choice(base)) for _ in range(r.randint(0, 6)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "\n \n"), (103, base[-3]), (104, base[-3] + "\n" + base[-3]), (None, base[-4])]
    got = lines.duplicate_lines(spark.createDataFrame([(*d, "old") for d in docs], SCHEMA)).collect()
    assert {x.doc_id: (x.n_lines, x.removed, x.n_links) for x in got} == brute(docs)
    assert len(got) == len(docs)


def test_bit_parallel_distance(spark):
    r = random.Random(7)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("abé") for _ in range(r.choice([0, 1, 2, 3, 6, 30, 90])))
        pairs.append((a, edited(r, a)))
    pairs = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= 2]
    rows = spark.createDataFrame(pairs, "a string, b string")
    for x in rows.select("a", "b", lines.distance(F.col("a"), F.col("b")).alias("d"), lines.edit_distance(F.col("a"), F.col("b"), 2).alias("e")).collect():
        want = min(3, levenshtein(x.a, x.b))
        assert (min(3, x.d), min(3, x.e)) == (want, want), x


def test_profiles_of_near_lines_are_near(spark):
    r = random.Random(8)
    pairs = [(a, edited(r, a)) for a in ("".join(r.choice("abcdefgé \U0001f600") for _ in range(r.choice([10, 30, 200]))) for _ in range(300))]
    pairs = [(a, b, levenshtein(a, b)) for a, b in pairs]
    rows = spark.createDataFrame(pairs, "a string, b string, d int")
    rows = rows.select("d", lines.profile(F.col("a")).alias("x"), lines.profile(F.col("b")).alias("y"))
    assert rows.where(~lines.profiles_near("x", "y", F.col("d"))).count() == 0


def test_lines_that_differ_in_a_word_or_two_make_few_pairs(spark):
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnopqrst") for _ in range(r.randint(5, 9))) for _ in range(60)]
    texts = set()
    for _ in range(80):
        changed = list(words)
        for at in r.sample(range(60), 2):
            changed[at] = "".join(r.choice("abcdefghijklmnopqrst") for _ in range(len(words[at])))
        texts.add(" ".join(changed))
    texts |= {sorted(texts)[0] + "x"}
    rows = spark.createDataFrame([(t,) for t in sorted(texts)], "line string").select("line", F.xxhash64("line").alias("id"), F.char_length("line").alias("n_chars"))
    assert 1 <= lines.candidates(rows).count() < len(texts)


@pytest.mark.parametrize("crowd", [2, 4])
def test_small_crowds_against_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(lines, "CROWD", crowd)
    test_against_brute_force(spark, monkeypatch, 2)


def test_lines_of_a_common_segment_meet_without_longer_keys(spark, monkeypatch):
    made, fine_keys = [], lines.fine_keys
    monkeypatch.setattr(lines, "fine_keys", lambda rows, probe: made.append(rows.count()) or fine_keys(rows, probe))
    r = random.Random(10)
    start = "a beginning that many lines have in common, and é "
    texts = [start + "".join(r.choice("abcdefghijklmnopqrst ") for _ in range(60)) for _ in range(40)]
    texts += [texts[0][:70] + "x" + texts[0][71:], texts[1] + "yz"]
    rows = spark.createDataFrame([(t,) for t in texts], "line string").select("line", F.xxhash64("line").alias("id"), F.char_length("line").alias("n_chars"))
    assert 2 <= lines.candidates(rows).count() < len(texts)
    assert made == [0, 0]


@pytest.mark.parametrize("wanted", [False, True])
def test_keys_of_probes_are_computed_by_compiled_code_and_once(spark, capsys, wanted):
    rows = spark.createDataFrame([("a" * 50, 1, 50)], "line string, id long, n_chars int")
    keys = lines.probes(rows)
    if wanted:
        keys = possible(keys, "key", spark.createDataFrame([(1,)], "key long"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    plan = capsys.readouterr().out
    # HotSpot interprets methods of more than 8000 bytes.
    assert 0 < max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", plan))) < 8000
    assert len(re.findall(r"^.*(?:Project|Filter) \S*.*xxhash64", plan, re.M)) == 1


def test_repeated_rows(spark):
    text = "a line that is long enough\nanother line, long enough too\na line that is long enough"
    docs = spark.createDataFrame([(1, text, "")] * 3 + [(2, text, "")], SCHEMA)
    got = sorted((x.doc_id, x.n_lines, x.removed) for x in lines.duplicate_lines(docs).collect())
    assert got == [(1, 3, [2])] * 3 + [(2, 3, [0, 1, 2])]


def test_a_very_long_line_and_an_empty_table(spark):
    long = "0123456789" * 20_000
    docs = spark.createDataFrame([(1, long, ""), (2, long[:70_000] + "x" + long[70_001:], ""), (3, long + long, "")], SCHEMA)
    got = {x.doc_id: (x.removed, x.n_links) for x in lines.duplicate_lines(docs).collect()}
    assert got == {1: ([], 1), 2: ([0], 1), 3: ([], 0)}
    assert lines.duplicate_lines(docs.limit(0)).count() == 0
