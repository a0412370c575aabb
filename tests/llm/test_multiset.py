import hashlib
import random

import pytest
from pyspark.sql import functions as F

from mentionlake.llm import multiset as m

SCHEMA = "doc_id long, text string, edited string"


def hexes(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.h for r in rows.orderBy("i").select(m.to_hex(m.fingerprint(F.col("t"))).alias("h")).collect()]


def test_order_does_not_matter_and_counts_do(spark):
    a, b, c, d, e, f = hexes(spark, "one two\nthree\nfour five", "four five\none two\nthree", "three\nthree\none two\nfour five", None, "", "\n")
    assert a == b and a != c and d == e and e != f
    assert len(a) == 16 + m.LANES * 8 + m.SUMS * 15


def test_paragraphs_go_in_and_out(spark):
    rows = spark.createDataFrame([("x y\nlong paragraph of more than eight words, so two pieces", "new é line")], "t string, p string")
    before = m.fingerprint(F.col("t"))
    got = rows.select(
        m.to_hex(m.with_paragraph(before, F.col("p"))).alias("added"), m.to_hex(m.fingerprint(F.concat("p", F.lit("\n"), "t"))).alias("whole"),
        m.to_hex(m.without_paragraph(m.with_paragraph(before, F.col("p")), F.col("p"))).alias("back"), m.to_hex(before).alias("before")).first()
    assert got.added == got.whole and got.back == got.before and got.added != got.before


def test_likeness(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    base = " ".join(r.choice(words) for _ in range(2000))
    half = base[: len(base) // 2] + " ".join(r.choice(words) for _ in range(1000))
    other = " ".join(r.choice(words) for _ in range(2000))
    rows = spark.createDataFrame([(base, base), (base, half), (base, other), ("", ""), ("", base), (None, "")], "a string, b string")
    got = [x.n for x in rows.coalesce(1).select(m.likeness(m.fingerprint(F.col("a")), m.fingerprint(F.col("b"))).alias("n")).collect()]
    assert got[0] == 1.0 and 0.3 < got[1] < 0.75 and got[2] < 0.3 and got[3:] == [1.0, 0.0, 1.0]


def expected(rows):
    """In falling order of ids; those without one last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(text) // 2
        out.append((doc, text, text[: len(text) - k] + following[:k]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("per_range", "cells"), [(1, 3), (3, 1024), (2000, 1024)])
def test_edited_texts(spark, monkeypatch, per_range, cells):
    monkeypatch.setattr(m, "ROWS_PER_RANGE", per_range)
    monkeypatch.setattr(m, "CELLS", cells)
    r = random.Random(per_range)
    ids = [-(1 << 62), 1 << 62, 0, *r.sample(range(50), 30), *(10**12 + i for i in range(9))]
    rows = [(i, "".join(r.choice("aé日\n ") for _ in range(r.choice([0, 1, 2, 9, 40])))) for i in dict.fromkeys(ids)]
    rows += [(None, "no id"), (77, None)]
    docs = spark.createDataFrame([(*x, "old") for x in rows], SCHEMA).repartition(5)
    got = sorted(((x.doc_id, x.text, x.edited) for x in m.edited_texts(docs).collect()), key=str)
    assert got == expected(rows)
    hexed = docs.withColumn("h", m.to_hex(m.fingerprint(F.coalesce("text", F.lit(""))))).select("doc_id", "h")
    firsts = {x.doc_id: x.h for x in hexed.collect()}
    order = [x[0] for x in sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0)))]
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    for x in m.edited_texts(docs).withColumn("h", m.to_hex(F.col("next_fp"))).collect():
        assert x.h == firsts[following[x.doc_id]]


def test_repeated_rows_one_row_and_none(spark):
    twice = spark.createDataFrame([(1, "abcd", ""), (1, "abcd", ""), (1, "xy", ""), (0, "12", "")], SCHEMA)
    got = [(x.doc_id, x.text) for x in m.edited_texts(twice).collect()]
    assert sorted(got) == [(0, "12"), (1, "abcd"), (1, "abcd"), (1, "xy")]
    one = m.edited_texts(twice.where("doc_id = 0")).first()
    assert one.edited == "11"
    assert m.edited_texts(twice.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = "Paragraph of some words here.\n" * 40_000
    docs = spark.createDataFrame([(2, text, ""), (1, "end", "")], SCHEMA)
    row = m.edited_texts(docs).where("doc_id = 2").select(F.sha2("edited", 256).alias("h")).first()
    assert row.h == hashlib.sha256((text[: len(text) // 2] + "end").encode()).hexdigest()
