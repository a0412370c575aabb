import hashlib

import pytest
from pyspark.sql import functions as F

from mentionlake.llm import mixing
from mentionlake.llm.common import word_count

SCHEMA = "doc_id long, source string, text string, taken string"


def filled(sizes, weights, cap):
    """Share again and again until nothing is above its cap."""
    targets, open_ = {}, dict(zip(sizes, weights, strict=True))
    left = sum(sizes.values())
    while open_:
        level = left / sum(open_.values())
        over = [s for s in open_ if cap * sizes[s] <= level * open_[s]]
        if not over:
            return targets | {s: level * w for s, w in open_.items()}
        for s in over:
            targets[s] = cap * sizes[s]
            left -= targets[s]
            del open_[s]
    return targets


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "old") for r in rows], SCHEMA)


@pytest.mark.parametrize("per_bucket", [1, 4096])
def test_targets_and_words(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", per_bucket)
    rows = [(i, s, "w " * (1 + i % n)) for s, n, many in (("a", 30, 4), ("b", 9, 50), ("c", 5, 20), (None, 3, 6), ("", 7, 40)) for i in range(many)]
    got = mixing.curriculum(docs_of(spark, rows), word_count(F.col("text"))).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = filled({s: sizes[s] for s in order}, [(5, 2, 1)[i % 3] for i in range(len(order))], 3)
    for s in order:
        mine = [r for r in got if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s]) for r in mine)
        assert sum(r.taken for r in mine) == int(want[s] + 0.5)
    assert all(0 <= r.taken <= 3 * r.size and len(r.positions) <= 3 and r.positions == sorted(r.positions) for r in got)
    assert all(0 <= p <= 1 for r in got for p in r.positions)


def test_whole_documents(spark):
    rows = [(i, "ab"[i % 2], "w " * (i % 7)) for i in range(100)] + [(200, "e", ""), (201, "e", None)]
    got = mixing.curriculum(docs_of(spark, rows), word_count(F.col("text")), cut=False)
    assert all(r.taken == r.size * len(r.positions) for r in got.where("size > 0").collect())
    assert {(r.doc_id, len(r.positions)) for r in got.where("source = 'e'").collect()} == {(200, 1), (201, 1)}
    copies = mixing.in_order(got).collect()
    assert [c.position for c in copies] == sorted(c.position for c in copies)


def test_repeated_rows_ties_and_nulls(spark):
    rows = [(1, "a", "x y")] * 3 + [(None, None, None), (None, "a", "z"), (2, None, "")]
    first, second = (sorted(map(str, mixing.curriculum(docs_of(spark, rows), word_count(F.col("text"))).collect())) for _ in range(2))
    assert first == second and len(first) == 6


def test_a_very_long_text(spark):
    got = mixing.curriculum(docs_of(spark, [(1, "a", "word " * 400_000), (2, "b", "x")]), word_count(F.col("text"))).collect()
    assert {r.doc_id: r.size for r in got} == {1: 400_000, 2: 1}


def test_empty_table(spark):
    got = mixing.curriculum(docs_of(spark, []), word_count(F.col("text")))
    assert got.count() == 0 and got.columns == ["doc_id", "source", "text", "size", "source_size", "target", "taken", "positions"]


@pytest.mark.parametrize("weight", [5, 2, 1])
def test_inverse_of_the_demand(spark, weight):
    knots = mixing.SCHEDULE[weight]
    steps = 200_000
    demand, at, shares = 0.0, [], [0.0, 0.1, 0.37, 0.5, 0.8, 0.99]
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    for i in range(steps):
        t = (i + 0.5) / steps
        (t0, w0), (t1, w1) = next((a, b) for a, b in zip(knots, knots[1:], strict=False) if a[0] <= t <= b[0])
        while len(at) < len(shares) and demand / whole >= shares[len(at)] - 1e-12:
            at.append(t)
        demand += (w0 + (w1 - w0) * (t - t0) / (t1 - t0)) / steps
    got = spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.invert(F.col("s"), knots).alias("t")).collect()
    assert [r.t for r in got] == pytest.approx(at, abs=1e-3)


def test_order_within_a_source_is_the_digests(spark):
    rows = [(i, "a", "one two") for i in range(50)]
    got = mixing.curriculum(docs_of(spark, rows), word_count(F.col("text"))).collect()
    by_time = [r.doc_id for r in sorted(got, key=lambda r: r.positions[0])]
    assert by_time == sorted(range(50), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
