import hashlib
import math

import pytest

from mentionlake.llm import sharding

SCHEMA = "doc_id long, text string, slot string"


def bid(key, shard, weight):
    unit = (int(hashlib.md5(f"{key}:{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return weight / -math.log(unit)


def expected(key, weights):
    return max(range(len(weights)), key=lambda i: (bid(key, i, weights[i]), -i))


@pytest.mark.parametrize("per_bucket", [1, 4096])
def test_against_brute_force(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", per_bucket)
    ids = [*range(300), 7, 7, None, None]
    docs = spark.createDataFrame([(i, f"t{i}", "old") for i in ids], SCHEMA)
    rows = sharding.place(docs).collect()
    assert len(rows) == len(ids)
    weights = [1.0] * 16
    slots = {}
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == expected(key, weights)
        assert r.grown_shard == expected(key, [*weights, 1.0])
        assert r.grown_shard in (r.shard, 16)
        slots.setdefault(r.shard, []).append((r.slot, hashlib.md5(key.encode()).hexdigest()))
    for found in slots.values():
        found.sort()
        assert [s for s, _ in found] == list(range(len(found)))
        assert [d for _, d in found] == sorted(d for _, d in found)


def test_weights_share_the_keys(spark):
    docs = spark.range(6000).toDF("doc_id")
    counts = {r["shard"]: r["count"] for r in sharding.place(docs, weights=(1.0, 2.0, 3.0)).groupBy("shard").count().collect()}
    assert [round(counts[i] / 1000) for i in range(3)] == [1, 2, 3]


def test_removing_a_shard_moves_its_keys_only(spark):
    docs = spark.range(500).toDF("doc_id")
    before = {r.doc_id: r.shard for r in sharding.place(docs, weights=(1.0,) * 5).collect()}
    after = {r.doc_id: r.shard for r in sharding.place(docs, weights=(1.0,) * 4).collect()}
    assert all(after[k] == s for k, s in before.items() if s != 4)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    placed = sharding.place(docs)
    assert placed.columns == ["doc_id", "text", "shard", "slot", "grown_shard"]
    assert placed.count() == 0
