from pyspark.sql import functions as F

from mentionlake.llm import common


def test_the_bit_map_loses_no_row_and_lets_few_others_pass(spark, monkeypatch):
    rows = spark.range(20_000).select(F.xxhash64("id").alias("k"), "id")
    wanted = rows.where("id % 50 = 0").select("k")
    passed = common.possible(rows, "k", wanted)
    assert passed.columns == ["k", "id"]
    assert passed.where("id % 50 = 0").count() == 400
    assert passed.count() < 800
    monkeypatch.setattr(common, "MAPS", 1)
    monkeypatch.setattr(common, "BITS_PER_KEY", 1000)
    assert common.possible(rows, "k", wanted).where("id % 50 = 0").count() == 400
    assert common.possible(rows, "k", wanted.limit(0)).count() == 0


def test_digest_buckets_rise_with_the_digest(spark):
    rows = spark.range(3000).select(F.md5(F.col("id").cast("string").cast("binary")).alias("d"))
    got = [(r.d, r.b) for r in rows.withColumn("b", common.digest_bucket(F.col("d"), 3000, 100)).collect()]
    assert [b for _, b in sorted(got)] == sorted(b for _, b in got)
    assert {b for _, b in got} == set(range(32))
    assert {r.b for r in rows.select(common.digest_bucket(F.col("d"), 10, 100).alias("b")).collect()} == {0}


def test_chunks_cut_at_spaces_only():
    data = b"aa bbb  c " + b"d" * 50 + b" e"
    for size in (1, 3, 7, 100):
        parts = list(common.chunks(data, size))
        assert b"".join(parts) == data and all(p.endswith(b" ") for p in parts[:-1])
