import random

import pytest
from pyspark.sql import functions as F

from mentionlake.operators.dedupe import latest_per_key, listing, row_digest, surrogate_key, top_n
from mentionlake.operators.merge import merge_into_table, merge_latest
from mentionlake.schemas import bronze_schema
from mentionlake.sources.tables import append

VERSIONED = "id string, updated_at bigint, payload string"


def test_an_interrupted_upsert_is_completed_by_the_next(spark, lake, rows, monkeypatch):
    from mentionlake.operators import merge

    name = lake.bronze_table("submissions")
    def batch(*data):
        df = spark.createDataFrame(list(data), "id string, updated_at bigint, partition_date string")
        known = spark.table(name).columns
        return df.selectExpr(*[c if c in df.columns else f"NULL AS {c}" for c in known])

    merge.merge_into_table(spark, name, batch(("a", 1, "01-01-2024"), ("b", 1, "01-01-2024"), ("c", 1, "02-01-2024")), "id", "updated_at")

    def stop(*_):
        raise RuntimeError("lost")

    # The new content is complete, and the first date is already emptied when the run stops.
    monkeypatch.setattr(merge, "overwrite_partitions", stop)
    with pytest.raises(RuntimeError):
        merge.merge_into_table(spark, name, batch(("a", 2, "02-01-2024")), "id", "updated_at")
    monkeypatch.undo()
    merge.clear_partitions(spark, name, ["01-01-2024"])
    merge.merge_into_table(spark, name, batch(("d", 1, "03-01-2024")), "id", "updated_at")
    assert rows(spark.table(name), "id", "updated_at", "partition_date") == [
        ("a", 2, "02-01-2024"), ("b", 1, "01-01-2024"), ("c", 1, "02-01-2024"), ("d", 1, "03-01-2024")]


def test_latest_per_key(spark, rows):
    data = [("a", 1, "x"), ("a", 2, "y"), ("b", None, "n"), ("b", 0, "z"), ("c", 5, "q"), ("c", 5, "p")]
    df = spark.createDataFrame(data, VERSIONED)
    assert rows(latest_per_key(df, "id", "updated_at", ["payload"])) == [("a", 2, "y"), ("b", 0, "z"), ("c", 5, "p")]


def test_ties_do_not_depend_on_input_order(spark, rows):
    data = [("a", 1, str(i)) for i in range(50)]
    found = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, VERSIONED).repartition(1 + seed)
        found.add(rows(latest_per_key(df, "id", "updated_at"))[0])
    assert len(found) == 1


def test_copies_are_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("id"), F.col("id").alias("updated_at"))
    plan = latest_per_key(df, "id", "updated_at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_same_on_both_routes(spark, rows):
    data = [("hot" if i % 3 else f"g{i % 30}", i * 7919 % 10007, i) for i in range(6000)]
    df = spark.createDataFrame(data, "g string, score int, id int")
    order = [F.desc("score"), F.col("id")]
    want = []
    for group in {g for g, _, _ in data}:
        ranked = sorted((r for r in data if r[0] == group), key=lambda r: (-r[1], r[2]))[:1500]
        want += [(*r, i + 1) for i, r in enumerate(ranked)]
    assert rows(top_n(df, "g", order, 1500)) == sorted(want, key=lambda r: tuple((True, str(v)) for v in r))
    small = rows(top_n(df, "g", order, 3))
    assert small == sorted((r for r in want if r[3] <= 3), key=lambda r: tuple((True, str(v)) for v in r))
    assert top_n(df, "g", order, 3, since=F.col("score") > 10006).count() == 0


def test_listing(spark, rows):
    now = 1704067200
    data = [("phones", "a", now - 10, 1), ("phones", "b", now - 90000, 9), ("tabs", "c", now - 3700, 5), ("tabs", "d", now, 5)]
    df = spark.createDataFrame(data, "subreddit string, id string, created_utc bigint, score int")
    order = [F.desc("score"), F.col("id")]
    assert rows(listing(df, "Top", order, now, "day"), "id", "rank", "sort_type") == [("a", 1, "top"), ("c", 1, "top"), ("d", 2, "top")]
    assert rows(listing(df, "controversial", order, now, limit=1), "id") == [("b",), ("c",)]
    with pytest.raises(ValueError):
        listing(df, "new", order, now)


def test_surrogate_keys_are_dense_and_stable(spark):
    df = spark.createDataFrame([(f"k{i}", i) for i in range(3000)], "k string, v int")
    first = {r.k: r.key for r in surrogate_key(df, "k", "key").collect()}
    again = {r.k: r.key for r in surrogate_key(df.repartition(7), "k", "key", prefix=2).collect()}
    assert sorted(first.values()) == list(range(1, 3001))
    assert first == again


def test_rows_sharing_a_natural_key_keep_their_numbers(spark):
    df = spark.createDataFrame([("k", i) for i in range(40)], "k string, v int")
    found = {tuple(sorted((r.v, r.key) for r in surrogate_key(d, "k", "key", tiebreak=row_digest(d)).collect()))
             for d in (df, df.repartition(5), df.orderBy(F.desc("v")))}
    assert len(found) == 1


def upsert(target, source):
    """The rule row by row: higher versions replace, new keys are added."""
    state = {i: (i, v, p) for i, v, p in target if i is not None}
    for i, v, p in source:
        if i is None:
            continue
        old = state.get(i)
        if old is None or (v is not None and old[1] is not None and v > old[1]):
            state[i] = (i, v, p)
    loose = [r for r in target + source if r[0] is None]
    return list(state.values()) + loose


def test_merge_rule(spark, rows):
    target = [("newer", 5, "t"), ("equal", 5, "t"), ("older", 5, "t"), ("tnull", None, "t"), ("snull", 5, "t"),
              ("only_t", 1, "t"), (None, 3, "t"), (None, 9, "t2")]
    source = [("newer", 6, "s"), ("equal", 5, "s"), ("older", 4, "s"), ("tnull", 9, "s"), ("snull", None, "s"),
              ("only_s", None, "s"), (None, 4, "s")]
    t, s = (spark.createDataFrame(x, VERSIONED) for x in (target, source))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(merge_latest(t, s, "id", "updated_at")) == sorted(upsert(target, source), key=key)


def test_merge_matches_the_rule_on_random_batches(spark, rows):
    rng = random.Random(7)
    batch = lambda tag: [(f"k{i}", rng.choice([None, 1, 2, 3]), tag) for i in rng.sample(range(60), 40)]
    target, source = batch("t"), batch("s")
    t, s = (spark.createDataFrame(x, VERSIONED) for x in (target, source))
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(merge_latest(t, s, "id", "updated_at")) == sorted(upsert(target, source), key=key)


def posts(spark, *values):
    df = spark.createDataFrame(list(values), "id string, updated_at bigint, score int, partition_date string")
    schema = bronze_schema("submissions")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def state(spark, table, rows):
    return rows(spark.table(table), "id", "updated_at", "score", "partition_date")


def test_table_merge_moves_rows_and_clears_dates(spark, lake, rows):
    table = lake.bronze_table("submissions")
    append(posts(spark, ("a", 1, 1, "01-01-2024"), ("b", 1, 1, "02-01-2024"), ("c", 1, 1, "03-01-2024")), table)
    touched = merge_into_table(
        spark, table, posts(spark, ("a", 2, 2, "04-01-2024"), ("b", 0, 9, "04-01-2024"), (None, 9, 9, "05-01-2024")),
        "id", "updated_at",
    )
    assert touched == ["01-01-2024", "02-01-2024", "04-01-2024"]
    want = [("a", 2, 2, "04-01-2024"), ("b", 1, 1, "02-01-2024"), ("c", 1, 1, "03-01-2024")]
    assert state(spark, table, rows) == want
    assert "partition_date=01-01-2024" not in [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    merge_into_table(spark, table, posts(spark, ("a", 2, 2, "04-01-2024")), "id", "updated_at")
    assert state(spark, table, rows) == want


def test_order_of_batches_does_not_matter(spark, lake, rows):
    table = lake.bronze_table("submissions")
    batches = [[(f"k{i}", v, v, f"0{1 + (i + v) % 5}-01-2024") for i in range(v, 12)] for v in (1, 2, 3)]
    for batch in (batches[2], batches[0], batches[1], batches[0]):
        merge_into_table(spark, table, posts(spark, *batch), "id", "updated_at")
    newest = {i: (i, v, s, d) for batch in batches for i, v, s, d in batch}
    assert state(spark, table, rows) == sorted(newest.values())


def test_rerun_repairs_an_interrupted_merge(spark, lake, rows):
    """The new copy was committed, the emptied date not yet cleared."""
    table = lake.bronze_table("submissions")
    append(posts(spark, ("a", 1, 1, "01-01-2024"), ("a", 2, 2, "02-01-2024")), table)
    merge_into_table(spark, table, posts(spark, ("a", 2, 2, "02-01-2024")), "id", "updated_at")
    assert state(spark, table, rows) == [("a", 2, 2, "02-01-2024")]


def _versions(seed, n, keys):
    import random
    random.seed(seed)
    return [(f"k{random.randrange(keys)}", random.choice([None, 1, 2, 3]), random.choice("ab"), "text " * random.randrange(3)) for _ in range(n)]


@pytest.mark.parametrize("bits", [64, 1 << 26])
def test_first_rows_without_a_shuffle_of_whole_rows(spark, monkeypatch, rows, bits):
    from mentionlake.operators import dedupe, merge
    from mentionlake.session import materialise, staging

    monkeypatch.setattr(dedupe, "MAP_BITS", bits)
    schema = "id string, v int, tie string, body string"
    found = _versions(1, 300, 90) + _versions(2, 20, 5) * 2
    target = materialise(spark.createDataFrame(_versions(3, 120, 90) + [(None, 1, "a", "x")], schema), "target")
    source = materialise(spark.createDataFrame(found, schema), "source")
    with staging(spark, "test-first") as save:
        latest = dedupe.latest_rows(save, source, "id", "v", ["tie"])
        assert rows(latest) == rows(dedupe.latest_per_key(source, "id", "v", ["tie"]))
    with staging(spark, "test-merge") as save:
        merged = merge.merged_rows(save, target, source, ["id"], "v", ["tie"])
        assert rows(merged) == rows(merge.merge_latest(target, source, "id", "v", ["tie"]))
    with staging(spark, "test-none") as save:
        single = materialise(source.dropDuplicates(["id"]), "single")
        alone = dedupe.latest_rows(save, single, "id", "v", ["tie"])
        assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
        assert rows(alone) == rows(single)
