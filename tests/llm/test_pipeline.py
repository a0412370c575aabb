import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mentionlake.llm import decontamination, simhash, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
INSULT = "blorgface"


def sentence(r, n=40):
    return " ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    r = random.Random(3)
    items = [sentence(r, 20) for _ in range(5)]
    texts, kinds = {}, {}
    for i in range(240):
        kind = "toxic" if i % 4 == 0 else "copy" if i % 10 == 1 and i > 10 else "leak" if i % 10 == 3 else "clean"
        text = sentence(r)
        if kind == "toxic":
            text = f"{INSULT} {text} {INSULT}ish"
        elif kind == "copy":
            text = texts[i - 10] if kinds[i - 10] in ("clean", "copy") else text
        elif kind == "leak":
            text = f"{text} {items[i % 5]}"
        texts[i], kinds[i] = text, kind
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t)) for i, t in texts.items()]
    rows += [(900, None, None, None, None), (901, "", "en", "src0", 0), (5, texts[5], "en", "src1", 1)]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(k == "toxic")) for i, k in kinds.items() if i % 3]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, kinds


def test_stages(spark, fixture):
    folder, texts, kinds = fixture
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
        out = corpus_pipeline.materialise(out, f"test-{name}")
        seen[name] = [r.doc_id for r in out.collect()]
        docs = out
    clean = seen["toxicity"]
    assert not any(kinds.get(i) == "toxic" for i in clean)
    assert {i for i, k in kinds.items() if k != "toxic"} | {900, 901} == set(clean)
    single = seen["simhash_near_dedup"]
    assert len(single) == len(set(single))
    first = {}
    for i in sorted(set(clean) - {900, 901}):
        first.setdefault(texts[i], i)
    assert set(first.values()) | {900} == set(single)
    pure = seen["benchmark_decontamination"]
    assert set(single) - set(pure) == {i for i in single if kinds.get(i) == "leak"}
    mixed = seen["curriculum_mixing"]
    assert set(mixed) <= set(pure) and max(map(mixed.count, mixed)) <= 3
    assert sorted(seen["rendezvous_sharding"]) == sorted(mixed)
    slots = {}
    for r in docs.collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_gives_the_same_rows_again(spark, fixture):
    rows = [sorted(map(str, corpus_pipeline.run(spark, fixture[0]).select("doc_id", "shard", "slot").collect())) for _ in range(2)]
    assert rows[0] == rows[1]


def test_empty_documents(spark, fixture):
    docs = spark.read.parquet(f"{fixture[0]}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, fixture[0]), "test-empty")
        assert docs.count() == 0


def test_each_stage_calls_an_operator():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "curriculum_mixing", "rendezvous_sharding"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert toxicity.THRESHOLD == 0.7 and simhash.DISTANCE == 2 and decontamination.WINDOW == 13
