import random
import re

import numpy as np
import pytest
import xxhash

from mentionlake.llm import golay, graph, simhash

SCHEMA = "doc_id long, text string, fp string, root int"


def brute(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(values):
    """Number of the least member for each distinct value, by comparing all."""
    values = sorted(set(values))
    root = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j in range(i):
                if (a ^ values[j]).bit_count() <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    return dict(zip(values, root, strict=True))


def test_words_two_bits_apart_share_a_codeword():
    table = golay.tables()
    assert np.bincount(table[2]).tolist() == [0, 277, 0, 0, 0, 0, 1771]
    r = np.random.default_rng(0)
    words = r.integers(0, 1 << 23, 400)

    def near(w):
        number, of = golay.indices(w)
        return [set(number[of == i].tolist()) for i in range(len(w))]

    for i in range(23):
        for j in range(i, 23):
            other = words ^ (1 << i) ^ ((1 << j) if j != i else 0)
            assert all(a & b for a, b in zip(near(words), near(other), strict=True)) or pytest.fail(f"{i} {j}")
        words = r.integers(0, 1 << 23, 20)


@pytest.mark.parametrize("piece", [9, 1 << 20])
def test_fingerprints(monkeypatch, piece):
    monkeypatch.setattr(simhash, "PIECE_BYTES", piece)
    r = random.Random(5)
    texts = [None, "", " \t\n", "One", "one TWO", "a b c", "a b\tc\vd\x1ce é Ä x", "same " * 50]
    texts += [" ".join(r.choice(["x", "Y", "zé", "\n"]) for _ in range(n)) for n in (4, 30, 200)]
    for t in texts:
        assert simhash.fingerprint(t.encode() if t is not None else None) % (1 << 64) == brute(t)


@pytest.mark.parametrize("bucket", [0, 2, 64])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(bucket)
    values = {0, 1, 3, 7, 1 << 63, (1 << 64) - 1}
    for _ in range(12):
        v = r.getrandbits(64)
        for _ in range(r.randint(1, 14)):
            values.add(v)
            for _ in range(r.randint(1, 3)):
                v ^= 1 << r.randrange(64)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = [(i, v) for i, v in enumerate(signed)] + [(i + 1000, v) for i, v in enumerate(signed[::2])]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    found = {r.fp: r.component_id for r in simhash.classes(prints).collect()}
    root = joined(values)
    least = {}
    for i, v in rows:
        least[root[v % (1 << 64)]] = min(i, least.get(root[v % (1 << 64)], 1 << 60))
    alone = {i: v for i, v in enumerate(signed) if v not in found}
    assert all(found[v] == least[root[v % (1 << 64)]] for v in found)
    assert all(list(root.values()).count(root[v % (1 << 64)]) == 1 for v in alone.values())


def docs_of(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (3, base), (9, base + " end"), (4, "quite another text"), (6, None), (2, ""), (None, "no id here at all"), (None, "no id here at all"), (4, "quite another text")]
    return spark.createDataFrame([(*r, "old", 7) for r in rows], SCHEMA)


def test_near_duplicates(spark):
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs_of(spark).select("doc_id", "text")).collect()]
    assert len(got) == 9
    prints = {i: f for i, f, _ in got}
    assert prints[3] == prints[5] and prints[2] == prints[6] == "0" * 16 and len(prints[None]) == 16
    component = {i: c for i, _, c in got}
    assert component[5] == component[3] == 3 and component[6] == 2 and component[4] == 4 and component[None] is None
    if (int(prints[3], 16) ^ int(prints[9], 16)).bit_count() <= 2:
        assert component[9] == 3


def test_one_of_each(spark):
    kept = simhash.one_of_each(docs_of(spark).select("doc_id", "text"))
    assert kept.columns == ["doc_id", "text"]
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids.count(4) == 1 and ids.count(None) == 1 and 3 in ids and 5 not in ids and 2 in ids and 6 not in ids


def test_clashing_columns_and_empty_tables(spark):
    docs = docs_of(spark)
    assert simhash.near_duplicates(docs).count() == 9
    assert set(simhash.one_of_each(docs).columns) <= set(docs.columns)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "a long, b long")
    nodes = spark.range(n + 1).selectExpr("id AS node", "struct(id + 5 AS least, id AS node) AS label")
    assert {r.label.node for r in graph.components(edges, nodes).collect()} == {0}
