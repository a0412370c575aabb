"""A toxicity classifier whose score does not depend on which group a sentence names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.llm.common import chunks
from mentionlake.llm.decontamination import FOLD
from mentionlake.llm.learn import Adam, draw, held_out, sigmoid
from mentionlake.session import materialise, ship_package

#: Terms of a group stand for each other in neutral sentences.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives"),
    ("disabled", "deaf", "blind"),
)
#: At most so many toxic and so many other labelled rows are fitted on. Their digests choose them; each stands for as many as there are.
FIT_TOXIC, FIT_OTHER = 6000, 12000
#: Words and their beginnings fall into so many buckets; those that tell the classes apart by so many standard deviations are used.
BUCKETS, SELECTED, DEVIATIONS, LEAST_ROWS = 1 << 20, 2048, 4.0, 3
PREFIXES = (4, 5, 6)
STEPS, RATE, DECAY = 400, 0.1, 2e-5
#: Weight of the squared change of the score when an identity term is swapped.
FAIRNESS = 10.0
THRESHOLD = 0.7
PIECE_BYTES = 4 << 20


def words(text: bytes | None) -> set[bytes]:
    """Distinct words, lower-cased for A to Z."""
    found: set[bytes] = set()
    for piece in chunks((text or b"").translate(FOLD), PIECE_BYTES):
        found.update(piece.split())
    return found


def buckets(found: set[bytes]) -> set[int]:
    """Of each word and its beginnings. A whole word ends in a blank, so it differs from a beginning."""
    out = {crc32(w + b" ") for w in found}
    for n in PREFIXES:
        out.update(map(crc32, {w[:n] for w in found if len(w) >= n}))
    return {h & BUCKETS - 1 for h in out}


def swaps(found: set[bytes], groups: Sequence[Sequence[str]]) -> list[set[bytes]]:
    """The words with one identity term replaced, for each term that occurs and each that it could be."""
    out = []
    for group in groups:
        terms = [t.encode() for t in group]
        for term in terms:
            if term in found:
                out += [(found - {term}) | {other} for other in terms if other != term]
    return out


class Model(NamedTuple):
    selected: dict[int, int]  # bucket: its column
    weights: np.ndarray
    constant: float


class Rows(NamedTuple):
    """A sparse 0/1 matrix."""

    row: np.ndarray
    column: np.ndarray
    n: int

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n)

    def back(self, r: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.column, r[self.row], size)


def sparse(rows: list[list[int]]) -> Rows:
    return Rows(np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array([c for r in rows for c in r], np.int64), len(rows))


def descend(
    x: Rows, y: np.ndarray, before: Rows, after: Rows, size: int, fairness: float, counts: np.ndarray, pair_counts: np.ndarray,
) -> tuple[np.ndarray, float]:
    """Logistic loss, plus the mean squared change of the logit between rows and their swapped forms. ``counts``: the rows that each stands for."""
    w, adam = np.zeros(size + 1), Adam(size + 1, RATE)
    w[-1] = np.log((counts @ y + 0.5) / (counts @ (1 - y) + 0.5))
    for _ in range(STEPS):
        error = (sigmoid(x.times(w[:-1]) + w[-1]) - y) * (counts / counts.sum())
        gradient = np.append(x.back(error, size) + DECAY * w[:-1], error.sum())
        if before.n:
            change = (before.times(w[:-1]) - after.times(w[:-1])) * (2 * fairness * pair_counts / pair_counts.sum())
            gradient[:-1] += before.back(change, size) - after.back(change, size)
        w -= adam.step(gradient)
    return w[:-1], float(w[-1])


def counted(sample: DataFrame) -> DataFrame:
    """(bucket, toxic, other): rows with it. Each task adds up its rows before anything is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[label, list(buckets(words(text.as_py())))] += 1
        some = np.flatnonzero(counts.any(axis=0))
        for i in range(0, len(some), 100_000):
            part = some[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])], names=["bucket", "toxic", "other"])

    return sample.select("t", "l").mapInArrow(run, "bucket long, toxic long, other long").groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def select(counts: DataFrame, toxic: int, other: int) -> list[int]:
    """The buckets that toxic rows have more often than chance explains."""
    share = (F.col("toxic") + F.col("other")) / (toxic + other)
    deviation = (F.col("toxic") / toxic - F.col("other") / other) / F.sqrt(share * (1 - share) * (1 / toxic + 1 / other))
    found = counts.where((F.col("toxic") >= LEAST_ROWS) & (share < 1)).withColumn("z", deviation).where(F.col("z") >= DEVIATIONS)
    return [r.bucket for r in found.orderBy(F.desc("z"), "bucket").limit(SELECTED).collect()]


def vectors(sample: DataFrame, selected: dict[int, int], groups: Sequence[Sequence[str]]) -> list:
    """Of each row its label, its columns, and those of its swapped forms."""

    def columns(found: set[bytes]) -> list[int]:
        return sorted(selected[b] for b in buckets(found) if b in selected)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, changed = [], []
            for text in batch.column(0):
                found = words(text.as_py())
                x.append(columns(found))
                changed.append([columns(s) for s in swaps(found, groups)])
            kinds = [pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(x, kinds[0]), pa.array(changed, kinds[1])], names=["l", "i", "x", "changed"])

    rows = sample.select("t", "l", "i").mapInArrow(run, "l int, i string, x array<long>, changed array<array<long>>").collect()
    return sorted(rows, key=lambda r: (r.i, r.x))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS, fairness: float = FAIRNESS,
) -> Model | None:
    """Fit on at most ``FIT_TOXIC`` and ``FIT_OTHER`` rows, weighted so that the classes keep the share they have among all
    labels. An id with several labels is toxic if any says so.

    None where a class has no rows. Only what tells the classes apart, and identity terms, becomes a column.
    """
    ship_package(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("l"))
    known = materialise(known, "toxicity-labels")
    chosen = draw(known.where("l = 1"), FIT_TOXIC, id_col).unionByName(draw(known.where("l = 0"), FIT_OTHER, id_col))
    texts = docs.select(F.col(id_col), F.col(text_col).cast("binary").alias("t"))
    sample = materialise(texts.join(F.broadcast(chosen), id_col).select("t", "l", F.col(id_col).cast("string").alias("i")), "toxicity-sample")
    n = {r.l: r.n for r in sample.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return None
    # All rows with a label over those fitted on; n has the latter.
    learnable = docs.select(id_col).join(known, id_col).groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()
    stands_for = {r.l: r.n / n[r.l] for r in learnable}
    chosen_buckets = select(counted(sample), n[1], n[0])
    terms = buckets({t.encode() for group in groups for t in group})
    selected = {b: i for i, b in enumerate([*chosen_buckets, *sorted(terms - set(chosen_buckets))])}
    rows = vectors(sample, selected, groups)
    pairs = [(list(r.x), list(c)) for r in rows for c in r.changed]
    counts = np.array([stands_for[r.l] for r in rows])
    pair_counts = np.array([stands_for[r.l] for r in rows for _ in r.changed])
    w, constant = descend(
        sparse([list(r.x) for r in rows]), np.array([float(r.l) for r in rows]), sparse([a for a, _ in pairs]), sparse([b for _, b in pairs]),
        len(selected), fairness, counts, pair_counts)
    return Model(selected, w, constant)


def score(text: bytes | None, model: Model | None) -> float:
    if model is None:
        return 0.0
    found = [model.selected[b] for b in buckets(words(text)) if b in model.selected]
    return float(sigmoid(np.array([model.constant + model.weights[sorted(found)].sum()]))[0])


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``score``; 0 for all without a model. A null text counts as empty, and every text has a score."""
    ship_package(docs.sparkSession)
    docs = docs.drop("score")
    keep = docs.columns if keep is None else keep
    kept = [f for f in docs.schema.fields if f.name in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            scores = pa.array([score(t.as_py(), shared.value) for t in batch.column(last)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], scores], names=[*batch.schema.names[:last], "score"])

    return docs.select(*[f.name for f in kept], F.col(text_col).cast("binary").alias("__text")).mapInArrow(
        run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``held_out``, ``score``, ``predicted``. Labels of held-out ids are not seen; an empty table gives an empty one."""
    model = train(docs, labels.where(~held_out(modulus, remainder)))
    out = scored(docs.drop("held_out", "predicted"), model, keep=keep)
    return out.withColumn("held_out", held_out(modulus, remainder)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
