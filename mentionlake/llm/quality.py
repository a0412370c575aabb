"""A quality classifier that learns from trusted positives and unlabelled text."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlake.llm.common import chunks
from mentionlake.llm.learn import Adam, draw, held_out, sigmoid
from mentionlake.session import ship_package

#: At most so many trusted positives, and as many unlabelled rows, are fitted on. Their digests choose them.
FIT_ROWS = 8000
BINS, EPOCHS, BATCH, RATE, DECAY = 8, 30, 512, 0.02, 1e-4
#: nnPU: below this the risk of the negatives is pushed back up, by this share of a step.
BETA, GAMMA = 0.0, 1.0
THRESHOLD = 0.7
PIECE_BYTES = 4 << 20
SIGNS = b".,;:!?|*$%&#@<>{}=_/\\~^\"'()-"
TERMINAL = tuple(b".!?:;,")
FEATURES = 18 + len(SIGNS)


def features(text: bytes | None) -> np.ndarray:
    """Shape of a text: shares of characters, of kinds of words and lines, repetition, and sizes."""
    text = text or b""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256).astype(np.float64)
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    other, blank, lines = counts[128:].sum(), counts[32] + counts[9:14].sum(), counts[10] + 1
    n_words = letters = same = capital = shouted = closed = symbols = 0
    distinct, deflated = set(), 0
    for piece in chunks(text, PIECE_BYTES):
        words = piece.split()
        n_words += len(words)
        letters += sum(map(len, words))
        distinct.update(words)
        same += sum(map(eq, words, words[1:]))
        shouted += sum(map(bytes.isupper, words))
        capital += sum(map(bytes.istitle, words))
        closed += sum(1 for w in words if w[-1] in TERMINAL)
        symbols += sum(1 for w in words if not (w[-1] >= 128 or 65 <= w[-1] <= 90 or 97 <= w[-1] <= 122 or 48 <= w[-1] <= 57))
        deflated += len(zlib.compress(piece, 1))
    n, w, letter = max(len(text), 1), max(n_words, 1), max(upper + lower + other, 1)
    line_list = text.split(b"\n")
    shape = [
        upper / letter, lower / n, digit / n, other / n, blank / n, np.log1p(len(text)), np.log1p(n_words), letters / w, len(distinct) / w,
        same / w, shouted / w, capital / w, closed / w, symbols / w, min(deflated / n, 2.0), np.log1p(lines), len(set(line_list)) / lines, np.log1p(n / lines),
    ]
    return np.concatenate([shape, counts[list(SIGNS)] / w])


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    edges: np.ndarray  # by feature
    weights: np.ndarray
    prior: float


def design(model: Model, x: np.ndarray) -> np.ndarray:
    """Each feature as a number and as one of some bins, and a constant: an additive model."""
    z = np.clip((x - model.mean) / model.spread, -4, 4)
    bins = np.stack([np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(x.shape[1])], axis=1)
    hot = np.zeros((len(x), x.shape[1], BINS))
    np.put_along_axis(hot, bins[:, :, None], 1.0, axis=2)
    return np.concatenate([z, hot.reshape(len(x), -1), np.ones((len(x), 1))], axis=1)


def descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> np.ndarray:
    """Minimise the non-negative risk for a class prior; without one, tell positives from unlabelled rows."""
    rng, weights = np.random.default_rng(seed), np.zeros(positive.shape[1])
    adam = Adam(len(weights), RATE)
    steps = max(1, min(len(positive), len(unlabelled)) // BATCH)
    for _ in range(EPOCHS * max(1, 8 // steps)):
        for p, u in zip(np.array_split(rng.permutation(len(positive)), steps), np.array_split(rng.permutation(len(unlabelled)), steps), strict=True):
            xp, xu = positive[p], unlabelled[u]
            fp, fu = sigmoid(xp @ weights), sigmoid(xu @ weights)
            if prior is None:
                gradient = xp.T @ (fp - 1) / len(p) + xu.T @ fu / len(u)
            else:
                up = xu.T @ fu / len(u) - prior * (xp.T @ fp) / len(p)
                risk = -np.log1p(-np.minimum(fu, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(fp, 1 - 1e-12)).mean()
                gradient = -GAMMA * up if risk < -BETA else up + prior * (xp.T @ (fp - 1)) / len(p)
            weights -= adam.step(gradient + DECAY * weights)
    return weights


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled rows, from the best bin.

    A classifier of one half of the rows ranks the other half. Above a threshold that negatives do not reach, the share of
    unlabelled rows over the share of positives is the prior; the threshold is the one whose ratio has the least upper bound.
    """
    weights = descend(positive[::2], unlabelled[::2], None, 1)
    p, u = np.sort(positive[1::2] @ weights), np.sort(unlabelled[1::2] @ weights)
    if not len(p) or not len(u):
        return 0.5
    above_p = 1 - np.searchsorted(p, p) / len(p)
    above_u = 1 - np.searchsorted(u, p) / len(u)
    slack = np.sqrt(np.log(40) / 2 / len(p)) + np.sqrt(np.log(40) / 2 / len(u))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model | None:
    """None where there are no positives or no rows at all."""
    if not len(positive) or not len(unlabelled):
        return None
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-6
    edges = np.quantile(unlabelled, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Model(mean, spread, edges, np.zeros(0), 0.5)
    p, u = design(model, positive), design(model, unlabelled)
    prior = class_prior(p, u)
    return model._replace(weights=descend(p, u, prior, 2), prior=prior)


def sampled(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """Features of the drawn rows, in an order that does not depend on tasks."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["i", "x"])

    chosen = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("binary").alias("t")).join(F.broadcast(ids.select(F.col(id_col).alias("i")).distinct()), "i")
    i_type = docs.schema[id_col].dataType
    rows = chosen.mapInArrow(run, T.StructType([T.StructField("i", i_type), T.StructField("x", T.ArrayType(T.DoubleType()))])).collect()
    return np.array([r.x for r in sorted(rows, key=lambda r: (r.i, r.x))]).reshape(-1, FEATURES)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = FIT_ROWS) -> Model | None:
    """Fit on at most ``rows`` positives and ``rows`` unlabelled documents; other labels are not used.

    An id with several labels is a positive only if all are 1. Labels of held-out rows must be gone from ``labels``.
    """
    positives = labels.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("l")).where("l = 1").select(id_col)
    return fit(sampled(docs, draw(positives, rows, id_col), id_col, text_col), sampled(docs, draw(docs.select(id_col), rows, id_col), id_col, text_col))


def scored(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``score``; 0.5 for all without a model. A null text counts as empty, and every text has a score."""
    ship_package(docs.sparkSession)
    docs = docs.drop("score")
    keep = docs.columns if keep is None else keep
    kept = [f for f in docs.schema.fields if f.name in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, model = batch.num_columns - 1, shared.value
            x = np.array([features(t.as_py()) for t in batch.column(last)]).reshape(-1, FEATURES)
            score = np.full(len(x), 0.5) if model is None else sigmoid(design(model, x) @ model.weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(score)], names=[*batch.schema.names[:last], "score"])

    return docs.select(*[f.name for f in kept], F.col(text_col).cast("binary").alias("__text")).mapInArrow(
        run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2, keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``held_out``, ``score``, ``predicted``. Labels of held-out ids are not seen; an empty table gives an empty one."""
    model = train(docs, labels.where(~held_out(modulus, remainder)))
    out = scored(docs.drop("held_out", "predicted"), model, keep=keep)
    return out.withColumn("held_out", held_out(modulus, remainder)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
