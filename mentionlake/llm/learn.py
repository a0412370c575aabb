"""Bounded samples of labelled rows, and small helpers of the classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlake.llm.common import crc_of_id


def held_out(modulus: int, remainder: int, id_col: str = "doc_id"):
    """Whether a row's label must not be learned from; rows without an id are not held out, but have no label either."""
    return F.coalesce(crc_of_id(id_col) % modulus == remainder, F.lit(False))


def draw(ids: DataFrame, rows: int, id_col: str = "doc_id") -> DataFrame:
    """About the ``rows`` ids with the least digest: at most ``rows``, and all where there are no more.

    A bound on the digest leaves twice as many at most to sort, however large the table is.
    """
    share = min(1.0, 2.0 * rows / max(1, ids.count()))
    digest = F.md5(F.concat(F.lit("fit:"), F.col(id_col).cast("string")).cast("binary"))
    unit = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)
    return ids.where(F.col(id_col).isNotNull() & (unit <= share)).orderBy(digest).limit(rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    def __init__(self, size: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)
