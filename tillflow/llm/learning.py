"""What the learned scorers share: the held-out fold, labels, a bounded training sample, logistic fits, order statistics."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import text_of

# Rows of labelled texts that a scorer learns from at most; chosen by a hash of the id, so that a table of any size
# gives a sample spread over all of it.
SAMPLE_ROWS = 12_000


def held_out(id: str = "doc_id") -> Column:
    """True for the fold that is never learned from; rows without id belong to it."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def usable_labels(labels: DataFrame, label: str, id: str = "doc_id") -> DataFrame:
    """(id, label int) outside the held-out fold; of repeated labels of an id the larger counts."""
    return labels.where(~held_out(id)).where(F.col(label).isNotNull()).groupBy(F.col(f"`{id}`").alias("id")).agg(
        F.max(label).cast("int").alias("label"))


def sample(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text",
           rows: int = SAMPLE_ROWS) -> DataFrame:
    """(whole, label int, half int) of at most ``rows`` labelled rows outside the held-out fold.

    Rows without id or label are not used; of repeated labels of an id the larger counts, of its texts the one with
    the smallest hash.
    """
    chosen = usable_labels(labels, label, id).orderBy(F.xxhash64("id"), "id").limit(rows).withColumn("half", F.pmod(F.xxhash64("id"), F.lit(2)))
    texts = docs.select(F.col(f"`{id}`").alias("id"), text_of(text).alias("whole"))
    # At most ``rows`` rows of three numbers.
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label", "half").agg(
        F.min(F.struct(F.xxhash64("whole").alias("hash"), "whole")).alias("t")).select("t.whole", "label", "half")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression of y (0 or 1) on the columns of x, by damped Newton steps."""

    def at(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = sigmoid(x @ w)
        return x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x

    return newton(at, x.shape[1], ridge, steps)


def newton(at: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], size: int, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by damped Newton steps; ``at`` gives the loss's gradient and curvature, without the ridge."""
    w = np.zeros(size)
    for _ in range(steps):
        gradient, curve = at(w)
        step = np.linalg.solve(curve + ridge * np.eye(size), gradient + ridge * w)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def order_statistic(rows: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The value with ``k`` values before it in sorted order, exactly: counts in ever narrower bins, never the values."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high")).first()
    low, high, value = ends.low, ends.high, F.col(column)
    while low < high:
        place = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1))
        counts = rows.where(value.between(low, high)).groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy("bin").collect()
        for r in counts:
            if k < r.n:
                low, high = r.low, r.high
                break
            k -= r.n
    return low
