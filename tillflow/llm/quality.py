"""Quality scores by Bradley-Terry ranking of labelled texts.

A pair of texts, one labelled good and one not, is a preference. The chance that the good one wins is the logistic
function of the difference of their scores, and a score is a weighted sum of measures of the text; the weights
maximise the likelihood of the preferences. A text is kept if its score exceeds the quantile of the training
scores that leaves out as large a share as the labels do.

All labelled texts outside the held-out fold are learned from. Their measures are dealt out to blocks of bounded size, in
which texts of either label meet; every Newton step is a pass over the blocks whose sums go to the driver, and the
quantile is found by counting.

Defined cases: NULL and empty texts have all measures 0 and a score like any other; without preferences (no
labels, or one kind only) every score is 0.5; equal texts have equal scores; missing ids count as held out;
input columns named like a result are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import drop_written, fresh, text_of, with_results, written
from tillflow.llm.learning import held_out, newton, order_statistic, sigmoid, usable_labels

# Preferences per text of the rarer label, or as many as give every text of the other label one.
PAIRS_EACH = 20
# Texts that meet in a block, and of the rarer label at least, on average: with 32, a block without any has a chance of 1e-14.
BLOCK_ROWS = 1024
LEAST_RARE = 32
# The sums of a block are added up as whole numbers of this unit, so that their order does not matter.
UNIT = 2.0 ** -30
SYMBOLS = "#$%&*+=<>^~@\\{}[]_"


def measures(text: str) -> list[float]:
    """Shares between 0 and 1, whatever the length of the text."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_MEASURES
    use = Counter(words)
    lines = text.split("\n")
    again = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1)
    shares = [
        sum(map(text.count, SYMBOLS)) / n, text.count("|") / n, text.count("!") / n, text.count("?") / n,
        sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n, sum(map(str.isdigit, words)) / n,
        again / n, 1 - pairs, use.most_common(1)[0][1] / n, 1 - len(set(lines)) / len(lines),
        min(1.0, len(text) / n / 20), (text.count(".") + text.count(",")) / n,
    ]
    return [min(1.0, s) ** 0.5 for s in shares] + [min(1.0, n / 50)]


N_MEASURES = 14


def training(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(place, label, x): the measures of every labelled text outside the held-out fold, with a hash of its id.

    Rows without id or label are not used; of repeated labels of an id the larger counts, of its texts the one with
    the smallest hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measures(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.float64()))], ["id", "hash", "x"])

    texts = docs.where(~held_out(id)).select(F.col(f"`{id}`").alias("id"), F.xxhash64(text_of(text)).alias("hash"),
                                             text_of(text).alias("whole"))
    measured = texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, hash long, x array<double>")
    return measured.join(usable_labels(labels, label, id), "id").groupBy("id", "label").agg(
        F.min(F.struct("hash", "x")).alias("t")).select(F.xxhash64("id").alias("place"), "label", "t.x")


def _in_blocks(rows: DataFrame, good: int, poor: int) -> DataFrame:
    """One row per block: its texts in order of their places. Where the rarer label is too rare, its texts are in several blocks."""
    blocks, rare = -(-(good + poor) // BLOCK_ROWS), min(good, poor)
    copies = F.when(F.col("label") == int(good <= poor), min(blocks, -(-LEAST_RARE * blocks // rare))).otherwise(1)
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return dealt.groupBy(F.pmod(F.pmod("place", F.lit(blocks)) + F.col("copy"), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", "label", "x"))).alias("texts"))


def preferences(good: np.ndarray, poor: np.ndarray) -> np.ndarray:
    """Differences better - worse: PAIRS_EACH for each of the rarer kind, and one at least for each of the other."""
    most, least = max(len(good), len(poor)), min(len(good), len(poor))
    if not least:
        return np.empty((0, N_MEASURES))
    rounds = min(least, max(1, -(-PAIRS_EACH * least // most)))
    at = np.tile(np.arange(most), rounds)
    other = (at + np.repeat(np.arange(rounds), most)) % least
    return good[at] - poor[other] if len(good) == most else good[other] - poor[at]


def _step(blocks: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the preferences' log loss, summed over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_MEASURES * (N_MEASURES + 1), np.int64)
        for batch in batches:
            for texts in batch.column(0):
                of = texts.values
                y = of.field("label").to_numpy(zero_copy_only=False)
                x = np.array(of.field("x").to_pylist()).reshape(-1, N_MEASURES)
                d = preferences(x[y == 1], x[y == 0])
                p = sigmoid(d @ weights)
                sums = np.concatenate([d.T @ (p - 1), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
                total += np.rint(sums / UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["k", "v"])

    rows = blocks.select("texts").mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(N_MEASURES * (N_MEASURES + 1))
    for r in rows:
        out[r.k] = r.v * UNIT
    return out[:N_MEASURES], out[N_MEASURES:].reshape(N_MEASURES, N_MEASURES)


def fit(rows: DataFrame) -> tuple[np.ndarray, float] | None:
    """Weights and threshold from all rows (place, label, x); the driver gets sums and counts only."""
    rows = written(rows, "measured")
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, poor = n.get(1, 0), n.get(0, 0)
    if not good or not poor:
        return None
    blocks = written(_in_blocks(rows, good, poor), "blocks")
    # P(better beats worse) = logistic(w . (better - worse)).
    weights = newton(lambda w: _step(blocks, w), N_MEASURES, ridge=0.1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(0).to_pylist()).reshape(-1, N_MEASURES)
            yield pa.RecordBatch.from_arrays([pa.array(x @ weights)], ["s"])

    scores = written(rows.select("x").mapInArrow(scored, "s double"), "scores")
    around = [order_statistic(scores, "s", k) for k in (max(poor - 1, 0), min(poor, good + poor - 1))]
    drop_written(rows, blocks, scores)
    return weights, sum(around) / 2


def score_quality(df: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text",
                  train_on: DataFrame | None = None) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Labels are learned outside the held-out fold only, from all labelled texts of ``train_on`` or ``df``.
    """
    model = fit(training(train_on if train_on is not None else df, labels, label, id, text))
    whole, score = fresh(df, "whole", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(whole)).to_pylist()
            out = np.full(len(texts), 0.5)
            if model and texts:
                out = sigmoid(np.array([measures(t) for t in texts]) @ model[0] - model[1])
            kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != whole]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out)], [n for n in batch.schema.names if n != whole] + [score])

    columns = [F.col(f"`{c}`") for c in df.columns]
    scored = df.select(*columns, text_of(text).alias(whole)).mapInArrow(run, df.select(*columns).schema.add(score, "double"))
    return with_results(scored, score=F.col(score), predicted=(F.col(score) >= 0.5).cast("int")).drop(
        *([score] if score != "score" else []))
