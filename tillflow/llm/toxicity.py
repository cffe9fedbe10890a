"""Toxicity by a weighted lexicon that one Aho-Corasick pass matches on folded text.

Folding lowers case, maps look-alike letters to Latin ones and digits or signs beside letters to the letters they
stand for; 1, i and l are one letter. The lexicon holds words and beginnings of words with their log odds in labelled texts. The weights of
the matched words, those inside an exception phrase left out, are summed and divided by the length of the text; a
logistic fit turns that into a score.

Defined cases: NULL and empty texts match nothing and get the score of a text without matches; without labels of
both kinds every score is 0; each word counts with its heaviest entry only; equal texts have equal scores;
missing ids count as held out; input columns named like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, text_of, with_results
from tillflow.llm.learning import SAMPLE_ROWS, logistic_fit, sample, sigmoid

# Letters that look like Latin ones, and signs that stand for letters inside words.
HOMOGLYPHS = str.maketrans("аеорсухікмнтвԁӏοαειν", "aeopcyxikmhtbdioaeiv")
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
# Runs of them before, between and after letters. Exclamation marks end words and, three or more, part them; one digit
# after a single letter is a label, as in "a1".
_INSIDE = re.compile(r"(?<![^\W_])[013457@$]+(?=[^\W\d_])|(?<=[^\W\d_])(?!!{3,}[^\W\d_])[013457@$!]+(?=[^\W\d_])"
                     r"|(?<=[^\W\d_])(?!(?<![^\W_].)[0-9](?![^\W_]|[@$]))[013457@$]+(?![^\W_]|[@$])", re.DOTALL)
_SPACES = str.maketrans({"l": "i", **{c: " " for c in map(chr, range(128)) if not c.isalnum()}})
# Phrases whose lexicon words are meant otherwise; an argument of the operator.
EXCEPTIONS = ("trash can", "trash bin", "garbage collection", "stupid question", "class clown", "sore loser award")

# The lexicon: word beginnings of these lengths, at least so heavy, found in at least so many toxic texts, and at
# most so many entries, the heaviest.
PREFIXES = range(5, 9)
LEAST_WEIGHT = 2.5
LEAST_TEXTS = 3
MOST_ENTRIES = 20_000
# Words added to every length, so that one match in a very short text does not decide alone.
LENGTH_OFFSET = 20


def fold(text: str) -> str:
    """Lower case, look-alikes and substitutes resolved, l as i, everything but letters and digits a space."""
    low = text.lower()
    if not low.isascii():
        low = low.translate(HOMOGLYPHS)
    low = _INSIDE.sub(lambda m: m[0].translate(SUBSTITUTES), low)
    return f" {low.translate(_SPACES)} "


def entries(folded: str) -> set[str]:
    """The lexicon entries a text could have: ``' word '`` and ``' begin'``."""
    words = set(folded.split())
    out = {f" {w} " for w in words if len(w) > 2}
    out.update(f" {w[:k]}" for w in words for k in PREFIXES if len(w) >= k)
    return out


def lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries with their smoothed log odds."""
    found = ((math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1)), t) for t, a, b in counts
             if a >= LEAST_TEXTS)
    heavy = sorted((pair for pair in found if pair[0] >= LEAST_WEIGHT), key=lambda p: (-p[0], p[1]))
    return {t: w for w, t in heavy[:MOST_ENTRIES]}


class Matcher:
    """Sums the weights of a text's lexicon words in one pass."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...]):
        self.automaton = ahocorasick.Automaton()
        for phrase in exceptions:
            self.automaton.add_word(fold(phrase), (len(fold(phrase)), None))
        for entry, weight in weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.automaton.make_automaton()

    def measures(self, text: str) -> list[float]:
        """1, root of the weight per word, logarithm of the number of matched words."""
        folded = fold(text)
        best: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        if len(self.automaton):
            for last, (length, weight) in self.automaton.iter(folded):
                start = last - length + 1
                if weight is None:
                    excused.append((start, last))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        if excused and best:
            covered = {i for a, b in excused for i in range(a, b)}
            best = {s: w for s, w in best.items() if s not in covered}
        return [1.0, math.sqrt(sum(best.values()) / (len(folded.split()) + LENGTH_OFFSET)), math.log1p(len(best))]


def _counts(texts: DataFrame) -> tuple[list, list]:
    """(entry, half, toxic texts, clean texts) of entries that enough toxic texts have, and (half, label, texts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], Counter] = {}
        for batch in batches:
            for whole, label, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen.setdefault((half, label), Counter()).update(entries(fold(whole)))
        for (half, label), counter in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(counter.keys(), pa.string()), pa.array([half] * len(counter), pa.int32()),
                 pa.array([n * label for n in counter.values()], pa.int64()),
                 pa.array([n * (1 - label) for n in counter.values()], pa.int64())], ["entry", "half", "toxic", "clean"])

    each = texts.select("whole", "label", F.col("half").cast("int")).mapInArrow(
        run, "entry string, half int, toxic long, clean long")
    by = each.groupBy("entry").agg(*[F.sum(F.when(F.col("half") == h, F.col(k)).otherwise(0)).alias(f"{k}{h}")
                                     for k in ("toxic", "clean") for h in (0, 1)])
    heavy = by.where(F.col("toxic0") + F.col("toxic1") >= LEAST_TEXTS).orderBy(
        F.desc((F.col("toxic0") + F.col("toxic1") + 0.5) / (F.col("clean0") + F.col("clean1") + 0.5)), "entry").limit(
        MOST_ENTRIES)
    return heavy.collect(), texts.groupBy("half", "label").count().collect()


def fit(texts: DataFrame, exceptions: tuple[str, ...]) -> tuple[dict[str, float], np.ndarray] | None:
    """Lexicon and weights of its measures. Each half of the sample is measured with the other half's lexicon."""
    found, sizes = _counts(texts)
    n = {(r.half, r.label): r["count"] for r in sizes}
    total = {label: n.get((0, label), 0) + n.get((1, label), 0) for label in (0, 1)}
    if not total[0] or not total[1]:
        return None
    halves = [Matcher(lexicon([(r.entry, r[f"toxic{h}"], r[f"clean{h}"]) for r in found], n.get((h, 1), 0), n.get((h, 0), 0)),
                      exceptions) for h in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [halves[1 - h].measures(t) for t, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    rows = sorted(texts.select("whole", "label", "half").mapInArrow(run, "label int, x array<double>").collect())
    weights = logistic_fit(np.array([r.x for r in rows]), np.array([r.label for r in rows]), ridge=0.01)
    whole = lexicon([(r.entry, r.toxic0 + r.toxic1, r.clean0 + r.clean1) for r in found], total[1], total[0])
    return whole, weights


def score_toxicity(df: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text",
                   exceptions: tuple[str, ...] = EXCEPTIONS, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.7 on), learned outside the held-out fold from at
    most ``rows`` labelled texts."""
    model = fit(sample(df, labels, label, id, text, rows), exceptions)
    whole, score = fresh(df, "whole", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model[0], exceptions) if model else None
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(whole)).to_pylist()
            out = np.zeros(len(texts))
            if matcher and texts:
                out = sigmoid(np.array([matcher.measures(t) for t in texts]) @ model[1])
            kept = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != whole]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out)], [n for n in batch.schema.names if n != whole] + [score])

    columns = [F.col(f"`{c}`") for c in df.columns]
    scored = df.select(*columns, text_of(text).alias(whole)).mapInArrow(run, df.select(*columns).schema.add(score, "double"))
    return with_results(scored, score=F.col(score), predicted=(F.col(score) >= 0.7).cast("int")).drop(
        *([score] if score != "score" else []))
