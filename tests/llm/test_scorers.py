import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, ODD, docs, prose
from tillflow.llm import learning, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    texts, labels = [], []
    for i in range(400):
        draw, poor, toxic = random.Random(i), i % 7 == 0, i % 5 == 0
        words = prose(i, 60 + i % 90, 900).split()
        if toxic:
            for w in ("moron", "ID10T", "trаsh", "scumbag")[:2 + i % 3]:  # one with a Cyrillic letter
                words.insert(draw.randrange(len(words)), w)
        text = " ".join(words)
        if poor:
            text = " ".join(f"{w}$$$" for w in words) if i % 2 else " ".join([words[0]] * 80)
        texts.append(text)
        labels.append((i, int(not poor), int(toxic and not (poor and not i % 2))))
    return docs(spark, texts), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("score, label, least", [(quality.score_quality, "quality", 0.95), (toxicity.score_toxicity, "toxic", 0.9)])
def test_held_out_accuracy(corpus, score, label, least):
    frame, labels = corpus
    out = score(frame, labels.select("doc_id", label)).join(labels, "doc_id").where(learning.held_out()).collect()
    assert len(out) > 80 and np.mean([r.predicted == r[label] for r in out]) >= least
    assert all(0 <= r.score <= 1 for r in out)


@pytest.mark.parametrize("score, label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_odd_texts_and_labels(spark, corpus, score, label):
    frame, labels = corpus
    odd = docs(spark, [*ODD, *ODD, "x " * 60_000], [None, *range(9001, 9001 + 2 * len(ODD))]).withColumnRenamed("lang", "score")
    many = labels.unionAll(spark.createDataFrame([(None, 1, 1), (5, None, None), (10, 1, 0), (77777, 0, 1)], LABELS))
    both = frame.withColumnRenamed("lang", "score").unionAll(odd)
    rows = score(both, many.select("doc_id", label)).where("doc_id IS NULL OR doc_id > 9000").collect()
    assert len(rows) == 2 * len(ODD) + 1 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    by_text = {}
    assert all(by_text.setdefault(r.text or "", r.score) == r.score for r in rows)


@pytest.mark.parametrize("score, label, neutral", [(quality.score_quality, "quality", 0.5), (toxicity.score_toxicity, "toxic", 0.0)])
def test_nothing_to_learn_from(spark, score, label, neutral):
    none = spark.createDataFrame([], LABELS).select("doc_id", label)
    assert [r.score for r in score(docs(spark, ["a b"]), none).collect()] == [neutral]
    assert score(spark.createDataFrame([], DOCS), none).count() == 0


def test_held_out_labels_are_never_learned(spark, corpus):
    frame, labels = corpus
    turned = labels.withColumn("quality", F.when(learning.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in quality.score_quality(frame, x.select("doc_id", "quality")).collect()} for x in (labels, turned))
    assert a == b
    ids = [r[0] for r in labels.where(learning.held_out()).select("doc_id").collect()]
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in ids)


def test_sample_is_bounded_and_stable(corpus):
    frame, labels = corpus
    a, b = (sorted(learning.sample(frame.repartition(n), labels, "toxic", rows=50).collect()) for n in (1, 7))
    assert a == b and len(a) == 50


def test_folding_and_exceptions():
    assert toxicity.fold("Tr4sh, ТRASH! 1d10t 2024 a1") == " trash  trash  idiot 2024 a1 "
    assert "idiot" in toxicity.fold("an IDI0T here") and "moron" in toxicity.fold("m0r0n")
    matcher = toxicity.Matcher({" trash ": 5.0, " tras": 4.0}, ("trash can",))
    assert matcher.measures("a trash can")[1] == 0 and matcher.measures("a trash heap")[1] > 0
    assert matcher.measures("trash " * 10)[2] == pytest.approx(np.log1p(10))


def test_an_id_with_many_texts_gives_one_of_them(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], LABELS)
    chosen = learning.sample(docs(spark, [f"text {i}" for i in range(60)]), labels, "toxic").count()
    hot = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)
    texts, ids = [f"text {i}" for i in range(60)] + [f"hot {i}" for i in range(500)], [*range(60), *[hot] * 500]
    a, b = (sorted(learning.sample(docs(spark, texts, ids).repartition(n), labels, "toxic").collect()) for n in (1, 7))
    assert a == b and len(a) == chosen


def test_folding_of_long_runs_word_ends_and_l():
    for text, word in (("a$$", "ass"), ("4$$hole", "asshole"), ("garb4g3", "garbage"), ("1d107", "idiot"), ("idi07", "idiot"),
                       ("1oser", "loser"), ("LO5ER", "loser"), ("1diot!", "idiot"), ("a$$$$h0le", "asssshole")):
        assert toxicity.fold(f"an {text}, here").split() == toxicity.fold(f"an {word} here").split(), text
    assert toxicity.fold("b2 a1 in 2024 x5. stop!!!you idiot!!!").split() == ["b2", "a1", "in", "2024", "x5", "stop", "you", "idiot"]


def test_quality_learns_from_every_labelled_text(spark, corpus, monkeypatch):
    """Nothing is sampled: texts beyond any old cap count, each is in a block and has a preference."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", 64)
    frame, labels = corpus
    trained = quality.training(frame, labels, "quality")
    want = labels.where(~learning.held_out()).count()
    n = {r.label: r.n for r in trained.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(n.values()) == want
    blocks = quality._in_blocks(trained, n[1], n[0]).collect()
    assert len(blocks) == -(-want // 64) and len({t.place for b in blocks for t in b.texts}) == want
    for b in blocks:
        x = {y: np.array([t.x for t in b.texts if t.label == y]) for y in (0, 1)}
        assert len(x[0]) and len(quality.preferences(x[1], x[0])) >= max(len(x[0]), len(x[1]))
    a, b = (quality.fit(trained.repartition(k)) for k in (1, 7))
    assert a[0].tolist() == b[0].tolist() and a[1] == b[1]


def test_order_statistic(spark):
    values = [float(i * i % 97) for i in range(300)] + [1e-12 * i for i in range(50)] + [-5.0] * 40
    frame = spark.createDataFrame([(v,) for v in values], "s double")
    assert [learning.order_statistic(frame, "s", k, bins=8) for k in (0, 39, 45, 200, 389)] == [sorted(values)[k] for k in (0, 39, 45, 200, 389)]
