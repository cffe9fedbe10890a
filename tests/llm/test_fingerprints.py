import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, ODD, docs, prose
from tillflow.llm import syncmers


@pytest.mark.parametrize("block_rows", [2000, 7])
def test_neighbours_and_edits(spark, block_rows):
    texts = [*ODD, *[prose(i, 5 + i * 3) for i in range(40)], "same", "same", prose(50, 20_000)]
    ids = [i * 3 for i in range(len(texts))]
    rows = {r.key: r for r in syncmers.fingerprints_with_next(docs(spark, texts, ids), block_rows=block_rows).collect()}
    assert len(rows) == len(texts)
    whole = [t or "" for t in texts]
    for n, (i, text) in enumerate(zip(ids, whole, strict=True)):
        after, half = whole[(n + 1) % len(whole)], len(text) // 2
        assert rows[i].n_chars == len(text) and rows[i].edited == text[:len(text) - half] + after[:half]
        assert rows[i].next == rows[ids[(n + 1) % len(ids)]].own
    shared = {}
    assert all(shared.setdefault(t, rows[i].own) == rows[i].own for i, t in zip(ids, whole, strict=True))


def test_missing_and_repeated_keys(spark):
    texts = [f"text {i} {prose(i, 30)}" for i in range(60)]
    ids = [None if i % 3 == 0 else 5 if i % 3 == 1 else i for i in range(60)]
    out = syncmers.fingerprints_with_next(docs(spark, texts, ids), block_rows=5)
    rows = out.withColumn("sha", F.sha2("edited", 256)).collect()
    assert len(rows) == 60 and len({r.sha for r in rows}) == 60
    # Every document is the next one of exactly one other.
    assert sorted(map(tuple, (r.own for r in rows))) == sorted(map(tuple, (r.next for r in rows)))
    alone = syncmers.fingerprints_with_next(docs(spark, ["a b c d"], [1])).collect()[0]
    assert alone.own == alone.next and alone.edited == "a b a b"[:4] + "a b"
    assert syncmers.fingerprints_with_next(spark.createDataFrame([], DOCS)).count() == 0


def test_anchors_are_closed_syncmers_and_context_free(spark):
    passage = prose(1, 60)
    frame = docs(spark, [f"{prose(2, 30)} {passage} {prose(3, 11)}", f"{prose(4, 7)} {passage}"])
    a, b = (r.anchors for r in syncmers.with_anchors(frame).orderBy("doc_id").collect())
    inside = [[(x.at - start, x.hash) for x in found if start <= x.at <= start + 60 - syncmers.K]
              for found, start in ((a, 30), (b, 7))]
    assert inside[0] == inside[1] and len(inside[0]) > 15
    inner = spark.range(1).select(F.array(*[F.lit(v) for v in (5, 1, 7, 9, 3, 8, 2, 4)]).alias("i"))
    chosen = [x.at for x in inner.select(syncmers.anchors(F.col("i")).alias("a")).first().a]
    want = [i for i in range(5) if min([5, 1, 7, 9, 3, 8, 2, 4][i:i + 4]) in
            ([5, 1, 7, 9, 3, 8, 2, 4][i], [5, 1, 7, 9, 3, 8, 2, 4][i + 3])]
    assert chosen == want


def test_likeness(spark):
    row = spark.range(1).select(F.expr("array(1, 2, 2, 3)").alias("a"), F.expr("array(3, 4)").alias("b"),
                                F.expr("CAST(array() AS array<int>)").alias("n"))
    got = row.select(*[syncmers.likeness(F.col(x), F.col(y)) for x, y in ("aa", "ab", "nn", "an")]).first()
    assert tuple(got) == (1.0, 2 / 5, 1.0, 0.0)


def test_sha_of_the_contract(spark):
    text = "é\U0001F600x"
    row = syncmers.fingerprints_with_next(docs(spark, [text], [1])).withColumn("s", F.sha2("edited", 256)).first()
    assert row.s == hashlib.sha256((text[:2] + text[:1]).encode()).hexdigest()
