import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, ODD, docs, prose
from tillflow.llm import minhash
from tillflow.llm.components import components


def plain(ids, texts, size, percent=80):
    """Sets and smallest ids by comparing every set with every other."""
    sets = []
    for text in texts:
        words = (text or "").encode().lower().split()
        width = min(size, len(words))
        sets.append(frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if words else frozenset())
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, key in enumerate(ids):
        least[find(i)] = min(least.get(find(i), key), key)
    return [(key, len(s), least[find(i)]) for i, (key, s) in enumerate(zip(ids, sets, strict=True))]


def edited(text, share, seed):
    draw = random.Random(seed)
    return " ".join(f"z{draw.randrange(10**6)}" if draw.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def texts():
    base, other = prose(1, 150), prose(2, 60)
    return [*ODD, "one", "One two", "one TWO", base, base, base.upper(), *[edited(base, 0.03 + 0.001 * i, i) for i in range(90)],
            *[edited(other, 0.04, i) for i in range(12)], *[prose(100 + i, 80) for i in range(30)],
            *[f"{other} {prose(500 + i, 40)}" for i in range(20)], prose(9, 9000), prose(9, 9000) + " more"]


@pytest.mark.parametrize("size, short", [(2, 32), (2, 4), (5, 32)])
def test_equals_all_pairs(spark, texts, size, short, monkeypatch):
    monkeypatch.setattr(minhash, "SHORT_LIST", short)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 10 if short == 4 else 500_000)
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    rows = minhash.near_duplicates(docs(spark, texts, ids), shingle=size).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(plain(ids, texts, size))
    assert all(r.kept == (r.doc_id == r.component_id) and r.lang == "en" for r in rows)


def test_missing_and_repeated_ids(spark):
    frame = docs(spark, ["a b c", "a b c", "a b c", "x y", "x y", None, None], [None, 3, 3, None, None, None, 8])
    rows = minhash.near_duplicates(frame, shingle=2).collect()
    assert sum(r.kept for r in rows) == 4
    assert {r.component_id for r in rows if r.text == "a b c"} == {3}
    assert {r.component_id for r in rows if r.text == "x y"} == {None}


def test_empty_and_clashing_names(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    frame = docs(spark, ["a b", "a b"]).withColumnRenamed("lang", "node").withColumnRenamed("start", "kept")
    rows = minhash.near_duplicates(frame, shingle=2).collect()
    assert {r.node for r in rows} == {"en"} and sum(r.kept for r in rows) == 1


def test_components_of_a_path_a_star_and_repeats(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    random.Random(1).shuffle(path)
    star = [(1000, 1000 + i) for i in range(1, 300)] + [(1000, 1001), (1001, 1000), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(300))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_step_emits_all_pairs_of_a_group(spark):
    base = prose(4, 150)
    texts = [edited(base, 0.05, i) for i in range(400)]
    want = len({c for *_, c in plain(range(400), texts, 2)})
    links, made = minhash._links, []

    def counted(pairs, *rest):
        made.append(pairs.count())
        return links(pairs, *rest)

    minhash._links = counted
    try:
        found = minhash.near_duplicates(docs(spark, texts), shingle=2)
        assert found.agg(F.count_distinct("component_id")).first()[0] == want
    finally:
        minhash._links = links
    assert max(made) < 400 * 60
