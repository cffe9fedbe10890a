import re

import pytest

from tests.llm.helpers import DOCS, ODD, docs, prose
from tillflow.llm.decontaminate import mark_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def plain(texts, items, window=10):
    """Every window of every item looked up at every place."""
    held = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            held.setdefault(tuple(words[i:i + window]), set()).add(item)
    out = []
    for text in texts:
        words, hit, found = WORD.findall((text or "").translate(LOW)), set(), set()
        for size in {len(w) for w in held}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in held:
                    hit |= set(range(i, i + size))
                    found |= held[tuple(words[i:i + size])]
        out.append((len(words), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


@pytest.fixture
def benchmark_rows():
    long = prose(1, 40, 300)
    return [(1, long), (2, long[:120]), (10, "Solo"), (11, "two Words"), (12, "now three words"), (13, ""), (14, None),
            (3, prose(2, 10, 300)), (3, prose(3, 12, 300)), (None, prose(4, 15, 300)), (20, "ÉCOLE École ünï " * 4),
            (21, "the " * 10)]


@pytest.mark.parametrize("small", [True, False])
def test_equals_a_plain_search(spark, benchmark_rows, small):
    long = benchmark_rows[0][1].split()
    texts = [*ODD, prose(9, 200, 300), " ".join(long), " ".join(long[5:14]), " ".join(long[5:15]),
             f"{prose(5, 30, 300)} {' '.join(long[20:32]).upper()}, {prose(6, 20, 300)}", "x solo y", "two words two-words",
             "now three words now three", f"{benchmark_rows[7][1]} {benchmark_rows[9][1]}", "École ünï ÉCOLE " * 5,
             "the " * 400, prose(7, 5000, 300) + " " + " ".join(long[-10:])]
    frame = docs(spark, texts)
    bench = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    limits = {} if small else {"broadcast_shingles": 0, "broadcast_windows": 0}
    rows = mark_contamination(frame.unionAll(frame), bench, **limits).collect()
    want = plain(texts, benchmark_rows)
    assert len(rows) == 2 * len(texts)
    for r in rows:
        assert (r.n_words, r.n_hit, list(r.item_ids)) == want[r.doc_id], texts[r.doc_id]
        assert r.contaminated == (r.n_hit > 0) and r.n_items == len(r.item_ids)


def test_empty_sides_and_clashing_names(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    frame = docs(spark, ["one two", None]).withColumnRenamed("lang", "n_hit").withColumnRenamed("start", "row")
    rows = mark_contamination(frame, bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.row) for r in rows] == [(2, 0, 0), (0, 0, 1)]
    full = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert mark_contamination(spark.createDataFrame([], DOCS), full).count() == 0
    assert mark_contamination(frame, full).where("contaminated").count() == 1
