import zlib

from tests.llm.helpers import DOCS, ODD, docs
from tillflow.llm.sharding import assign_shards


def jump(key, shards):
    """The published loop, for comparison."""
    at, there, key = -1, 0, key % 2**64
    while there < shards:
        at = there
        key = (key * 2862933555777941757 + 1) % 2**64
        there = int((at + 1) * (2.0**31 / ((key >> 33) + 1)))
    return at


def test_equals_the_published_loop_and_only_moves_into_the_new_shard(spark):
    ids = [*range(3000), -1, -2**63, 2**63 - 1, 10**15]
    rows = assign_shards(docs(spark, [f"t{i}" for i in ids], ids), 24).collect()
    assert all(r.shard == jump(r.doc_id, 24) and r.grown_shard == jump(r.doc_id, 25) for r in rows)
    assert all(r.grown_shard in (r.shard, 24) for r in rows)
    assert 0 < sum(r.grown_shard == 24 for r in rows) < len(rows) / 10


def test_slots_have_no_gaps_and_sizes_are_bytes(spark):
    texts = [*ODD, *["copy"] * 500, *[f"é{i}" for i in range(300)]]
    ids = [None if i % 9 == 0 else 7 if i % 9 == 1 else i for i in range(len(texts))]
    frame = docs(spark, texts, ids)
    rows = assign_shards(frame.unionAll(frame), 5).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 8 and r.text_crc32 == zlib.crc32(data)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == 2 * len(texts)
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert len({r.shard for r in rows if r.doc_id is None and (r.text or "").startswith("é")}) > 1


def test_one_shard_text_keys_names_and_empty(spark):
    frame = docs(spark, ["a", "b", "c"]).withColumnRenamed("lang", "slot").withColumnRenamed("start", "block")
    rows = assign_shards(frame, 1).collect()
    assert sorted(r.slot for r in rows) == [0, 1, 2] and {r.shard for r in rows} == {0} and rows[0].block is not None
    assert assign_shards(frame, 4, key="text").count() == 3
    assert assign_shards(spark.createDataFrame([], DOCS), 24).count() == 0
