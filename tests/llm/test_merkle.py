import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm import merkle, queries

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()), T.StructField("tree", T.StringType()),
    T.StructField("at", T.IntegerType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    return [(level[(at >> k) ^ 1], at >> k & 1) for k, level in enumerate(tree[:-1]) if (at >> k) ^ 1 < len(level)], len(tree) - 1


def expected(rows):
    """(leaf, subroot, root, proof, folded, verified) per row, from whole trees in memory."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for number, g in enumerate(order):
        for at, r in enumerate(sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            shown = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                shown[3] += 1
            proof, node = [], leaf(shown)
            for tree, place in ((trees[g], at), (top, number)):
                for k, level in enumerate(tree[:-1]):
                    other = (place >> k) ^ 1
                    if other < len(level):
                        proof.append(level[other])
                        node = h(level[other], node) if place >> k & 1 else h(node, level[other])
                    else:
                        node = h(node)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h(*proof), node, node == top[-1][0]))
    return out


def table(n, seed, langs=("en", "de", None, "", "é", "z")):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = draw.choice([None, "", f"text {i}", "é\U0001F600" * draw.randrange(9)])
        lang = "en" if i % 3 == 0 else draw.choice(langs)
        id = None if i % 50 == 7 else 5 if i % 10 == 3 else i
        rows.append((id, draw.choice([None, "a", "b"]), lang, None if i % 11 == 0 else i, text, "t", i))
    return rows + rows[:20]


def keyed(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("n, step", [(0, 2), (1, 2), (2, 12), (333, 2), (500, 3), (700, 12)])
def test_equals_whole_trees_in_memory(spark, n, step, monkeypatch):
    rows = table(n, n)[: max(n, 0) + 20] if n > 2 else table(n, 1)[:n]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    changed = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)),
                     F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    presented = merkle.leaf_hash(*[changed if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    monkeypatch.setattr(merkle.manifest, "__defaults__", (*merkle.manifest.__defaults__[:-1], step))
    monkeypatch.setattr(merkle.prove, "__defaults__", (None, step))
    found = merkle.proofs(frame, presented=presented).drop("path").collect()
    assert keyed(found) == keyed(expected(rows))


def test_proofs_of_some_rows_fetch_what_they_lack(spark):
    rows = [(i, "s", f"l{i % 2}", i, f"t{i}", "t", i) for i in range(101)]
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), step=3)
    wanted = made.leaves.where("id IN (0, 2, 3, 50, 99, 100)")
    found = merkle.prove(made, wanted, step=3).withColumn("up", merkle.folded(F.lower(F.hex("digest")), F.col("path"))).collect()
    assert sorted(r.id for r in found) == [0, 2, 3, 50, 99, 100]
    assert {r.up for r in found} == {expected(rows)[0][3]} and all(r.root.hex() == r.up for r in found)


def test_missing_nodes_are_the_smallest_set():
    for size in (1, 2, 5, 16, 37):
        for seed in range(30):
            draw = random.Random(seed)
            places = sorted(draw.sample(range(size), draw.randint(1, size)))
            got = {(level, int(i)) for level, found in merkle.missing_nodes(np.array(places), size) for i in found}
            needed, derived, level, n = set(), {(0, i) for i in places}, 0, size
            while n > 1:
                here = {i for k, i in derived if k == level}
                needed |= {(level, i ^ 1) for i in here if i ^ 1 < n and i ^ 1 not in here}
                derived |= {(level + 1, i >> 1) for i in here}
                level, n = level + 1, (n + 1) // 2
            assert got == needed


def test_query_equals_whole_trees(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*merkle.FIELDS).collect()
    assert keyed(queries.op13_merkle(spark, "/root/testdata/sf0.001").collect()) == keyed(expected(docs))
