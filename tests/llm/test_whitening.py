import numpy as np
import pytest
from pyspark.sql import types as T

from tillflow.llm import queries, whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("deviation", T.StringType()), T.StructField("x", T.StringType())])


def frame(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, "d", "x") for i, v in zip(ids or range(len(vectors)), vectors, strict=True)], SCHEMA)


def numbers(vectors):
    return np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors])


def check(found, vectors, components=8):
    """Against numpy's own eigenvectors, up to sign."""
    x = numbers(vectors)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s) / n
    v = centred.T @ centred / n
    values, axes = (a[..., ::-1] for a in np.linalg.eigh(v))
    k = len(found[0].white)
    assert all(r.n == n and len(r.white) == k for r in found)
    white = np.array([r.white for r in sorted(found, key=lambda r: r.id)])
    deviation = [sum(int(d) ** 2 for d in row) for row in n * x - s]
    assert [r.deviation for r in sorted(found, key=lambda r: r.id)] == deviation
    np.testing.assert_allclose(found[0].shares, values[:k] / np.trace(v), rtol=1e-9)
    assert found[0].identity_error < 1e-6
    expected = centred @ axes[:, :k] / np.sqrt(values[:k])
    for i in range(k):
        if min(abs(values[i] - values[j]) for j in range(len(values)) if j != i) > 1e-9 * values[0]:
            sign = np.sign(expected[:, i] @ white[:, i])
            np.testing.assert_allclose(white[:, i], sign * expected[:, i], atol=1e-6)
    return k


def test_equals_numpy(spark):
    draw = np.random.default_rng(1)
    vectors = (draw.standard_normal((400, 20)) * np.linspace(1, 0.05, 20)).astype(np.float32).tolist()
    found = whitening.whiten(frame(spark, vectors).repartition(5)).collect()
    assert check(found, vectors) == 8


def test_bad_vectors_are_dropped_and_repeated_ones_count(spark):
    draw = np.random.default_rng(2)
    good = draw.standard_normal((60, 5)).astype(np.float32).tolist() + [[0.5] * 5] * 40
    bad = [None, [], [1.0] * 4, [None] + [1.0] * 4, [float("nan")] * 5, [float("inf")] + [0.0] * 4, [3e30] * 5]
    found = whitening.whiten(frame(spark, good + bad)).collect()
    assert len(found) == 100 and check(found, good) == 5


def test_ranks_below_the_wanted_number(spark):
    draw = np.random.default_rng(3)
    basis = draw.integers(-3, 4, (2, 12))
    vectors = (draw.integers(-4, 5, (200, 2)) @ basis / 4).tolist()
    assert len(whitening.whiten(frame(spark, vectors)).first().white) == 2
    for few in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None], [[]]):
        assert whitening.whiten(frame(spark, few)).collect() == []


def test_equal_eigenvalues_are_one_space(spark):
    # A cross: the covariance is a multiple of the identity.
    vectors = [[s * (i == j) / 4 for j in range(4)] for i in range(4) for s in (1.0, -1.0)] * 3
    found = whitening.whiten(frame(spark, vectors, list(range(24)))).collect()
    assert check(found, vectors) == 4


def test_missing_and_repeated_ids(spark):
    found = whitening.whiten(frame(spark, [[1.0, 0.0], [0.0, 1.0], [0.5, 0.7]], [None, 4, 4])).collect()
    assert sorted(str(r.id) for r in found) == ["4", "4", "None"]


@pytest.mark.parametrize("seed", range(6))
def test_counts_are_those_of_the_eigenvalues(seed):
    draw = np.random.default_rng(seed)
    a = draw.standard_normal((9, 9))
    a = a + a.T if seed % 2 else np.round(a + a.T)
    if seed == 4:
        a = np.zeros((9, 9)) + np.fliplr(np.eye(9))
    values = np.linalg.eigvalsh(a)
    for shift in (*draw.uniform(-6, 6, 20), -0.3, 0.001):
        assert whitening.count_below(a, shift) == (values < shift).sum()


@pytest.mark.parametrize("spectrum", [
    [9, 4, 1, 0.5], [1, 1 - 1e-9, 1 - 2e-9, 0.1], [5, 5, 5, 2, 2, 1e-9], [1, 1e-5, 1e-9, 0], [3] * 10, [2, 1e-18]])
def test_pairs_of_close_and_equal_eigenvalues(spectrum):
    d = len(spectrum)
    q = np.linalg.qr(np.random.default_rng(9).standard_normal((d, d)))[0]
    matrix = q @ np.diag(spectrum) @ q.T * 1e6
    matrix = (matrix + matrix.T) / 2
    values, vectors = whitening.leading_pairs(matrix, 8)
    want = np.sort(np.array(spectrum) * 1e6)[::-1]
    want = want[:8][want[:8] > 1e-14 * want[0] * d * 4]
    np.testing.assert_allclose(values, want[:len(values)], rtol=1e-6, atol=1e-8)
    assert len(values) == len(want)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-6
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-7


def test_query_equals_numpy(spark):
    rows = queries.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    kept = {r.vec_id: r.embedding for r in table if r.embedding and all(c is not None and np.isfinite(c) for c in r.embedding)}
    assert len(rows) == 8 * len(kept) and {r.component for r in rows} == set(range(1, 9))
    x = numbers([kept[i] for i in sorted(kept)])
    centred = x - x.mean(axis=0)
    values, axes = (a[..., ::-1] for a in np.linalg.eigh(centred.T @ centred / len(x)))
    for c in range(8):
        got = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id) if r.component == c + 1])
        want = centred @ axes[:, c] / np.sqrt(values[c])
        np.testing.assert_allclose(got * np.sign(got @ want), want, atol=1e-7)
    assert rows[0].identity_error < 1e-9 and abs(sum({r.component: r.explained for r in rows}.values()) - values[:8].sum() / values.sum()) < 1e-9
