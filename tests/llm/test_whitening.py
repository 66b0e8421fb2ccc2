"""Whitened components against numpy's dense eigenvectors."""

import numpy as np
import pytest

from constella.llm import whitening
from constella.llm.common import importable

VECTORS = "vec_id bigint, embedding array<float>, label int, n string, component double, key string, v string"


def frame(spark, rows):
    importable(spark)
    return spark.createDataFrame([(i, v, 0, "x", 0.5, "k", "v") for i, v in rows], VECTORS)


def compare(spark, vectors, components, gap=1e-4):
    """Projections agree up to sign wherever an eigenvalue stands apart from its neighbours."""
    got = whitening.whiten(frame(spark, list(enumerate(v.tolist() for v in vectors))), components).collect()
    x = np.floor(64 * vectors.astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    assert len(got) == n * k
    z = np.zeros((n, k))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[r.vec_id], s))
        assert abs(r.explained / (e[r.component - 1] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    want = y @ q[:, :k] / np.sqrt(e[:k])
    for j in range(k):
        apart = min([abs(e[j] - e[i]) for i in (j - 1, j + 1) if 0 <= i < len(e)], default=1) / e[0]
        if apart > gap:
            sign = np.sign(z[:, j] @ want[:, j])
            assert np.abs(z[:, j] * sign - want[:, j]).max() < 1e-7
    return got


@pytest.mark.parametrize("seed,spectrum", [(0, lambda i: 1 / (1 + i)), (1, lambda i: 1.0), (2, lambda i: 0.8 ** i)])
def test_components_match_the_dense_ones(spark, seed, spectrum):
    rng = np.random.default_rng(seed)
    vectors = rng.standard_normal((200, 24)) * np.array([spectrum(i) for i in range(24)]) + 3
    got = compare(spark, vectors, 6)
    assert max(r.residual for r in got) < 1e-11


def test_filter_turns_the_block_to_the_wanted_space():
    rng = np.random.default_rng(4)
    base, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    e = np.sort(rng.uniform(0, 1, 60))[::-1]
    v = base * e @ base.T
    calls = []
    product = lambda q: calls.append(q.shape[1]) or v @ q
    found, q, residual = whitening.leading(product, 60, 8)
    assert np.abs(found - e[:8]).max() < 1e-12 and residual.max() < 1e-12 and len(calls) < 200
    assert np.abs(np.abs(np.sum(q * base[:, :8], axis=0)) - 1).max() < 1e-9
    low = whitening.lower_bound(product, 60, rng)
    assert low <= e[-1]


@pytest.mark.parametrize("values", [np.ones(30), np.r_[np.ones(20), np.zeros(10)], np.r_[3, np.full(29, 1 - 1e-9)],
                                    1 - 1e-7 * np.arange(30)])
def test_ties_at_the_edge_of_the_block_end(values):
    rng = np.random.default_rng(5)
    base, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    v = base * values @ base.T
    found, q, residual = whitening.leading(lambda q: v @ q, 30, 5)
    assert np.abs(found - np.sort(values)[::-1][:5]).max() < 1e-10 and residual.max() < 1e-10
    assert np.abs(q.T @ q - np.eye(5)).max() < 1e-12


def test_unusable_vectors_and_fewer_dimensions(spark):
    good = [[1.0, 2.0, 0.5], [-1.0, 0.25, 4.0], [3.0, 3.0, 3.0], [0.0, -2.0, 1.0], [0.0, -2.0, 1.0]]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = [(1, good[0]), (2, good[1]), (None, good[2]), (3, good[3]), (3, good[4])] + [(9, b) for b in bad]
    got = whitening.whiten(frame(spark, rows), 32).collect()
    assert len(got) == 15 and {r.vec_id for r in got} == {1, 2, 3, None} and {r.component for r in got} == {1, 2, 3}
    assert all(r.n == 5 and r.identity_error < 1e-9 for r in got)
    compare(spark, np.array(good), 32)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(i, [0.5, 0.25]) for i in range(4)]])
def test_tables_without_variance_give_no_rows(spark, rows):
    assert whitening.whiten(frame(spark, rows)).collect() == []
    # one dimension that varies
    flat = whitening.whiten(frame(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert {r.component for r in flat} == {1}


def test_large_sums_stay_exact(spark):
    rows = [(i, [float(2**37) * (i % 3), float(i)]) for i in range(300)]
    got = whitening.whiten(frame(spark, rows)).collect()
    x = [(64 * 2**37 * (i % 3) + 1_000_000, 64 * i + 1_000_000) for i in range(300)]
    s = [sum(c) for c in zip(*x)]
    assert {(r.vec_id, int(r.deviation)) for r in got} == {
        (i, sum((300 * a - b) ** 2 for a, b in zip(v, s))) for i, v in enumerate(x)}
