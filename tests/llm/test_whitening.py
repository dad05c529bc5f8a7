import numpy as np
import pytest
from helpers import clashing, empty

from conftest import SF001
from ledgerloom.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def slow(vectors, k=16):
    """(n, vec_id -> deviation, values, vectors, trace) from the definitions, with exact integers."""
    grid = {i: tuple(int(np.floor(np.float64(c) * 64)) + 1_000_000 for c in v) for i, v in vectors.items()}
    fit = sorted(set(grid.values()))
    n, sums = len(fit), [sum(col) for col in zip(*fit)]
    off = {x: [n * c - s for c, s in zip(x, sums)] for x in fit}
    centred = np.array([off[x] for x in fit], float) / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    deviation = {i: sum(c * c for c in off[x]) for i, x in grid.items()}
    return n, deviation, values[::-1][:k], vecs[:, ::-1][:, :k], np.trace(cov), {i: np.array(off[x], float) / n for i, x in grid.items()}


def held(found, vectors, k=16):
    n, deviation, values, vecs, trace, centred = slow(vectors, k)
    rows = {(r.vec_id, r.component): r for r in found.collect()}
    assert set(rows) == {(i, c + 1) for i in vectors for c in range(len(values))}
    for c in range(len(values)):
        got = np.array([rows[i, c + 1].whitened for i in vectors])
        want = np.array([centred[i] @ vecs[:, c] for i in vectors]) / np.sqrt(values[c])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8  # either sign, one for all rows
    for (i, c), r in rows.items():
        assert r.n == n and r.deviation == deviation[i]
        assert abs(r.explained - values[c - 1] / trace) < 1e-12 and r.identity_error < 1e-10


def test_embeddings_against_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in rows.collect()}
    held(whitening.whiten(rows), vectors)


def test_repeats_are_fitted_once_and_bad_vectors_left_out(spark):
    rng = np.random.default_rng(3)
    vectors = {i: [float(c) for c in rng.standard_normal(5).astype(np.float32)] for i in range(40)}
    vectors |= {100 + i: vectors[7] for i in range(60)}
    bad = [(200, None, 0), (201, [1.0, None, 0.0, 0.0, 0.0], 0), (202, [float("nan")] * 5, 0), (203, [float("-inf")] * 5, 0)]
    rows = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()] + bad, VECTORS)
    held(whitening.whiten(clashing(rows)), vectors, 5)


def test_defined_results_of_edge_cases(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)], VECTORS)
    assert whitening.whiten(rows).isEmpty()  # no spread
    assert whitening.whiten(empty(rows)).isEmpty()
    assert whitening.whiten(spark.createDataFrame([(1, [], 0)], VECTORS)).isEmpty()
    flat = spark.createDataFrame([(None, [1.0, 5.0], 0), (2, [2.0, 5.0], 0), (2, [2.0, 5.0], 0)], VECTORS)
    got = sorted((r.vec_id is None, r.component, round(abs(r.whitened), 12), round(r.explained, 12)) for r in whitening.whiten(flat).collect())
    assert got == [(False, 1, 1.0, 1.0)] * 2 + [(True, 1, 1.0, 1.0)]  # the entry without spread is no component
    with pytest.raises(ValueError, match="unequal length"):
        whitening.whiten(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0)], VECTORS))


@pytest.mark.parametrize("spectrum", [0.999, 0.9, 0.5, 0.0])
def test_jacobi_davidson_reaches_double_precision(spectrum):
    """Slow, fast and no decay (then with null space), more dimensions than the subspace may have."""
    rng, d = np.random.default_rng(1), 120
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    values = spectrum ** np.arange(d) if spectrum else np.r_[np.ones(3), np.zeros(d - 3)]
    matrix = (q * values) @ q.T
    passes = []

    def product(block):
        passes.append(block.shape[1])
        return matrix @ block

    got, vecs = whitening.jacobi_davidson(product, d, 16)
    assert np.abs(got - values[:16]).max() < 1e-13
    assert np.linalg.norm(matrix @ vecs - vecs * got, axis=0).max() <= 4 * d * np.finfo(float).eps * 1.01
    assert np.abs(vecs.T @ vecs - np.eye(16)).max() < 1e-13
    assert max(passes) <= 26 and len(passes) < 200


def test_minres_solves_the_projected_equation():
    rng, d = np.random.default_rng(2), 30
    m = rng.standard_normal((d, d))
    m, shift = m @ m.T, np.array([3.0, 20.0])
    u = np.linalg.qr(rng.standard_normal((d, 2)))[0]
    project = lambda b: b - u * (u * b).sum(axis=0)
    rhs = project(rng.standard_normal((d, 2)))
    t = whitening.minres(lambda b: m @ b, shift, project, rhs, 200)
    assert np.abs(project(m @ t - t * shift) - rhs).max() < 1e-8
