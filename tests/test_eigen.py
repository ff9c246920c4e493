"""Leading components by passes against whole matrices, packed sums, and imputation with a written state."""

import numpy as np
import pytest

from curatrix.operators import batch as G
from curatrix.operators import corr as C
from curatrix.operators import matrix as X
from curatrix.operators.eigen import leading


def long(spark, m, parts=3):
    rows = [(f"t{i:03d}", f"r{j:03d}", None if np.isnan(m[i, j]) else float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, "target_id string, run string, value double").repartition(parts)


@pytest.mark.parametrize("values", [np.linspace(-3, 9, 150), np.r_[np.zeros(146), 1.0, 5.0, 5.0, 5.0], np.ones(30), np.array([2.0]), np.r_[np.full(100, 1.0) + 1e-3 * np.arange(100), 1.5]])
def test_leading_pairs_of_known_matrices(values):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(n, n)))[0]
    a = (q * values) @ q.T
    passes = []
    for k in (1, 3):
        w, v = leading(lambda x: (passes.append(x.shape[1]), a @ x)[1], n, k)
        want = np.sort(values)[::-1][: min(k, n)]
        assert np.allclose(w, want, atol=1e-8) and np.allclose(a @ v, v * w, atol=1e-7) and np.allclose(v.T @ v, np.eye(len(w)), atol=1e-9)
    start = q[:, np.argsort(-values)[:1]]
    passes.clear()
    leading(lambda x: (passes.append(x.shape[1]), a @ x)[1], n, 1, start)
    assert len(passes) <= 6 or n > 100


def test_leading_of_a_zero_matrix():
    w, v = leading(lambda q: np.zeros_like(q), 7, 2)
    assert np.allclose(w, 0) and v.shape == (7, 2)


def test_packed_sums_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(X, "PIECE", 7)
    monkeypatch.setattr(X, "FAN", 2)
    monkeypatch.setattr(X, "CELLS", 12)
    rng = np.random.default_rng(2)
    m = rng.normal(size=(50, 5))
    matrix = X.RunMatrix(long(spark, m))
    spread = matrix.rows.repartition(9)
    assert np.allclose(matrix.sums(lambda x: x.T @ x, rows=spread), m.T @ m)
    assert matrix.sums(lambda x, ids: np.array([[len(ids), x.sum()]]), with_ids=True) == pytest.approx(np.array([[50, m.sum()]]))
    assert matrix.sums(lambda x: x.T @ x, rows=matrix.rows.where("false")).shape == (0, 0)


def planted(runs=40, n=150, seed=4):
    rng = np.random.default_rng(seed)
    groups = ["ab"[j % 2] for j in range(runs)]
    x = rng.normal(size=(n, runs)) * 0.4 + np.outer(rng.normal(size=n), rng.normal(size=runs)) * 1.5 + np.outer(rng.normal(size=n), rng.normal(size=runs))
    x[: n // 2] += np.array([2.0 * (g == "b") for g in groups])
    return x, groups


def span(v):
    return v @ v.T


def test_counts_and_factors_by_passes_are_those_of_whole_grams(spark, monkeypatch):
    x, groups = planted()
    m, design = X.RunMatrix(long(spark, x)), G.design_matrix(groups)
    counts = X.RunMatrix(long(spark, np.round(np.expm1(np.clip(x + 4, 0, 8)))))
    whole = G.num_sv_be(m, design, 5), G.num_sv_leek(m, design), G.sva_factors(m, design, 2), G.latent_factors(counts, design, 2, rounds=3), G.latent_factors(counts, design, rounds=2)
    assert whole[0] == 2
    monkeypatch.setattr(X, "HELD_BYTES", 2 * 16 * 40 * 40)  # two matrices in a pass
    assert (G.num_sv_be(m, design, 5), G.num_sv_leek(m, design)) == whole[:2]
    for module in (X, G):
        monkeypatch.setattr(module, "GRAM_RUNS", 8)
    assert G.num_sv_be(m, design, 3) == 2
    assert np.abs(span(G.sva_factors(m, design, 2)) - span(whole[2])).max() < 1e-6
    assert np.abs(span(G.latent_factors(counts, design, 2, rounds=3)[0]) - span(whole[3][0])).max() < 1e-6
    some = G.latent_factors(counts, design, rounds=2)
    assert some[0].shape == whole[4][0].shape and np.abs(span(some[0]) - span(whole[4][0])).max() < 1e-6


def test_coordinates_by_passes_keep_distances(spark, monkeypatch):
    x, _ = planted(60, 80)
    matrix = C.correlation_matrix(long(spark, x)).cache()
    far = lambda df: (lambda a: np.linalg.norm(a[:, None] - a[None], axis=2))(np.array([r[1:] for r in df.orderBy("run").collect()]))
    whole = far(X.pca_coordinates(matrix)), far(X.mds_coordinates(matrix))
    r = np.corrcoef(x.T)
    w, v = np.linalg.eigh(r)
    top = v[:, -5:] * np.sqrt(w[-5:])
    assert np.allclose(whole[0], np.linalg.norm(top[:, None] - top[None], axis=2), atol=1e-6)
    monkeypatch.setattr(X, "GRAM_RUNS", 10)
    assert np.allclose(far(X.pca_coordinates(matrix)), whole[0], atol=1e-7) and np.allclose(far(X.mds_coordinates(matrix)), whole[1], atol=1e-7)
    matrix.unpersist()
    monkeypatch.setattr(X, "MAX_PLACED", 20)
    with pytest.raises(ValueError):
        X.pca_coordinates(matrix)


def plain_imputation(m, k, rounds, tol=1e-6):
    miss = np.isnan(m)
    y = np.where(miss, np.nanmean(m, 1, keepdims=True), m)
    before = None
    for _ in range(rounds):
        if before is not None and not (np.abs(y - before) > tol).any():
            break
        mean = y.mean(0)
        v = np.linalg.eigh((y - mean).T @ (y - mean))[1][:, -k:]
        before, y = y, np.where(miss, (y - mean) @ v @ v.T + mean, y)
    return y


@pytest.mark.parametrize("replayed,rounds", [(1, 7), (3, 7), (5, 50)])
def test_imputation_with_a_written_state_equals_a_plain_loop(spark, monkeypatch, replayed, rounds):
    rng = np.random.default_rng(6)
    m = rng.normal(size=(40, 2)) @ rng.normal(size=(2, 9)) + rng.normal(size=(40, 9)) * 0.05
    m[rng.random(m.shape) < 0.15] = np.nan
    monkeypatch.setattr(X, "REPLAYED", replayed)
    held = []
    replay = X._replay
    monkeypatch.setattr(X, "checkpointed", lambda df, label="": (held.append(label), X_checkpointed(df, label))[1])
    got = np.full(m.shape, np.nan)
    for r in X.impute_low_rank(long(spark, m), 2, rounds).collect():
        got[int(r.target_id[1:]), int(r.run[1:])] = r.value
    assert replay is X._replay and np.allclose(got, plain_imputation(m, 2, rounds), atol=1e-8)
    assert held.count("filled-rows") >= 2 or rounds == 50


X_checkpointed = X.checkpointed
