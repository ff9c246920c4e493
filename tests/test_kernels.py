"""Matrix kernels and batch effects against numpy on small matrices."""

import math
import random

import numpy as np
import pytest

from curatrix.operators import batch as G
from curatrix.operators import corr as C
from curatrix.operators import matrix as X


def long(spark, m, runs=None):
    runs = runs or [f"r{j:02d}" for j in range(m.shape[1])]
    rows = [(f"t{i:03d}", runs[j], None if np.isnan(m[i, j]) else float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])]
    return spark.createDataFrame(rows, "target_id string, run string, value double").repartition(3)


def wide(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[int(r.target_id[1:]), int(r.run[1:])] = np.nan if r.value is None else r.value
    return out


def low_rank(n=60, k=8, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, 2)) @ rng.normal(size=(2, k)) + 5 + rng.normal(size=(n, k)) * 0.01


@pytest.mark.parametrize("nipals", [False, True])
def test_low_rank_imputation_finds_the_missing_cells(spark, nipals):
    full = low_rank()
    holes = full.copy()
    holes[::7, 1], holes[3::11, 5] = np.nan, np.nan
    got = wide(X.impute_low_rank(long(spark, holes), k=2, nipals=nipals), full.shape)
    miss = np.isnan(holes)
    assert np.allclose(got[~miss], full[~miss])
    mean = np.where(miss, np.nanmean(holes, 1, keepdims=True), holes)
    assert np.abs(got - full)[miss].mean() < 0.2 * np.abs(mean - full)[miss].mean()


def test_imputation_of_a_tiny_matrix_keeps_row_means(spark):
    m = np.array([[1.0, np.nan, 3.0]])
    assert wide(X.impute_low_rank(long(spark, m)), (1, 3)).tolist() == [[1.0, 2.0, 3.0]]


def test_imputed_cells_respect_the_floor(spark):
    m = low_rank() - 5
    m[0, 0] = np.nan
    assert wide(X.impute_low_rank(long(spark, m), k=2, floor=100.0), m.shape)[0, 0] == 100.0


def test_coordinates_keep_distances(spark):
    m = low_rank(40, 6)
    r = np.corrcoef(m.T)
    pca = np.array([[x.pc1, x.pc2, x.pc3, x.pc4, x.pc5] for x in X.pca_coordinates(C.correlation_matrix(long(spark, m))).orderBy("run").collect()])
    assert np.allclose(pca @ pca.T, r, atol=1e-3)
    mds = np.array([[x.mds1, x.mds2] for x in X.mds_coordinates(C.correlation_matrix(long(spark, m))).orderBy("run").collect()])
    d = np.linalg.norm(mds[:, None] - mds[None], axis=2)
    assert np.corrcoef(d.ravel(), (1 - r).ravel())[0, 1] > 0.95


def test_f_tail_against_known_values():
    assert G.f_tail(np.array([4.964603]), 1, 10)[0] == pytest.approx(0.05, abs=1e-5)
    assert G.f_tail(np.array([3.885294]), 2, 12)[0] == pytest.approx(0.05, abs=1e-5)
    assert G.f_tail(np.array([0.0]), 3, 5)[0] == pytest.approx(1.0)
    for a, b in ((2.0, 3.0), (0.5, 0.5)):
        assert G.incomplete_beta(a, b, np.array([0.3]))[0] + G.incomplete_beta(b, a, np.array([0.7]))[0] == pytest.approx(1)
    assert G.incomplete_beta(0.5, 0.5, np.array([0.25]))[0] == pytest.approx(2 / math.pi * math.asin(0.5))


def planted(seed=0, n=200, runs=16):
    """Half of the targets follow groups, all follow a hidden factor."""
    rng = np.random.default_rng(seed)
    groups = ["a"] * (runs // 2) + ["b"] * (runs // 2)
    hidden = rng.normal(size=runs)
    x = rng.normal(size=(n, runs)) * 0.3 + np.outer(rng.normal(size=n) * 1.5, hidden)
    x[: n // 2, runs // 2 :] += 2
    return x, groups, hidden


def test_design_and_residuals(spark):
    x, groups, _ = planted()
    d = G.design_matrix(groups)
    assert d.shape == (16, 2) and d[:, 1].sum() == 8
    with pytest.raises(ValueError):
        G.design_matrix(["a", " "])
    res = wide(G.residualize(X.RunMatrix(long(spark, x)), d), x.shape)
    assert np.allclose(res[:, :8].mean(1), 0) and np.allclose(res[:, 8:].mean(1), 0)


def test_surrogates_find_the_hidden_factor(spark):
    x, groups, hidden = planted()
    m, d = X.RunMatrix(long(spark, x)), G.design_matrix(groups)
    assert G.num_sv_be(m, d, b=10) == 1
    assert G.num_sv_leek(m, d) == 1
    sv = G.sva_factors(m, d, 1, rounds=3)
    h = hidden - G.hat(d) @ hidden
    s = sv[:, 0] - G.hat(d) @ sv[:, 0]
    assert abs(np.corrcoef(h, s)[0, 1]) > 0.98
    clean = wide(G.sva_correct(m, d, sv, counts=False), x.shape)
    before, after = (np.mean([abs(np.corrcoef(r - G.hat(d) @ r, h)[0, 1]) for r in y]) for y in (x, clean))
    assert after < 0.5 * before
    p = {r.target_id: r.p for r in G.f_test(m, d, np.ones((16, 1))).collect()}
    assert len(p) == 200 and all(0 <= v <= 1 for v in p.values())


def test_local_fdr_is_monotone_and_separates():
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.random(4000), rng.beta(0.1, 5, 1000)])
    f = G.local_fdr(p)
    assert (np.diff(f[np.argsort(p)]) >= 0).all() and f[p < 1e-4].mean() < 0.3 < 0.8 < f[p > 0.5].mean()


def counts_with_batch(seed=4, n=150, runs=12):
    rng = np.random.default_rng(seed)
    groups, batches = ["a", "b"] * (runs // 2), ["p"] * (runs // 2) + ["q"] * (runs // 2)
    mu = np.exp(rng.normal(4, 0.5, n))[:, None] * np.ones(runs)
    mu[:30, 1::2] *= 4
    mu *= np.where(np.arange(runs) < runs // 2, 1, np.exp(rng.normal(0, 0.8, n))[:, None])
    return rng.poisson(mu).astype(float), groups, batches


def test_unwanted_variation_is_taken_out(spark):
    x, groups, batches = counts_with_batch()
    meta = spark.createDataFrame([(f"r{j:02d}", g, b, "no") for j, (g, b) in enumerate(zip(groups, batches))], "run string, sample_group string, bioproject string, exclusion string")
    done, k = G.ruvseq(long(spark, x), meta, k_max=2, top_n=80, least=20)
    assert 1 <= k <= 2 and np.isfinite(wide(done, x.shape)).all()
    # all targets as controls: the first factor is the batch
    model = G.CountModel(long(spark, x), meta)
    m = model.m
    basis = G.ruv_basis(model.residuals(), long(spark, x).select("target_id").distinct(), m.runs, 2)
    assert G.factor_r2(basis[:, 0], batches) > 0.9
    assert G.ruv_select_k(m, basis, groups, batches, 2) >= 1
    y = np.log1p(wide(G.ruv_correct(m, basis, 1), x.shape))

    def share(m, labels):
        return np.mean([G.factor_r2(r, labels) for r in m])

    assert share(y, batches) < 0.5 * share(np.log1p(x), batches)
    assert share(y[:30], groups) > 0.8 * share(np.log1p(x)[:30], groups)


def test_chi_square_tail():
    x = np.array([0.0, 0.5, 3.0, 20.0])
    assert np.allclose(G.chi2_tail(x, 2), np.exp(-x / 2)) and np.allclose(G.chi2_tail(x, 4), np.exp(-x / 2) * (1 + x / 2))
    assert G.chi2_tail(np.array([3.841459]), 1)[0] == pytest.approx(0.05, abs=1e-7)
    for df in (3, 5, 7):  # against the density, summed
        grid = np.linspace(0, 6, 200_001)
        tail = 1 - np.trapezoid(grid ** (df / 2 - 1) * np.exp(-grid / 2), grid) / (2 ** (df / 2) * math.gamma(df / 2))
        assert G.chi2_tail(np.array([6.0]), df)[0] == pytest.approx(tail, abs=1e-6)


def best_rate(y, lib, alpha):
    """The rate of the highest likelihood by a search over ever finer grids of its logarithm."""
    low, high = -20.0, 5.0
    for _ in range(12):
        grid = np.linspace(low, high, 201)
        mu = np.exp(grid)[:, None] * lib
        ll = (y * np.log(mu) - (mu if alpha == 0 else (y + 1 / alpha) * np.log1p(alpha * mu))).sum(1)
        at, step = ll.argmax(), (high - low) / 200
        low, high = grid[at] - 2 * step, grid[at] + 2 * step
    return np.exp(grid[at]), ll[at]


def test_count_model_refits_spread_targets(spark):
    rng = np.random.default_rng(11)
    mu = np.exp(rng.normal(3, 0.5, 30))[:, None] * np.linspace(0.5, 2, 12)
    x = rng.poisson(mu * np.where(np.arange(30)[:, None] < 15, rng.gamma(2, 0.5, mu.shape), 1)).astype(float)
    x[29], x[28, 3:], x[27, 2] = 0, 0, np.nan
    groups = ["a", "b", "c"] * 4
    meta = spark.createDataFrame([(f"r{j:02d}", g) for j, g in enumerate(groups)], "run string, sample_group string")
    model = G.CountModel(long(spark, x), meta)
    tests = {r.target_id: r for r in model.tests().collect()}
    cells = {(r.target_id, r.run): r for r in model.residuals().collect()}
    assert len(cells) == np.isfinite(x).sum() and len(tests) == 30 and not any(r.failed for r in tests.values())
    lib, of = np.nansum(x, 0), np.array(groups)
    for i in range(30):
        seen, t = np.isfinite(x[i]), tests[f"t{i:03d}"]
        start = {g: x[i][seen & (of == g)].sum() / lib[seen & (of == g)].sum() for g in "abc"}
        m0 = np.array([start[g] for g in of]) * lib
        use = seen & (m0 > 0)
        alpha = (((x[i] - m0) ** 2 - m0) / m0**2)[use].mean() if use.sum() > 1 else 0
        alpha = alpha if alpha > 1e-6 else 0
        assert t.dispersion == pytest.approx(alpha)
        if not np.nansum(x[i]):
            assert t.p == 1 and all(cells[(t.target_id, f"r{j:02d}")].value == 0 for j in range(12))
            continue
        total = 0
        for g in "abc":
            at = seen & (of == g)
            if x[i][at].sum():
                rate, ll = best_rate(x[i][at], lib[at], alpha)
                total += ll
                for j in np.flatnonzero(at):
                    got, y, m = cells[(t.target_id, f"r{j:02d}")], x[i][j], rate * lib[j]
                    assert got.mu == pytest.approx(m, rel=1e-6)
                    lead = y * math.log(y / m) if y else 0
                    d = lead - ((y - m) if alpha == 0 else (y + 1 / alpha) * math.log((1 + alpha * y) / (1 + alpha * m)))
                    assert got.value == pytest.approx(math.copysign(math.sqrt(max(0, 2 * d)), y - m), abs=1e-5)
        assert t.p == pytest.approx(math.exp(-max(0, total - best_rate(x[i][seen], lib[seen], alpha)[1])), abs=1e-6)
    assert sum(t.dispersion > 0.1 for t in tests.values()) >= 12


def test_count_model_with_one_group_leaves_counts(spark):
    x = counts_with_batch()[0]
    meta = spark.createDataFrame([(f"r{j:02d}", "a", "p") for j in range(12)], "run string, sample_group string, bioproject string")
    done, k = G.ruvseq(long(spark, x), meta)
    assert k == 0 and np.array_equal(wide(done, x.shape), x)
    assert {r.p for r in G.CountModel(long(spark, x), meta).tests().collect()} == {1.0}


def test_too_few_controls_mean_all_targets(spark):
    x, groups, _ = counts_with_batch(n=40)
    meta = spark.createDataFrame([(f"r{j:02d}", g) for j, g in enumerate(groups)], "run string, sample_group string")
    p, c = G.anova_pvalue(long(spark, x), meta), long(spark, x)
    assert G.control_targets(p, c).count() == 40
    assert G.control_targets(p, c, 30, 10).count() == 15 and G.control_targets(p, c, 30, 20).count() == 20


def test_estimators_of_surrogate_counts_fall_back(spark):
    d = G.design_matrix(["a", "b"] * 6)
    flat = np.tile(np.array([1.0, 3.0] * 6), (20, 1))
    m = X.RunMatrix(long(spark, flat))
    assert G.num_sv_be(m, d) is None and G.num_sv(m, d) == (0, "leek")
    few = X.RunMatrix(long(spark, flat[:4]))
    assert G.num_sv(few, d) == (None, "failed")
    with pytest.raises(ValueError):
        G.num_sv_leek(few, d)
    x, groups, _ = planted()
    assert G.num_sv(X.RunMatrix(long(spark, x)), G.design_matrix(groups), b=10) == (1, "be")


def test_anova_matches_the_f_statistic(spark):
    x, groups, _ = counts_with_batch()
    meta = spark.createDataFrame([(f"r{j:02d}", g) for j, g in enumerate(groups)], "run string, sample_group string")
    p = {r.target_id: r.p for r in G.anova_pvalue(long(spark, x), meta).collect()}
    want = G._f_block(np.log1p(x), G.design_matrix(groups), np.ones((12, 1)))
    assert all(p[f"t{i:03d}"] == pytest.approx(want[i], abs=1e-9) for i in range(len(x)))


def test_latent_factors_settle_on_the_batch(spark):
    x, groups, batches = counts_with_batch()
    u, ok = G.latent_factors(X.RunMatrix(long(spark, x)), G.design_matrix(groups), k=1)
    assert ok and G.factor_r2(u[:, 0], batches) > 0.9
    noise = np.random.default_rng(1).poisson(50, (400, 24)).astype(float)
    u, ok = G.latent_factors(X.RunMatrix(long(spark, noise)), G.design_matrix(["a", "b"] * 12))
    assert ok and u.shape[1] == 0


def test_kendall_and_finite_block(spark):
    rng = random.Random(2)
    m = np.array([[rng.randint(0, 5) for _ in range(5)] for _ in range(12)], float)
    got = {(r.run_a, r.run_b): r.r for r in C.kendall_matrix(long(spark, m)).collect()}
    for (a, b), t in got.items():
        x, y = m[:, int(a[1:])], m[:, int(b[1:])]
        sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
        assert t == pytest.approx((sx * sy).sum() / math.sqrt((sx != 0).sum() * (sy != 0).sum()))
    m[:, 4] = 1
    kept = X.finite_block(C.correlation_matrix(long(spark, m))).collect()
    assert {r.run_b for r in kept} == {"r01", "r02", "r03"}


@pytest.mark.parametrize("algorithm", ["no", "sva", "ruvseq", "latent"])
def test_finalize_runs_every_algorithm(spark, algorithm):
    x, groups, batches = counts_with_batch(n=40)
    x[0, :] = 0
    meta = spark.createDataFrame([(f"r{j:02d}", g, b, "no" if j else "bad") for j, (g, b) in enumerate(zip(groups, batches))], "run string, sample_group string, bioproject string, exclusion string")
    out, means, tau = G.finalize(long(spark, x), meta, algorithm)
    assert out.count() == 40 * 11 and means.count() == 80
    assert {r.value for r in out.where("target_id = 't000'").collect()} == {0.0}
    assert all(r.tau is None or 0 <= r.tau <= 1 for r in tau.collect())
