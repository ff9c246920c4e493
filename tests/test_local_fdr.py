"""The local false discovery rate against the method written out: every probit in the density, a spline through it, one rate per target."""

import math
from statistics import NormalDist

import numpy as np
import pytest

from curatrix.operators import batch as G
from curatrix.operators.matrix import RunMatrix
from curatrix.operators.spline import evaluate, smoothing_spline


def by_hand(p):
    """With the cubic that a spline is while the density's differences from it stay under the bound."""
    x = np.array([NormalDist().inv_cdf(min(max(v, 1e-8), 1 - 1e-8)) for v in p])
    width = 1.5 * len(x) ** -0.2 * np.std(x, ddof=1)
    grid = np.linspace(x.min(), x.max(), min(4096, max(512, len(x))))
    density = np.array([sum(math.exp(-0.5 * ((g - v) / width) ** 2) for v in x) for g in grid]) / (len(x) * width * math.sqrt(2 * math.pi))
    cubic = np.polynomial.Polynomial.fit(grid, density, 3)
    assert ((cubic(grid) - density) ** 2).sum() < len(grid)
    rate = np.minimum(1, min(1, (p >= 0.8).mean() / 0.2) * np.exp(-0.5 * x**2) / math.sqrt(2 * math.pi) / np.maximum(cubic(x), 1e-8))
    order, out = np.argsort(p, kind="stable"), np.empty(len(p))
    out[order] = np.maximum.accumulate(rate[order])
    return out


@pytest.mark.parametrize("seed,shape", [(1, (0.4, 3)), (2, (1, 1)), (3, (3, 0.5)), (4, (0.3, 0.3))])
def test_each_p_has_the_rate_of_the_method(seed, shape):
    p = np.random.default_rng(seed).beta(*shape, 300)
    assert np.abs(G.local_fdr(p) - by_hand(p)).max() < 1e-9


def test_few_and_equal_p():
    assert G.local_fdr(np.array([0.9])).tolist() == [1.0] and G.local_fdr(np.array([0.3])).tolist() == [0.0] and len(G.local_fdr(np.zeros(0))) == 0
    same = G.local_fdr(np.full(50, 0.9))
    assert (same >= 0).all() and same.max() < 1e-6  # a density of 1e7 or so


def test_a_steep_curve_takes_knots():
    x = np.linspace(0, 1, 700)
    y = 30 * np.sin(15 * x)
    spline = smoothing_spline(x, y, 700.0)
    assert len(spline[0]) > 8 and abs(((evaluate(spline, x) - y) ** 2).sum() - 700) < 1.4


def test_a_row_for_every_target(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 12))
    x[:20, ::2] += 1.5
    m = RunMatrix(spark.createDataFrame([(f"t{i:02d}", f"r{j:02d}", float(x[i, j])) for i in range(60) for j in range(12)], "target_id string, run string, value double").repartition(5))
    design, one = G.design_matrix(["a", "b"] * 6), np.ones((12, 1))
    got = sorted(tuple(r) for r in G.Posterior(m, design, one).rates().collect())
    p = np.array(sorted(r.p for r in G.f_test(m, design, one).collect()))
    assert np.allclose([g[0] for g in got], p) and np.abs(np.array([g[1] for g in got]) - by_hand(p)).max() < 1e-9
    assert np.abs(G._posterior(m, design, one)(G.probit(p)) - by_hand(p)).max() < 1e-9


def test_equal_p_of_targets(spark):
    rows = [(f"t{i}", f"r{j}", 1.0) for i in range(9) for j in range(6)]
    m = RunMatrix(spark.createDataFrame(rows, "target_id string, run string, value double").repartition(3))
    got = [tuple(r) for r in G.Posterior(m, G.design_matrix(["a", "b"] * 3), np.ones((6, 1))).rates().collect()]
    assert len(got) == 9 and len({p for p, _ in got}) == 1 and all(0 <= f < 1e-6 for _, f in got)
