"""Pairs of blocks by patterns of missing cells, sums of their classes without a row per pair, and places from factors."""

import itertools

import numpy as np
import pytest

from curatrix.operators import corr as C
from curatrix.operators import eigen
from curatrix.operators import matrix as X


def long(spark, x, ids="r{:03d}"):
    return spark.createDataFrame([(f"t{j:02d}", ids.format(i), float(v)) for i, row in enumerate(x) for j, v in enumerate(row) if np.isfinite(v)], "target_id string, run string, value double").repartition(3)


def made(n, t, holes=0, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, t))
    for i in range(n):
        if holes and i % 3:
            x[i, (i % holes) :: holes] = np.nan
    return x


def r_of(a, b):
    both = np.isfinite(a) & np.isfinite(b)
    return np.corrcoef(a[both], b[both])[0, 1]


def meta_of(spark, n):
    # a run without metadata, one with two rows, one without a project
    rows = [(f"r{i:03d}", None if i == 4 else f"p{i % 3}", f"g{i % 2}") for i in range(n) if i != 7] + [("r002", "p1", "g1")]
    return rows, spark.createDataFrame(rows, "run string, bioproject string, sample_group string")


def by_hand(x, rows, keep=lambda a, b: True):
    out = {c: [] for c in C.CLASSES}
    for (a, p, g), (b, q, h) in itertools.product(rows, rows):
        if a < b and keep(a, b):
            out[("wi" if p is not None and p == q else "bw") + ("wi" if g == h else "bw")].append(r_of(x[int(a[1:])], x[int(b[1:])]))
    return out


@pytest.mark.parametrize("holes", [0, 4])
def test_class_statistics_make_no_rows_of_pairs(spark, monkeypatch, holes):
    monkeypatch.setattr(C, "LEAST_RUNS", 5)
    monkeypatch.setattr(C, "STRIP", 20)
    monkeypatch.setattr(C, "LEAST_TILE", 1)
    monkeypatch.setattr(C, "LOOKED_AT", 3)
    monkeypatch.setattr(C, "TILE_BINS", 8)
    monkeypatch.setattr(C.RunPairs, "table", None)
    x = made(26, 9, holes)
    rows, meta = meta_of(spark, 26)
    got = {r["pair_class"]: r for r in C.correlation_statistics(C.run_pairs(long(spark, x)), meta).collect()}
    for c, r in by_hand(x, rows).items():
        assert got[c]["n"] == len(r) and np.allclose([got[c]["mean"], got[c]["median"], got[c]["variance"]], [np.mean(r), np.median(r), np.var(r, ddof=1)], atol=1e-12)


def test_round_statistics_make_no_rows_of_pairs(spark, monkeypatch):
    x = made(26, 9, 4, seed=3)
    rows, meta = meta_of(spark, 26)
    expr = long(spark, x).selectExpr("*", "if(substr(run, 4) < '5', 'a', 'b') species")
    dropped = spark.createDataFrame([("a", "r003", 0), ("a", "r011", 1), ("b", "r008", 0)], "species string, run string, round int")
    rounds = spark.createDataFrame([("a", 2), ("b", 1)], "species string, last_round int")
    old = sorted(map(tuple, C.round_statistics(C.correlation_matrix(expr, within="species"), meta, dropped, rounds).collect()))
    monkeypatch.setattr(C.RunPairs, "table", None)
    new = sorted(map(tuple, C.round_statistics(C.run_pairs(expr, "species"), meta, dropped, rounds).collect()))
    assert len(old) == 28
    for a, b in zip(old, new):
        assert a[:4] == b[:4] and all(u == v or abs(u - v) < 1e-12 for u, v in zip(a[4:], b[4:]))


@pytest.mark.parametrize("holes", [0, 4, 1])
def test_tiles_of_patterns_are_the_strips(holes):
    x = made(40, 9, holes, seed=5)
    if holes == 1:
        x = np.where(np.random.default_rng(1).random(x.shape) < 0.3, np.nan, made(40, 9, 0, seed=5))  # hardly two rows alike
    x[11] = 2.0
    x -= np.nanmean(x, axis=1, keepdims=True)
    a, b = np.arange(0, 25), np.arange(25, 40)
    for tiles, strips in ((C._r_tiles, C._r_strips), (C._tau_tiles, C._tau_strips)):
        (_, n, r), = strips(x, x)
        seen = np.zeros((40, 40), int)
        for left, right, k, got, above in itertools.chain(tiles(x, a, a), tiles(x, a, b), tiles(x, b, b)):
            counts = C._upper(got.shape, above) if above is not None else np.ones(got.shape, bool)
            seen[np.ix_(left, right)] += counts
            assert np.allclose(got[counts], r[np.ix_(left, right)][counts], atol=1e-12, equal_nan=True) and (np.broadcast_to(k, got.shape)[counts] == n[np.ix_(left, right)][counts]).all()
        assert (seen + seen.T + np.eye(40) == 1).all()


def test_rows_meet_few_large_blocks(spark):
    pairs = C.run_pairs(long(spark, made(40, 5)))
    rows = spark.range(400_000).selectExpr("'' _key", "cast(id as string) run", "array(0) i", "array(0.0D) v")
    # before, 391 blocks of 1,024 runs: a row went out as often
    assert rows.join(rows.groupBy("_key").count(), "_key").limit(1).count() and C.PAIR_RUNS == 1 << 14 and pairs._dealt(rows)._df.count() == 25 * 400_000


def test_places_from_factors(spark, monkeypatch):
    x = made(30, 6, seed=8)
    x[4] = 1.0  # without variance
    direct = [sorted(map(tuple, f(C.run_pairs(long(spark, x))).collect())) for f in (X.pca_coordinates, X.mds_coordinates)]
    monkeypatch.setattr(X, "GRAM_RUNS", 28)
    monkeypatch.setattr(C.RunPairs, "product", None)
    monkeypatch.setattr(X, "MAX_PLACED", 5)  # before, more runs than that raised
    for f, want in zip((X.pca_coordinates, X.mds_coordinates), direct):
        got = sorted(map(tuple, f(C.run_pairs(long(spark, x))).collect()))
        assert [g[0] for g in got] == [w[0] for w in want] and len(got) == 29
        assert np.abs(np.abs(np.array([g[1:] for g in got])) - np.abs(np.array([w[1:] for w in want]))).max() < 1e-8


def test_a_basis_of_many_runs_is_narrower(monkeypatch):
    monkeypatch.setattr(eigen, "BASIS_BYTES", 16 * 300 * 30)
    a = np.random.default_rng(0).normal(size=(300, 300))
    a = a @ a.T
    widest = []
    w, _ = eigen.leading(lambda q: (widest.append(q.shape[1]), a @ q)[1], 300, 3)
    assert np.allclose(w, np.linalg.eigvalsh(a)[::-1][:3])


def test_distances_meet_no_broadcast_of_places(spark, monkeypatch):
    x = made(24, 5, seed=2)
    monkeypatch.setattr(X, "_coordinates", None)  # before, places of all runs were rows of the driver
    z = (x - x.mean(1, keepdims=True)) / x.std(1, keepdims=True) / 5**0.5
    got = X.pca_distances(long(spark, x)).collect()
    assert len(got) == 24 * 23 // 2
    for r in got:
        assert abs(r["distance"] - np.linalg.norm(z[int(r["run_a"][1:])] - z[int(r["run_b"][1:])])) < 1e-7
