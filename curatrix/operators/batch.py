"""Batch effects: designs, residuals, tests, surrogate variables, unwanted variation, latent factors, and their reports.

Every pass runs over blocks of targets and brings back sums of runs-by-runs size; factors are runs-by-k and broadcast.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from itertools import accumulate
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators.matrix import GRAM_RUNS, RunMatrix, signed, top_eigen
from curatrix.operators.metadata import numbered
from curatrix.operators.spline import evaluate, smoothing_spline
from curatrix.operators.tmm import library_sizes, upper_quartile_factor
from curatrix.session import checkpointed, forget

# Fixed values of the methods.
SV_LEVEL, ENERGY, LEADING = 0.10, 0.60, 0.10
DISPERSED, NOISE, LEAST_ROWS = 1e-6, 1e-6, 10
#: p of which the null has a known share, distance of p from 0 and 1, factor on n^-1/5, points of a density and of a search for turns.
HIGH_P, LFDR_EPS, SCOTT, LEAST_GRID, MOST_GRID, TURNS = 0.8, 1e-8, 1.5, 512, 4096, 1 << 16
#: Most runs of which the eigenvalue estimate takes a gram matrix, of 72 MB then; of more runs few targets are needed.
GRAM_SIDE = 3_000


# tails


def incomplete_beta(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function by its continued fraction."""
    x = np.clip(np.asarray(x, float), 0, 1)
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for num in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    with np.errstate(divide="ignore"):
        front = np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + p * np.log(y) + q * np.log1p(-y)) / p
    out = np.where(y <= 0, 0.0, front * h)
    return np.where(swap, 1 - out, out)


def f_tail(f: np.ndarray, d1: float, d2: float) -> np.ndarray:
    """P(F > f)."""
    f = np.maximum(np.asarray(f, float), 0)
    return incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def chi2_tail(x: np.ndarray, df: int) -> np.ndarray:
    """P(X > x) of a chi-square variable with whole degrees of freedom, by the recurrence of the incomplete gamma function."""
    z = np.maximum(np.asarray(x, float), 0) / 2
    a = 0.5 if df % 2 else 1.0
    out = np.vectorize(math.erfc, otypes=[float])(np.sqrt(z)) if df % 2 else np.exp(-z)
    while a < df / 2:
        with np.errstate(divide="ignore"):
            out = out + np.where(z > 0, np.exp(a * np.log(z) - z - math.lgamma(a + 1)), 0.0)
        a += 1
    return np.clip(out, 0, 1)


# designs


def design_matrix(groups: list[str]) -> np.ndarray:
    """Intercept and a column per sorted level after the first; a blank group raises."""
    if any(not str(g).strip() for g in groups):
        raise ValueError("blank group")
    levels = sorted(set(groups))
    return np.array([[1.0, *(float(g == level) for level in levels[1:])] for g in groups])


def hat(design: np.ndarray) -> np.ndarray:
    """Runs by runs: for few runs only."""
    return design @ np.linalg.pinv(design)


def span(design: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span the design's."""
    u, s, _ = np.linalg.svd(design, full_matrices=False)
    return u[:, s > 1e-15 * s[0]] if len(s) else u


def fitted(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows projected on orthonormal columns, which takes nothing of runs-by-runs size."""
    return (x @ q) @ q.T


def left_over(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return x - fitted(x, q)


def group_of(meta: DataFrame, runs: list[str], column: str = "sample_group") -> list[str]:
    wanted = meta.sparkSession.createDataFrame([(r,) for r in runs], "run string")  # as many as a matrix may have
    found = dict(meta.select("run", column).join(F.broadcast(wanted), "run", "left_semi").collect())
    return [found[r] for r in runs]


def residualize(m: RunMatrix, design: np.ndarray) -> DataFrame:
    """Rows minus their projection on the design."""
    q = span(design)
    return m.map(lambda x: left_over(np.nan_to_num(x), q))


def _f_block(x: np.ndarray, full: np.ndarray, null: np.ndarray) -> np.ndarray:
    n, k, k0 = len(full), np.linalg.matrix_rank(full), np.linalg.matrix_rank(null)
    r1 = (left_over(x, span(full)) ** 2).sum(1)
    r0 = (left_over(x, span(null)) ** 2).sum(1)
    with np.errstate(divide="ignore", invalid="ignore"):
        f = ((r0 - r1) / (k - k0)) / (r1 / (n - k))
    return np.where(np.isfinite(f), f_tail(np.nan_to_num(f), k - k0, n - k), np.where(r0 - r1 > 1e-12, 0.0, 1.0))


def f_test(m: RunMatrix, full: np.ndarray, null: np.ndarray) -> DataFrame:
    """p of nested designs per target."""
    return m.per_row(lambda x: {"p": _f_block(np.nan_to_num(x), full, null)}, "p double")


def anova_pvalue(expr: DataFrame, meta: DataFrame) -> DataFrame:
    """One-way p per target on log1p of finite values, from sums per group; only the tail is Python."""
    v = F.log1p(F.greatest(T.finite(F.col("value")), F.lit(0.0)))
    rows = expr.join(meta.select("run", "sample_group"), "run").withColumn("v", v)
    g = rows.groupBy("target_id", "sample_group").agg(F.count("v").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q")).where("n > 0")
    t = g.groupBy("target_id").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))

    def tail(batches):
        for pdf in batches:
            out = np.ones(len(pdf))
            between, within = pdf["b"] - pdf["s"] ** 2 / pdf["n"], pdf["q"] - pdf["b"]
            for (k, n), at in pdf.groupby(["k", "n"]).indices.items():
                if k > 1 and n > k:
                    w = np.maximum(within.to_numpy()[at], 1e-300)
                    out[at] = f_tail(np.maximum(between.to_numpy()[at], 0) / (k - 1) / (w / (n - k)), k - 1, n - k)
            yield pdf[["target_id"]].assign(p=out)

    return t.mapInPandas(tail, "target_id string, p double")


# surrogate variables


def most_sv(m: RunMatrix, design: np.ndarray) -> int:
    """As many surrogates as the smaller side of the matrix leaves beside the design and the mean."""
    return max(0, min(m.n, m.n_targets) - design.shape[1] - 1)


def num_sv_be(m: RunMatrix, design: np.ndarray, b: int = 20, seed: int = 1) -> int | None:
    """How many singular values of the residuals stand out of ``b`` permutations of every row (seeded by target).

    A task holds the sums of as many permutations as HELD_BYTES of the matrix kernels allow; of many runs it holds a stretch of
    the rows of one, or a few columns if targets are many, too. None if there are no residuals to share out.
    """
    q, n = span(design), m.n
    free = min(n, m.n_targets) - np.linalg.matrix_rank(design)
    if free <= 0:
        return 0

    def residuals(x: np.ndarray, ids: list[str], k: int) -> np.ndarray:
        r = left_over(np.nan_to_num(x), q)
        if not k:
            return r
        # a target's permutation follows from its id, whatever block it is in
        order = np.stack([np.random.default_rng([seed, k, *t.encode()]).permutation(n) for t in ids])
        return left_over(np.take_along_axis(r, order, axis=1), q)

    if n <= GRAM_RUNS or m.n_targets <= GRAM_RUNS // 4:
        spectra: list[np.ndarray | None] = []

        def shares(g: np.ndarray) -> None:
            w = top_eigen(g, free)[0]
            spectra.append(None if np.trace(g) <= 1e-12 * m.n_targets else w / w.sum())

        def grams(x: np.ndarray, ids: list[str], these: range) -> np.ndarray:
            return np.stack([((r := residuals(x, ids, k)).T @ r).ravel() for k in these])

        if n <= GRAM_RUNS:
            for _, sums in m.stacked(grams, b + 1, n * n):
                for g in sums.reshape(-1, n, n):
                    shares(g)
        else:  # of few targets the gram of the other side has the same eigenvalues
            for g in m.side_grams(residuals, b + 1):
                shares(g)
        if any(s is None for s in spectra):
            return None
        p = np.maximum.accumulate((np.stack(spectra[1:]) >= spectra[0]).mean(0))
        return min(int((p <= SV_LEVEL).sum()), most_sv(m, design))

    # of more runs only as many leading shares as it takes for one not to stand out, one permutation at a time
    some, found = min(8, free), [None] * (b + 1)
    while True:
        shares = []
        for k in range(b + 1):
            w, v, trace = m.leading(lambda x, ids, k=k: residuals(x, ids, k), some, found[k], with_ids=True)
            if trace <= 1e-12 * m.n_targets:
                return None
            found[k] = v
            shares.append(w / trace)
        p = np.maximum.accumulate((np.stack(shares[1:]) >= shares[0]).mean(0))
        if p[-1] > SV_LEVEL or some == free:
            return min(int((p <= SV_LEVEL).sum()), most_sv(m, design))
        some = min(2 * some, free)


def _first(hit: np.ndarray, after: int, default: int) -> int:
    at = np.flatnonzero(hit[after:])
    return int(at[0]) + after if len(at) else default


def num_sv_leek(m: RunMatrix, design: np.ndarray, parts: int = 10, steps: int = 100) -> int:
    """How many eigenvalues stay above a threshold that shrinks with the number of targets.

    Targets are dealt into tenths by a hash of their id; growing unions of tenths each give the eigenvalues of the residual
    gram less the noise level. Among the thresholds, the stretch where the count has settled over the unions decides.
    Fewer than ten targets raise.
    """
    if m.n_targets < LEAST_ROWS:
        raise ValueError("fewer than ten targets")
    n, scale, count = m.n, np.linspace(0, 2, steps), np.zeros((steps, parts))
    if n > GRAM_SIDE:
        # the gram of the other side has the same eigenvalues beside zeros, and fewer targets than runs leave no noise level;
        # zeros count for nothing here, while those of a gram of runs are above a threshold of zero by rounding, or not
        if m.n_targets > GRAM_RUNS // 4:
            raise ValueError("too many runs and targets for the eigenvalue estimate")
        q, of = span(design), np.array([zlib.crc32(r[0].encode()) % parts for r in m.rows.select("target_id").orderBy("target_id").collect()])
        gram = m.side_grams(lambda x, ids, k: left_over(np.nan_to_num(x), q), 1)[0]
        for j in range(parts):
            size = max((of <= j).sum(), 1)
            w = np.linalg.eigvalsh(gram[np.ix_(of <= j, of <= j)] / size) if (of <= j).any() else np.zeros(1)
            count[:, j] = (w[None, :] > np.maximum((scale * size ** (-1 / 3) * n)[:, None], 1e-12 * w.max())).sum(1)
        return _settled(count, most_sv(m, design))
    keep = np.eye(n) - hat(design)

    def tenths(x: np.ndarray, ids: list[str], these: range) -> np.ndarray:
        x, of = np.nan_to_num(x), np.array([zlib.crc32(i.encode()) % parts for i in ids])
        out = np.zeros((len(these), n * n + 1))
        for row, j in zip(out, these):
            y = x[of == j]
            row[:-1], row[-1] = (y.T @ y).ravel(), len(y)
        return out

    grown = accumulate(row for _, sums in m.stacked(tenths, parts, n * n + 1) for row in sums)
    for j, row in enumerate(grown):
        gram, size = row[:-1].reshape(n, n), max(row[-1], 1.0)
        noise = np.linalg.eigvalsh(gram)[0] / size
        w = np.linalg.eigvalsh(keep @ gram @ keep / size - noise * keep)
        count[:, j] = (w[None, :] > (scale * size ** (-1 / 3) * n)[:, None]).sum(1)
    return _settled(count, most_sv(m, design))


def _settled(count: np.ndarray, most: int) -> int:
    """The count of the stretch of thresholds (rows) where it has settled over the unions (columns)."""
    spread = count.var(axis=1, ddof=1)
    rise = _first(spread > 2 * spread[0], 0, 0)
    settled = _first(spread < spread[0] / 2, rise + 1, 0)
    leaves = _first(spread > spread[0], settled + 1, len(count) - 1)
    values, times = np.unique(count[settled : leaves + 1, -1], return_counts=True)
    return int(min(max(values[times.argmax()], 0), most))


def num_sv(m: RunMatrix, design: np.ndarray, b: int = 20) -> tuple[int | None, str]:
    """The permutation estimate, or else the eigenvalue one, and which it is; None and ``failed`` if neither can be had."""
    n = num_sv_be(m, design, b)
    if n is not None:
        return n, "be"
    return (num_sv_leek(m, design), "leek") if m.n_targets >= LEAST_ROWS else (None, "failed")


def probit(p: np.ndarray) -> np.ndarray:
    """Normal quantiles of p, which is held LFDR_EPS away from 0 and 1."""
    normal = NormalDist()
    return np.array([normal.inv_cdf(v) for v in np.clip(p, LFDR_EPS, 1 - LFDR_EPS).tolist()])


class FdrCurve:
    """Local false discovery rate as a function of probits: null share from p >= 0.8, a kernel density with 1.5 times Scott's
    bandwidth on an even grid, a smoothing spline through it, at most 1, and nowhere less than at a smaller probit.

    The running maximum is over the probits that there are. Where the rate rises it is the rate itself, or what came before; where
    it falls it is what the first probit there has: so a few stretches of the curve, with the largest rate of the probits in
    each, are enough, and no probits are sorted.
    """

    def __init__(self, n: int, n_high: int, low: float, high: float, density: Callable[[np.ndarray], np.ndarray], most: Callable[[Callable], np.ndarray]):
        """``density`` of the probits at points, and ``most``: the largest value in each stretch, for a function that gives the
        stretch and the value of each probit."""
        self.null = min(1.0, n_high / n / (1 - HIGH_P)) if n else 1.0
        self.spline = None
        if n < 2:
            return
        grid = np.linspace(low, high, min(MOST_GRID, max(LEAST_GRID, n)))
        self.spline = smoothing_spline(grid, density(grid), float(len(grid)))
        fine = np.linspace(low, high, TURNS)
        rising = np.diff(self.raw(fine)) >= 0
        turns = np.flatnonzero(rising[1:] != rising[:-1]) + 1
        self.ends, self.rising = fine[turns], rising[np.append(0, turns)]
        self.before = np.maximum.accumulate(most(lambda x: (self.stretch(x), self.raw(x))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.minimum(1.0, self.null * np.exp(-0.5 * x**2) / math.sqrt(2 * math.pi) / np.maximum(evaluate(self.spline, x), LFDR_EPS))

    def stretch(self, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, x, "right")

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.spline is None:
            return np.full(len(x), self.null)
        k = self.stretch(x)
        earlier = np.where(k > 0, self.before[k - 1], -np.inf)
        return np.where(self.rising[k], np.maximum(earlier, self.raw(x)), self.before[k])


def _kernel_sum(grid: np.ndarray, x: np.ndarray, width: float) -> np.ndarray:
    """Sum over ``x`` of normal densities of a width, at each point of the grid."""
    out = np.zeros(len(grid))
    for k in range(0, len(x), 256):
        out += np.exp(-0.5 * ((grid[:, None] - x[None, k : k + 256]) / width) ** 2).sum(1)
    return out / (width * math.sqrt(2 * math.pi))


def _alike(low: float, high: float, first: float) -> bool:
    return max(first - low, high - first) <= 1e-8 + 1e-5 * abs(first)


def local_fdr(p: np.ndarray) -> np.ndarray:
    """Posterior of the null for each p, as ``FdrCurve`` has it; equal probits are drawn apart by LFDR_EPS."""
    if not len(p):
        return np.zeros(0)
    x = probit(p)
    if len(x) > 1 and _alike(x.min(), x.max(), x[0]):
        x = x + np.linspace(-LFDR_EPS, LFDR_EPS, len(x))
    width = SCOTT * len(x) ** -0.2 * x.std(ddof=1) if len(x) > 1 else 1.0

    def most(of: Callable) -> np.ndarray:
        k, v = of(x)
        return np.array([v[k == j].max(initial=-np.inf) for j in range(k.max() + 1)])

    return FdrCurve(len(x), int((p >= HIGH_P).sum()), x.min(), x.max(), lambda grid: _kernel_sum(grid, x, width) / len(x), most)(x)


class Posterior:
    """p and local false discovery rate of every target for nested designs, by passes over a written table of p: targets are
    neither collected nor put in bins."""

    def __init__(self, m: RunMatrix, full: np.ndarray, null: np.ndarray):
        table = checkpointed(f_test(m, full, null), "target-p")
        n, first = table.count(), table.orderBy("target_id").first()

        def frames(f: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
            """What ``f`` makes of p and probit in each task, a row of numbers."""
            def run(batches):
                for pdf in batches:
                    yield pd.DataFrame({"s": [np.ascontiguousarray(f(pdf["p"].to_numpy(float), _drawn(pdf)), float).tobytes()]})

            return [np.frombuffer(r["s"]) for r in self.table.mapInPandas(run, "s binary").collect()]

        self.table = table.withColumn("apart", F.lit(0.0))
        shape = np.stack(frames(lambda p, x: np.array([(p >= HIGH_P).sum(), x.sum(), x.min(), x.max()]))) if n else np.array([[0.0, 0.0, 0.0, 0.0]])
        if n > 1 and _alike(shape[:, 2].min(), shape[:, 3].max(), probit(np.array([first["p"]]))[0]):
            step = 2 * LFDR_EPS / (n - 1)
            self.table = checkpointed(numbered(table, ["target_id"], "k").select("target_id", "p", ((F.col("k") - 1) * step - LFDR_EPS).alias("apart")), "target-p")
            forget(table)
            shape = np.stack(frames(lambda p, x: np.array([(p >= HIGH_P).sum(), x.sum(), x.min(), x.max()])))
        mean = shape[:, 1].sum() / max(n, 1)
        spread = math.sqrt(sum(s[0] for s in frames(lambda p, x: np.array([((x - mean) ** 2).sum()]))) / (n - 1)) if n > 1 else 1.0
        width = SCOTT * max(n, 1) ** -0.2 * spread

        def density(grid: np.ndarray) -> np.ndarray:
            return sum(frames(lambda p, x: _kernel_sum(grid, x, width))) / n

        def most(of: Callable) -> np.ndarray:
            def tops(p: np.ndarray, x: np.ndarray) -> np.ndarray:
                k, v = of(x)
                out = np.full(k.max() + 1, -np.inf)
                np.maximum.at(out, k, v)
                return out

            found = frames(tops)
            size = max(len(t) for t in found)
            return np.max([np.append(t, np.full(size - len(t), -np.inf)) for t in found], axis=0)

        self.curve = FdrCurve(n, int(shape[:, 0].sum()), shape[:, 2].min(), shape[:, 3].max(), density, most)

    def rates(self) -> DataFrame:
        """``p, lfdr`` of each target."""
        curve = self.curve

        def run(batches):
            for pdf in batches:
                yield pd.DataFrame({"p": pdf["p"], "lfdr": curve(_drawn(pdf))})

        return self.table.mapInPandas(run, "p double, lfdr double")


def _drawn(pdf: pd.DataFrame) -> np.ndarray:
    return probit(pdf["p"].to_numpy(float)) + pdf["apart"].to_numpy(float)


def _posterior(m: RunMatrix, full: np.ndarray, null: np.ndarray) -> FdrCurve:
    """The local false discovery rate as a function of probits; the table of p goes."""
    found = Posterior(m, full, null)
    forget(found.table)
    return found.curve


def sva_factors(m: RunMatrix, design: np.ndarray, n_sv: int, rounds: int = 5) -> np.ndarray:
    """Surrogate variables (runs by n_sv), re-weighted: targets count by how surely they follow the surrogates but not the groups."""
    n, one = m.n, np.ones((m.n, 1))
    q = span(design)
    sv = m.leading(lambda x: left_over(np.nan_to_num(x), q), n_sv)[1]
    for _ in range(rounds):
        both, only = np.hstack([design, sv]), np.hstack([one, sv])
        of_sv, of_groups = _posterior(m, both, design), _posterior(m, both, only)

        def weighted(x: np.ndarray) -> np.ndarray:
            x = np.nan_to_num(x)
            w = (1 - of_sv(probit(_f_block(x, both, design)))) * of_groups(probit(_f_block(x, both, only)))
            return (x - x.mean(1, keepdims=True)) * w[:, None]

        sv = m.leading(weighted, n_sv, sv)[1]
    return sv


def sva_correct(m: RunMatrix, design: np.ndarray, sv: np.ndarray, counts: bool = True) -> DataFrame:
    """Only what the surrogates explain beyond the design is taken away; counts go through log1p and back, not below 0."""
    both = np.hstack([design, sv])
    slope = np.linalg.pinv(both)[design.shape[1] :].T  # runs by surrogates

    def clean(x: np.ndarray) -> np.ndarray:
        y = np.log1p(np.maximum(x, 0)) if counts else x
        y = np.nan_to_num(y)
        y = y - (y @ slope) @ sv.T
        return np.maximum(np.expm1(y), 0) if counts else y

    return m.map(clean)


# unwanted variation


def upper_quartile_normalize(expr: DataFrame) -> DataFrame:
    """Counts over their run's upper quartile relative to the mean one, rounded; a useless scale is 1."""
    positive = expr.groupBy("target_id").agg(F.max("value").alias("m")).where("m > 0").select("target_id")
    q = expr.join(positive, "target_id", "left_semi").groupBy("run").agg(F.percentile("value", 0.75).alias("q"))
    mean = q.agg(F.avg("q").alias("mean"))
    scale = q.crossJoin(F.broadcast(mean)).select("run", F.try_divide("q", "mean").alias("s"))
    scale = scale.withColumn("s", F.when(T.finite(F.col("s")) > 0, F.col("s")).otherwise(1.0))
    return expr.join(scale, "run").withColumn("value", F.round(F.col("value") / F.col("s"))).withColumnRenamed("s", "scale")


def effective_libraries(counts: DataFrame) -> DataFrame:
    """``(run, library)``: library sizes times upper-quartile factors with a geometric mean of 1; a useless factor is 1."""
    sizes = library_sizes(counts)
    f = sizes.select("run").join(upper_quartile_factor(counts, sizes), "run", "left")
    f = f.withColumn("factor", F.when(F.col("factor") > 0, F.col("factor")).otherwise(1.0))
    mean = f.agg(F.exp(F.avg(F.log("factor"))).alias("mean"))
    return sizes.join(f, "run").crossJoin(F.broadcast(mean)).select("run", (F.col("library_size") * F.col("factor") / F.col("mean")).alias("library"))


def _rates(y: np.ndarray, seen: np.ndarray, lib: np.ndarray, of: np.ndarray, alpha: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Means with one rate per row and label, of counts with a given dispersion per row, by scoring; and which rows settled.

    With no dispersion the start, a ratio of sums, is the answer. A step changes a rate by a factor of e at most.
    """
    y, exposure, a = y * seen, seen * lib, alpha[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        rate = np.nan_to_num((y @ of) / (exposure @ of))
        for _ in range(rounds):
            mu = (rate @ of.T) * lib
            w = seen / (1 + a * mu)
            step = np.clip(np.nan_to_num((((y - mu) * w) @ of) / ((mu * w) @ of)), -1, 1)
            rate = rate * np.exp(step)
            if np.abs(step).max(initial=0) < 1e-12:
                break
    return (rate @ of.T) * lib, np.abs(step).max(axis=1, initial=0) < 1e-6


def _likelihood(y: np.ndarray, mu: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Log likelihood of cells, less what does not depend on the mean."""
    a = np.maximum(alpha, 1e-300)
    gain = y * np.log(np.where(y > 0, np.maximum(mu, 1e-300), 1))
    return gain - np.where(alpha > 0, (y + 1 / a) * np.log1p(alpha * mu), mu)


def _count_block(x: np.ndarray, lib: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
    """Group model of a block: means, deviance residuals, p against one rate for all, dispersion, and if a refit failed."""
    seen = np.isfinite(x).astype(float)
    y, none = np.maximum(np.nan_to_num(x), 0), np.zeros(len(x))
    flat = np.ones((of.shape[0], 1))
    mu, _ = _rates(y, seen, lib, of, none)
    used = seen * (mu > 0)
    terms = used * ((y - mu) ** 2 - mu) / np.maximum(mu**2, 1e-12)
    alpha = np.where(used.sum(1) > 1, terms.sum(1) / np.maximum(used.sum(1), 1), 0.0)
    alpha = np.where(alpha > DISPERSED, alpha, 0.0)
    (full, ok), (null, ok0) = _rates(y, seen, lib, of, alpha), _rates(y, seen, lib, flat, alpha)
    failed = ~(ok & ok0)
    alpha = np.where(failed, 0.0, alpha)
    mu = np.where(failed[:, None], mu, full)
    null = np.where(failed[:, None], _rates(y, seen, lib, flat, none)[0], null)
    a = np.broadcast_to(alpha[:, None], y.shape)
    best = _likelihood(y, mu, a)
    stat = np.maximum(2 * ((best - _likelihood(y, null, a)) * seen).sum(1), 0)
    groups = ((seen @ of) > 0).sum(1)
    p = np.ones(len(x))
    for g in set(groups[groups > 1].tolist()):
        p[groups == g] = chi2_tail(stat[groups == g], g - 1)
    deviance = 2 * (_likelihood(y, y, a) - best)
    return {"mu": mu, "value": np.sign(y - mu) * np.sqrt(np.maximum(deviance, 0)), "p": p, "dispersion": alpha, "failed": failed}


class CountModel:
    """Per target a one-way Poisson model with library offsets, refitted as negative binomial where the moments show more
    spread (more than 1e-6); a refit that does not settle falls back to Poisson and is flagged.

    ``libraries(run, library)`` are the offsets, library sizes by default. Missing cells count for nothing.
    """

    def __init__(self, expr: DataFrame, meta: DataFrame, libraries: DataFrame | None = None):
        libraries = libraries or library_sizes(expr).withColumnRenamed("library_size", "library")
        self.m = m = RunMatrix(expr.join(meta.select("run"), "run", "left_semi"))
        groups, size = group_of(meta, m.runs), group_of(libraries, m.runs, "library")
        levels = sorted(set(groups))
        self.of = np.array([[float(g == v) for v in levels] for g in groups])
        self.lib = np.array(size, float)

    def residuals(self) -> DataFrame:
        """``(target_id, run, mu, value)``: means and deviance residuals of the cells there are."""
        lib, of = self.lib, self.of
        return self.m.cells(lambda x: {k: v for k, v in _count_block(x, lib, of).items() if k in ("mu", "value")}, "mu double, value double")

    def tests(self) -> DataFrame:
        """``(target_id, p, dispersion, failed)``: the likelihood-ratio test of the groups."""
        lib, of = self.lib, self.of
        return self.m.per_row(lambda x: {k: v for k, v in _count_block(x, lib, of).items() if k in ("p", "dispersion", "failed")}, "p double, dispersion double, failed boolean")


def fit_diagnostics(tests: DataFrame) -> DataFrame:
    """One row about the fits of ``CountModel.tests``: targets, those with more than Poisson spread that kept their refit,
    those whose refit did not settle and fell back, those without a p, whether any fell back, and the reasons."""
    fell = F.count_if(F.col("failed"))
    counts = tests.agg(
        F.count(F.lit(1)).alias("n_targets"), F.count_if(~F.col("failed") & (F.col("dispersion") > DISPERSED)).alias("n_refitted"),
        fell.alias("n_refit_failed"), F.count_if(T.finite(F.col("p")).isNull()).alias("n_without_p"), (fell > 0).alias("fallback_used"),
    )
    return counts.withColumn("reasons", F.when(F.col("fallback_used"), "negative_binomial_refit_failed").otherwise(""))


def expressed_targets(counts: DataFrame, libraries: DataFrame, n_runs: int) -> DataFrame:
    """Targets with more than one count per million in a quarter of the runs, in two at least."""
    cpm = counts.join(libraries, "run").withColumn("cpm", F.try_divide(F.col("value") * 1e6, F.col("library")))
    return cpm.groupBy("target_id").agg(F.count_if(F.col("cpm") > 1).alias("n")).where(F.col("n") >= max(2, n_runs // 4)).select("target_id")


def control_targets(p: DataFrame, normalized: DataFrame, top_n: int = 1000, least: int = 100) -> DataFrame:
    """Of the ``top_n`` targets with the highest p, the half with the smallest median absolute deviation of normalised
    values, at least ``least``; all targets of ``normalized`` if fewer than ``least`` have a p. ``p`` holds the targets to choose from."""
    usable = p.where(T.finite(F.col("p")).isNotNull())
    n = usable.count()
    if n < least:
        return normalized.select("target_id").distinct()
    top = usable.orderBy(F.desc("p"), "target_id").limit(top_n).select("target_id")
    chosen = normalized.join(F.broadcast(top), "target_id")  # top_n rows at most
    mid = chosen.groupBy("target_id").agg(F.median("value").alias("mid"))
    mad = chosen.join(mid, "target_id").groupBy("target_id").agg(F.median(F.abs(F.col("value") - F.col("mid"))).alias("mad"))
    return mad.orderBy("mad", "target_id").limit(max(least, min(n, top_n) // 2)).select("target_id")


def ruv_basis(residuals: DataFrame, controls: DataFrame, runs: list[str], k: int) -> np.ndarray:
    """The first ``k`` directions of the controls' centred residuals, fewer if there are fewer; none of mere rounding noise."""
    m = RunMatrix(residuals.join(controls, "target_id", "left_semi"), runs)

    def centred(x: np.ndarray) -> np.ndarray:
        x = np.nan_to_num(x)
        return x - x.mean(1, keepdims=True)

    largest = m.per_row(lambda x: {"m": np.abs(centred(x)).max(1)}, "m double").agg(F.max("m")).first()[0]
    if largest is None or largest <= NOISE:
        return np.zeros((m.n, 0))
    w, v, _ = m.leading(centred, k)
    return v[:, w > max(1e-16, 1e-14 * w[0])]


def ruv_correct(m: RunMatrix, basis: np.ndarray, k: int, whole: bool = True) -> DataFrame:
    """log(x + 1) without the first k factors, back to counts, rounded and not below 0 unless ``whole`` is false."""
    if not k:
        return m.map(lambda x: x)
    q = span(np.hstack([np.ones((m.n, 1)), basis[:, :k]]))

    def clean(x: np.ndarray) -> np.ndarray:
        y = np.log1p(np.maximum(np.nan_to_num(x), 0))
        y = np.expm1(left_over(y, q) + y.mean(1, keepdims=True))
        return np.maximum(np.round(y), 0) if whole else y

    return m.map(clean)


def factor_r2(values: np.ndarray, groups: list[str]) -> float:
    """Share of a vector's variance between groups."""
    total = ((values - values.mean()) ** 2).sum()
    g = np.array(groups)
    between = sum((g == k).sum() * (values[g == k].mean() - values.mean()) ** 2 for k in set(groups))
    return float(between / total) if total > 1e-300 else 0.0


def component_score(v: np.ndarray, groups: list[str], batches: list[str]) -> tuple[float, float]:
    """Mean share of groups minus that of batches over the first components, and that of groups alone."""
    g = float(np.mean([factor_r2(v[:, i], groups) for i in range(v.shape[1])]))
    return g - float(np.mean([factor_r2(v[:, i], batches) for i in range(v.shape[1])])), g


def ruv_select_k(m: RunMatrix, basis: np.ndarray, groups: list[str], batches: list[str], k_max: int, n_pc: int = 3) -> int:
    """The k with the best score, less twice the loss of group signal; ties prefer k > 0, then the smaller k.

    One pass for a few runs: the gram of the corrected logs follows from the gram of the logs. Of more runs the first components
    of each k come from passes.
    """
    k_max, n_pc = min(k_max, basis.shape[1]), min(n_pc, m.n - 1)
    logs = lambda x: np.log1p(np.maximum(np.nan_to_num(x), 0))
    gram = m.sums(lambda x: (y := logs(x)).T @ y) if m.n <= GRAM_RUNS else None

    def components(k: int) -> np.ndarray:
        q, one = span(np.hstack([np.ones((m.n, 1)), basis[:, :k]])), np.full((m.n, 1), m.n**-0.5)
        if gram is None:
            return m.leading(lambda x: left_over(logs(x), q if k else one), n_pc)[1]
        j = np.eye(m.n) - fitted(np.eye(m.n), q if k else one)
        return top_eigen(j @ gram @ j, n_pc)[1]

    scores, g0 = [], None
    for k in range(k_max + 1):
        s, g = component_score(components(k), groups, batches)
        g0 = g if g0 is None else g0
        scores.append((s - 2 * max(0.0, g0 - g), k > 0, -k))
    best = max(range(k_max + 1), key=lambda k: (round(scores[k][0], 12), *scores[k][1:]))
    return best


def ruvseq(expr: DataFrame, meta: DataFrame, k_max: int = 5, top_n: int = 1000, least: int = 100) -> tuple[DataFrame, int]:
    """Upper-quartile scaled counts, residuals of the group model of counts + 1, controls, factors, chosen k, corrected counts.

    With one group, or if no factor helps, the counts come back as they are.
    """
    expr = expr.join(meta.select("run"), "run", "left_semi").select("target_id", "run", "value")
    plus = expr.withColumn("value", F.col("value") + 1)
    libraries = effective_libraries(plus)
    model = CountModel(plus, meta, libraries)
    runs, groups = model.m.runs, group_of(meta, model.m.runs)
    if len(set(groups)) < 2:
        return expr, 0
    scaled = upper_quartile_normalize(expr)
    p = model.tests().join(expressed_targets(plus, libraries, len(runs)), "target_id", "left_semi")
    m, k_max = RunMatrix(scaled, runs), min(k_max, len(runs) - 1)
    basis = ruv_basis(model.residuals(), control_targets(p, scaled, top_n, least), runs, k_max)
    k = ruv_select_k(m, basis, groups, group_of(meta, runs, "bioproject"), k_max)
    if not k:
        return expr, 0
    lanes = scaled.select("run", "scale").distinct()
    back = F.greatest(F.round(F.col("value") * F.col("scale")), F.lit(0.0))
    return ruv_correct(m, basis, k).join(lanes, "run").select("target_id", "run", back.alias("value")), k


# latent factors


def _energetic(m: RunMatrix, f, free: int) -> int:
    """How many leading components hold ENERGY of the whole; none if the first holds under LEADING."""
    some = free if m.n <= GRAM_RUNS else min(8, free)
    while True:
        w, _, trace = m.leading(f, some)
        share = w / max(trace, 1e-300)
        if share[0] < LEADING:
            return 0
        if share.sum() >= ENERGY or some == free:
            return int(np.searchsorted(np.cumsum(share), ENERGY) + 1)
        some = min(2 * some, free)


def latent_factors(m: RunMatrix, design: np.ndarray, k: int | None = None, rounds: int = 200, tol: float = 1e-5) -> tuple[np.ndarray, bool]:
    """Factors orthogonal to the design from residuals weighted by a negative-binomial variance, refitted until the
    subspace settles. Without ``k``: as many as hold 60 % of the energy, none if the first holds under 10 %."""
    of_design = span(design)
    u, settled = np.zeros((m.n, 0)), False
    for _ in range(rounds):
        both = span(np.hstack([design, u]))

        def weighted(x: np.ndarray) -> np.ndarray:
            y = np.log1p(np.maximum(np.nan_to_num(x), 0))
            mu = np.maximum(np.expm1(fitted(y, both)), 1e-3)
            alpha = np.clip((((np.nan_to_num(x) - mu) ** 2 - mu) / mu**2).mean(1, keepdims=True), 1e-4, 10)
            w = 1 / np.sqrt((1 / mu + alpha).mean(1, keepdims=True))
            return left_over(y, of_design) * w

        if k is None:
            free = m.n - np.linalg.matrix_rank(design)
            k = _energetic(m, weighted, free) if free else 0
        if not k:
            return np.zeros((m.n, 0)), True
        new = m.leading(weighted, k, u)[1]
        if u.shape[1] == k and 2**0.5 * np.linalg.norm(u - new @ (new.T @ u)) <= tol:  # the distance of the projections
            return new, True
        u = signed(new)
    return u, settled


# reports


def combat_batch_gate(meta: DataFrame) -> DataFrame:
    """Per run: whether its batch has more than one run, and why none is corrected if so."""
    kept = meta.where(T.is_kept(F.col("exclusion")))
    rows = kept.withColumn("n_in_batch", F.count(F.lit(1)).over(Window.partitionBy("bioproject")))
    usable = rows.where("n_in_batch > 1").agg(F.count_distinct("bioproject").alias("n_batches"), F.count_distinct("sample_group").alias("n_groups"))
    reason = F.when(F.col("n_batches") == 0, "no_batch").when(F.col("n_batches") == 1, "one_batch").otherwise("")
    return rows.crossJoin(F.broadcast(usable)).select("run", "bioproject", ((F.col("n_in_batch") > 1) & (F.col("n_batches") > 1)).alias("corrected"), reason.alias("skip_reason"), (F.col("n_groups") > 1).alias("with_group"))


def batch_annotate(meta: DataFrame, plan: DataFrame, algorithm: str) -> DataFrame:
    done = meta.join(plan.select("run", "corrected"), "run", "left")
    yes = F.coalesce("corrected", F.lit(False))
    return done.withColumns({"batch_corrected": F.when(yes, "yes").otherwise("no"), "batch_algorithm": F.when(yes, algorithm).otherwise("none")}).drop("corrected")


def batch_summary(annotated: DataFrame) -> DataFrame:
    return annotated.agg(F.count(F.lit(1)).alias("n_runs"), F.count_if(F.col("batch_corrected") == "yes").alias("n_corrected"), F.count_distinct("bioproject").alias("n_batches"), F.max("batch_algorithm").alias("algorithm"))


def covariate_r2(factors: DataFrame, meta: DataFrame, categorical: list[str], numeric: list[str]) -> DataFrame:
    """``(factor, covariate, r2)``: squared correlation for numbers, between over total squares for groups.

    ``factors(run, factor, value)``.
    """
    from curatrix.operators.corr import safe_pearson

    rows = factors.join(meta, "run")
    out = None
    for c in categorical:
        g = rows.groupBy("factor", c).agg(F.count("value").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
        t = g.groupBy("factor").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"))
        mean = F.col("s") * F.col("s") / F.col("n")
        one = t.select("factor", F.lit(c).alias("covariate"), F.try_divide(F.col("b") - mean, F.nullif(F.col("q") - mean, F.lit(0.0))).alias("r2"))
        out = one if out is None else out.unionByName(one)
    for c in numeric:
        r = safe_pearson(rows, ["factor"], "value", c).select("factor", F.lit(c).alias("covariate"), (F.col("r") * F.col("r")).alias("r2"))
        out = r if out is None else out.unionByName(r)
    return out


def finalize(expr: DataFrame, meta: DataFrame, algorithm: str = "sva", method: str = "lognp1-none") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transform and correct, reset zeros, then group means and specificity.

    ``sva`` corrects after the transform, ``ruvseq`` and ``latent`` before it, ``no`` not at all.
    """
    from curatrix.operators import expression as E

    meta = meta.where(T.is_kept(F.col("exclusion")))
    expr = E.densify(expr.join(meta.select("run"), "run", "left_semi").select("target_id", "run", "value"))
    log = method.split("-")[0]
    ready = expr
    if algorithm in ("sva", "no"):
        ready = expr.withColumn("value", T.log_transform(F.col("value"), log))
    if algorithm == "sva":
        m = RunMatrix(ready)
        design = design_matrix(group_of(meta, m.runs))
        n_sv, _ = num_sv(m, design)
        ready = sva_correct(m, design, sva_factors(m, design, n_sv), counts=False) if n_sv else ready
    elif algorithm == "ruvseq":
        ready = ruvseq(expr, meta)[0]
    elif algorithm == "latent":
        m = RunMatrix(expr)
        design = design_matrix(group_of(meta, m.runs))
        u, ok = latent_factors(m, design)
        ready = sva_correct(m, design, u) if ok and u.shape[1] else expr
    if algorithm not in ("sva", "no"):
        ready = ready.withColumn("value", T.log_transform(F.col("value"), log))
    out = E.maintain_zero(ready, expr, clip=log.endswith("p1")).select("target_id", "run", "value")
    means = E.sample_group_mean(out, meta)
    return out, means, E.tau(means, log)
