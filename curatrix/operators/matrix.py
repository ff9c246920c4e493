"""Targets-by-runs kernels: each is a distributed pass over targets that yields sums of runs-by-runs size, or less.

Targets are many, runs few. Rows go through tasks in blocks. Of a few runs the gram matrix comes back to the driver, where an
eigen step is done, and its result is broadcast for the next pass; of more runs leading components come from passes that
send runs by a few columns. Sums travel as packed pieces and are merged in a tree. Missing cells are NaN inside blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators.corr import RunPairs, run_pairs, standard_rows
from curatrix.operators.eigen import leading
from curatrix.session import checkpointed, forget

#: Runs of a matrix at most, of which the driver holds names and a few numbers each; more raise.
MAX_RUNS = 1_000_000
#: Up to so many runs a gram matrix is taken for leading components; beyond, passes that send a few columns.
GRAM_RUNS = 1_024
#: Cells of a block of targets, bytes of the sums that a task holds, numbers of a packed piece, and pieces merged in a task.
CELLS, HELD_BYTES, PIECE, FAN = 1 << 21, 256 << 20, 1 << 17, 16
#: Rounds of imputation that are replayed before the filled rows are written again.
REPLAYED = 5
#: Runs of coordinates at most, where some lack targets; the driver holds up to 100 numbers for each, fewer of many runs.
MAX_PLACED = MAX_RUNS


class RunMatrix:
    """A long expression table as rows of values in a fixed order of runs."""

    def __init__(self, expr: DataFrame, runs: list[str] | None = None):
        self.runs = runs or [r[0] for r in expr.select("run").distinct().orderBy("run").limit(MAX_RUNS + 1).collect()]
        if len(self.runs) > MAX_RUNS:
            raise ValueError("too many runs for a matrix of runs by runs")
        self.n = len(self.runs)
        spark = expr.sparkSession
        order = spark.createDataFrame(list(zip(self.runs, range(self.n))), "run string, i int")
        cells = expr.select("target_id", "run", T.finite(F.col("value")).alias("value")).join(F.broadcast(order), "run")  # MAX_RUNS rows at most
        rows = cells.groupBy("target_id").agg(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("i", "value"))).alias("c")).select("target_id", F.transform("c", lambda x: x["i"]).alias("i"), F.transform("c", lambda x: x["value"]).alias("v"))
        self.rows = checkpointed(rows)  # passes read it again and again

    @cached_property
    def n_targets(self) -> int:
        return self.rows.count()

    def sums(self, f: Callable[..., np.ndarray], with_ids: bool = False, rows: DataFrame | None = None, block: Callable | None = None) -> np.ndarray:
        """The sum over all blocks of a small matrix that ``f`` makes of each (and of its target ids, if asked).

        A task adds up its blocks and sends packed pieces of the sum; pieces of a place are added in lanes of FAN tasks, then
        over lanes. ``rows`` and ``block`` stand in for the matrix's rows and for how a slice of them becomes an argument.
        """
        n, make = self.n, block or _block

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for pdf in batches:
                for part in _slices(pdf, n):
                    m = f(make(part, n), part["target_id"].tolist()) if with_ids else f(make(part, n))
                    total = m if total is None else total.__iadd__(m)
            if total is not None:
                lane, flat = TaskContext.get().partitionId() // FAN, np.ascontiguousarray(total, float).ravel()
                for k in range(0, max(1, len(flat)), PIECE):
                    yield pd.DataFrame({"piece": [k // PIECE], "lane": [lane], "height": [len(total)], "s": [flat[k : k + PIECE].tobytes()]})

        schema = "piece int, lane int, height int, s binary"
        parts = (self.rows if rows is None else rows).mapInPandas(run, schema)
        lanes = parts.groupBy("piece", "lane").applyInPandas(_merged, schema).withColumn("lane", F.lit(0))
        found = sorted(lanes.groupBy("piece", "lane").applyInPandas(_merged, schema).collect())
        return np.concatenate([np.frombuffer(r["s"]) for r in found]).reshape(found[0]["height"], -1) if found else np.zeros((0, 0))

    def stacked(self, f: Callable[[np.ndarray, list[str], range], np.ndarray], parts: int, size: int) -> Iterator[tuple[range, np.ndarray]]:
        """Sums of ``parts`` matrices of ``size`` numbers, as many in a pass as HELD_BYTES allow; ``f`` makes those of a range,
        a row each."""
        some = max(1, HELD_BYTES // (16 * size))  # the sum, and what is added to it
        for first in range(0, parts, some):
            these = range(first, min(first + some, parts))
            yield these, self.sums(lambda x, ids, these=these: f(x, ids, these), with_ids=True)

    def leading(self, f: Callable[..., np.ndarray], k: int, start: np.ndarray | None = None, with_ids: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
        """The ``k`` largest eigenvalues and vectors of the gram matrix of the rows that ``f`` makes of each block, and its trace."""
        if self.n <= GRAM_RUNS:
            gram = self.sums(lambda x, *ids: (y := f(x, *ids)).T @ y, with_ids)
            if not len(gram):
                gram = np.zeros((self.n, self.n))
            return *top_eigen(gram, k), float(np.trace(gram))
        trace = 0.0

        def times(q: np.ndarray) -> np.ndarray:
            """The product, and below it the trace in every column."""
            nonlocal trace
            s = self.sums(lambda x, *ids: np.vstack([(y := f(x, *ids)).T @ (y @ q), np.full((1, q.shape[1]), (y**2).sum())]), with_ids)
            if not len(s):
                return np.zeros(q.shape)
            trace = float(s[-1, 0])
            return s[:-1]

        w, v = leading(times, self.n, k, start)
        if not trace:
            return np.zeros(k), np.eye(self.n, k), 0.0
        return np.maximum(w, 0), signed(v), trace

    def side_grams(self, f: Callable[[np.ndarray, list[str], int], np.ndarray], parts: int) -> list[np.ndarray]:
        """Of few targets and many runs: per part the gram matrix, targets (in order of their ids) by targets, of the rows that
        ``f`` makes. Rows are cut into stretches of runs, whose products are added."""
        n, width = self.n, max(1, PIECE // max(1, self.n_targets))

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for part in _slices(pdf, n):
                    x, ids = _block(part, n), part["target_id"].tolist()
                    for k in range(parts):
                        y = f(x, ids, k)
                        for first in range(0, n, width):
                            yield pd.DataFrame({"target_id": ids, "piece": k, "at": first // width, "s": [np.ascontiguousarray(r).tobytes() for r in y[:, first : first + width]]})

        def product(pdf: pd.DataFrame) -> pd.DataFrame:
            y = np.stack([np.frombuffer(s) for s in pdf.sort_values("target_id")["s"]])
            return pd.DataFrame({"piece": pdf["piece"].iloc[:1], "lane": pdf["at"].iloc[:1] // FAN, "height": len(y), "s": [(y @ y.T).tobytes()]})

        schema = "piece int, lane int, height int, s binary"
        lanes = self.rows.mapInPandas(cut, "target_id string, piece int, at int, s binary").groupBy("piece", "at").applyInPandas(product, schema)
        lanes = lanes.groupBy("piece", "lane").applyInPandas(_merged, schema).withColumn("lane", F.lit(0))
        found = sorted(lanes.groupBy("piece", "lane").applyInPandas(_merged, schema).collect())
        return [np.frombuffer(r["s"]).reshape(r["height"], -1) for r in found]

    def map(self, f: Callable[[np.ndarray], np.ndarray], rows: DataFrame | None = None, block: Callable | None = None) -> DataFrame:
        """Every block through ``f``, back in long form."""
        n, runs, make = self.n, self.runs, block or _block

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for part in _slices(pdf, n):
                    x = f(make(part, n))
                    yield pd.DataFrame({"target_id": np.repeat(part["target_id"].to_numpy(), n), "run": np.tile(runs, len(part)), "value": x.ravel()})

        return (self.rows if rows is None else rows).mapInPandas(run, "target_id string, run string, value double")

    def cells(self, f: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
        """Columns per cell that ``f`` makes of a block, for the cells that are not missing."""
        n, runs = self.n, np.array(self.runs, object)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for part in _slices(pdf, n):
                    x = _block(part, n)
                    r, c = np.nonzero(np.isfinite(x))
                    yield pd.DataFrame({"target_id": part["target_id"].to_numpy()[r], "run": runs[c], **{k: v[r, c] for k, v in f(x).items()}})

        return self.rows.mapInPandas(run, f"target_id string, run string, {schema}")

    def per_row(self, f: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
        """Columns per target that ``f`` makes of a block."""
        n = self.n

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for part in _slices(pdf, n):
                    yield pd.DataFrame({"target_id": part["target_id"].to_numpy(), **f(_block(part, n))})

        return self.rows.mapInPandas(run, f"target_id string, {schema}")


def _slices(pdf: pd.DataFrame, n: int) -> Iterator[pd.DataFrame]:
    """Rows of about CELLS cells."""
    some = max(1, CELLS // max(1, n))
    for first in range(0, len(pdf), some):
        yield pdf.iloc[first : first + some]


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(pdf["s"].iloc[0]).copy()
    for s in pdf["s"].iloc[1:]:
        total += np.frombuffer(s)
    return pdf.iloc[:1].assign(s=[total.tobytes()])


def _block(pdf: pd.DataFrame, n: int) -> np.ndarray:
    x = np.full((len(pdf), n), np.nan)
    for k, (i, v) in enumerate(zip(pdf["i"], pdf["v"])):
        x[k, np.asarray(i, int)] = v
    return x


def signed(vectors: np.ndarray) -> np.ndarray:
    """Columns turned so that the largest loading is positive."""
    at = np.abs(vectors).argmax(0)
    return vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def top_eigen(gram: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    w, v = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(-w)[:k]
    return np.maximum(w[order], 0), signed(v[:, order])


def power_components(gram: np.ndarray, k: int, rounds: int = 500, tol: float = 1e-9) -> np.ndarray:
    """The first components one by one, by power iteration with deflation."""
    g, out = gram.copy(), []
    for _ in range(k):
        v = np.ones(len(g)) / len(g) ** 0.5 + np.arange(len(g)) * 1e-6
        for _ in range(rounds):
            new = g @ v
            size = np.linalg.norm(new)
            if size < 1e-12:
                break
            new /= size
            if np.linalg.norm(new - v) < tol:
                v = new
                break
            v = new
        out.append(v)
        g = g - (v @ g @ v) * np.outer(v, v)
    return signed(np.stack(out, 1))


def _row_mean(x: np.ndarray) -> np.ndarray:
    have = np.isfinite(x)
    n = have.sum(1)
    mean = np.where(n > 0, np.where(have, x, 0).sum(1) / np.maximum(n, 1), 0)
    return np.where(have, x, mean[:, None])


Step = tuple[np.ndarray, np.ndarray]


def _replay(miss: np.ndarray, y: np.ndarray, steps: list[Step]) -> np.ndarray:
    """Filled rows after more steps: missing cells take the low-rank reconstruction of the centred rows."""
    for mean, v in steps:
        y = np.where(miss, (y - mean) @ v @ v.T + mean, y)
    return y


def _filled(pdf: pd.DataFrame, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values with NaN, which are missing, and the rows as filled when they were last written."""
    x = _block(pdf, n)
    return x, ~np.isfinite(x), np.stack(pdf["y"].to_numpy()) if len(pdf) else x


def _replay_across(miss: np.ndarray, y: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """As ``_replay`` for rows of runs: the reconstruction of a run needs the directions over targets and its own mean."""
    for u in steps:
        mean = y.mean(1, keepdims=True)
        y = np.where(miss, (y - mean) @ u @ u.T + mean, y)
    return y


def impute_low_rank(expr: DataFrame, k: int = 4, rounds: int = 50, tol: float = 1e-6, floor: float | None = None, nipals: bool = False) -> DataFrame:
    """Missing cells by iterated reconstruction from the first components (eigen, or power iteration).

    Filled rows are a written table, which a new one replaces every REPLAYED rounds; a round's pass replays only the steps since,
    so late rounds cost what early ones do. Too small a matrix keeps row means. Of more than GRAM_RUNS runs and fewer targets,
    rows are runs and the gram matrix is that of targets; if both are more, components come from passes.
    """
    m = RunMatrix(expr)
    n_runs, n_targets = m.n, m.n_targets
    across = n_runs > GRAM_RUNS >= n_targets
    if across:
        forget(m.rows)
        m = RunMatrix(expr.select(F.col("run").alias("target_id"), F.col("target_id").alias("run"), "value"))
    n, replay = m.n, _replay_across if across else _replay
    state_schema = "target_id string, i array<int>, v array<double>, y array<double>"

    def write(rows: DataFrame, step: Callable[[pd.DataFrame], np.ndarray]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for part in _slices(pdf, n):
                    yield part[["target_id", "i", "v"]].assign(y=list(step(part)))

        return checkpointed(rows.mapInPandas(run, state_schema), "filled-rows")

    def start(part: pd.DataFrame) -> np.ndarray:
        x = _block(part, n)
        return np.where(np.isfinite(x), x, means) if across else _row_mean(x)

    if across:
        s = m.sums(lambda x: np.stack([np.nan_to_num(x).sum(0), np.isfinite(x).sum(0).astype(float)]))
        means = np.divide(s[0], s[1], out=np.zeros(n), where=s[1] > 0) if len(s) else np.zeros(n)
    state, steps = write(m.rows, start), []
    rank = min(k, n_targets - 1, n_runs - 1)
    if rank >= 1:
        for done in range(rounds):
            pending = list(steps)

            def moved(block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
                """Filled rows as they are now, and how many cells the last step moved."""
                _, miss, y = block
                before = replay(miss, y, pending[:-1])
                y = replay(miss, before, pending[-1:])
                return y, (np.abs(y - before) > tol).sum()

            def parts(block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
                y, count = moved(block)
                if n > GRAM_RUNS:
                    return np.stack([y.sum(0), np.full(n, count, float)])
                g = np.zeros((n + 1, n + 1))
                if across:
                    y = y - y.mean(1, keepdims=True)
                g[:n, :n] = y.T @ y
                g[n, :n] = y.sum(0)
                g[n, n] = count
                return g

            s = m.sums(parts, rows=state, block=_filled)
            if done and s[-1, -1] == 0:
                break
            if n > GRAM_RUNS:
                mean = s[0] / n_targets

                def times(q: np.ndarray) -> np.ndarray:
                    return m.sums(lambda block: (y := moved(block)[0] - mean).T @ (y @ q), rows=state, block=_filled)

                v = signed(leading(times, n, rank, steps[-1][1] if steps else None)[1])
            else:
                mean = s[n, :n] / n_targets
                gram = s[:n, :n] if across else s[:n, :n] - n_targets * np.outer(mean, mean)
                v = power_components(gram, rank) if nipals else top_eigen(gram, rank)[1]
            steps.append(v if across else (mean, v))
            if len(steps) > REPLAYED:
                old, past = state, list(steps[:-1])  # the last step stays, to see how far it moves
                state = write(old, lambda part, past=past: replay(*_filled(part, n)[1:], past))
                forget(old)
                steps = steps[-1:]
    final = list(steps)

    def fill(block: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        x, miss, y = block
        y = replay(miss, y, final)
        return np.where(miss, np.maximum(y, floor), x) if floor is not None else y

    out = m.map(fill, state, _filled)
    return out.select(F.col("run").alias("target_id"), F.col("target_id").alias("run"), "value") if across else out


def correlation_array(matrix: DataFrame, runs: list[str]) -> np.ndarray:
    """The runs-by-runs array of pair correlations (one on the diagonal); runs are few by the model of the data."""
    at = {r: i for i, r in enumerate(runs)}
    pdf = matrix.toPandas()
    out = np.eye(len(runs))
    i, j = pdf["run_a"].map(at).to_numpy(), pdf["run_b"].map(at).to_numpy()
    out[i, j] = out[j, i] = pdf["r"].to_numpy(float)
    return out


def _correlating(pairs: RunPairs) -> list[str]:
    """Runs of ``pairs`` that correlate with anything at all, in order, which they are numbered by then."""
    runs = sorted(r[0] for r in pairs.rows.select("run").limit(MAX_RUNS + 1).collect())
    if len(runs) > MAX_RUNS:
        raise ValueError("too many runs for pairs of runs")
    with_any = pairs.numbered(runs).product(np.ones_like, np.ones((len(runs), 1)))[:, 0]
    return [r for r, n in zip(runs, with_any) if n > 0]


def finite_block(matrix: DataFrame | RunPairs) -> DataFrame:
    """Pairs of runs that correlate with anything at all; a pair that is still missing raises."""
    if isinstance(matrix, RunPairs):
        good = matrix.rows.sparkSession.createDataFrame([(r,) for r in _correlating(matrix)], "run string")
        matrix.rows = matrix.rows.join(F.broadcast(good), "run", "left_semi")  # a row per run
        out = matrix.table().drop("_key")
        return out.withColumn("r", F.when(F.col("r").isNull(), F.raise_error(F.lit("correlation of a pair is undefined")).cast("double")).otherwise(F.col("r")))
    both = matrix.select(F.col("run_a").alias("run"), "r").unionByName(matrix.select(F.col("run_b").alias("run"), "r"))
    good = both.groupBy("run").agg(F.count("r").alias("n")).where("n > 0").select("run")
    kept = matrix.join(good.select(F.col("run").alias("run_a")), "run_a", "left_semi").join(good.select(F.col("run").alias("run_b")), "run_b", "left_semi")
    # a projection: a filter could be moved before the joins and meet pairs that they drop
    return kept.withColumn("r", F.when(F.col("r").isNull(), F.raise_error(F.lit("correlation of a pair is undefined")).cast("double")).otherwise(F.col("r")))


def _placed(kept: DataFrame, n_axes: int, direct: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], product: Callable[[Callable, np.ndarray, int], np.ndarray], name: str) -> DataFrame:
    """Coordinates from leading eigenpairs: of the whole array for a few runs, else by passes over the pairs."""
    spark = kept.sparkSession
    runs = sorted(r[0] for r in kept.select("run_a").union(kept.select("run_b")).distinct().limit(MAX_PLACED + 1).collect())
    n = len(runs)
    if n > MAX_PLACED:
        raise ValueError("too many runs for coordinates")
    k = min(n_axes, n)
    if n <= GRAM_RUNS:
        w, v = direct(correlation_array(kept, runs))
    else:
        order = spark.createDataFrame(list(zip(runs, range(n))), "run string, i int")
        at = lambda s: F.broadcast(order.select(F.col("run").alias(f"run_{s}"), F.col("i").alias(s)))  # noqa: E731  # MAX_PLACED rows at most
        pairs = checkpointed(kept.join(at("a"), "run_a").join(at("b"), "run_b").select("a", "b", "r"), "pairs")

        def times(of_r: Callable[[np.ndarray], np.ndarray], q: np.ndarray) -> np.ndarray:
            """Product with the symmetric array of ``of_r`` of each pair's correlation, diagonal apart."""
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                total = np.zeros(q.shape)
                for pdf in batches:
                    a, b, r = pdf["a"].to_numpy(), pdf["b"].to_numpy(), of_r(pdf["r"].to_numpy(float))
                    for c in range(q.shape[1]):
                        total[:, c] += np.bincount(a, r * q[b, c], n) + np.bincount(b, r * q[a, c], n)
                lane, flat = TaskContext.get().partitionId() // FAN, total.ravel()
                for piece in range(0, len(flat), PIECE):
                    yield pd.DataFrame({"piece": [piece // PIECE], "lane": [lane], "height": [n], "s": [flat[piece : piece + PIECE].tobytes()]})

            schema = "piece int, lane int, height int, s binary"
            lanes = pairs.mapInPandas(run, schema).groupBy("piece", "lane").applyInPandas(_merged, schema).withColumn("lane", F.lit(0))
            found = sorted(lanes.groupBy("piece", "lane").applyInPandas(_merged, schema).collect())
            return np.concatenate([np.frombuffer(x["s"]) for x in found]).reshape(q.shape)

        w, v = leading(lambda q: product(times, q, n), n, k)
        w, v = np.maximum(w, 0), signed(v)
        forget(pairs)
    return _coordinates(spark, runs, w, v, n_axes, name)


def _coordinates(spark: SparkSession, runs: list[str], w: np.ndarray, v: np.ndarray, n_axes: int, name: str) -> DataFrame:
    xy = np.zeros((len(runs), n_axes))
    xy[:, : len(w)] = v * np.sqrt(w)
    rows = [(r, *map(float, xy[i])) for i, r in enumerate(runs)]
    return spark.createDataFrame(rows, "run string, " + ", ".join(f"{name}{i + 1} double" for i in range(n_axes)))


def _placed_by_blocks(pairs: RunPairs, n_axes: int, direct: Callable, product: Callable, name: str) -> DataFrame:
    """As ``_placed``, where a pass makes the pairs of each two blocks anew, so that none are written."""
    runs = _correlating(pairs)
    n, spark = len(runs), pairs.rows.sparkSession
    if n <= GRAM_RUNS:
        return _placed(finite_block(pairs), n_axes, direct, product, name)
    if n > MAX_PLACED:
        raise ValueError("too many runs for coordinates")
    if (pairs.numbered(runs).product(np.ones_like, np.ones((n, 1))) < n - 1).any():
        raise ValueError("correlation of a pair is undefined")
    w, v = leading(lambda q: product(pairs.product, q, n), n, min(n_axes, n))
    return _coordinates(spark, runs, np.maximum(w, 0), signed(v), n_axes, name)


class Factors:
    """Leading eigenpairs of an array that is ``phi @ diag(weight) @ phi.T`` over runs, ``phi`` being made of each run's standardised row.

    Two passes over rows of runs, whatever their number: the gram matrix of ``phi``, less its means if ``centred``, comes to the driver, where
    directions follow; places are made in tasks. Nothing of the length of the runs is on the driver.
    """

    def __init__(self, pairs: RunPairs, phi: Callable[[np.ndarray], np.ndarray], weight: np.ndarray, centred: bool, k: int):
        self.rows, self.phi, self.n_targets = pairs.rows.select("run", "i", "v"), phi, pairs.n_targets
        n_targets = self.n_targets

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(weight) + 1,) * 2)
            for z in _some_rows(batches, n_targets, len(weight)):
                y = np.hstack([phi(z[0]), np.ones((len(z[0]), 1))])
                total += y.T @ y
            lane = TaskContext.get().partitionId() // FAN
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([lane], pa.int32()), pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "lane", "height", "s"])

        schema = "piece int, lane int, height int, s binary"
        lanes = self.rows.mapInArrow(sums, schema).groupBy("piece", "lane").applyInPandas(_merged, schema).withColumn("lane", F.lit(0))
        found = lanes.groupBy("piece").applyInPandas(_merged, schema).collect()
        total = np.frombuffer(found[0]["s"]) if found else np.zeros((len(weight) + 1) ** 2)
        gram, n = total.reshape(len(weight) + 1, -1), total[-1]
        self.n, self.mean = int(n), gram[-1, :-1] / max(n, 1.0) * centred
        gram = gram[:-1, :-1] - n * np.outer(self.mean, self.mean)
        w, u = np.linalg.eigh((gram + gram.T) / 2)
        if (weight == 1).all():
            self.to = u[:, np.argsort(-w)[:k]]  # a place is a product with a direction, however short
            return
        some = w > 1e-12 * max(w.max(), 1e-300)
        root, u = np.sqrt(w[some]), u[:, some]
        found, y = top_eigen(root[:, None] * (u.T @ (weight[:, None] * u)) * root, k)
        self.to = (u / root) @ y * np.sqrt(found)

    def places(self) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]:
        """What makes places of rows of runs, a few at a time with their runs."""
        phi, n_targets, mean, to = self.phi, self.n_targets, self.mean, self.to

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for z, runs in _some_rows(batches, n_targets, len(mean)):
                yield (phi(z) - mean) @ to, runs

        return made

    def coordinates(self, n_axes: int, name: str) -> DataFrame:
        """A column per axis, turned so that the largest number is positive."""
        rows, places, k = self.rows, self.places(), self.to.shape[1]

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for xy, runs in places(batches):
                if len(xy):
                    at = np.abs(xy).argmax(0)
                    yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(runs[at], pa.string()), pa.array(xy[at, range(k)])], ["axis", "run", "x"])

        sign, most = np.ones(k), {}
        for r in rows.mapInArrow(ends, "axis int, run string, x double").collect():
            most[r["axis"]] = min(most.get(r["axis"], (0.0, "", 0.0)), (-abs(r["x"]), r["run"], r["x"]))
        for axis, (_, _, x) in most.items():
            sign[axis] = -1.0 if x < 0 else 1.0
        names = [f"{name}{i + 1}" for i in range(n_axes)]

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for xy, runs in places(batches):
                xy = np.hstack([xy * sign, np.zeros((len(xy), n_axes - k))])
                yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), *(pa.array(np.ascontiguousarray(c)) for c in xy.T)], ["run", *names])

        return rows.mapInArrow(placed, "run string, " + ", ".join(f"{c} double" for c in names))

    def table(self) -> DataFrame:
        """``run, x``: the place on all axes."""
        places = self.places()

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for xy, runs in places(batches):
                x = pa.ListArray.from_arrays(pa.array(np.arange(len(xy) + 1, dtype=np.int32) * xy.shape[1]), pa.array(xy.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(runs, pa.string()), x], ["run", "x"])

        return self.rows.mapInArrow(placed, "run string, x array<double>")


def _some_rows(batches: Iterator[pa.RecordBatch], n_targets: int, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Standardised rows of about CELLS numbers, and their runs."""
    some = max(1, CELLS // max(1, width))
    for batch in batches:
        for first in range(0, batch.num_rows, some):
            part = batch.slice(first, some)
            z, at = standard_rows(part, n_targets)
            yield z, np.array(part.column(0).to_pylist(), object)[at]


def _products(z: np.ndarray) -> np.ndarray:
    """Rows and products of each two of their numbers: twice a product of two rows, taken away, and its square."""
    i, j = np.triu_indices(z.shape[1])
    return np.hstack([z, z[:, i] * z[:, j] * np.where(i == j, 1.0, 2**0.5)])


def _factored(matrix: DataFrame | RunPairs, width: Callable[[int], int]) -> bool:
    """Whether there are many runs, of which none lacks a target, and few numbers that their pairs are products of."""
    return isinstance(matrix, RunPairs) and width(matrix.n_targets) <= GRAM_RUNS < matrix.rows.count() and matrix.whole()


def pca_distances(expr: DataFrame) -> DataFrame:
    """``(run_a, run_b, distance)`` of runs on all axes of their correlation, absent cells being zero."""
    m = RunMatrix(expr)
    matrix = run_pairs(m.map(np.nan_to_num))
    n_axes = min(m.n, m.n_targets)  # there are no more
    if isinstance(matrix, RunPairs) and 0 < m.n_targets <= GRAM_RUNS:
        places = checkpointed(Factors(matrix, lambda z: z, np.ones(m.n_targets), False, m.n_targets).table(), "places")
        return matrix.between(places, m.n_targets)
    matrix = matrix.table().drop("_key") if isinstance(matrix, RunPairs) else matrix
    xy = pca_coordinates(matrix, n_axes)
    place = xy.select("run", F.array(*xy.columns[1:]).alias("x"))
    pairs = matrix.join(place.withColumnsRenamed({"run": "run_a", "x": "a"}), "run_a").join(place.withColumnsRenamed({"run": "run_b", "x": "b"}), "run_b")
    return pairs.select("run_a", "run_b", F.sqrt(F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)).alias("distance"))


def pca_coordinates(matrix: DataFrame | RunPairs, k: int = 5) -> DataFrame:
    """Eigenvectors of the run correlation, scaled by the root of their eigenvalues, signs fixed."""
    if _factored(matrix, lambda t: t):
        return Factors(matrix, lambda z: z, np.ones(matrix.n_targets), False, k).coordinates(k, "pc")
    place, kept = (_placed_by_blocks, matrix) if isinstance(matrix, RunPairs) else (_placed, finite_block(matrix))
    return place(kept, k, lambda r: top_eigen(r, k), lambda times, q, n: times(lambda r: r, q) + q, "pc")


def mds_coordinates(matrix: DataFrame | RunPairs) -> DataFrame:
    """Classic scaling of 1 - r on two axes."""
    if _factored(matrix, lambda t: t * (t + 3) // 2):
        t = matrix.n_targets  # (1 - r) ** 2 less its means, by -1/2: r less half of its square
        return Factors(matrix, _products, np.append(np.ones(t), np.full(t * (t + 1) // 2, -0.5)), True, 2).coordinates(2, "mds")
    def direct(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        j = np.eye(len(r)) - 1 / len(r)
        return top_eigen(-j @ (1 - r) ** 2 @ j / 2, 2)

    def product(times: Callable, q: np.ndarray, n: int) -> np.ndarray:
        y = times(lambda r: (1 - r) ** 2, q - q.mean(0))
        return -(y - y.mean(0)) / 2

    place, kept = (_placed_by_blocks, matrix) if isinstance(matrix, RunPairs) else (_placed, finite_block(matrix))
    return place(kept, 2, direct, product, "mds")
