"""Near-duplicate embeddings by a pivot-permutation index.

Reference vectors (pivots) are a bounded, spread-out sample of the table. Every vector is described by its nearest pivots
in order. It enters the inverted lists of the first few, so a pivot's rank decides whether it retrieves. How many pivots
describe a vector, and how many lists it enters, is measured: of vectors that are no pivots, perturbed copies at just the
threshold must be retrieved with the target recall. Where no setting gets there, all vectors make one list, which is exact. Two
vectors that meet in a list are candidates if their ordered prefixes share enough pivots, and are taken once, in the list
of the smallest pivot at which they meet; the comparison is the exact cosine in double precision. Long lists are dealt into
pairs of blocks. Equal vectors take part as one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import block_count, connected_components, deal_pairs, materialize, sorted_groups, with_block_pairs
from curatrix.llm.jaccard import roots

COSINE = 0.9
#: Numbers of nearest pivots that may describe a vector, tried in turn; how many of them a pair must share, and the share
#: of pairs to be retrieved.
NEAREST, SHARED, TARGET_RECALL = (8, 16, 32, 64, 128), 2, 0.98
#: Vectors on perturbed copies of which recall is measured, and from how many on only those far from all pivots count.
MEASURED, SPREAD = 2000, 100
#: Pivots grow with the root of the number of vectors from the first bound up to so many bytes; alike ones are dropped.
LEAST_PIVOTS, PIVOT_BYTES, PIVOT_COSINE = 64, 64 << 20, 0.7
LIST_BLOCK = 256
#: Products of vectors with pivots at once.
CELLS = 1 << 22


def unit(rows: list) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows or vanishes."""
    m = np.array(rows, np.float64)
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def permutations(units: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Numbers of the nearest pivots of each row, nearest first, ties by number; rows are taken in parts of CELLS products."""
    k, some = min(nearest, len(pivots)), max(1, CELLS // max(1, len(pivots)))
    out = np.empty((len(units), k), np.int32)
    for first in range(0, len(units), some):
        far = -(units[first : first + some] @ pivots.T)
        close = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1)
        order = np.argsort(np.take_along_axis(far, close, axis=1), axis=1, kind="stable")
        out[first : first + some] = np.take_along_axis(close, order, axis=1)
    return out


def retrieved(x: np.ndarray, y: np.ndarray, reach: int, shared: int) -> np.ndarray:
    """Which pairs of permutations (row by row) meet in a list of their first ``reach`` pivots and share enough pivots."""
    both = x[:, :, None] == y[:, None, :]
    return both[:, :reach, :reach].any((1, 2)) & (both.sum((1, 2)) >= shared)


def perturbed(units: np.ndarray, cosine: float, seed: int = 5) -> np.ndarray:
    """A copy of every row at exactly this cosine, in a random direction."""
    noise = np.random.default_rng(seed).normal(size=units.shape)
    noise -= (noise * units).sum(1, keepdims=True) * units
    size = np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * units + (1 - cosine**2) ** 0.5 * np.divide(noise, size, out=np.zeros_like(noise), where=size > 0)


def measured_reach(units: np.ndarray, pivots: np.ndarray, threshold: float = COSINE, target: float = TARGET_RECALL) -> tuple[int, int, int] | None:
    """Pivots that describe a vector, lists that it enters, and pivots that a pair must share, to meet the target just at
    the threshold; the least of each. None if nothing meets it.

    ``units`` are no pivots. Those with a pivot as near as PIVOT_COSINE are easy to find and are left out while enough others are there.
    """
    if not len(units):
        return 1, 1, 1
    nearest = np.concatenate([(units[i : i + 256] @ pivots.T).max(1) for i in range(0, len(units), 256)])
    if (nearest < PIVOT_COSINE).sum() >= SPREAD:
        units = units[nearest < PIVOT_COSINE]
    most = min(NEAREST[-1], len(pivots))
    x, y = permutations(units, pivots, most), permutations(perturbed(units, threshold), pivots, most)
    for k in NEAREST:
        shared = min(SHARED, k, most)
        both = x[:, :k, None] == y[:, None, :k]
        # the list where a pair first meets: the least larger rank of a shared pivot
        larger = np.where(both, np.maximum(np.arange(both.shape[1])[:, None], np.arange(both.shape[2])[None, :]), most).min((1, 2))
        larger = np.where(both.sum((1, 2)) >= shared, larger, most)
        for reach in range(1, min(k, most) + 1):
            if (larger < reach).mean() >= target:
                return min(k, most), reach, shared
        if k >= most:
            break
    return None


def choose_pivots(vectors: DataFrame, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit pivots: the first vectors by hash, without those close to an earlier one; and the next vectors by hash, the sample
    for ``measured_reach``.

    At most PIVOT_BYTES of pivots and MEASURED vectors are collected, as arrays. Up to half of a small table are pivots.
    """
    want = int(max(1, min(PIVOT_BYTES // (8 * size), max(LEAST_PIVOTS, 4 * n**0.5), n // 2)))
    found = vectors.orderBy(F.xxhash64("h1", "h2"), "h1").limit(want + MEASURED).select(F.col("vector").cast("array<double>").alias("v")).toArrow()
    rows = unit(found.column("v").combine_chunks().flatten().to_numpy().reshape(-1, size))
    kept = np.zeros((0, size))
    for first in range(0, want, 256):
        block = rows[first : min(first + 256, want)]
        block = block[(block @ kept.T).max(1, initial=-1.0) < PIVOT_COSINE]
        near, ok = block @ block.T >= PIVOT_COSINE, []
        for i in range(len(block)):
            if not near[i, ok].any():
                ok.append(i)
        kept = np.concatenate([kept, block[ok]]) if ok else kept
    return kept, rows[want:]


def _compare(threshold: float, plan: dict[int, tuple[int, int, int]]):
    """Links of every row of a list (or of two blocks of it), and the smallest row it is linked to, step by step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        for table in sorted_groups(batches, ["pivot", "lo", "hi"]):
            pivot, lo, hi = (table.column(c)[0].as_py() for c in ("pivot", "lo", "hi"))
            node, copies, mine = (table.column(c).to_numpy() for c in ("node", "copies", "mine"))
            vectors = table.column("vector").to_pylist()
            _, reach, shared = plan[len(vectors[0])]
            near = np.array(table.column("near").to_pylist(), np.int64)
            numbers, local = np.unique(near, return_inverse=True)
            local = local.reshape(near.shape)
            has = np.zeros((len(node), len(numbers)), np.float32)
            np.put_along_axis(has, local, 1, axis=1)
            met = np.zeros_like(has)  # the lists before this one that a row enters
            np.put_along_axis(met, local[:, :reach], (near[:, :reach] < pivot).astype(np.float32), axis=1)
            units = unit(vectors)
            a, b = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
            candidate = (has[a] @ has[b].T >= shared) & (met[a] @ met[b].T < 1)
            if lo == hi:
                candidate = np.triu(candidate, 1)
            i, j = np.nonzero(candidate & (units[a] @ units[b].T >= threshold))
            i, j = a[i], b[j]
            links = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
            order = np.argsort(node, kind="stable")
            place = np.empty(len(node), np.int64)
            place[order] = np.arange(len(node))
            root = node[order][roots(len(node), place[i], place[j])[place]]
            for column, values in zip(out, (node, links.astype(np.int64), root)):
                column.append(values[links > 0])
            if sum(map(len, out[0])) > 20_000:
                yield _links(out)
                out = [[], [], []]
        yield _links(out)

    return run


def _links(columns: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in columns], ["node", "links", "root"])


def cosine_links(vectors: DataFrame, threshold: float = COSINE) -> DataFrame:
    """A row per vector: ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, link with
    nothing. Vectors of different lengths are not linked; each length has pivots of its own. A cosine of just the
    threshold links. Repeated rows count as vectors of their own. Other columns, labels among them, are not looked at, so
    their names cannot clash. An empty table gives no row.
    """
    e = F.col("embedding").cast("array<double>")
    ok = F.col("vec_id").isNotNull() & e.isNotNull() & F.exists(e, lambda x: x != 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), F.coalesce(ok, F.lit(False)).alias("ok"), F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    rows = materialize(rows, "vectors")
    classes = materialize(
        rows.where("ok").groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")), "distinct-vectors"
    )
    spark, kind = vectors.sparkSession, dict(rows.dtypes)["vector"]
    of_length, plan, first = {}, {}, 0
    for size, n in classes.groupBy(F.size("vector").alias("size")).count().orderBy("size").collect():  # as many rows as lengths
        pivots, sample = choose_pivots(classes.where(F.size("vector") == size), n, size)
        found = measured_reach(sample, pivots, threshold)
        if found is None:  # one list of all, dealt into pairs of blocks
            pivots, found = pivots[:1], (1, 1, 1)
        of_length[size], plan[size] = (pivots, first), found
        first += len(pivots)
    sent = spark.sparkContext.broadcast(of_length)  # PIVOT_BYTES at most for a length

    def describe(batches):
        for batch in batches:
            length = np.array([len(v) for v in batch.column(2).to_pylist()])
            for size in np.unique(length):
                part = batch.take(pa.array(np.flatnonzero(length == size)))
                pivots, number = sent.value[int(size)]
                near = permutations(unit(part.column(2).to_pylist()), pivots, plan[int(size)][0]) + number
                reach = pa.array([plan[int(size)][1]] * len(near), pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(near.tolist(), pa.list_(pa.int32())), reach], ["node", "copies", "vector", "near", "reach"])

    index = materialize(classes.select("node", "copies", "vector").mapInArrow(describe, f"node long, copies long, vector {kind}, near array<int>, reach int"), "pivot-index")
    lists = index.withColumn("pivot", F.explode(F.slice("near", 1, F.col("reach")))).drop("reach")
    sizes = lists.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))  # a row per pivot, PIVOT_BYTES of them at most for a length
    dealt = lists.join(F.broadcast(sizes.withColumn("blocks", block_count(F.col("n"), LIST_BLOCK))), "pivot").where("n > 1").drop("n")
    dealt = deal_pairs(with_block_pairs(dealt, "blocks", F.xxhash64("node")), F.xxhash64("pivot")).sortWithinPartitions("pivot", "lo", "hi")

    found = materialize(dealt.mapInArrow(_compare(threshold, plan), "node long, links long, root long"), "cosine-links")
    over = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links")).join(over, "node", "left")
    result = classes.select("h1", "h2", "node", "copies").join(links, "node", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")
    )
    out = rows.select("vec_id", "ok", "h1", "h2").join(result, ["h1", "h2"], "left")
    return out.select(
        "vec_id", F.when(F.col("ok"), F.col("n_links")).otherwise(0).cast("long").alias("n_links"), F.when(F.col("ok"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
