"""Hard-negative mining with rotated one-bit codes.

Vectors are whole numbers. Each is turned by a fixed rotation (signs and Hadamard steps) and described by a few one-bit codes:
the signs of what is left of its direction, and how far that is aligned with them (stored), code after code. An anchor's
rotated direction is quantised to four bits, so that its product with a code is a sum of popcounts of bit planes. Codes
and alignments estimate a score; the part of the vector that no code holds is at right angles to none of the anchor for certain,
so Cauchy-Schwarz bounds it by its stored length. A pair outside every wanted interval is passed over; the rest are
scored in whole numbers, so results are exact.

Anchors meet rows in blocks: a task holds a block of rows and a block of anchors, and both grow with the table between fixed
bounds. A block pair sends only its best few rows for each anchor, which a window then ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import materialize, sorted_groups

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 80, 100
#: Components are floored after this factor.
SCALE = 256
#: Codes of a vector, and bits of an anchor's components.
CODES, BITS = 3, 4
SEED = 13
#: Least rows of a block, and most components of its rows together; the same of anchors.
ROWS, ANCHORS = (1024, 1 << 22), (1024, 1 << 18)
#: Cells (anchors times rows) that are estimated at once.
CELLS = 1 << 20


def signs(size: int, seed: int = SEED) -> np.ndarray:
    """Three rows of fixed signs for a rotation of ``size`` dimensions."""
    return np.random.default_rng([seed, size]).integers(0, 2, (3, size)) * 2.0 - 1.0


def rotate(units: np.ndarray) -> np.ndarray:
    """Rows padded to a power of two (64 at least), turned by three steps of signs and a Hadamard matrix; lengths stay."""
    size = max(64, 1 << (units.shape[1] - 1).bit_length())
    out = np.zeros((len(units), size))
    out[:, : units.shape[1]] = units
    for s in signs(size):
        out *= s
        width = 1
        while width < size:
            pair = out.reshape(len(out), -1, 2, width)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(len(out), size)
            width *= 2
        out /= size**0.5
    return out


def packed(bits: np.ndarray) -> np.ndarray:
    """Bits of the last axis as unsigned 64-bit words."""
    return np.packbits(bits, axis=-1).view(np.uint64)


def encode(units: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows, codes, words), alignments (rows, codes), and the length of what is left of each direction."""
    rest = rotate(units)
    root = rest.shape[1] ** 0.5
    out, aligned = [], []
    for _ in range(codes):
        up = rest >= 0
        b = np.where(up, 1 / root, -1 / root)
        a = (rest * b).sum(1)
        rest = rest - a[:, None] * b
        out.append(packed(up))
        aligned.append(a)
    return np.stack(out, 1), np.stack(aligned, 1), np.linalg.norm(rest, axis=1)


class Anchors:
    """Rotated directions of anchors in bit planes."""

    def __init__(self, units: np.ndarray):
        turned = rotate(units)
        self.size = turned.shape[1]
        low, high = turned.min(1, keepdims=True), turned.max(1, keepdims=True)
        step = np.maximum((high - low) / ((1 << BITS) - 1), 1e-300)
        level = np.clip(np.rint((turned - low) / step), 0, (1 << BITS) - 1).astype(np.uint8)
        near = low + step * level
        self.planes = np.stack([packed(level >> k & 1) for k in range(BITS)], 1)
        self.low, self.step, self.total = low[:, 0], step[:, 0], level.sum(1, dtype=np.int64)
        #: What rounding moves at most, and the length of what is compared.
        self.moved, self.length = np.linalg.norm(turned - near, axis=1), np.linalg.norm(near, axis=1)

    def interval(self, at: slice, codes: np.ndarray, aligned: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the cosine of each anchor of ``at`` (rows) with each coded vector (columns)."""
        planes, low, step, total = self.planes[at], self.low[at, None], self.step[at, None], self.total[at, None]
        middle = np.zeros((len(planes), len(codes)))
        for c in range(codes.shape[1]):
            weighted = np.zeros(middle.shape, np.int32)
            for k in range(BITS):
                for w in range(codes.shape[2]):
                    weighted += np.bitwise_count(planes[:, k, w][:, None] & codes[:, c, w]).astype(np.int32) << k
            ones = np.bitwise_count(codes[:, c]).sum(1, dtype=np.int64)
            # the product with signs: twice the sum where the code is up, less the sum of all
            middle += aligned[:, c] * (low * (2 * ones - self.size) + step * (2.0 * weighted - total)) / self.size**0.5
        give = left * self.length[at, None] + self.moved[at, None] + 1e-9
        return middle - give, middle + give


def _whole(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("vector").to_pylist()), "<i4").reshape(table.num_rows, -1).astype(np.float64)


def scores(rows: np.ndarray, anchor: np.ndarray, norms: np.ndarray, norm: float) -> np.ndarray:
    """Whole inner products; in doubles as long as these are exact."""
    if not len(rows) or norms.max() * norm < 2.0**52:
        return (rows @ anchor).astype(np.int64)
    return rows.astype(np.int64) @ anchor.astype(np.int64)


class Block:
    """The rows of a block, and which of them an anchor may want."""

    def __init__(self, table: pa.Table):
        self.id, self.label = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        self.vector = _whole(table)
        self.norm = np.linalg.norm(self.vector, axis=1)
        stored = np.frombuffer(b"".join(table.column("aligned").to_pylist()), "<f8").reshape(len(self.id), -1)
        self.aligned, self.left = stored[:, :-1], stored[:, -1]
        self.codes = np.frombuffer(b"".join(table.column("code").to_pylist()), "<u8").reshape(*self.aligned.shape, -1)

    def intervals(self, table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, float]]:
        """Number, vector, bounds of all scores, and length of each anchor."""
        vector = _whole(table)
        norm = np.linalg.norm(vector, axis=1)
        turned = Anchors(vector / np.maximum(norm, 1)[:, None])
        some = max(1, CELLS // max(1, len(self.id)))
        for first in range(0, len(vector), some):
            at = slice(first, min(first + some, len(vector)))
            low, high = turned.interval(at, self.codes, self.aligned, self.left)
            for i in range(at.start, at.stop):
                size = self.norm * norm[i]
                yield i, vector[i], low[i - first] * size - 1e-6, high[i - first] * size + 1e-6, norm[i]

    def first(self, rows: np.ndarray, got: np.ndarray, k: int) -> np.ndarray:
        """Places in ``rows`` of the first ``k`` by score, ties by id."""
        if len(rows) > k:
            edge = np.partition(got, len(got) - k)[len(got) - k]
            some = np.flatnonzero(got >= edge)
        else:
            some = np.arange(len(rows))
        return some[np.lexsort((self.id[rows[some]], -got[some]))[:k]]


def kth_largest(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.Table]]:
    """Blocks of rows with the anchors that they meet, from a stream sorted by block pair and side."""
    for group in sorted_groups(batches, ["row_block", "anchor_block"]):
        split = int((group.column("side").to_numpy() == 0).sum())
        if 0 < split < group.num_rows:
            yield Block(group.slice(0, split)), group.slice(split)


def _positives(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors in _pairs(batches):
            ids, labels = anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist()
            out: list[list] = [[], [], []]
            for i, q, low, high, norm in block.intervals(anchors):
                same = np.flatnonzero((block.label == labels[i]) & (block.id != ids[i]))
                may = same[high[same] >= kth_largest(low[same], k)]
                got = scores(block.vector[may], q, block.norm[may], norm)
                top = block.first(may, got, k)
                for column, values in zip(out, (np.full(len(top), ids[i]), block.id[may[top]], got[top])):
                    column.append(values)
            yield _batch(out, ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int, low_share: int, high_share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, anchors in _pairs(batches):
            ids, labels, wanted = (anchors.column(c).to_pylist() for c in ("vec_id", "label", "positives"))
            out: list[list] = [[] for _ in range(5)]
            for i, q, low, high, norm in block.intervals(anchors):
                other = np.flatnonzero(block.label != labels[i])
                a, b = low[other], high[other]
                spans = [(p, s, -(-low_share * s // 100), high_share * s // 100) for p, s in ((x["positive_id"], x["positive_score"]) for x in wanted[i])]
                may = np.zeros(len(other), bool)
                for _, _, least, most in spans:
                    if least <= most:
                        sure = a[(a >= least) & (b <= most)]
                        may |= (b >= max(least, kth_largest(sure, k))) & (a <= most)
                rows = other[may]
                got = scores(block.vector[rows], q, block.norm[rows], norm)
                for p, s, least, most in spans:
                    fit = np.flatnonzero((got >= least) & (got <= most))
                    top = fit[block.first(rows[fit], got[fit], k)]
                    for column, values in zip(out, (np.full(len(top), ids[i]), np.full(len(top), p), block.id[rows[top]], np.full(len(top), s), got[top])):
                        column.append(values)
            yield _batch(out, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    return run


def _batch(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64), pa.int64()) for c in columns], names)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, vector`` (components floored after ``scale``, as little-endian 32-bit words), ``size``, and the stored
    ``code`` and ``aligned`` (alignments, then what is left) of rows that take part."""
    e = F.col("embedding").cast("array<double>")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite
    rows = vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("vector"))

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS[0]):
                part = batch.slice(first, ROWS[0])
                lists = part.column(2)
                size = np.diff(lists.offsets.to_numpy())
                with np.errstate(over="ignore", invalid="ignore"):
                    each = np.split(np.floor(lists.flatten().to_numpy() * scale), np.cumsum(size)[:-1])
                    fits = np.array([x @ x < 2.0**62 for x in each], bool)
                words, codes, aligned = ([None] * len(each) for _ in range(3))
                for n in np.unique(size[fits]):
                    at = np.flatnonzero(fits & (size == n))
                    whole = np.stack([each[i] for i in at])
                    code, along, left = encode(whole / np.maximum(np.linalg.norm(whole, axis=1), 1)[:, None])
                    for i, w, c, a in zip(at, whole.astype("<i4"), code, np.column_stack([along, left])):
                        words[i], codes[i], aligned[i] = w.tobytes(), c.tobytes(), a.tobytes()
                columns = [part.column(0), part.column(1), *(pa.array(x, pa.binary()) for x in (words, codes, aligned)), pa.array(size, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "code", "aligned", "size"]).filter(pa.array(fits, pa.bool_()))

    return rows.mapInArrow(floor, "vec_id long, label long, vector binary, code binary, aligned binary, size int")


def _meet(rows: DataFrame, anchors: DataFrame, row_blocks: Column, anchor_blocks: Column) -> DataFrame:
    """Every block of rows beside every block of anchors of the same length of vector, dealt to partitions in turn.

    A block is part of a length, so vectors of other lengths never meet; ``first`` numbers the blocks of a length on.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mine = F.pmod(F.xxhash64("vec_id", "vector"), F.col("row_blocks")).cast("int")
    left = rows.withColumns({"row_block": mine, "anchor_block": F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)), "side": F.lit(0)})
    own = F.pmod(F.xxhash64("vec_id"), F.col("anchor_blocks")).cast("int")
    right = anchors.withColumns({"anchor_block": own, "row_block": F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)), "side": F.lit(1)})
    both = left.unionByName(right, allowMissingColumns=True)
    pair = F.col("first").cast("long") + F.col("row_block").cast("long") * F.col("anchor_blocks") + F.col("anchor_block")
    both = both.withColumns({"row_block": (F.col("first") + F.col("row_block")).cast("long"), "part": F.pmod(pair, F.lit(n)).cast("int")}).drop("first", "row_blocks", "anchor_blocks", "size")
    return both.repartitionById(n, "part").drop("part").sortWithinPartitions("row_block", "anchor_block", "side")


def _blocks(n: Column, bounds: tuple[int, int], target: int) -> Column:
    """Blocks for ``n`` rows of vectors of ``size``: about ``target`` of them, none smaller or larger than the bounds."""
    size = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]) / F.col("size"), F.ceil(n / target)))
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def mine(vectors: DataFrame, is_anchor: str | Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """A row per anchor, positive and hard negative: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id, label, embedding``; ``is_anchor`` is a condition on ``vec_id`` and ``label``. An anchor's positives are its
    best other rows of the same label, its negatives the best rows of other labels with a score of ``low`` to ``high`` hundredths of
    the positive's; ties go to the smaller id. A positive without one gives no row, and neither does a negative score.
    Rows with a null id, label or vector, with no, null or non-finite components, and rows whose whole-number length reaches 2^31 (their
    products leave 64 bits) take no part. Vectors of another length than the anchor's are not compared with it. Repeated rows take part each,
    but never with an anchor of their own id; of anchors with one id the first by label and vector counts. Other columns, whatever their names, are
    not looked at. An empty table gives no row.
    """
    rows = materialize(whole_vectors(vectors, scale), "whole-vectors")
    condition = F.expr(is_anchor) if isinstance(is_anchor, str) else is_anchor
    anchors = rows.where(condition).groupBy("vec_id").agg(F.min(F.struct("label", "vector", "size")).alias("_a")).select("vec_id", "_a.*")
    target = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if(condition).alias("k"))
    shape = sizes.select("size", _blocks(F.col("n"), ROWS, target).alias("row_blocks"), _blocks(F.col("k"), ANCHORS, target).alias("anchor_blocks"))
    first = F.coalesce(F.sum(F.col("row_blocks").cast("long")).over(Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shape = F.broadcast(materialize(shape.withColumn("first", first), "block-shape"))  # a row per length of vector
    rows, anchors = rows.join(shape, "size"), materialize(anchors, "anchors").join(shape, "size")

    found = _meet(rows, anchors, F.col("row_blocks"), F.col("anchor_blocks")).mapInArrow(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = found.withColumn("_r", best).where(F.col("_r") <= positives)
    chosen = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # a few
    anchors = materialize(anchors.join(chosen, "vec_id"), "anchors-with-positives")
    both = _meet(rows, anchors, F.col("row_blocks"), F.col("anchor_blocks"))
    mined = both.mapInArrow(_negatives(negatives, low, high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return mined.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
