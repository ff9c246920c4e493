"""What several operators share: the shared folder, written intermediates, sorted-group streams and components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.session import checkpointed as materialize
from curatrix.session import forget

#: Rows and bytes of text that a task works on at once (at least one row).
ROWS_AT_ONCE, BYTES_AT_ONCE = 4096, 2 << 20


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns whose names (in any letter case) an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Groups of a stream sorted by ``keys``, one table each; holds one group at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = list(zip(*(table.column(k).to_pylist() for k in keys)))
        begin = 0
        for i, v in enumerate(values):
            if last is not None and v != last:
                if i > begin:
                    held.append(table.slice(begin, i - begin))
                yield pa.concat_tables(held)
                held, begin = [], i
            last = v
        held.append(table.slice(begin))
    if held:
        yield pa.concat_tables(held)


def rows_at_once(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded rows and bytes of its text ``column``."""
    size, at = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()), 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(size, (size[at - 1] if at else 0) + BYTES_AT_ONCE, "right"))
        stop = max(at + 1, min(upto, at + ROWS_AT_ONCE))
        yield batch.slice(at, stop - at)
        at = stop


def release() -> None:
    """Give memory of freed Arrow arrays back at the end of a task; workers stay for the tasks of later stages."""
    pa.default_memory_pool().release_unused()


def ragged(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each entry has."""
    return np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


def gather(pool: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the ``wanted`` entries one after another, and where each ends."""
    n = size[wanted]
    stop = np.cumsum(n)
    return pool[np.repeat((np.cumsum(size) - size)[wanted] - stop + n, n) + np.arange(stop[-1] if len(stop) else 0)], stop


def list_bounds(lists: pa.ListArray, stop: np.ndarray) -> np.ndarray:
    """Bounds of each list's ids, from the ends of its entries' ids."""
    return np.concatenate([[0], stop])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of an undirected edge list ``(a, b)``; the component is its smallest node.

    Every round takes the smallest label among neighbours, then jumps to the label's own label, so
    chains shorten by doubling. Nothing is collected; each round is a written table that replaces the one before.
    Nodes without an edge do not appear. Null ends are ignored.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    pairs = materialize(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(pairs.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    before = labels
    for _ in range(max_rounds):
        near = (
            pairs.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        own = labels.select(F.col("node").alias("mid"), F.col("component").alias("jump"))
        nxt = materialize(step.join(own, "mid").select("node", F.least("mid", "jump").alias("component"), "old"), "labels")
        moved = nxt.where("component <> old").limit(1).count()
        forget(before)
        before, labels = nxt, nxt.select("node", "component")
        if not moved:
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def member_filter(nodes: DataFrame, bits: int, of: Column | None = None) -> np.ndarray:
    """A bit map of hashed ids (of ``node``, if no hash is given), made of sums per task: ``bits`` / 8 bytes."""
    slot = F.pmod(F.xxhash64("node") if of is None else of, F.lit(bits)) + 1
    maps = nodes.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for k, m in maps:
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(bytes(m), np.uint8)
    return out


#: Bits of a map for each member, bits of a map at least and at most, and maps of a cascade.
BITS_A_MEMBER, LEAST_BITS, MOST_BITS, MAPS = 32, 1 << 16, 1 << 28, 8


class Members:
    """Which ids of a known set are members, by a cascade of bit maps: exact, and of bounded size.

    The first map holds the members; ids that hit it by chance are in the second; members that hit that one are in the third, and so
    on, until nothing is left that a map takes for its opposite. Only ids are shuffled. Where members are so many that
    maps of full size leave ids open, ``open`` is true, and ids that pass all maps are to be looked up by a join.
    """

    def __init__(self, ids: DataFrame, members: DataFrame, name: str = "doc_id"):
        known = ids.select(F.col(name).cast("long").alias("node")).where("node is not null").distinct()
        marked = known.join(members.select(F.col(name).cast("long").alias("node")).where("node is not null").distinct().withColumn("member", F.lit(True)), "node", "left")
        self.rows = materialize(marked.select("node", F.coalesce("member", F.lit(False)).alias("member")), "members")
        self.maps: list[np.ndarray] = []
        left = {r["member"]: r["count"] for r in self.rows.groupBy("member").count().collect()}
        for k in range(MAPS):
            holds = k % 2 == 0
            if not left.get(holds):
                break
            bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_MEMBER * left[holds] - 1).bit_length()))
            passed = self._passed()
            self.maps.append(member_filter(passed.where(F.col("member") == holds), bits, F.xxhash64(F.lit(k), "node")))
            left = {r["member"]: r["count"] for r in self._passed().groupBy("member").count().collect()}
        self.open = bool(self.maps and left.get(len(self.maps) % 2 == 0))
        forget(self.rows)

    @staticmethod
    def hashes(name: str = "node") -> Column:
        """What ``levels`` and ``is_member`` look at, made beside the rows."""
        return F.array(*[F.xxhash64(F.lit(k), F.col(name).cast("long")) for k in range(MAPS)])

    def _passed(self) -> DataFrame:
        if not self.maps:
            return self.rows
        sent = self.rows.sparkSession.sparkContext.broadcast(self.maps)  # MOST_BITS a map at most

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.select([0, 1]).filter(pa.array(levels(sent.value, batch.column(2)) == len(sent.value), pa.bool_()))

        return self.rows.select("node", "member", self.hashes()).mapInArrow(keep, "node long, member boolean")


def levels(maps: list[np.ndarray], hashes: pa.ListArray) -> np.ndarray:
    """How many maps each id passes before the first that does not hold it."""
    each = hashes.flatten().to_numpy().reshape(max(1, len(hashes)), -1)[: len(hashes)]
    out, going = np.zeros(len(each), np.int64), np.ones(len(each), bool)
    for k, m in enumerate(maps if len(each) else ()):
        slot = each[:, k] & (8 * len(m) - 1)
        going &= (m[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
        out += going
    return out


def is_member(maps: list[np.ndarray], hashes: pa.ListArray, still_open: bool = False) -> np.ndarray:
    """Ids that a map of non-members does not hold, or that pass all maps, the last being one of members, if nothing is open."""
    passed = levels(maps, hashes)
    return (passed % 2 == 1) & ~(still_open & (passed == len(maps)))


def block_count(size, block: int):
    """Column: how many blocks of about ``block`` rows hold ``size`` rows."""
    return F.greatest(F.lit(1), F.ceil(size / F.lit(float(block)))).cast("int")


def with_block_pairs(df: DataFrame, blocks: str, salt) -> DataFrame:
    """Deal a group of ``blocks`` blocks into pairs of blocks ``(lo, hi)`` that together hold every pair of rows once.

    A row goes to the ``blocks`` pairs that its own block is part of; a group of one block stays one group.
    ``mine`` is the row's block.
    """
    return (
        df.withColumn("mine", F.pmod(salt, F.col(blocks)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn("lo", F.least("mine", "other"))
        .withColumn("hi", F.greatest("mine", "other"))
        .drop("other", blocks)
    )


def deal_pairs(df: DataFrame, group) -> DataFrame:
    """Partition by ``group`` (a hash) and block pair ``(lo, hi)``; the pairs of one group go to partitions in turn, so that
    as few as possible of a large group's meet in one."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pair = F.col("hi").cast("long") * (F.col("hi") + 1) / 2 + F.col("lo")
    return df.repartitionById(n, F.pmod(F.pmod(group, F.lit(n)) + pair.cast("long"), F.lit(n)).cast("int"))
