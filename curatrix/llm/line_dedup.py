"""Line dedup with a sharded minimal perfect hash over distinct line hashes.

Lines are counted by a 128-bit hash of their key, first inside each task, then over the corpus. Distinct hashes that two
documents hold at least are dealt into shards by their leading bits (a line of one document goes at no threshold, so it
needs no entry); each shard is built into a minimal perfect hash (bit levels with ranks) that indexes compact fingerprint,
count and holder arrays. Documents probe the arrays: a line is frequent if its fingerprint is the one stored at its index
and the count there reaches the threshold. While the arrays are small (their size is known before they are sent) every
task gets all of them, and no line and no text is shuffled. Beyond that size, line hashes are dealt by shard to the arrays,
in as many pieces as their number asks for, and the hits come back by document. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fresh, materialize

MIN_CHARS = 20
MIN_DOCS = 3
#: Hashes a shard holds on average, and bytes of arrays that are sent to every task at most.
SHARD_KEYS = 200_000
BROADCAST_BYTES = 32 << 20
#: Line hashes that are dealt to one copy of a shard's arrays, about.
PROBED_LINES = 4_000_000
#: Distinct lines that a task counts before it passes the counts on.
HELD_LINES = 300_000
NO_ID = -(1 << 63)

_MIX, _ALL = 0x9E3779B97F4A7C15, (1 << 64) - 1
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (keys ^ np.uint64((level + 1) * _MIX & _ALL)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(29))) % np.uint64(size)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: each level keeps the slots that one key alone falls on."""

    def __init__(self, levels: list[tuple[int, np.ndarray]]):
        self.levels, base = [], 0
        for size, bits in levels:
            ones = _ONES[bits]
            ranks = np.concatenate([[0], np.cumsum(ones)])[:-1] + base
            self.levels.append((size, bits, ranks))
            base += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            size = max(64, 2 * len(rest))
            at = _slot(rest, len(levels), size)
            count = np.bincount(at.astype(np.int64), minlength=size)
            levels.append((size, np.packbits(count == 1, bitorder="little")))
            rest = rest[count[at.astype(np.int64)] > 1]
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """0 .. n-1 for the n keys that it was built from; any other key gives any index or -1."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, bits, ranks) in enumerate(self.levels):
            if not len(todo):
                break
            at = _slot(keys[todo], level, size).astype(np.int64)
            byte, bit = bits[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            before = byte[hit] & ((np.uint16(1) << bit[hit].astype(np.uint16)) - 1).astype(np.uint8)
            out[todo[hit]] = ranks[at[hit] >> 3] + _ONES[before]
            todo = todo[~hit]
        return out


class LineIndex:
    """Perfect hash of a shard with fingerprints, document counts and the largest holder of each line."""

    def __init__(self, row: dict):
        sizes = row["sizes"]
        cut = np.cumsum([0] + [(s + 7) // 8 for s in sizes])
        bits = np.frombuffer(row["bits"], np.uint8)
        self.hash = PerfectHash([(s, bits[a:b]) for s, a, b in zip(sizes, cut, cut[1:])])
        self.prints, self.counts, self.holders = np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["counts"], np.int32), np.frombuffer(row["holders"], np.int64)
        self.twins = np.frombuffer(row["twins"], np.int64).reshape(-1, 4)

    def dropped(self, h1: np.ndarray, h2: np.ndarray, owner: np.ndarray, min_docs: int) -> np.ndarray:
        """Which lines go: found in enough documents, and held by another document than theirs."""
        at = self.hash.index(h1)
        safe = np.maximum(at, 0)
        if not len(self.prints):
            return np.zeros(len(h1), bool)
        drop = (at >= 0) & (self.prints[safe] == h2) & (self.counts[safe] >= min_docs) & (self.holders[safe] != owner)
        for a, b, docs, holder in self.twins:
            same = (h1.view(np.int64) == a) & (h2.view(np.int64) == b)
            drop = np.where(same, (docs >= min_docs) & (holder != owner), drop)
        return drop


def _shard_row(shard: int, pdf: pd.DataFrame) -> dict:
    pdf = pdf.sort_values(["h1", "h2"])
    # different lines whose hashes share the first half are next to impossible, but not wrong: all but one go beside the arrays
    twin = pdf.duplicated("h1").to_numpy()
    held = int(pdf["docs"].sum())
    twins, pdf = pdf.loc[twin, ["h1", "h2", "docs", "holder"]].to_numpy(np.int64), pdf.loc[~twin]
    h1, h2 = pdf["h1"].to_numpy(np.int64).view(np.uint64), pdf["h2"].to_numpy(np.int64).view(np.uint64)
    ph = PerfectHash.build(h1)
    at = ph.index(h1)
    prints, counts, holders = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
    prints[at], counts[at], holders[at] = h2, np.minimum(pdf["docs"], 2**31 - 1), pdf["holder"]
    return {"shard": shard, "held": held, "sizes": [s for s, _, _ in ph.levels], "bits": b"".join(b.tobytes() for _, b, _ in ph.levels), "prints": prints.tobytes(), "counts": counts.tobytes(), "holders": holders.tobytes(), "twins": twins.tobytes()}


INDEX = "shard int, held long, sizes array<int>, bits binary, prints binary, counts binary, holders binary, twins binary"


def keys_of(text: str | None, min_chars: int) -> tuple[list[bytes], list[int], list[bytes]]:
    """The lines of a text, and where keys of at least ``min_chars`` code points stand, with those keys."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at, keys = [], []
    for i, k in enumerate(data.lower().split(b"\n")):  # bytes: only A-Z change and only ASCII white space is stripped
        if len(k) >= min_chars:
            k = k.strip()
            if len(k) >= min_chars and (k.isascii() or len(k.decode("utf-8", "surrogatepass")) >= min_chars):
                at.append(i)
                keys.append(k)
    return data.split(b"\n"), at, keys


def _halves(keys: list[bytes]) -> np.ndarray:
    """(n, 2) unsigned halves of the keys' 128-bit hashes."""
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), ">u8").astype(np.uint64).reshape(-1, 2)


def count_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, docs, holder) per distinct line key; every task passes on sums, so a line of all documents is a row per task."""
    def partial(batches):
        held: dict[bytes, list[int]] = {}

        def flush():
            h = np.frombuffer(b"".join(held), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
            docs_, holder = zip(*held.values())
            return pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(docs_, pa.int64()), pa.array(holder, pa.int64())], ["h1", "h2", "docs", "holder"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                doc = NO_ID if doc is None else doc
                for k in set(keys_of(text, min_chars)[2]):
                    d = xxhash.xxh3_128_digest(k)
                    got = held.get(d)
                    if got is None:
                        held[d] = [1, doc]
                    else:
                        got[0] += 1
                        if doc > got[1]:
                            got[1] = doc
                if len(held) > HELD_LINES:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial, "h1 long, h2 long, docs long, holder long")
    return counted.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("holder").alias("holder"))


def line_index(docs: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """One row of arrays per shard, and the number of shard bits, which grows with the number of lines that repeat."""
    repeated = materialize(count_lines(docs, min_chars).where("docs > 1"), "repeated-lines")
    bits = max(0, (max(1, repeated.count()) // shard_keys).bit_length())

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_shard_row(int(pdf["shard"].iloc[0]), pdf)])

    return materialize(repeated.withColumn("shard", _shard(bits)).groupBy("shard").applyInPandas(build, INDEX), "line-index"), bits


def _shard(bits: int):
    return F.shiftrightunsigned("h1", 64 - bits).cast("int") if bits else F.lit(0)


def _decide(texts: list, ids: list, min_chars: int, lookup) -> tuple[list, list, list]:
    """Kept text, n_lines and n_dropped of each document; ``lookup`` tells which (hash, document) pairs go."""
    split = [keys_of(t, min_chars) for t in texts]
    h = _halves([k for _, _, keys in split for k in keys])
    owner = np.repeat(np.array([NO_ID if i is None else i for i in ids], np.int64), [len(k) for _, _, k in split]) if len(ids) else np.zeros(0, np.int64)
    drop, at = lookup(h[:, 0], h[:, 1], owner), 0
    kept, n_lines, n_dropped = [], [], []
    for text, (lines, where, keys) in zip(texts, split):
        gone = {i for i, d in zip(where, drop[at : at + len(keys)]) if d}
        at += len(keys)
        kept.append(b"\n".join([x for i, x in enumerate(lines) if i not in gone]).decode("utf-8", "surrogatepass") if gone else text)
        n_lines.append(len(lines))
        n_dropped.append(len(gone))
    return kept, n_lines, n_dropped


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: bool = False, broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Every document with ``text`` without repeated lines, ``n_lines`` (before) and ``n_dropped``.

    A line goes when its key (ASCII white space stripped at both ends, A-Z lower-cased) has at least ``min_chars``
    code points and is found in at least ``min_docs`` rows, unless the document is the largest ``doc_id`` holding it;
    that one keeps all of its copies. A null or empty text is one empty line and stays as it is; rows that repeat a
    ``doc_id`` count as documents of their own and are kept or cut alike; a null ``doc_id`` is smaller than any other.
    Ties need no order, since a line has one holder. Texts are read whole, however long. An empty table gives no row.
    With ``carry`` all columns of ``docs`` stay (those named ``n_lines`` or ``n_dropped`` are replaced).
    """
    docs = fresh(docs, "n_lines", "n_dropped") if carry else docs.select("doc_id", "text")
    if min_docs < 2:
        raise ValueError("a line of one document is no repeated line")
    index, bits = line_index(docs, min_chars, shard_keys)
    size = index.agg(F.sum(sum(F.length(c) for c in ("bits", "prints", "counts", "holders", "twins")))).first()[0] or 0
    if size > broadcast_bytes:
        return _routed(docs, index, bits, min_chars, min_docs)

    rows = {r["shard"]: r.asDict() for r in index.collect()}
    sent = docs.sparkSession.sparkContext.broadcast(rows)
    names, (doc_at, text_at) = docs.columns, (docs.columns.index("doc_id"), docs.columns.index("text"))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {k: LineIndex(v) for k, v in sent.value.items()}

        def lookup(h1, h2, owner):
            drop, of = np.zeros(len(h1), bool), (h1 >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h1), np.int64)
            for s in np.unique(of):
                if int(s) in shards:
                    mine = np.flatnonzero(of == s)
                    drop[mine] = shards[int(s)].dropped(h1[mine], h2[mine], owner[mine], min_docs)
            return drop

        for batch in batches:
            kept, n_lines, n_dropped = _decide(batch.column(text_at).to_pylist(), batch.column(doc_at).to_pylist(), min_chars, lookup)
            cols = [pa.array(kept, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(rewrite, f"{own}, n_lines long, n_dropped long")


def _routed(docs: DataFrame, index: DataFrame, bits: int, min_chars: int, min_docs: int) -> DataFrame:
    """The way for arrays of any size: hashes stream past their shard's arrays in pieces of the corpus, hits come back."""
    docs = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "docs")

    def hashes(batches):
        for batch in batches:
            out = [[], [], [], []]
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                _, at, keys = keys_of(text, min_chars)
                h = _halves(keys).view(np.int64)
                for o, v in zip(out, ([row] * len(at), [NO_ID if doc is None else doc] * len(at), at, h)):
                    o.extend(v)
            h = np.array(out[3], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1])], ["_row", "owner", "line", "h1", "h2"])

    lines = docs.select("_row", "doc_id", "text").mapInArrow(hashes, "_row long, owner long, line int, h1 long, h2 long")
    # lines of a shard: those it knows, and its part of the others, which hashes spread evenly
    n_lines = docs.agg(F.sum(F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)))).first()[0] or 0
    salts = F.ceil((F.col("held") + F.lit(n_lines / (1 << bits))) / PROBED_LINES).cast("int")
    copies = materialize(index.select("shard", salts.alias("salts")), "copies")  # a row per shard
    left = lines.withColumn("shard", _shard(bits)).join(F.broadcast(copies), "shard").withColumn("salt", F.pmod(F.xxhash64("_row", "line"), F.col("salts")).cast("int"))
    right = index.join(F.broadcast(copies), "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    both = left.withColumn("of_line", F.lit(True)).unionByName(right.withColumn("of_line", F.lit(False)), allowMissingColumns=True).drop("salts", "held")
    dealt = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", "of_line")  # the arrays come before their lines

    def probe(batches):
        arrays = None
        for batch in batches:
            begins = np.flatnonzero(~batch.column("of_line").to_numpy(zero_copy_only=False))
            for a, b in zip([-1, *begins.tolist()], [*begins.tolist(), batch.num_rows]):
                if a >= 0:
                    arrays = LineIndex({k: batch.column(k)[a].as_py() for k in ("sizes", "bits", "prints", "counts", "holders", "twins")})
                mine = batch.slice(a + 1, b - a - 1)
                if mine.num_rows:
                    h1, h2, owner = (mine.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("h1", "h2", "owner"))
                    gone = pa.array(np.flatnonzero(arrays.dropped(h1.view(np.uint64), h2.view(np.uint64), owner, min_docs)))
                    yield pa.RecordBatch.from_arrays([mine.column("_row").take(gone), mine.column("line").take(gone)], ["_row", "line"])

    hits = dealt.mapInArrow(probe, "_row long, line int")
    gone = hits.groupBy("_row").agg(F.collect_set("line").alias("_gone"))
    joined = docs.join(gone, "_row", "left").withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>")))
    lines_of = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    kept = F.array_join(F.filter(lines_of, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    names = [F.col(f"`{c}`") if c != "text" else F.when(F.size("_gone") > 0, kept).otherwise(F.col("text")).alias("text") for c in docs.columns if c != "_row"]
    return joined.select(*names, F.size(lines_of).cast("long").alias("n_lines"), F.size("_gone").cast("long").alias("n_dropped"))
