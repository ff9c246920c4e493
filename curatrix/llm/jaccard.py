"""N-gram Jaccard join: a MinHash LSH forest finds candidates, exact comparison of shingle sets decides.

Documents with the same shingle set form a class, found by one aggregation, and take part as one representative.
Each of the forest's trees is a trie of representatives, sorted by the tree's own stretch of their signatures. The trie is
dealt by its shortest useful prefix, the longest at which the expected share of pairs at the threshold that meet in some
tree reaches the target recall. Inside such a subtree rows are matched at full depth first; then the prefix is shortened
level by level, and only rows that are not joined yet are compared. A node is done, and shortens no further, as soon as
all of its rows are joined, since every pair below it will be verified.
What looks alike (with slack) is joined into candidate components; only their members' texts are turned into shingle
sets and shuffled. Within a component every pair is verified exactly. Large subtrees and components are dealt into
pairs of blocks, a partition after the other, so no task holds more than two blocks at a time. Results are a row per
document, never pairs of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import block_count, connected_components, deal_pairs, fresh, materialize, member_filter, release, sorted_groups, with_block_pairs

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
#: Share of pairs at the threshold that must meet in a tree.
TARGET_RECALL = 0.999
#: How far under the threshold the agreement of two signatures may be: six standard deviations for the smallest sets.
SLACK = 0.25
BUCKET_BLOCK = 2048
COMPONENT_BLOCK, COMPONENT_SHINGLES = 512, 1_000_000
#: Bits of the map of wanted ids for each of them, and bits at most; a fuller map only lets more texts pass to the join.
BITS_AN_ID, MOST_BITS = 16, 1 << 28
REMEMBERED_WORDS = 100_000

_MUL = np.uint64(0x9DDFEA08EB382D69)
#: Permutations of a signature, each with a share of its values: a permutation's value of a bin is the least in that bin.
PERMUTATIONS, _BINS = 4, TREES * DEPTH // 4
_TURN = np.random.default_rng(3).integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
#: Where each bin begins in the range of hashes, and which other bins of its permutation stand in for it when it is empty.
_BEGIN = np.arange(_BINS, dtype=np.uint64) << np.uint64(64 - (_BINS - 1).bit_length())
_STAND_IN = (np.random.default_rng(11).integers(0, _BINS, (64, PERMUTATIONS, _BINS)) + _BINS * np.arange(PERMUTATIONS)[:, None]).reshape(64, -1)
_words: dict[bytes, int] = {}


def prefix_depth(threshold: float, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """The longest prefix with which pairs at ``threshold`` meet in some tree with probability ``target``; no data is read."""
    for k in range(depth, 1, -1):
        if 1 - (1 - threshold**k) ** trees >= target:
            return k
    return 1


def shingle_set(text: str | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; fewer words make one shingle; no words make none."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > REMEMBERED_WORDS:
        _words.clear()
    for w in set(words).difference(_words):
        _words[w] = xxhash.xxh3_64_intdigest(w)
    h = np.array([_words[w] for w in words], np.uint64)
    n = max(1, len(h) - width + 1)
    s = np.zeros(n, np.uint64)
    for k in range(min(width, len(h))):
        s = (s ^ (s >> np.uint64(29))) * _MUL + h[k : k + n]
    return np.unique(s ^ (s >> np.uint64(32)))


def signature(s: np.ndarray) -> bytes:
    """MinHash values, 16 bits each: the smallest hash of each bin of the hash range, for a few permutations.

    An empty bin takes the value of the first filled one in its own fixed order of bins. A tree's stretch takes bins of
    all permutations in turn.
    """
    x = s * _TURN[:, None]
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x.sort(axis=1)
    at = np.stack([np.searchsorted(row, _BEGIN) for row in x])
    full = (at < np.append(at[:, 1:], np.full((PERMUTATIONS, 1), len(s)), axis=1)).ravel()
    source = np.arange(len(full))
    empty = np.flatnonzero(~full)
    for stand_in in _STAND_IN:
        if not len(empty):
            break
        source[empty] = stand_in[empty]
        empty = empty[~full[source[empty]]]
    for k in empty:
        first = k // _BINS * _BINS
        source[k] = first + np.argmax(full[first : first + _BINS])
    low = x[source // _BINS, at.ravel()[source]]
    values = (low * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
    return values.astype("<u2").reshape(PERMUTATIONS, -1, TREES).transpose(2, 1, 0).tobytes()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h1, h2, n, sig = [], [], [], []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text)
            a, b = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8").tolist()
            h1.append(a)
            h2.append(b)
            n.append(len(s))
            sig.append(signature(s) if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "h1", "h2", "shingles", "sig"])
    _words.clear()
    release()


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component among ``n`` nodes with edges (i, j)."""
    lab = np.arange(n)
    while len(i):
        low = np.minimum(lab[i], lab[j])
        before = lab.copy()
        np.minimum.at(lab, i, low)
        np.minimum.at(lab, j, low)
        lab = lab[lab]
        if (lab == before).all():
            break
    return lab


def descend(sig: np.ndarray, stretch: np.ndarray, floor: float, shortest: int, side: np.ndarray | None = None) -> tuple[np.ndarray, list[int]]:
    """Join alike rows of a subtree, sorted by ``stretch``: each row's smallest joined row, and comparisons by level.

    From the full depth to the ``shortest`` prefix, rows under one node are compared if they are not joined yet, and, with
    ``side``, only across sides: rows of one side meet elsewhere.
    """
    lab, compared = np.arange(len(sig)), []
    for depth in range(stretch.shape[1], shortest - 1, -1):
        new = np.flatnonzero(np.concatenate([[True], (stretch[1:, :depth] != stretch[:-1, :depth]).any(1), [True]]))
        done = 0
        for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
            if b - a < 2:
                continue
            for i in range(a, b - 1):
                other = lab[i + 1 : b] != lab[i]
                apart = i + 1 + np.flatnonzero(other if side is None else other & (side[i + 1 : b] != side[i]))
                if not len(apart):
                    if i == a and not other.any():
                        break
                    continue
                done += len(apart)
                hit = apart[(sig[apart] == sig[i]).mean(1) >= floor]
                if len(hit):
                    joined = np.unique(np.append(lab[hit], lab[i]))
                    lab[np.isin(lab, joined)] = joined[0]
        compared.append(done)
    return lab, compared


def _alike(floor: float, shortest: int):
    """Spanning edges among rows of a subtree (or of two blocks of it) whose signatures agree in at least ``floor``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _with_end(batches):
            table = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if table is None or not table.num_rows:
                continue
            key, lo, hi, mine, tree, node = (table.column(c).to_numpy() for c in ("key", "lo", "hi", "mine", "tree", "node"))
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
            if batch is not None:  # the last subtree may go on in the next batch
                rest = table.slice(int(new[-1]))
                stop, new = int(new[-1]), new[:-1]
                if not len(new):
                    continue
            else:
                stop = len(key)
            sig = np.frombuffer(b"".join(table.column("sig").slice(0, stop).to_pylist()), "<u2").reshape(stop, -1)
            sizes = np.diff(np.append(new, stop))
            group = np.repeat(np.arange(len(new)), sizes)
            small = sizes <= 8
            a, b = [], []
            for d in range(1, 8):  # small subtrees: all pairs at a distance, for all of them at once
                i = np.flatnonzero(small[group[:-d]] & (group[:-d] == group[d:])) if stop > d else np.zeros(0, np.int64)
                for part in np.array_split(i, max(1, len(i) // 50_000)):
                    part = part[(lo[part] == hi[part]) | (mine[part] != mine[part + d])]
                    hit = part[(sig[part] == sig[part + d]).mean(1) >= floor] if len(part) else part
                    a.append(node[hit])
                    b.append(node[hit + d])
            for g in np.flatnonzero(~small):
                s = slice(int(new[g]), int(new[g] + sizes[g]))
                t = int(tree[s.start]) * DEPTH
                lab, _ = descend(sig[s], sig[s, t : t + DEPTH], floor, shortest, None if lo[s.start] == hi[s.start] else mine[s])
                at = np.flatnonzero(lab != np.arange(len(lab)))
                a.append(node[s][at])
                b.append(node[s][lab[at]])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    return run


def _with_end(batches):
    yield from batches
    yield None


def _verify(threshold: float):
    """Links of every member within its component's block pair, and the smallest member it is linked to, step by step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for table in sorted_groups(batches, ["component", "lo", "hi"]):
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            node, copies, mine, blocks = (table.column(c).to_numpy() for c in ("node", "copies", "mine", "n_blocks"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            n = np.array([len(s) for s in sets], np.int64)
            _, ids, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            row = np.repeat(np.arange(len(n)), n)
            shared = seen[ids] > 1  # a shingle of one member is in no intersection
            col = np.cumsum(seen > 1) - 1
            row, ids = row[shared], col[ids[shared]]
            order = np.argsort(ids, kind="stable")
            row, ids = row[order], ids[order]
            # of two blocks only pairs across them; pairs of a block are those of the block with itself
            a = np.flatnonzero(mine == lo)
            b = a if lo == hi else np.flatnonzero(mine == hi)
            common = np.zeros((len(a), len(b)), np.float32)
            width = max(512, min(8192, 8_000_000 // max(1, len(n))))
            for c in range(0, int(ids[-1]) + 1 if len(ids) else 0, width):
                s = slice(*np.searchsorted(ids, [c, c + width]))
                m = np.zeros((len(n), width), np.float32)
                m[row[s], ids[s] - c] = 1
                common += m[a] @ m[b].T if lo != hi else m @ m.T
            ok = common >= threshold * (n[a, None] + n[None, b] - common) - 1e-6
            i, j = np.nonzero(np.triu(ok, 1) if lo == hi else ok)
            i, j = a[i], b[j]
            links = np.bincount(i, weights=copies[j], minlength=len(n)) + np.bincount(j, weights=copies[i], minlength=len(n))
            by_id = np.argsort(node, kind="stable")
            place = np.empty(len(n), np.int64)
            place[by_id] = np.arange(len(n))
            root = node[by_id][roots(len(n), place[i], place[j])[place]]
            out += [r for r in zip(node.tolist(), links.astype(np.int64).tolist(), root.tolist(), (blocks > 1).tolist()) if r[1]]
            if len(out) > 20_000:
                yield _links(out)
                out = []
        yield _links(out)

    return run


def _links(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))], ["node", "links", "root", "several"])


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: ``doc_id``, ``class_id`` (smallest id reachable by links), ``n_links``, ``kept`` (is that smallest).

    A link is a Jaccard similarity of at least ``threshold`` of the sets of runs of five words (words end at ASCII white
    space; texts under five words are one run). Texts without words (null, empty) link with nothing. Documents with one
    set are linked with each other; a similarity of just the threshold links. Texts are read whole, however long. Rows of one ``doc_id`` are one document, linked with what any of its texts is
    linked with; a null id links with nothing. An empty table gives no row. Other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(rows.mapInArrow(_sketches, "doc_id long, h1 long, h2 long, shingles long, sig binary"), "sketches")
    reps = materialize(
        sketches.where("shingles > 0 and doc_id is not null").groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.min_by("sig", "doc_id").alias("sig")), "representatives",
    )

    shortest, floor = prefix_depth(threshold), threshold - SLACK
    trees = F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("sig", 2 * DEPTH * t + 1, 2 * DEPTH).alias("stretch")) for t in range(TREES)])
    leaves = reps.select("node", F.explode(trees).alias("leaf")).select("node", "leaf.tree", "leaf.stretch")
    leaves = leaves.withColumn("key", F.xxhash64("tree", F.substring("stretch", 1, 2 * shortest)))
    several = leaves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = leaves.join(several, "key").join(reps.select("node", "sig"), "node")
    dealt = with_block_pairs(members.withColumn("blocks", block_count(F.col("n"), BUCKET_BLOCK)), "blocks", F.xxhash64("node"))
    tries = deal_pairs(dealt.select("key", "lo", "hi", "mine", "tree", "stretch", "node", "sig"), F.col("key")).sortWithinPartitions("key", "lo", "hi", "stretch")
    parts = connected_components(tries.mapInArrow(_alike(floor, shortest), "a long, b long"))

    candidates = parts.join(reps.select("node", "copies", "h1", "h2"), "node")
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_AN_ID * parts.count()).bit_length()))
    wanted = spark.sparkContext.broadcast(member_filter(parts.select("node"), bits))

    def sets(batches):
        for batch in batches:
            slot = batch.column(2).to_numpy()
            hit = np.flatnonzero((wanted.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
            ids, texts = batch.column(0).take(pa.array(hit)), batch.column(1).take(pa.array(hit)).to_pylist()
            found = [shingle_set(t) for t in texts]
            h = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), ">i8") for s in found], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([ids, pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([s.tobytes() for s in found], pa.binary())], ["node", "h1", "h2", "shingles"])
        _words.clear()
        release()

    slot = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(bits)), F.lit(0)).alias("slot")
    of_text = rows.select("doc_id", "text", slot).mapInArrow(sets, "node long, h1 long, h2 long, shingles binary").where("node is not null")
    of_text = of_text.join(candidates, ["node", "h1", "h2"]).dropDuplicates(["node", "h1", "h2"])
    of_text = materialize(of_text, "shingles")
    weight = of_text.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("shingles") / 8).alias("w"))
    weight = weight.select("component", F.greatest(block_count(F.col("n"), COMPONENT_BLOCK), block_count(F.col("w"), COMPONENT_SHINGLES)).alias("n_blocks"))
    pairs = with_block_pairs(of_text.join(weight, "component").withColumn("blocks", F.col("n_blocks")), "blocks", F.xxhash64("node", "h1"))
    pairs = pairs.select("component", "lo", "hi", "mine", "node", "copies", "n_blocks", "shingles")
    pairs = deal_pairs(pairs, F.xxhash64("component")).sortWithinPartitions("component", "lo", "hi")
    found = materialize(pairs.mapInArrow(_verify(threshold), "node long, links long, root long, several boolean"), "links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    split = found.where("several").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if split.limit(1).count():  # components of several blocks: what each block joined is joined over blocks
        over = connected_components(split).withColumnRenamed("component", "wide")
        links = links.join(over, "node", "left").withColumn("root", F.coalesce("wide", "root")).drop("wide")
    result = reps.select("h1", "h2", "node", "copies").join(links, "node", "left").select(
        "h1", "h2", F.coalesce("root", "node").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = sketches.select("doc_id", "h1", "h2", (F.col("shingles") > 0).alias("has")).join(result, ["h1", "h2"], "left")
    own = F.col("has") & F.col("doc_id").isNotNull()
    return out.select(
        "doc_id", F.when(own, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(own, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, with one document of each class; ids of the others are dropped by an anti join."""
    gone = jaccard_classes(docs, threshold).where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return fresh(docs, "_gone").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
