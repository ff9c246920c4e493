"""Quality rules: counted base rules, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed byte n-grams are counted: one over every document (raw), one over trusted documents
(target). A document's score is the mean over its n-grams of log p_target - log p_raw, so length cancels out;
it is kept when it passes the base rules and scores at least a fixed threshold. Nothing is sampled at random.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import Members, fresh, is_member, levels

BITS = 16
SMOOTHING = 0.5
#: Nats per n-gram under which a document is more than noise away from trusted text.
MIN_LLR = -0.5

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
SYMBOLS = b"#*$%&|<>"


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    chars = len(text) - (len(data) - sum(map(len, words)))
    repeats, n = 0, len(words)
    if n > 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            counts, upto = Counter(windows), 0
            for i, w in enumerate(windows):
                if counts[w] > 1:
                    repeats += i + 3 - max(i, upto)
                    upto = i + 3
    return n, chars, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeats


def _grams(data: bytes) -> np.ndarray:
    """Buckets of all 4-byte n-grams."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 4:
        return np.zeros(0, np.uint32)
    return ((b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def _chunks(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of encoded texts of about ``limit`` bytes, each with the index of its first text."""
    held, size, first = [], 0, 0
    for i, t in enumerate(texts):
        held.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= limit:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def gram_model(docs: DataFrame, trusted_ids: DataFrame, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw by bucket.

    ``trusted_ids`` names trusted documents; all of them are the target, found by an exact cascade of bit maps, so ids are shuffled and
    texts are not (but for texts that maps of full size leave open, which meet their ids in a join). A null id is no trusted document. Counts of raw n-grams cover every document. Each task sends one row per
    bucket; the driver gets 2**BITS rows, whatever the input.
    """
    members = Members(docs, trusted_ids)
    maps, still_open = docs.sparkSession.sparkContext.broadcast(members.maps), members.open

    def count(batches, joined=False):
        raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for batch in batches:
            wanted = np.ones(batch.num_rows, bool) if joined else is_member(maps.value, batch.column(1), still_open) & batch.column(2).to_numpy(zero_copy_only=False)
            for first, run in _chunks(batch.column(0).to_pylist()):
                for chosen, into in ((False, raw), (True, target)):
                    # the separator's n-grams are left out by counting each text's own
                    parts = [_grams(x) for k, x in enumerate(run) if not chosen or wanted[first + k]]
                    if parts:
                        into += np.bincount(np.concatenate(parts), minlength=1 << BITS)
        if joined:  # counted as raw before
            raw, target = np.zeros_like(raw), raw
        got = np.flatnonzero(raw + target)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(raw[got]), pa.array(target[got])], ["bucket", "raw", "target"])

    def count_target(batches):
        return count(batches, joined=True)

    def unsure(batches):
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(levels(maps.value, batch.column(2)) == len(maps.value), pa.bool_()))

    counted = docs.select("text", Members.hashes("doc_id"), F.col("doc_id").isNotNull()).mapInArrow(count, "bucket int, raw long, target long")
    if still_open:
        ids = trusted_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
        some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", Members.hashes("doc_id")).where("doc_id is not null").mapInArrow(unsure, "doc_id long, text string")
        more = some.join(ids, "doc_id").select("text").mapInArrow(count_target, "bucket int, raw long, target long")
        counted = counted.unionByName(more)
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.full(1 << BITS, smoothing), np.full(1 << BITS, smoothing)
    raw[rows["bucket"]] += rows["raw"]
    target[rows["bucket"]] += rows["target"]
    if not rows["target"].sum():
        return np.zeros(1 << BITS)  # no trusted text: no verdict beyond the base rules
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def judge(docs: DataFrame, model: np.ndarray, min_llr: float = MIN_LLR, carry: bool = False) -> DataFrame:
    """Every document with its base counts, ``llr`` and ``kept``; with ``carry``, after all of its own columns.

    A null or empty text has no words and fails the base rules. Ties and repeated rows are judged each on its own
    text, whole and however long; the verdict does not depend on which rows lie beside it. Columns of ``docs`` named like a
    result column are left out. An empty table gives an empty result.
    """
    added = [x.strip().split()[0] for x in BASE.split(",")] + ["llr", "kept"]
    docs = fresh(docs, *added) if carry else docs.select("doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def score(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            llr = np.zeros(len(texts))
            for first, run in _chunks(texts):
                ends = np.cumsum([len(x) for x in run])
                begin = ends - [len(x) for x in run]
                n = np.maximum(ends - 3 - begin, 0)
                # each text's own sum, so that its neighbours do not touch even the last digit
                terms = np.append(table.value[_grams(b"".join(run))], [0.0] * 4)
                total = np.add.reduceat(terms, np.stack([begin, begin + n], 1).ravel())[::2]
                llr[first : first + len(run)] = np.where(n > 0, total, 0) / np.maximum(n, 1)
            base = np.array([base_counts(t or "") for t in texts], np.int64).reshape(-1, 5)
            failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
            cols = [*batch.columns, *(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= min_llr))]
            yield pa.RecordBatch.from_arrays(cols, [*batch.schema.names, *added])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(score, f"{own}, {BASE}, llr double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, carry: bool = False) -> DataFrame:
    """Judge ``docs`` with the documents labelled ``quality = 1`` as the trusted target."""
    return judge(docs, gram_model(docs, labels.where("quality = 1")), carry=carry)
