"""Importance resampling towards a target: hashed word features, gains of target over corpus, and seeded Gumbel scores.

Buckets are CRCs of feature bytes. The distinct features of a block of text are grouped by length into two-dimensional byte
arrays; all CRCs of a group advance together, one column at a time, and the buckets are scattered back to where the features
stand. Counts of both sides cover every text; the drawn documents are the highest of one ordered, range-dealt table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import materialize, release

BUCKETS = 10_000
#: Longest run of words that is a feature.
LONGEST_RUN = 1
#: Documents with fewer words are scored and not drawn; of the others this share, in hundredths, is.
LEAST_WORDS, PERCENT = 20, 10
SEED = 2024
#: Bytes of text whose features are worked on at once, and the longest feature that joins a byte array; longer ones go singly.
BLOCK, LONGEST_ROW = 1 << 20, 256
#: Bytes looked at together for the end of a word.
LOOK = 4096

#: Digits, letters and bytes beyond ASCII make words; A-Z is lowered, the rest separates.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def crc_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional byte array, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all bytes of the spans, one span after the other."""
    stop = np.cumsum(lengths)
    return np.repeat(starts - stop + lengths, lengths) + np.arange(stop[-1] if len(stop) else 0)


def crc_of_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``data``. Equal spans are computed once, in byte arrays of spans of one length."""
    at = spread(starts, lengths)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    spans = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])
    coded = spans.dictionary_encode()
    bounds = np.frombuffer(coded.dictionary.buffers()[1], np.int64)[: len(coded.dictionary) + 1]
    pool = np.frombuffer(coded.dictionary.buffers()[2] or b"", np.uint8)
    size = np.diff(bounds)
    crc = np.zeros(len(size), np.uint32)
    order = np.argsort(size, kind="stable")
    ends = np.flatnonzero(np.diff(size[order], append=-1)) + 1
    for group in np.split(order, ends[:-1]):
        n = int(size[group[0]]) if len(group) else 0
        if n > LONGEST_ROW:
            crc[group] = [zlib.crc32(pool[bounds[i] : bounds[i] + n]) for i in group]
        elif len(group):
            crc[group] = crc_rows(pool[bounds[group][:, None] + np.arange(n)])
    return crc[coded.indices.to_numpy()]


def features(texts: pa.Array, longest: int = LONGEST_RUN) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, words of the run, CRC) of every feature, block by block; texts of any length are cut between words."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    at, carried = 0, 0  # bytes done, and where the words before them start that runs may still begin with
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        upto = int(offsets[np.searchsorted(offsets, stop)])
        while stop < upto:  # to the end of the word, or of the text
            gap = np.flatnonzero(_FOLD[data[stop : min(stop + LOOK, upto)]] == 32)
            if len(gap):
                stop += int(gap[0])
                break
            stop = min(stop + LOOK, upto)
        block = _FOLD[data[carried:stop]]
        word = block != 32
        edge = offsets[(offsets > carried) & (offsets < stop)] - carried
        starts, ends = word.copy(), word.copy()
        starts[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        starts[edge] = word[edge]
        ends[edge - 1] = word[edge - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        text = np.searchsorted(offsets, starts + carried, "right") - 1
        new = ends + carried > at
        for k in range(1, longest + 1):
            first, last = slice(0, len(starts) - k + 1), slice(k - 1, None)
            if k == 1:
                spaced, begin, end = block, starts, ends
            elif k == 2:  # the words with one space after each
                size = ends - starts + 1
                spaced = block[np.minimum(spread(starts, size), len(block) - 1)]
                end = np.cumsum(size) - 1
                spaced[end] = 32
                begin = end + 1 - size
            ok = (text[first] == text[last]) & new[last] if len(starts) >= k else np.zeros(0, bool)
            if ok.any():
                b = begin[first][ok]
                yield text[first][ok], np.full(len(b), k), crc_of_spans(spaced, b, end[last][ok] - b)
        carried = carried + int(starts[max(0, len(starts) - longest + 1)]) if longest > 1 and len(starts) else stop
        at = stop


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How often each bucket occurs in column ``text`` over all rows. A task sends a row per bucket; so many reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, crc in features(batch.column(0), longest):
                n += np.bincount(crc % buckets, minlength=buckets)
        release()
        got = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(got, pa.int32()), pa.array(n[got])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"]] = rows["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floor of 1000 times the log ratio of the target's and the corpus' smoothed shares."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (s_all + k) / (float(s + 1) * (t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST_RUN) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # a number per bucket

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for text, run, crc in features(batch.column(1), longest):
                words += np.bincount(text[run == 1], minlength=batch.num_rows)
                n += np.bincount(text, minlength=batch.num_rows)
                # sums of whole numbers far below 2^53 are exact
                weight += np.bincount(text, weights=sent.value[crc % len(gain)], minlength=batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, n, weight))], ["doc_id", "n_words", "n_features", "weight"])
        release()

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Adds ``score`` and ``rank``: of the rows with enough words, the highest ``percent`` hundredths, ties to the smaller id.

    Rows are dealt by ranges of their order and numbered where they lie; the driver gets two counts per partition.
    """
    spark = weighed.sparkSession
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = weighed.withColumns({"score": F.col("weight") + noise, "_enough": F.col("n_words") >= least_words, "_place": F.monotonically_increasing_id()})
    rows = materialize(rows, "scored-documents")  # else the sampling of ranges would score the texts again
    order = [F.desc("_enough"), F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("_place")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "ordered-documents")
    part = F.shiftright("_at", 33)
    before, at, enough = [], 0, 0
    for p, k, ok in sorted(placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)), F.sum(F.col("_enough").cast("long"))).collect()):
        before.append((p, at))
        at, enough = at + k, enough + ok
    offsets = spark.createDataFrame(before, "_part long, _before long")  # a row per partition
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    out = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return out.select("doc_id", "n_words", "n_features", "weight", "score", F.when(number <= percent * enough // 100, number).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """A row per document: ``doc_id, n_words, n_features, weight, score, rank`` (null if not drawn).

    ``target`` is any table with a ``text``. Null and empty texts have no features and weigh 0; texts are read whole, however
    long. Repeated rows count each time and may be drawn each; equal scores go by id, rows of one id by place; a null id is
    hashed as an empty one and comes last among equals. Without target or corpus all gains are those of empty counts.
    Other columns are not looked at, so their names cannot clash. An empty table gives no row.
    """
    gain = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    return draw(weigh(docs, gain, longest), least_words, percent, seed)
