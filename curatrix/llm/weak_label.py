"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Votes are counted by pattern over the whole
corpus (at most 3**labellers rows), and expectation-maximisation on those counts estimates each labeller's accuracy and
the posterior of every pattern. A linear scorer over hashed byte n-grams is then fitted to the posteriors of a bounded,
documented sample of documents, in the tasks that read them; what the tasks fit is averaged by their share of the sample.
Every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fresh
from curatrix.llm.quality_rules import BITS, _chunks, _grams, base_counts

#: Documents that the scorer is fitted on, about so many, chosen by a hash of id and text. A documented bound.
SAMPLE = 20_000
EPOCHS = 4
#: Tasks that fit the scorer, so that each sees enough of the sample, into however many splits the table falls.
FITTERS = 8
#: Texts, and their distinct n-grams, that a fitter goes over together.
AT_ONCE, HELD = 2000, 1 << 23
SCALE, RATE = 100.0, 0.5
GOOD, BAD = 1, 2  # a vote; 0 abstains

_UPPER = bytes(range(65, 91))
_ASCII = bytes(range(128))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))


def _vote(bad: bool, good: bool) -> int:
    return BAD if bad else GOOD if good else 0


def votes(text: str) -> tuple[int, ...]:
    """One vote per labeller, from counts over the whole text. Most only know one kind of bad text and else abstain."""
    data = text.encode("utf-8", "surrogatepass")
    n, chars, symbols, dup_lines, repeats = base_counts(text)
    if not n:
        return (BAD, *[0] * (LABELLERS - 1))
    ascii_letters = len(data) - len(data.translate(None, _LETTERS))
    upper = len(data) - len(data.translate(None, _UPPER))
    plain = ascii_letters + len(data.translate(None, _ASCII))  # letters, and bytes of other letters
    solid = sum(map(len, words := data.split()))
    ends = data.count(b". ") + data.count(b", ") + data.count(b".\n") + (data[-1:] == b".")
    bars, bangs, kinds = data.count(b" | "), data.count(b"!!"), len(set(words))
    return (
        _vote(n < 2, False),
        _vote(5 * symbols > n, False),
        _vote(100 * symbols > 4 * solid, 500 * symbols < solid),
        _vote(2 * upper > ascii_letters, False),
        _vote(10 * bangs > n, False),
        _vote(3 * repeats > n, False),
        _vote(n >= 50 and 10 * kinds < 2 * n, n >= 50 and 10 * kinds > 4 * n),
        _vote(10 * bars > n, False),
        _vote(n >= 20 and 100 * ends < n, 40 * ends > n),
        _vote(100 * plain < 88 * solid, 100 * plain > 93 * solid),
        _vote(chars < 2 * n or chars > 15 * n, False),
        _vote(3 * dup_lines > data.count(b"\n") + 1, False),
    )


LABELLERS = 12


def posterior_by_pattern(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of each vote pattern, and each labeller's estimated accuracy when it votes.

    Labellers are taken as independent given the class; abstaining is an outcome like a vote. Starts from majorities.
    """
    lean = (patterns == GOOD).sum(1) - 2.0 * (patterns == BAD).sum(1)
    p = 1 / (1 + np.exp(-lean))
    onehot = np.eye(3)[patterns]  # pattern, labeller, vote
    for _ in range(rounds):
        w = np.stack([p, 1 - p]) * counts
        table = np.einsum("cp,plv->clv", w, onehot) + 0.5
        table /= table.sum(2, keepdims=True)
        prior = (w.sum(1) + 1) / (w.sum() + 2)
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", onehot, np.log(table))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            p = new
            break
        p = new
    right = prior[0] * table[0, :, GOOD] + prior[1] * table[1, :, BAD]
    wrong = prior[0] * table[0, :, BAD] + prior[1] * table[1, :, GOOD]
    return p, right / (right + wrong)


def _code(v: tuple[int, ...]) -> int:
    return sum(x * 3**i for i, x in enumerate(v))


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[dict[int, float], np.ndarray, float, np.ndarray]:
    """Posterior by vote pattern, scorer weights and bias, and labeller accuracies."""
    def vote(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_code(votes(t or "")) for t in batch.column(1).to_pylist()], pa.int32())], ["doc_id", "code"])

    coded = docs.select("doc_id", "text").mapInArrow(vote, "doc_id long, code int")
    found = coded.groupBy("code").count().toPandas().sort_values("code")
    if not len(found):
        return {}, np.zeros(1 << BITS), 0.0, np.zeros(LABELLERS)
    codes, counts = found["code"].to_numpy(), found["count"].to_numpy(float)
    post, accuracy = posterior_by_pattern(np.stack([codes // 3**i % 3 for i in range(LABELLERS)], 1), counts)
    table = dict(zip(codes.tolist(), post.tolist()))

    part = min(1.0, sample / counts.sum())
    # which rows are chosen, which task fits them and in which order follows from ids and texts, not from where rows lie
    place = F.xxhash64("doc_id", "text")
    chosen = docs.where(F.pmod(place, F.lit(1 << 20)) < int(part * (1 << 20)) + (part == 1.0)).select("text", place.alias("place"))
    fitter = F.pmod(F.shiftright("place", 20), F.lit(FITTERS)).cast("int")
    chosen = chosen.repartitionById(FITTERS, fitter).sortWithinPartitions("place", "text").select("text")
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias, seen = np.zeros(1 << BITS), 0.0, 0
        held, bias_held = np.full(1 << BITS, 1e-8), 1e-8
        rows: list[tuple[np.ndarray, np.ndarray, float]] = []
        size = 0

        def learn():
            nonlocal bias, bias_held, seen, size
            seen += len(rows)
            for epoch in range(EPOCHS):
                for k, v, y in rows:
                    g = 1 / (1 + np.exp(-np.clip(bias + v @ weight[k], -30, 30))) - y
                    held[k] += (g * v) ** 2
                    weight[k] -= RATE * g * v / np.sqrt(held[k])
                    bias_held += g * g
                    bias -= RATE * g / bias_held**0.5
            rows.clear()
            size = 0

        for batch in batches:
            for text in batch.column(0).to_pylist():
                grams = _grams((text or "").encode("utf-8", "surrogatepass"))
                if len(grams):
                    k, c = np.unique(grams, return_counts=True)
                    rows.append((k, SCALE * c / len(grams), sent.value.get(_code(votes(text)), 0.5)))
                    size += len(k)
                if len(rows) >= AT_ONCE or size >= HELD:  # what a task holds is bounded
                    learn()
        if rows:
            learn()
        if seen:
            at = np.flatnonzero(weight)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(weight[at], bias) * seen), pa.array(np.full(len(at) + 1, seen), pa.int64())], ["bucket", "w", "n"])

    # FITTERS numbers a bucket, added in their order
    added = F.aggregate(F.sort_array(F.collect_list("w")), F.lit(0.0), lambda a, x: a + x)
    sums = chosen.mapInArrow(train, "bucket int, w double, n long").groupBy("bucket").agg(added.alias("w"), F.sum("n").alias("n")).toPandas()
    weight, total = np.zeros(1 << BITS), float(sums.loc[sums["bucket"] == -1, "n"].sum()) or 1.0
    mine = sums[sums["bucket"] >= 0]
    weight[mine["bucket"]] = mine["w"] / total
    return table, weight, float(sums.loc[sums["bucket"] == -1, "w"].sum()) / total, accuracy


def classify(docs: DataFrame, sample: int = SAMPLE, carry: bool = False) -> DataFrame:
    """Every document with the labellers' ``posterior``, the scorer's ``score`` in 0..1 and ``kept`` (score of 0.5 or more).

    A text without n-grams (null, empty, under four bytes) scores its posterior. Texts are read whole, however long. Ties and
    repeated rows are scored each on their own; an empty table gives an empty result. Scores follow from the rows, however
    they are dealt to files. With ``carry`` all columns of ``docs`` come first, but for those named like a result column.
    """
    table, weight, bias, _ = fit(docs, sample)
    docs = fresh(docs, "posterior", "score", "kept") if carry else docs.select("doc_id", "text")
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast((table, weight, bias))

    def score(batches):
        table, weight, bias = sent.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            post = np.array([table.get(_code(votes(t or "")), 0.5) for t in texts])
            out = post.copy()
            for first, run in _chunks(texts):
                for k, x in enumerate(run):
                    if len(x) >= 4:
                        out[first + k] = 1 / (1 + np.exp(-np.clip(bias + SCALE * weight[_grams(x)].mean(), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(post), pa.array(out), pa.array(out >= 0.5)], [*batch.schema.names, "posterior", "score", "kept"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(score, f"{own}, posterior double, score double, kept boolean")
