"""Packing of documents into training windows by best-fit decreasing.

Each task tokenizes its own input split and packs it: full windows are cut off first, the remainders go,
longest first, into the open window that they fill best; a segment tree over remaining capacities finds it.
Windows that stay loosely filled at the end of a split are opened again and packed together with those of
neighbouring splits, so small splits cost no padding. Texts and ids are never shuffled, only piece descriptions
of loose windows are. A task holds the piece descriptions of one split, whatever the corpus holds.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fresh, gather, list_bounds, materialize, ragged, release, rows_at_once

WINDOW = 2048
END_ID = 1
#: A window filled at least so far is final after the first level.
TIGHT = 0.995
#: So many neighbouring splits pack their loose windows together.
SPLITS_TOGETHER = 16
#: Runs that a worker remembers with their ids, in each of two generations.
REMEMBERED_WORDS = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_encoders: dict[str, "WordEncoder"] = {}


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(need)`` is the smallest capacity >= need that is open."""

    def __init__(self, top: int):
        self.size = 1 << top.bit_length()
        self.open = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(top + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.open[i] += by
            i >>= 1

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.windows[room].pop()

    def tightest(self, need: int) -> int | None:
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window and offset for each length (longest first wins, ties in the order given), and how many windows."""
    tree, where, at, used = CapacityTree(window), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[i]
        room = tree.tightest(need)
        if room is None:
            w, room, used = used, window, used + 1
        else:
            w = tree.take(room)
        where[i], at[i] = w, window - room
        if room > need:
            tree.put(w, room - need)
    return where, at, used


def _printable_bytes() -> dict[int, int]:
    """How byte-level vocabularies spell a byte: itself if it is a printable Latin-1 character, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: b if b in plain else 256 + sum(c not in plain for c in range(b)) for b in range(256)}


class WordEncoder:
    """Ids of whole texts from ids of their words.

    The tokenizer never joins characters across ASCII white space, so a text's ids are its words' ids. Arrow splits
    and numbers the words; the distinct ones of a batch that hold Latin letters, digits and punctuation only are cut
    into the tokenizer's runs, and each distinct run is looked up, a new one with the tokenizer's model. Any other word
    goes through the whole tokenizer. Ids are gathered by run and by word number. Texts on which folding first could
    differ (special strings, final sigma) go to the tokenizer whole. What is remembered has two generations, so that
    a full memory drops rare entries only.
    """

    SIMPLE = "^[!-~À-ÿ]+$"
    # Fixed pattern: the runs into which the vocabulary's own file cuts folded text, for the characters of SIMPLE.
    RUNS = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+)"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.spelling = self.tokenizer.model, _printable_bytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _run(self, run: str) -> bytes:
        spelled = run if run.isascii() else run.encode().decode("latin-1").translate(self.spelling)
        return np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()

    def _looked_up(self, entries: list[str], ask) -> list[bytes]:
        """Remembered ids of distinct entries; ``ask`` gives those of the others."""
        known, older = self.known, self.older
        new = [e for e in entries if e not in known]
        if len(known) + len(new) > REMEMBERED_WORDS:
            self.known, self.older = {}, known
            known, older, new = self.known, known, entries
        strange = [e for e in new if e not in older]
        known.update(zip(strange, ask(strange)))
        known.update((e, older[e]) for e in new if e in older)
        return [known[e] for e in entries]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and how many each has."""
        simple = pc.match_substring_regex(words, self.SIMPLE)
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(pc.if_else(simple, words, "")), self.RUNS, r"\1 "))
        runs = cut.flatten().dictionary_encode()
        entries = runs.dictionary.to_numpy(zero_copy_only=False).tolist()
        flat, stop = gather(*ragged(self._looked_up(entries, lambda new: map(self._run, new))), runs.indices.to_numpy())
        at = list_bounds(cut, stop)
        size, other = np.diff(at), words.filter(pc.invert(simple)).to_pylist()
        if other:
            ids = self._looked_up(other, self._whole)
            place = np.flatnonzero(~simple.to_numpy(zero_copy_only=False))
            flat = np.insert(flat, np.repeat(at[place], [len(x) // 4 for x in ids]), np.frombuffer(b"".join(ids), "<u4"))
            size[place] = [len(x) // 4 for x in ids]
        return flat, size

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        whole = pc.fill_null(pc.match_substring_regex(texts, r"<\||Σ|İ"), False)
        split = pc.ascii_split_whitespace(pc.if_else(whole, "", pc.fill_null(texts, "")))
        words = split.flatten().dictionary_encode()
        flat, stop = gather(*self._words(words.dictionary), words.indices.to_numpy())
        at = list_bounds(split, stop).tolist()
        out = [flat[a:b].tobytes() for a, b in zip(at, at[1:])]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            out[i] = self._whole([texts[int(i)].as_py()])[0]
        return out


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    """Tokenize and pack one split; a row per piece."""
    end, out = np.asarray([end_id], dtype="<u4").tobytes(), {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
    for batch in batches:
        for part in rows_at_once(batch, 1):
            for doc, buf in zip(part.column(0).to_pylist(), encoder(path).encode(part.column(1))):
                buf += end
                n = len(buf) // 4
                for s in range(0, n, window):
                    piece = buf[4 * s : 4 * (s + window)]
                    for k, v in zip(out, (doc, s, len(piece) // 4, zlib.crc32(piece), n)):
                        out[k].append(v)
    encoder(path).older.clear()
    release()
    # the order within a split does not depend on how rows arrived
    order = sorted(range(len(out["start"])), key=lambda i: (out["doc_id"][i] is not None, out["doc_id"][i] or 0, out["start"][i], out["ids_crc32"][i]))
    out = {k: [v[i] for i in order] for k, v in out.items()}
    where, at, used = best_fit(out["length"], window)
    filled = np.bincount(where, weights=out["length"], minlength=used) if used else np.zeros(0)
    table = pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})
    table = table.append_column("split", pa.array([TaskContext.get().partitionId()] * len(where), pa.int64()))
    table = table.append_column("slot", pa.array(where, pa.int64())).append_column("offset", pa.array(at, pa.int64()))
    table = table.append_column("tight", pa.array((filled >= TIGHT * window)[where] if used else [], pa.bool_()))
    yield from table.to_batches(max_chunksize=50_000)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where its ids lie in its document and in which window, at which offset, they go.

    A null text counts as empty (one piece: the end id). Overlong documents give full windows and one rest.
    Repeated rows and ties are packed like others; a null ``doc_id`` stays null. An empty table gives no row.
    Texts are cut whole, however long. Other columns of ``docs`` are not looked at, so their names cannot clash.
    Which windows are formed, and their numbers, follow from the input splits; any split gives full coverage.
    """
    def pieces(batches):
        return _pieces(batches, tokenizer_path, window, end_id)

    first = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        pieces, f"{PIECES}, split long, slot long, offset long, tight boolean"
    )
    first = materialize(first, "pieces")

    def again(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["split", "slot", "offset"], kind="stable").reset_index(drop=True)
        where, at, _ = best_fit(pdf["length"].tolist(), window)
        return pdf.assign(slot=where, offset=at)

    loose = (
        first.where("not tight")
        .withColumn("group", F.floor(F.col("split") / SPLITS_TOGETHER))
        .groupBy("group")
        .applyInPandas(again, f"{PIECES}, split long, slot long, offset long, tight boolean, group long")
    )
    named = [F.col(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
    done = first.where("tight").select(*named, F.expr("split * 4294967296L + slot").alias("sequence_id"), "offset")
    # windows of the second level are numbered apart from all windows of the first
    return done.unionByName(loose.select(*named, F.expr("-1L - group * 4294967296L - slot").alias("sequence_id"), "offset"))


def packed_sequences(docs: DataFrame, plan: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, pad_id: int = 0) -> DataFrame:
    """The windows themselves: ``sequence_id``, padded ``input_ids``, and ``segment`` (1, 2, ... by piece; 0 for padding).

    Needs unique document ids. Every window gathers at most ``window`` ids.
    """
    def ids(batches):
        for batch in batches:
            bufs = encoder(tokenizer_path).encode(batch.column(1))
            lists = [np.frombuffer(b, "<u4").astype("int32").tolist() + [end_id] for b in bufs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["doc_id", "ids"])

    tokens = docs.select("doc_id", "text").mapInArrow(ids, "doc_id long, ids array<int>")
    parts = fresh(plan, "ids").join(tokens, "doc_id").select("sequence_id", "offset", F.expr("slice(ids, cast(start + 1 as int), cast(length as int))").alias("piece"))
    lists = parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "piece"))).alias("p"))
    flat = F.flatten(F.transform("p", lambda x: x["piece"]))
    marks = F.flatten(F.transform("p", lambda x, i: F.transform(x["piece"], lambda _: i + 1)))
    pad = F.array_repeat(F.lit(pad_id), F.lit(window) - F.size(flat))
    return lists.select("sequence_id", F.concat(flat, pad).alias("input_ids"), F.concat(marks, F.array_repeat(F.lit(0), F.lit(window) - F.size(flat))).alias("segment"))
