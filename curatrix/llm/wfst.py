"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three parts. The normaliser maps white space to the space mark and adds the dummy prefix.
The lexicon is a trie of the pieces' characters, whose final states give a piece's id; a character without a piece has an
arc that spells its bytes. The joint automaton has one state per last piece and weighs the step to a next piece. For a
unigram model a piece costs minus its score and joints are free. For a BPE model pieces are free and a joint costs
nothing if merging the characters of both pieces gives back just these two, else infinitely much; this is decided by
replaying the merges of both pieces, best first, along the right edge of the one and the left edge of the other.

Text, lexicon and joints are composed lazily while the tropical-semiring shortest path is relaxed from left to right: a
state of the composition is a position with the last piece of the cheapest way there, and a joint is weighed when an arc
first needs it. (A BPE model has one finite way to a position, so nothing is lost by keeping one.) The same relaxation
serves both kinds of model. No piece spans the start of a space mark, so the composition falls apart into chunks; what
chunks of a batch are new is relaxed together, position by position, in arrays, and remembered. Long chunks and those with
characters spelled by bytes are relaxed alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from curatrix.llm.common import gather, list_bounds, ragged, rows_at_once

SPACE = "▁"
#: Chunks, in each of two generations, and joints that a worker remembers.
REMEMBERED_CHUNKS, REMEMBERED_JOINTS = 100_000, 300_000
#: Longest chunk that is relaxed together with others, and how many are; slots of the arrays that find arcs and joints (bits).
SHORT, TOGETHER, SLOT_BITS = 48, 20_000, 20
INFINITE = float("inf")
UNIGRAM, BPE = 1, 2
_loaded: dict[str, "PieceTransducer"] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of one protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else 4 if kind == 5 else 8
            yield key >> 3, data[at : at + size]
            at += size


class PieceTransducer:
    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_path)
        top = {k: v for k, v in _fields(sp.serialized_model_proto()) if k in (2, 3)}
        trainer, normal = dict(_fields(top.get(2, b""))), dict(_fields(top.get(3, b"")))
        self.kind = trainer.get(3, UNIGRAM)
        if normal.get(2):
            raise ValueError("models with a character map are not supported")
        self.prefix, self.squeeze = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.spelled: list[bytes] = []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled.append(bytes.fromhex(piece[3:5]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.spelled.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, sp.get_score(i)
                self.spelled.append(piece.replace(SPACE, " ").encode())
        if len(self.bytes) < 256:
            raise ValueError("models without byte fallback are not supported")
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces span words")
        self.letters = {p for p in self.ids if len(p) == 1}
        self._compile()
        # a line end without a piece of its own ends a chunk, since no arc crosses it
        stop = "" if any("\n" in p for p in self.ids) else "\n"
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{stop}]+|{SPACE}+" + ("|\n" if stop else ""))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _compile(self) -> None:
        """Trie, arc costs and an empty joint automaton from ``ids``, ``scores`` and ``kind``."""
        bpe, self.pieces = self.kind == BPE, list(self.ids)
        self.longest = max(map(len, self.pieces), default=1)
        #: Arcs of the trie by (state, character): next state, and the number of the piece that ends there (or -1).
        self.trie: dict[tuple[int, str], list[int]] = {}
        for n, piece in enumerate(self.pieces):
            state = 0
            for c in piece:
                arc = self.trie.setdefault((state, c), [len(self.trie) + 1, -1])
                state = arc[0]
            arc[1] = n
        self.costs = np.array([0.0 if bpe else -self.scores[p] for p in self.pieces] + [0.0])
        self.byte_cost = 0.0 if bpe else 10.0 - min(self.scores.values(), default=0.0)
        self.piece_ids = np.array([*self.ids.values(), 0], "<u4")
        #: Joint automaton: costs of (last piece, next piece) that were weighed; the last number stands for a start.
        self.start = len(self.pieces)
        self.joints: dict[tuple[int, int], float] = {}
        self.edges: dict[int, tuple | None] = {}

        letters = sorted({c for _, c in self.trie})
        self.code = np.zeros(0x110000, np.uint16 if len(letters) < 65_535 else np.uint32)
        self.code[[ord(c) for c in letters]] = range(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.arc_key = np.array([0] + [s * self.width + int(self.code[ord(c)]) for s, c in self.trie], np.int64)
        self.arc_next, self.arc_piece = (np.array([-1] + [a[k] for a in self.trie.values()], np.int32) for k in (0, 1))
        self.arc_slot = np.zeros(1 << SLOT_BITS, np.int32)
        slot = self._slot(self.arc_key)
        self.arc_slot[slot[1:]] = np.arange(1, len(slot))
        beside = 1 + np.flatnonzero(self.arc_slot[slot[1:]] != np.arange(1, len(slot)))  # arcs that lost their slot to another
        self.beside = beside[np.argsort(self.arc_key[beside])]
        self.joint_key, self.joint_cost = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, np.float32)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def _arcs(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Number of the arc from each state by each character; 0 where there is none."""
        key = state.astype(np.int64) * self.width + code
        arc = self.arc_slot[self._slot(key)]
        lost = np.flatnonzero((self.arc_key[arc] != key) & (arc > 0))
        if len(lost):
            found = self.beside[np.minimum(np.searchsorted(self.arc_key[self.beside], key[lost]), len(self.beside) - 1)] if len(self.beside) else np.zeros(len(lost), np.int64)
            arc[lost] = np.where(self.arc_key[found] == key[lost], found, 0)
        return arc

    def normalize(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def _replay(self, piece: str) -> tuple[list[float], list[str], list[str]] | None:
        """The merges that make a piece: their costs in order, and the left and right edge before, between and after them.

        None for a piece that merging its characters does not give.
        """
        parts, costs = list(piece), []
        left, right = [parts[0]], [parts[-1]]
        while True:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1], -INFINITE)
                if s > best:
                    best, at = s, i
            if at < 0:
                return (costs, left, right) if len(parts) == 1 else None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            costs.append(-best)
            left.append(parts[0])
            right.append(parts[-1])

    def _edges(self, piece: int) -> tuple | None:
        if piece not in self.edges:
            self.edges[piece] = self._replay(self.pieces[piece])
        return self.edges[piece]

    def _weigh(self, last: int, piece: int) -> float:
        if self.kind != BPE:
            return 0.0
        b = self._edges(piece)
        if b is None:
            return INFINITE
        if last == self.start:
            return 0.0
        (own, _, right), (their, left, _) = self._edges(last), b
        scores, i, j, m, n = self.scores, 0, 0, len(own), len(their)
        while True:
            x, y = own[i] if i < m else INFINITE, their[j] if j < n else INFINITE
            across = scores.get(right[i] + left[j])
            if across is not None and -across < x and -across <= y:
                return INFINITE
            if i == m and j == n:
                return 0.0
            if x <= y:
                i += 1
            else:
                j += 1

    def joint(self, last: int, piece: int) -> float:
        """Cost of ``piece`` after ``last``: the merges of both, taken in turn, must never prefer one across them."""
        w = self.joints.get((last, piece))
        if w is None:
            if len(self.joints) > REMEMBERED_JOINTS:
                self.joints.clear()
            w = self.joints[(last, piece)] = self._weigh(last, piece)
        return w

    def _joints(self, last: np.ndarray, piece: np.ndarray) -> np.ndarray:
        if self.kind != BPE:
            return np.zeros(len(last), np.float32)
        key = last.astype(np.int64) * len(self.costs) + piece
        slot = self._slot(key)
        out, missed = self.joint_cost[slot], np.flatnonzero(self.joint_key[slot] != key)
        if len(missed):
            new, which = np.unique(key[missed], return_inverse=True)
            cost = np.array([self.joint(k // len(self.costs), k % len(self.costs)) for k in new.tolist()], np.float32)
            out[missed] = cost[which]
            into = self._slot(new)
            self.joint_key[into], self.joint_cost[into] = new, cost
        return out

    def shortest_path(self, s: str) -> list[tuple[int, str]]:
        """Cheapest path through ``s`` composed with the transducer: (piece, "") or (-1, character spelled by bytes)."""
        stop, trie, costs = len(s), self.trie, self.costs
        cost, last, begin = [0.0] + [INFINITE] * stop, [self.start] * (stop + 1), [0] * (stop + 1)
        for at in range(stop):
            here, left, state, k = cost[at], last[at], 0, at
            if here == INFINITE:
                continue
            while k < stop and (arc := trie.get((state, s[k]))):
                state, piece = arc
                k += 1
                if piece >= 0 and (w := here + costs[piece] + self.joint(left, piece)) < cost[k]:
                    cost[k], last[k], begin[k] = w, piece, at
            if s[at] not in self.ids and here + self.byte_cost < cost[at + 1]:
                cost[at + 1], last[at + 1], begin[at + 1] = here + self.byte_cost, self.start, at
        path, at = [], stop
        while at:
            path.append((last[at], "") if last[at] != self.start else (-1, s[begin[at] : at]))
            at = begin[at]
        return path[::-1]

    def shortest_paths(self, chunks: list[str]) -> list[bytes]:
        """Ids along the cheapest path of each chunk; all of their characters are pieces."""
        code = self.code[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        owner = np.repeat(np.arange(len(chunks)), size)
        stop = np.cumsum(size)
        offset = np.arange(len(code)) - (stop - size)[owner]
        found, at, state = [], np.arange(len(code)), np.zeros(len(code), np.int64)
        upto = at
        while len(at):  # the trie is walked from every character at once
            arc = self._arcs(state, code[upto])
            on = np.flatnonzero(arc)
            at, upto, arc = at[on], upto[on] + 1, arc[on]
            ends = np.flatnonzero(self.arc_piece[arc] >= 0)
            found.append((at[ends], upto[ends], self.arc_piece[arc[ends]]))
            on = np.flatnonzero(upto < stop[owner[at]])
            at, upto, state = at[on], upto[on], self.arc_next[arc[on]]
        at, upto, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(offset[at].astype(np.uint8), kind="stable")
        at, upto, piece = at[order], upto[order], piece[order]
        cut = np.searchsorted(offset[at], np.arange(SHORT + 1))
        # a chunk has a node more than characters; the arcs of a round end in different nodes
        frm, to = at + owner[at], upto + owner[at]
        first, final = stop - size + np.arange(len(chunks)), stop + np.arange(len(chunks))
        cost, last, begin = np.full(len(code) + len(chunks), np.inf), np.full(len(code) + len(chunks), self.start, np.int32), np.zeros(len(code) + len(chunks), np.int64)
        cost[first] = 0
        for a, b in zip(cut, cut[1:]):
            if a == b:
                break
            f, t, p = frm[a:b], to[a:b], piece[a:b]
            w = cost[f] + self.costs[p] + self._joints(last[f], p)
            better = np.flatnonzero(w < cost[t])
            t = t[better]
            cost[t], last[t], begin[t] = w[better], p[better], f[better]
        on_path, node = np.zeros(len(cost), bool), final
        while len(node):
            on_path[node] = True
            node = begin[node]
            node = node[last[node] != self.start]
        taken = np.flatnonzero(on_path)
        ids = self.piece_ids[last[taken]]
        bounds = np.searchsorted(taken, np.append(first, len(cost))).tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        short = [len(c) <= SHORT and self.letters.issuperset(c) for c in chunks]
        some = [c for c, s in zip(chunks, short) if s]
        together = chain.from_iterable(self.shortest_paths(some[i : i + TOGETHER]) for i in range(0, len(some), TOGETHER))
        return [next(together) if s else self._alone(c) for c, s in zip(chunks, short)]

    def _alone(self, chunk: str) -> bytes:
        out: list[int] = []
        for piece, spelled in self.shortest_path(chunk):
            if piece < 0:
                out.extend(self.bytes[b] for b in spelled.encode("utf-8", "surrogatepass"))
            else:
                out.append(int(self.piece_ids[piece]))
        return np.asarray(out, "<u4").tobytes()

    def _parts(self, parts: list[list[str]]) -> list[bytes]:
        """Ids of lists of chunks."""
        if len(self.known) > REMEMBERED_CHUNKS:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {p for some in parts for p in some if p not in known}
        known.update((p, older[p]) for p in new if p in older)
        new = [p for p in new if p not in known]
        known.update(zip(new, self._chunks(new)))
        return [known[some[0]] if len(some) == 1 else b"".join([known[p] for p in some]) for some in parts]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none.

        Where single spaces separate words and each starts a chunk, Arrow splits texts and numbers words, and distinct
        ones are looked up. Other texts are cut one by one.
        """
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        plain = pc.invert(pc.match_substring_regex(texts, f"^ |  | $|{SPACE}")) if self.prefix else pc.is_null(texts)
        split = pc.split_pattern(pc.if_else(plain, texts, ""), " ")
        words = split.flatten().dictionary_encode()
        found = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = [[SPACE + w] if "\n" not in w else self.chunks.findall(SPACE + w) for w in found]
        if "" in found:  # an empty text
            parts[found.index("")] = []
        flat, stop = gather(*ragged(self._parts(parts)), words.indices.to_numpy())
        at = list_bounds(split, stop).tolist()
        out = [flat[a:b].tobytes() for a, b in zip(at, at[1:])]
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False)).tolist()
        for i, ids in zip(others, self._parts([self.chunks.findall(self.normalize(texts[i].as_py())) for i in others])):
            out[i] = ids
        return out

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def transducer(path: str) -> PieceTransducer:
    if path not in _loaded:
        _loaded[path] = PieceTransducer(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit) of the whole text, ``n_bytes`` ids that stand for single bytes,
    and ``decoded``, the text read back from the ids.

    A null or empty text has no ids. Repeated rows give repeated results; other columns are not looked at, so their names
    cannot clash. Texts are coded whole, however long: the time is in proportion to the length, and a text without any space
    holds lists of its own length. An empty table gives no row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = transducer(model_path)
        singles = np.zeros(len(t.spelled), bool)
        singles[list(t.bytes.values())] = True
        for batch in batches:
            for part in rows_at_once(batch, 1):
                bufs = t.encode_all(part.column(1))
                ids = [np.frombuffer(b, "<u4") for b in bufs]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(bufs, pa.binary()), pa.array([int(singles[i].sum()) for i in ids], pa.int64()), pa.array([t.decode(i) for i in ids], pa.string())],
                    ["doc_id", "ids", "n_bytes", "decoded"],
                )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, "doc_id long, ids binary, n_bytes long, decoded string")
