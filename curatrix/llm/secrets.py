"""Secret scans: fixed patterns, and sliding-window entropy per character class over candidate strings."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fresh

# Fixed patterns and lengths.
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)  # letters of ASCII only, in either case
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "entropy")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
WINDOW = 24
#: Character classes, each with the bits a character that its densest window must reach.
CLASSES = (("hex", frozenset("0123456789abcdefABCDEF"), 3.0), ("base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 4.0))
#: Candidates that are no secrets: well-known identifiers, examples, alphabets and plain words.
ALLOW = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?i).*(example|sample|placeholder|dummy|changeme|your[_-]).*"),
    re.compile(r"(?i).*(abcdefghijkl|0123456789|1234567890).*"),
    re.compile(r"[A-Za-z]*[+/_=-]*|[A-Z]?[a-z]+([+/_=-][A-Z]?[a-z]+)+[+/_=-]*"),
    re.compile(r"[0-9+/_=-]+"),
)

_HEX_MAP = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
_CANDIDATE_MAP = bytes(120 if re.match(r"[A-Za-z0-9+/_=-]", chr(i)) and i < 128 else 32 for i in range(256))


def densest_window(text: str, chars: frozenset, width: int = WINDOW) -> float:
    """The most bits a character in any ``width``-long window of runs of ``chars``; counts are updated, not recounted."""
    log = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    best, counts, held, run = 0.0, {}, 0.0, 0
    for i, c in enumerate(text):
        if c not in chars:
            counts, held, run = {}, 0.0, 0
            continue
        if run == width:
            old = text[i - width]
            held += log[counts[old] - 1] - log[counts[old]]
            counts[old] -= 1
        else:
            run += 1
        n = counts.get(c, 0)
        held += log[n + 1] - log[n]
        counts[c] = n + 1
        if run == width:
            best = max(best, math.log2(width) - held / width)
    return best


def entropy_spans(text: str) -> list[tuple[int, int]]:
    """Candidates dense enough for a class and not on the allow-list.

    A string of letters only is never a secret here: prose has no digits inside its words, and long words are as dense.
    """
    found = []
    for m in CANDIDATE.finditer(text):
        s = m.group()
        if any(a.fullmatch(s) for a in ALLOW) or not any(c.isdigit() for c in s):
            continue
        if any(densest_window(s, chars) >= bits for _, chars, bits in CLASSES):
            found.append(m.span())
    return found


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind's place in KINDS) in code points, by start then kind. Entropy spans inside a fixed one go."""
    found: list[tuple[int, int, int]] = []
    data = text.encode("utf-8", "surrogatepass")
    if b":" in data or b"=" in data:
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    if b"AKIA" in data:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if b"x" * MIN_HEX in data.translate(_HEX_MAP):
        found += [(*m.span(), 2) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    if b"x" * WINDOW in data.translate(_CANDIDATE_MAP):
        base = [(a, b) for a, b, _ in found]
        found += [(a, b, 3) for a, b in entropy_spans(text) if not any(c <= a and b <= d for c, d in base)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    out, upto = [], 0
    for a, b, _ in spans:
        if b > upto:
            if a >= upto:
                out += [text[upto:a], mark]
            upto = max(upto, b)
    return "".join([*out, text[upto:]])


def scan_secrets(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Every document with its span counts, a digest of the fixed spans, all spans and the text with spans masked.

    A null text counts as empty and stays null when masked. Texts are scanned whole, however long, each row on its own, so
    repeated rows and ties give repeated results. An empty table gives an empty result. With ``carry`` the columns of ``docs`` come first (those named like a result column go).
    """
    added = [x.strip().split()[0] for x in RESULT.split(",")]
    docs = fresh(docs, *added) if carry else docs.select("doc_id", "text")
    at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(at).to_pylist():
                spans = secret_spans(text) if text else []
                base = [s for s in spans if s[2] < 3]
                n = [sum(k == i for _, _, k in base) for i in range(3)]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), redact(text, spans) if spans else text))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in cols[:3]), *(pa.array(c, pa.string()) for c in cols[3:])], [*batch.schema.names, *added])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{own}, {RESULT}")
