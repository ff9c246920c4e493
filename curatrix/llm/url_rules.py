"""URL filters: pattern rules indexed by their rarest literal token; only rules that a URL's tokens fetch run their regex.

A rule's literal tokens are runs of ASCII letters and digits that must stand alone in every URL it fits. Tokens are counted over
the whole table, and each rule is filed under the one that fewest URLs hold. A URL looks its own tokens up, and the
rules found are tried; rules without a token are tried on every URL.

Two kinds of rules share the index. Site rules (``example.org/en/``) fit a host, its subdomains and paths that begin alike;
the longest one that fits decides. Pattern rules decide where no site rule does: ``||`` is the start of a host or of one of
its parts, ``|`` the start of the host or, last, the end of the URL, ``*`` any run, ``^`` a separator or the end, and a
leading ``@@`` makes an exception that overrides blocks. They see the URL after ``://``, with A-Z lowered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fresh

# Fixed site rules: verdict, host and path.
SITES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Patterns of spam, gambling, advertising and tracking hosts and paths.
PATTERNS = (
    "||casino-*.", "||free-bets.", "||cheap-pills.", "||ads-track.", "||adserver.", "||ads.", "||poker-*.", "||track.*/pixel^",
    "/popunder/", "/banner-ads/", "^affiliate_id=", "-viagra-", "/wp-login.php|", "@@||casino-history.",
)
#: Rules go to every task.
MOST_RULES = 1_000_000

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    #: What is to match: the host with the path for a site rule, all after ``://`` for a pattern.
    regex: str
    tokens: tuple[str, ...]
    site: bool

    @property
    def order(self) -> tuple[int, int, str]:
        """Longest first; of equal ones the longer host, then by text."""
        return -len(self.text), -len(self.text.partition("/")[0]), self.text


def site_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    host = host.translate(_LOWER)
    path = slash + path
    bounded = _bounded(f".{host}{path.translate(_LOWER)}*" if path else f".{host}/")
    return Rule(host + path, verdict, rf"(?s)(?:[^/]*\.)?{re.escape(host)}{re.escape(path) if path else r'(?=/|\Z)'}", bounded, True)


def _bounded(literal: str) -> tuple[str, ...]:
    """Tokens of a literal with ``*`` and ``^`` in it that no neighbour can lengthen."""
    found = []
    for m in _TOKEN.finditer(literal):
        left, right = literal[: m.start()][-1:], literal[m.end() : m.end() + 1]
        if left not in ("", "*") and right not in ("", "*"):
            found.append(m.group())
    return tuple(dict.fromkeys(found))


def pattern_rule(text: str) -> Rule:
    verdict, body = ("allow", text[2:]) if text.startswith("@@") else ("block", text)
    body = body.translate(_LOWER)
    start = 2 if body.startswith("||") else 1 if body.startswith("|") else 0
    end = len(body) > start and body.endswith("|")
    inner = body[start : len(body) - end]
    regex = "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%\-]|\Z)"}.get(c, re.escape(c)) for c in inner)
    head = (".*?", r"", r"(?:[^/?#]*\.)?")[start]
    # an anchor is a boundary; so are a host part's start and the end
    bounded = _bounded(("" if not start else "|") + inner + ("|" if end else ""))
    return Rule(text, verdict, f"(?s){head}{regex}" + (r"\Z" if end else ""), bounded, False)


def compile_rules(sites: Iterable[tuple[str, str]], patterns: Iterable[str]) -> list[Rule]:
    rules = [site_rule(*x) for x in sites] + [pattern_rule(x) for x in patterns]
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} are sent to every task")
    return rules


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host, path, and all after ``://`` with A-Z lowered; three empty texts where that is missing."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", ""
    stop = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    tail = rest[stop:]
    end = min((i for c in "?#" if (i := tail.find(c)) >= 0), default=len(tail))
    return rest[:stop].translate(_LOWER), tail[:end], rest.translate(_LOWER)


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens; a row per token reaches the driver."""
    sent = urls.sparkSession.sparkContext.broadcast(tokens)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter[str] = Counter()
        for batch in batches:
            for url in batch.column(0).to_pylist():
                n.update(sent.value.intersection(_TOKEN.findall(split_url(url)[2])))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

    rows = urls.select("url").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r.token: r.n for r in rows.collect()}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Places of rules by their rarest token (of equal ones the longer, then the first by text), and of those without a token."""
    by: dict[str, list[int]] = {}
    always = []
    for k, r in enumerate(rules):
        if r.tokens:
            by.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(k)
        else:
            always.append(k)
    return by, always


class Judge:
    """Rules with their regexes compiled, as a task holds them."""

    def __init__(self, rules: list[Rule], index: tuple[dict[str, list[int]], list[int]]):
        self.rules, (self.by, self.always) = rules, index
        self.match: dict[int, object] = {}

    def candidates(self, rest: str) -> list[int]:
        found = {k for t in set(_TOKEN.findall(rest)) for k in self.by.get(t, ())}
        return sorted(found.union(self.always))

    def fits(self, k: int, site: str, rest: str) -> bool:
        if k not in self.match:
            self.match[k] = re.compile(self.rules[k].regex).match
        return self.match[k](site if self.rules[k].site else rest) is not None

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str, str | None, int]:
        """host, path, rule, verdict, pattern, and how many regexes ran."""
        host, path, rest = split_url(url)
        tried = self.candidates(rest)
        fit = [self.rules[k] for k in tried if self.fits(k, host + path, rest)]
        site = min((r for r in fit if r.site), key=lambda r: r.order, default=None)
        decides = next((r for v in ("allow", "block") for r in fit if not r.site and r.verdict == v), None)
        verdict = site.verdict if site else decides.verdict if decides else "allow"
        return host, path, site and site.text, verdict, decides and decides.text, len(tried)


RESULT = "host string, path string, rule string, verdict string, pattern string, n_tried int"


def filter_urls(pages: DataFrame, sites: Iterable[tuple[str, str]] = SITES, patterns: Iterable[str] = PATTERNS) -> DataFrame:
    """Every page with ``host, path, rule, verdict, pattern, n_tried`` after its own columns.

    ``rule`` is the site rule that decides; ``pattern`` the first exception, else the first block, that fits. A null URL, an
    empty one, and one without ``://`` have empty parts, fit no rule and are allowed. URLs are judged whole, however long,
    each row on its own, so repeated rows are judged alike. Of site rules of one length the longer host decides. Columns of ``pages`` named like a
    result column are left out. An empty table gives an empty result. No text is shuffled.
    """
    names = [x.strip().split()[0] for x in RESULT.split(",")]
    rules = compile_rules(sites, patterns)
    counts = token_counts(pages, {t for r in rules for t in r.tokens})
    sent = pages.sparkSession.sparkContext.broadcast((rules, index_rules(rules, counts)))  # at most MOST_RULES rules
    pages = fresh(pages, *names)
    at = pages.columns.index("url")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Judge(*sent.value)
        for batch in batches:
            columns = list(zip(*map(one, batch.column(at).to_pylist()))) or [[]] * 6
            added = [pa.array(c, pa.int32() if i == 5 else pa.string()) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    return pages.mapInArrow(judge, f"{own}, {RESULT}")
