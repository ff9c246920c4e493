"""Importance resampling, URL rules and hard negatives against plain re-computation."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from curatrix.llm import hard_negatives, resampling, url_rules

# importance resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ODD = [None, "", "  \n", "The the THE cat", "é日本 naïve-word x9_y", "a" * 700 + " b", "tab\tand\x00nul", "Äpfel ÄPFEL"]


def plain_features(text, longest=1):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("block", [7, 64, 1 << 20])
def test_features_of_any_block_size(monkeypatch, longest, block):
    monkeypatch.setattr(resampling, "BLOCK", block)
    monkeypatch.setattr(resampling, "LOOK", 5)
    texts = [*ODD, "one two three four five six seven eight nine ten", "x" * 40, "last words here"]
    got = [Counter() for _ in texts]
    for text, _, crc in resampling.features(pa.array(texts).slice(0), longest):
        for t, c in zip(text.tolist(), crc.tolist()):
            got[t][c] += 1
    for t, g in zip(texts, got):
        assert g == Counter(zlib.crc32(f.encode()) for f in plain_features(t, longest)[0])


def test_features_of_a_slice():
    texts = pa.array(["gone", "kept words", None, "more"]).slice(1, 3)
    assert [(t.tolist(), c.tolist()) for t, _, c in resampling.features(texts)] == [([0, 0, 2], [zlib.crc32(x) for x in (b"kept", b"words", b"more")])]


def test_crc_rows_equal_the_library():
    rows = np.random.default_rng(1).integers(0, 256, (50, 11)).astype(np.uint8)
    assert resampling.crc_rows(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


def plain_resample(docs, target, k=97, longest=1, least=3, percent=40, seed=2024):
    s, t = Counter(), Counter()
    for rows, into in ((docs, s), (target, t)):
        for _, text in rows:
            into.update(zlib.crc32(f.encode()) % k for f in plain_features(text, longest)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + k) / ((s[b] + 1) * (t_all + k)))) for b in range(k)]
    out = []
    for i, text in docs:
        f, n = plain_features(text, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[zlib.crc32(x.encode()) % k] for x in f)
        out.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, [x[0] for x in order[: percent * len(order) // 100]]


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_with_odd_and_repeated_rows(spark, longest):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "x1"], rng.integers(1, 9)))) for i in range(60)]
    docs += [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "null id has words"), (7, "repeated id in here"), (7, "repeated id in here"), (200, "long " * 300_000)]
    target = [(1, "alpha alpha beta words"), (2, None)]
    df = spark.createDataFrame([(i, t, 5, "clash") for i, t in docs], "doc_id long, text string, weight int, rank string").repartition(5)
    got = resampling.resample(df, spark.createDataFrame(target, "item_id long, text string"), 97, longest, 3, 40).collect()
    want, drawn = plain_resample(docs, target, longest=longest)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5])
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == drawn
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_resampling_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    (r,) = resampling.resample(some, none, least_words=1, percent=100).collect()
    assert (r.n_features, r["rank"]) == (3, 1) and r.weight == plain_resample([(1, "a b c")], [], 10_000)[0][0][3]


# URL rules

URLS = [
    None, "", "no scheme", "http://", "http://ORG", "http://x.ORG/a?b", "https://Example.org/es/1", "https://example.org/en/15", "https://example.org/en/", "https://myexample.org/es/",
    "ftp://a.example.org/en/1/2#f", "http://com/fr/", "http://b.com/de/x", "http://b.com:80/de/x", "http://b.com?q=/de/", "http://www.casino-royal.net/p", "http://mycasino-royal.net/p",
    "http://casino-history.net/casino-a.", "http://x.net/popunder/", "http://x.net/Popunder/z", "http://x.net/?Affiliate_ID=3", "http://x.net/a-viagra-b", "http://x.net/wp-login.php", "http://x.net/wp-login.php?x",
    "http://track.me.net/z/pixel", "http://ads.net", "http://x.ads.net/", "http://badads.net/", "http://" + "a/" * 50_000 + "popunder/", "http://x.net/a\nb?c://d", "HTTP://É.org/é", "://org/",
]


def plain_verdict(url, sites, patterns):
    head, mark, rest = (url or "").partition("://")
    host = path = ""
    if mark:
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    host, rest = low(host), low(rest) if mark else ""
    fit = []
    for v, r in sites:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append((len(r), v, r))
    if fit:
        _, v, r = max(fit)
        return host, path, r, v
    hit = [p for p in patterns if re.match(url_rules.pattern_rule(p).regex, rest)]
    return host, path, None, "allow" if not hit or any(p.startswith("@@") for p in hit) else "block"


def test_urls_against_all_rules(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(URLS + URLS[:8])], "page_id long, url string, verdict string")
    got = sorted(url_rules.filter_urls(df).collect())
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [plain_verdict(u, url_rules.SITES, url_rules.PATTERNS) for u in URLS + URLS[:8]]
    assert df.count() == len(got) and got[0].n_tried == 0
    assert {r.url: r.verdict for r in got}["http://casino-history.net/casino-a."] == "allow"
    assert {r.url: r.verdict for r in got}["http://www.casino-royal.net/p"] == "block"
    assert url_rules.filter_urls(df.where("false")).collect() == []


def test_no_rule_is_lost_by_the_index():
    """Random rules and URLs of few letters: those that fit are among the candidates, whatever the counts."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("ab.-/*^1"), rng.integers(1, 7)))
    rules = [url_rules.pattern_rule(str(rng.choice(["", "|", "||", "@@"])) + word() + str(rng.choice(["", "|"]))) for _ in range(300)]
    rules += [url_rules.site_rule("block", "".join(rng.choice(list("ab.1"), 3)) + "/" + "".join(rng.choice(list("ab1/"), rng.integers(0, 4)))) for _ in range(60)]
    counts = {t: int(rng.integers(0, 9)) for r in rules for t in r.tokens}
    judge = url_rules.Judge(rules, url_rules.index_rules(rules, counts))
    saved = 0
    for _ in range(400):
        host, path, rest = url_rules.split_url("http://" + "".join(rng.choice(list("ab.-/1?"), rng.integers(0, 14))))
        found = set(judge.candidates(rest))
        saved += len(rules) - len(found)
        assert all(k in found for k in range(len(rules)) if judge.fits(k, host + path, rest))
    assert saved > 0


def test_a_rule_is_filed_under_its_rarest_token(spark):
    rules = url_rules.compile_rules([("block", "shop.example.com/rare/x")], ["/open", "a*b"])
    assert rules[0].tokens == ("shop", "example", "com", "rare") and rules[1].tokens == rules[2].tokens == ()
    df = spark.createDataFrame([("http://shop.example.com/",)] * 3 + [("http://shop.example.com/rare/y",), ("http://rare.net/shop/example",), (None,)], "url string")
    counts = url_rules.token_counts(df, set(rules[0].tokens))
    assert counts == {"shop": 5, "example": 5, "com": 4, "rare": 2}
    assert url_rules.index_rules(rules, counts) == ({"rare": [0]}, [1, 2])
    with pytest.raises(ValueError):
        url_rules.compile_rules([], ("x" for _ in range(url_rules.MOST_RULES + 1)))


# hard negatives


def test_intervals_hold_every_score():
    rng = np.random.default_rng(6)
    for size in (1, 3, 64, 100, 300):
        x, q = rng.normal(size=(200, size)), rng.normal(size=(20, size))
        x[:20] = q + 0.2 * x[:20]
        x[20:22], q[0] = 0, 0
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1), 1e-9)[:, None]
        x, q = unit(x), unit(q)
        low, high = hard_negatives.Anchors(q).interval(slice(0, 20), *hard_negatives.encode(x))
        cos = q @ x.T
        assert (low <= cos).all() and (cos <= high).all()
        assert np.allclose(np.linalg.norm(hard_negatives.rotate(x), axis=1), np.linalg.norm(x, axis=1))
    # the codes tell: of 300 dimensions most pairs are known to be far from alike
    assert (high < 0.5).mean() > 0.8


def plain_mining(rows, positives=5, negatives=5, low=80, high=100):
    ok = [(i, y, [math.floor(256 * a) for a in v]) for i, y, v in rows if i is not None and y is not None and v and all(a is not None and math.isfinite(a) for a in v)]
    ok = [r for r in ok if sum(a * a for a in r[2]) < 2**62]
    out, done = [], set()
    for a, y, q in sorted(ok):
        if a % 100 or a in done:
            continue
        done.add(a)
        got = [(-sum(map(int.__mul__, q, v)), i, z == y) for i, z, v in ok if i != a and len(v) == len(q)]
        near = sorted(x for x in got if x[2])[:positives]
        for s, p, _ in near:
            fit = sorted(x for x in got if not x[2] and low * -s <= 100 * -x[0] <= high * -s)[:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("rows,cells", [(None, None), (8, 16)])
def test_mining_with_odd_rows(spark, monkeypatch, rows, cells):
    if rows:  # many small blocks on both sides
        monkeypatch.setattr(hard_negatives, "ROWS", (rows, 64))
        monkeypatch.setattr(hard_negatives, "ANCHORS", (1, 8))
        monkeypatch.setattr(hard_negatives, "CELLS", cells)
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(4, 12))
    table = [(i * 10, int(i % 4), (centre[i % 4 if i % 3 else (i + 1) % 4] + rng.normal(size=12)).tolist()) for i in range(120)]
    table += [(1, 0, table[0][2]), (3, 1, table[0][2]), (3, 1, table[0][2]), (5, 0, [0.0] * 12), (700, 2, [1.0] * 12), (100, None, [1.0] * 12), (None, 1, [1.0] * 12), (200_000, 1, None)]
    table += [(300_000, 1, []), (7, 1, [1.0, None] * 6), (9, 1, [float("nan")] * 12), (11, 2, [float("inf")] * 12), (13, 2, [1e300] * 12), (400_000, 3, [1.0, 2.0]), (401, 3, [1.0, 1.9]), (402, 2, [0.9, 1.8])]
    table += [(500_000, -1, [-0.001] * 12), (500_100, 1, [2.0**19] * 12), (500_101, 1, [2.0**19 + 1] * 12), (500_102, 0, [2.0**19 - 1] * 12)]
    df = spark.createDataFrame([(*r, "clash") for r in table], "vec_id long, label int, embedding array<double>, rank string").repartition(4)
    got = sorted(tuple(r) for r in hard_negatives.mine(df, "vec_id % 100 = 0").collect())
    assert got == plain_mining(table) and len(got) > 50


def test_mining_of_an_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], "vec_id long, label int, embedding array<float>"), "vec_id % 100 = 0").collect() == []


@pytest.mark.parametrize("name", ["op11_crc_resample", "op12_token_rules", "op13_one_bit_negatives"])
def test_selection_queries_match_their_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    d, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    names = sorted(x[0] for x in want.description)
    got = entry.queries()[name](spark, d)
    assert sorted(got.columns) == names
    order = lambda rows: sorted(rows, key=repr)
    assert order(tuple(r[c] for c in names) for r in got.collect()) == order(tuple(dict(zip([x[0] for x in want.description], r))[c] for c in names) for r in want.fetchall())
