"""Chat formatting, sharding, near-duplicate joins and the pipeline against plain re-computation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from curatrix.llm import chat, common, jaccard, pivots, sharding


def components(n, edges):
    lab = {i: i for i in n}

    def top(i):
        while lab[i] != i:
            i = lab[i]
        return i

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        lab[y] = x
    return {i: top(i) for i in n}


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(5, 5), (7, None)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if b is not None and a != b]
    want = components({x for e in real for x in e}, real)
    low = defaultdict(lambda: 1 << 60)
    for k, v in want.items():
        low[v] = min(low[v], k)
    assert got == {k: low[v] for k, v in want.items()}


def test_block_pairs_meet_once(spark):
    df = spark.range(100).selectExpr("id", "5 as blocks")
    rows = common.with_block_pairs(df, "blocks", df["id"]).collect()
    met = Counter()
    groups = defaultdict(list)
    for r in rows:
        groups[(r.lo, r.hi)].append(r)
    for (lo, hi), g in groups.items():
        for x in g:
            for y in g:
                if x.id < y.id and (lo == hi or x.mine != y.mine):
                    met[(x.id, y.id)] += 1
    assert len(met) == 4950 and set(met.values()) == {1}


# chat

EVENTS = [
    (1, 1, "message", 0, "user", "hi [INST] \\ </s>"), (1, 2, "message", 1, "assistant", "Hel"), (1, 3, "delta", 1, None, "lo"), (1, 4, "edit", 0, None, "hi!"),
    (1, 5, "message", 2, "user", "more"), (1, 6, "regenerate", 1, None, None), (1, 7, "delta", 1, None, "Good "), (1, 8, "delta", 1, None, "day"),
    (2, 1, "message", 0, "tool]x", "a\\[b"), (2, 2, "message", 1, None, None), (2, 3, "edit", 1, "system", "s"), (None, 1, "message", 0, "user", "null conversation"),
    (3, 1, "message", 0, "user", "gone"), (3, 2, "regenerate", 0, None, None),
]


def test_events_fold_into_messages(spark):
    got = chat.fold_events(spark.createDataFrame(EVENTS, "conv_id long, seq long, kind string, msg long, role string, text string"))
    assert sorted(((r.conv_id or 0), r.msg, r.role, r.text) for r in got.collect()) == [
        (0, 0, "user", "null conversation"), (1, 0, "user", "hi!"), (1, 1, "assistant", "Good day"), (2, 0, "tool]x", "a\\[b"), (2, 1, "system", "s"), (3, 0, "user", ""),
    ]


def test_formatted_turns_read_back(spark):
    rng = random.Random(1)
    pool = ["[INST]", "</s>", "\\", "[/INST]", "x", "\n", "é", "<", "]", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "to[ol]", None]), "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for c in range(20) for t in range(6)]
    rows += [(0, 3, "assistant", None), (0, 3, "assistant", "tie"), (None, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat.format_turns(chat.messages_as_events(df))
    got = {r.conv_id: r for r in chat.read_back(turns).collect()}
    for c in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(mine), hashlib.sha256(text.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for r in turns.collect():
        under = chat.unescape(r.rendered[r.loss_start : r.loss_start + r.loss_length])
        assert under == "".join(t for _, t, loss in chat.parse(r.rendered) if loss)
    assert chat.read_back(chat.format_turns(chat.messages_as_events(df.limit(0)))).collect() == []


def test_a_log_of_drafts_deltas_edits_and_regenerations_comes_to_the_same_turns(spark):
    rng = random.Random(4)
    pool = ["[INST]", "</s>", "\\", "x", "\n", "é😀", "<", "] ", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), "".join(rng.choice(pool) for _ in range(rng.choice([0, 3, 40, 300])))) for c in range(12) for t in range(7)]
    rows += [(0, 3, "assistant", None), (0, 3, "user", None), (None, None, "user", "x"), (None, None, "user", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, kind string")
    log = chat.turns_as_log(df, piece=50)
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    plain = chat.read_back(chat.format_turns(chat.messages_as_events(df)))
    assert Counter(chat.read_back(chat.format_turns(log)).collect()) == Counter(plain.collect())
    assert chat.read_back(chat.format_turns(chat.turns_as_log(df.limit(0)))).collect() == []


def test_a_turn_of_any_length_is_parsed_in_little_memory():
    import tracemalloc

    text = "a \\[b\\<c\\\\ " * 2_000_000  # 20 million characters of the format
    formatted = f"[INST] {text} [/INST]{text}</s>"
    tracemalloc.start()
    sizes = [(role, len(x)) for role, x, _ in chat.parse(formatted)]
    assert tracemalloc.get_traced_memory()[1] < 400_000_000
    tracemalloc.stop()
    assert sizes == [("user", 16_000_000), ("assistant", 16_000_000)]


# sharding


@pytest.mark.parametrize("n", [0, 7, 1000])
def test_shards_are_even_and_slots_gapless(spark, n):
    rng = random.Random(n)
    rows = [(i, "hot" if i % 3 == 0 else f"pair {i // 4}" if i % 3 == 1 else rng.choice([None, "", f"single {i}"])) for i in range(n)]
    rows += rows[:2]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes = Counter(r.shard for r in got)
    assert max([0, *sizes.values()]) - min(sizes.get(s, 0) for s in range(24)) <= 1
    for s, k in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(k))
    assert all(r.law == "rows" and r.grown_shard is None for r in got)


def test_most_applicants_go_and_no_shard_overflows():
    assert sharding.accepted([0, 0, 0], {(0, 1): 5, (1, 2): 5, (2, 0): 5}) == {(0, 1): 1, (1, 2): 1, (2, 0): 1}
    assert sharding.accepted([3, 0], {(1, 0): 5}) == {(1, 0): 0.6} and sharding.accepted([0, 9], {(1, 0): 5}) == {(1, 0): 0}
    rng = random.Random(3)
    for _ in range(200):
        room = [rng.randint(0, 3) for _ in range(3)]
        flow = {(a, b): rng.randint(1, 3) for a in range(3) for b in range(3) if a != b and rng.random() < 0.7}
        share = sharding.accepted(room, flow)
        go = {k: round(share[k] * n) for k, n in flow.items()}
        loads = lambda x: [sum(n for (_, b), n in x.items() if b == s) - sum(n for (a, _), n in x.items() if a == s) for s in range(3)]
        assert all(v <= r for v, r in zip(loads(go), room))
        best = max(sum(x) for x in product(*(range(n + 1) for n in flow.values())) if all(v <= r for v, r in zip(loads(dict(zip(flow, x))), room)))
        assert sum(go.values()) == best


def test_shards_do_not_depend_on_where_rows_lie(spark):
    rows = [(i % 150, f"group {i // 6}" if i % 2 else "hot") for i in range(600)] + [(None, None)] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [Counter(tuple(r) for r in sharding.shard_documents(df.repartition(n)).collect()) for n in (3, 7)]
    assert got[0] == got[1]


def test_rows_that_stand_often_are_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "REPEATS", 7)
    got = sharding.shard_documents(spark.createDataFrame([(1, "x")] * 50 + [(2, "x")], "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in got) == {1: 50, 2: 1} and len({(r.shard, r.slot) for r in got}) == 51


def test_labels_gather_copies(spark):
    rows = [(i, f"group {i // 6}") for i in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shard = {r.doc_id: r.shard for r in got}
    together = sum(shard[i] == shard[j] for g in range(500) for i in range(6 * g, 6 * g + 6) for j in range(i + 1, 6 * g + 6))
    assert together / (500 * 15) > 0.5  # 1 in 24 by chance


# Jaccard join


def plain_jaccard(rows, threshold=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        if i is not None and w:
            sets.setdefault(i, []).append(frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)]))
    flat = [(i, s) for i, v in sets.items() for s in v]
    links, edges = Counter(), []
    for x in range(len(flat)):
        for y in range(len(flat)):
            (i, a), (j, b) = flat[x], flat[y]
            if x != y and len(a & b) >= threshold * len(a | b):
                links[(i, x)] += 1
                edges.append((i, j))
    return sets, edges, links


def near_copies(rng, n):
    out = []
    for g in range(n):
        words = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(rng.choice([3, 30, 120, 300]))]
        for _ in range(rng.choice([1, 2, 5])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = "changed"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("blocks", [False, True])
def test_classes_and_links_against_all_pairs(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(jaccard, "BUCKET_BLOCK", 3)
        monkeypatch.setattr(jaccard, "COMPONENT_BLOCK", 3)
    rng = random.Random(12)
    rows = list(enumerate(near_copies(rng, 60))) + [(900, None), (901, ""), (902, " \n"), (903, "two words"), (904, "two words"), (None, "two words")]
    hot = "a long common text with some words in it that many documents share " * 3
    rows += [(1000 + i, hot + f" tail {i}") for i in range(40)]
    got = {r.doc_id: r for r in jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets, edges, links = plain_jaccard(rows)
    ids = [i for i, _ in rows if i is not None]
    want = components(ids, edges)
    low = defaultdict(lambda: 1 << 60)
    for k, v in want.items():
        low[v] = min(low[v], k)
    assert {i: got[i].class_id for i in ids} == {i: low[want[i]] for i in ids}
    assert {i: got[i].n_links for i in ids} == {i: sum(v for (k, _), v in links.items() if k == i) for i in ids}
    assert got[None].n_links == 0 and sum(r.kept for r in got.values() if r.doc_id is not None) == len(set(low[v] for v in want.values()))


def test_jaccard_of_an_empty_table(spark):
    assert jaccard.jaccard_classes(spark.createDataFrame([], "doc_id long, text string, node string")).collect() == []


def test_prefix_is_shortened_until_the_recall_is_met():
    for s in (0.6, 0.8, 0.9):
        k = jaccard.prefix_depth(s)
        assert 1 - (1 - s**k) ** jaccard.TREES >= jaccard.TARGET_RECALL or k == 1
        assert k == jaccard.DEPTH or 1 - (1 - s ** (k + 1)) ** jaccard.TREES < jaccard.TARGET_RECALL


def plain_signature_pair(rng, n, share):
    """Two sets of n of which ``share`` is common to both, as sorted hashes."""
    u = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    common, rest = u[: round(len(u) * share)], u[round(len(u) * share) :]
    return np.sort(np.concatenate([common, rest[::2]])), np.sort(np.concatenate([common, rest[1::2]]))


@pytest.mark.parametrize("n", [5, 10, 40, 300])
def test_signatures_agree_as_sets_do_and_meet_in_a_tree(n):
    rng, agree, met = np.random.default_rng(n), [], 0
    for _ in range(400):
        x, y = (np.frombuffer(jaccard.signature(s), "<u2") for s in plain_signature_pair(rng, n, 0.8))
        agree.append((x == y).mean())
        met += (x == y).reshape(jaccard.TREES, jaccard.DEPTH)[:, : jaccard.prefix_depth(0.8)].all(1).any()
    assert abs(np.mean(agree) - 0.8) < 0.01 and min(agree) > 0.8 - jaccard.SLACK
    assert met >= 399


def test_descent_stops_where_all_rows_are_joined_and_goes_on_where_they_are_not():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 16, 128).astype("<u2")
    alike = np.tile(base, (60, 1))
    alike[np.arange(60), rng.integers(8, 128, 60)] += 1
    lab, compared = jaccard.descend(alike, alike[:, :8], 0.55, 4)
    assert (lab == 0).all() and compared == [59, 0, 0, 0, 0]  # full depth joins all; shorter prefixes compare nothing
    apart = alike.copy()
    apart[30:, 5:8] += np.arange(30, 60, dtype="<u2")[:, None]  # these share five values only, and no two share more
    lab, compared = jaccard.descend(apart, apart[:, :8], 0.55, 4)
    assert (lab == 0).all() and compared[0] == 29 and compared[1] == compared[2] == 0 and compared[3] >= 30 and compared[4] == 0


def test_descent_finds_the_components_of_all_pairs():
    rng = np.random.default_rng(6)
    centres = rng.integers(0, 1 << 16, (6, 128)).astype("<u2")
    sig = centres[rng.integers(0, 6, 200)]
    sig[:, :4] = 7  # one subtree
    for r in sig:
        r[rng.random(128) < rng.choice([0.05, 0.3])] = rng.integers(0, 1 << 16)
    sig[:, :4] = 7
    sig = sig[np.lexsort(sig[:, :8].T[::-1])]
    lab, _ = jaccard.descend(sig, sig[:, :8], 0.55, 4)
    ok = (sig[:, None, :] == sig[None, :, :]).mean(2) >= 0.55
    i, j = np.nonzero(np.triu(ok, 1))
    assert np.array_equal(lab, jaccard.roots(len(sig), i, j))


# pivots


@pytest.mark.parametrize("block", [1024, 20])
def test_cosine_links_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "LIST_BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(150, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(60):
        rows.append((200 + i, (base[i] * rng.uniform(0.5, 2) + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.4])).tolist()))
    rows += [(400 + i, (base[0] + rng.normal(size=32) * 0.05).tolist()) for i in range(90)] + [(600, base[1].tolist()), (600, base[1].tolist())]
    bad = [(700, None), (701, [0.0] * 32), (702, [None, *[1.0] * 31]), (703, [float("nan"), *[1.0] * 31]), (704, [float("inf"), *[1.0] * 31]), (None, base[2].tolist()), (705, [])]
    got = pivots.cosine_links(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")).collect()
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ok = m @ m.T >= 0.9
    np.fill_diagonal(ok, False)
    want = ok.sum()
    assert sum(r.n_links for r in got) >= 0.97 * want
    true = Counter(i for (i, _), n in zip(rows, ok.sum(1)) for _ in range(n))
    assert all(r.n_links <= max(1, true[r.vec_id]) for r in got)
    by = {r.vec_id: r for r in got if r.vec_id is not None}
    assert all(by[i].n_links == 0 and by[i].component_id == i and by[i].kept for i, _ in bad if i is not None)
    assert {by[400 + i].component_id for i in range(90)} == {0}
    assert len(got) == len(rows) + len(bad)


def test_recall_by_cosine_band_in_64_dimensions(spark):
    """Pairs spread over the bands from 0.9 on; the least recall over bands is recorded in the README."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    noise = rng.normal(size=(2000, 64))
    noise -= (noise * base[:2000]).sum(1, keepdims=True) * base[:2000]
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    cos = np.repeat([0.9005, 0.91, 0.93, 0.96, 0.99], 400)[:, None]
    m = np.concatenate([base, cos * base[:2000] + np.sqrt(1 - cos**2) * noise])
    got = {r.vec_id: r for r in pivots.cosine_links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")).collect()}
    ok = m @ m.T >= 0.9
    np.fill_diagonal(ok, False)
    assert all(got[i].n_links <= n for i, n in enumerate(ok.sum(1)))
    for k in range(5):
        pairs = range(400 * k, 400 * (k + 1))
        assert np.mean([got[i].component_id == got[3000 + i].component_id for i in pairs]) >= 0.95


def test_order_of_pivots_decides_what_is_retrieved():
    x, y = np.array([[1, 2, 3, 4, 5, 6, 7, 8]]), np.array([[5, 6, 7, 8, 1, 2, 3, 4]])
    assert not pivots.retrieved(x, y, 4, 2)[0] and pivots.retrieved(x, y, 5, 2)[0]
    assert not pivots.retrieved(x, np.array([[1, 12, 13, 14, 15, 16, 17, 18]]), 4, 2)[0]
    rng = np.random.default_rng(2)
    units, some = pivots.unit(rng.normal(size=(300, 16))), pivots.unit(rng.normal(size=(100, 16)))
    assert np.array_equal(pivots.permutations(units, some, 8), np.argsort(-(units @ some.T), axis=1, kind="stable")[:, :8])


BANDS = (0.9005, 0.92, 0.95, 0.99)


def spread_out(n, size, seed):
    return pivots.unit(np.random.default_rng(seed).normal(size=(n, size)))


@pytest.mark.parametrize("size,n", [(64, 20_000), (64, 70_000), (256, 70_000), (256, 1_000_000)])
def test_index_finds_pairs_of_vectors_that_are_no_pivots(size, n):
    some, sample, fresh = spread_out(int(max(64, 4 * n**0.5)), size, 1), spread_out(2000, size, 2), spread_out(2000, size, 3)
    k, reach, shared = pivots.measured_reach(sample, some)
    for cosine in BANDS:
        assert pivots.retrieved(pivots.permutations(fresh, some, k), pivots.permutations(pivots.perturbed(fresh, cosine, 9), some, k), reach, shared).mean() >= 0.95


def test_reach_is_the_least_that_retrieves_the_target():
    some, sample = spread_out(200, 32, 4), spread_out(300, 32, 5)
    k, reach, shared = pivots.measured_reach(sample, some)
    x, y = (pivots.permutations(v, some, k) for v in (sample, pivots.perturbed(sample, 0.9)))
    assert pivots.retrieved(x, y, reach, shared).mean() >= 0.98 > pivots.retrieved(x, y, reach - 1, shared).mean()
    assert pivots.measured_reach(sample, spread_out(2000, 32, 4), -0.9) is None and pivots.measured_reach(sample[:0], some) == (1, 1, 1)


def planted(n, size, each, bands=BANDS):
    base = spread_out(n, size, 6)
    copies = np.concatenate([pivots.perturbed(base[i * each : (i + 1) * each], c, 7 + i) for i, c in enumerate(bands)])
    return np.concatenate([base, copies])


def vector_table(spark, m, folder):
    pq.write_table(pa.table({"vec_id": np.arange(len(m)), "embedding": list(m)}), folder / "v.parquet", row_group_size=10_000)
    return spark.read.parquet(str(folder / "v.parquet"))


def test_links_of_seventy_thousand_vectors(spark, tmp_path):
    """More vectors than once were measured on their own pivots."""
    n, each = 70_000, 250
    m = planted(n, 64, each)
    got = pivots.cosine_links(vector_table(spark, m, tmp_path)).toPandas().set_index("vec_id").sort_index()
    for k in range(len(BANDS)):
        i = np.arange(k * each, (k + 1) * each)
        assert np.mean(got.component_id.loc[n + i].to_numpy() == got.component_id.loc[i].to_numpy()) >= 0.95
    assert (got.n_links.loc[len(BANDS) * each : n - 1] == 0).all()  # random vectors are far from 0.9


def test_where_no_setting_retrieves_enough_all_are_compared(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(pivots, "measured_reach", lambda *a: None)
    m = planted(300, 16, 20)
    got = pivots.cosine_links(vector_table(spark, m, tmp_path)).toPandas().set_index("vec_id").sort_index()
    ok = m @ m.T >= 0.9
    np.fill_diagonal(ok, False)
    assert (got.n_links.to_numpy() == ok.sum(1)).all()


def test_pivots_and_sample_are_apart(spark):
    m = planted(400, 8, 0)
    df = spark.createDataFrame([(i, 7 * i, v.tolist()) for i, v in enumerate(m)], "h1 long, h2 long, vector array<double>")
    some, sample = pivots.choose_pivots(df, 400, 8)
    assert len(sample) == 400 - 80 and not (some @ sample.T > 1 - 1e-9).any() and (np.triu(some @ some.T, 1) < pivots.PIVOT_COSINE).all()
    assert [len(x) for x in pivots.choose_pivots(df.limit(1), 1, 8)] == [1, 0]


def test_cosines_of_very_large_small_and_unequal_vectors(spark):
    rows = [(1, [1e200, 0.0]), (2, [1e200, 1e190]), (3, [1e-200, 1e-200]), (4, [3e-200, 3.1e-200]), (5, [1e-200, -1e-200]), (6, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.01]), (8, [5e-324, 0.0]), (9, [-1.0])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<double>, kept string")
    got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.cosine_links(df).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 8: (2, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (1, 6), 7: (1, 6), 9: (0, 9)}


def test_cosine_of_an_empty_table(spark):
    assert pivots.cosine_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


# pipeline


def test_pipeline_stages_follow_their_inputs(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, d), name)
        assert docs.columns == names
        assert docs.count() <= before
        before = docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert not any(labels.get(i) == 0 for i in texts)
    sets, edges, _ = plain_jaccard(list(texts.items()))
    assert all(i == j for i, j in edges)
    from curatrix.llm.secrets import secret_spans

    assert not any(s for t in texts.values() for s in secret_spans(t) if s[2] < 3)
    packed = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in packed} == set(texts)
