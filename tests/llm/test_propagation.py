"""Label propagation against a plain loop over rows, cut links counted."""

import math
import struct
from collections import Counter, defaultdict

import pytest
import xxhash

from curatrix.llm import sharding


def spark_hash(*values):
    """Spark's hash of (value, bytes) columns, one seeding the next."""
    h = 42
    for v, size in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q" if size == 8 else "<i", v), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def plain_propagation(rows, shards, rounds):
    """rows: rid -> [k1, k2, linked, shard]; moved in place."""
    quota, settled = -(-len(rows) // shards), {}
    for step in range(rounds):
        linked = {r: v for r, v in rows.items() if v[2]}
        held = Counter(v[3] for v in linked.values())
        groups = defaultdict(Counter)
        for k1, k2, _, s in linked.values():
            groups[k1, k2][s] += 1
        good = {}
        for (k1, k2), n in groups.items():
            most = max(n.values())
            order = sorted(n, key=lambda s: (-n[s], spark_hash((k1, 8), (s, 4)), s))
            fit = [s for s in order if settled.get(s, 0) < 0.95 * quota or n[s] == most]
            good[k1, k2] = fit[: math.ceil(sum(n.values()) / quota)]
        wish = {}
        for r, (k1, k2, _, s) in linked.items():
            g = good[k1, k2]
            wish[r] = s if s in g else g[spark_hash((r, 8), (step, 4)) % len(g)]
        flow = Counter((linked[r][3], to) for r, to in wish.items())
        settled = {a: n for (a, b), n in flow.items() if a == b}
        flow = {k: n for k, n in flow.items() if k[0] != k[1]}
        if not flow:
            return
        share = sharding.accepted([quota - held.get(s, 0) for s in range(shards)], flow)
        if not any(share.values()):
            return
        for r, to in wish.items():
            s = linked[r][3]
            if to != s and (spark_hash((r, 8), (-step - 1, 4)) % (1 << 20)) / (1 << 20) < share[s, to]:
                rows[r][3] = to


def cut(rows):
    groups = defaultdict(Counter)
    for k1, k2, linked, s in rows.values():
        if linked:
            groups[k1, k2][s] += 1
    return sum(math.comb(sum(n.values()), 2) - sum(math.comb(k, 2) for k in n.values()) for n in groups.values())


@pytest.mark.parametrize("rounds", [1, 2, 8])
@pytest.mark.parametrize("groups,shards", [([2] * 30 + [5] * 10 + [9] * 4, 6), ([60, 40, 3, 3, 2], 5), ([1] * 20, 4)])
def test_propagation_follows_a_plain_loop(spark, groups, shards, rounds):
    rows, rid = {}, 0
    for g, size in enumerate([*groups, *[1] * 25]):
        for _ in range(size):
            r = spark_hash((rid, 8))
            rows[r] = [g * 7919, -g, size > 1, r % shards]
            rid += 1
    df = spark.createDataFrame([(r, r, *v) for r, v in rows.items()], "rid long, doc_id long, k1 long, k2 long, linked boolean, shard int").repartition(5)
    before = cut(rows)
    got = {r.rid: r.shard for r in sharding.propagate(df, len(rows), shards, rounds).collect()}
    plain_propagation(rows, shards, rounds)
    assert got == {r: v[3] for r, v in rows.items()}
    after = cut(rows)
    assert after < before or not before or max(groups) == 1
    if rounds == 8:
        assert after <= 0.75 * before
        quota = -(-len(rows) // shards)
        done = sharding.even_out(df.drop("shard").join(spark.createDataFrame(list(got.items()), "rid long, shard int"), "rid"), len(rows), shards).collect()
        sizes = Counter(r.shard for r in done)
        assert max(sizes.values()) - min(sizes.values()) <= 1 and max(sizes.values()) == quota


def test_columns_that_clash_and_long_texts_of_shards(spark):
    rows = [(1, "a", "clash", 3), (2, "a", "clash", 4), (3, "long " * 200_000, None, None), (None, None, "x", 1), (4, "", "y", 2)]
    got = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")).collect()
    assert Counter(r.doc_id for r in got) == Counter([1, 2, 3, 4, None]) and {r.doc_id: r.size for r in got}[3] == 1_000_008
    one = {r.doc_id: r.shard for r in got}
    assert len({(r.shard, r.slot) for r in got}) == 5 and isinstance(one[1], int)
