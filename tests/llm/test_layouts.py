"""Verdicts that do not follow the layout of files, exact members by bit maps, and labellers against plain recomputation."""

import math
from collections import Counter

import numpy as np
import pytest

from curatrix.llm import common, quality_rules, weak_label


@pytest.mark.parametrize("least,each", [(1 << 16, 32), (1 << 3 << 12, 1)])
def test_members_are_exact(spark, monkeypatch, least, each):
    """Also with maps so small that most ids hit by chance."""
    monkeypatch.setattr(common, "LEAST_BITS", least)
    monkeypatch.setattr(common, "BITS_A_MEMBER", each)
    ids = spark.range(30_000).selectExpr("id * 7 as doc_id").unionByName(spark.range(50).selectExpr("cast(null as long) as doc_id"))
    members = spark.range(0, 200_000, 2).selectExpr("id as doc_id").unionByName(spark.range(3).selectExpr("cast(null as long) as doc_id"))
    maps = common.Members(ids, members).maps
    assert len(maps) > 1
    held = ids.where("doc_id is not null").select("doc_id", common.Members.hashes("doc_id").alias("h")).toArrow()
    got = common.is_member(maps, held.column("h").combine_chunks())
    assert got.tolist() == [i % 2 == 0 and i < 200_000 for i in held.column("doc_id").to_pylist()]


def test_members_of_empty_sets(spark):
    some, none = spark.range(5).selectExpr("id as doc_id"), spark.range(0).selectExpr("id as doc_id")
    for ids, members in ((some, none), (none, some)):
        maps = common.Members(ids, members).maps
        h = some.select(common.Members.hashes("doc_id").alias("h")).toArrow().column("h").combine_chunks()
        assert not common.is_member(maps, h).any()
    maps = common.Members(some, some).maps
    assert common.is_member(maps, h).all()


def test_texts_that_full_maps_leave_open_meet_their_ids(spark, monkeypatch):
    docs = spark.range(60_000).selectExpr("id as doc_id", "concat('text ', md5(cast(id as string))) as text").unionByName(spark.range(9).selectExpr("cast(null as long) as doc_id", "'null id' as text"))
    ids = spark.range(0, 60_000, 2).selectExpr("id as doc_id").unionByName(spark.range(2).selectExpr("cast(null as long) as doc_id"))
    want = quality_rules.gram_model(docs, ids)
    monkeypatch.setattr(common, "LEAST_BITS", 1 << 12)
    monkeypatch.setattr(common, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(common, "MAPS", 4)
    assert common.Members(docs, ids).open and np.array_equal(quality_rules.gram_model(docs, ids), want)


TEXT = ["The cat sat on the mat, and it was good. ", "BUY NOW!! cheap | pills | $$$ ", "one two three four five six seven. "]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = [(i, "".join(TEXT[k] * int(rng.integers(1, 9)) for k in rng.integers(0, 3, rng.integers(1, 5))) + f"w{i}") for i in range(400)]
    return out + [(None, "no id " * 30), (None, "no id " * 30), (5, None), (6, ""), (7, "abc"), (8, "long text, " * 100_000)]


def written(spark, rows, folder, files):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(files).write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_classifier_does_not_follow_the_layout(spark, rows, tmp_path):
    got = []
    for k, files in enumerate((3, 7)):
        docs = written(spark, rows[:: 1 - 2 * k], tmp_path / str(k), files)
        got.append(Counter(tuple(r) for r in weak_label.classify(docs).drop("text").collect()))
    assert got[0] == got[1] and sum(got[0].values()) == len(rows)


def test_quality_model_does_not_follow_the_layout(spark, rows, tmp_path):
    ids = spark.range(0, 400, 3).selectExpr("id as doc_id")
    models = [quality_rules.gram_model(written(spark, rows, tmp_path / str(n), n), ids) for n in (3, 7)]
    assert np.array_equal(*models)


def plain_posterior(patterns, counts, rounds=100):
    """The same model, vote by vote."""
    p = [1 / (1 + math.exp(-sum({0: 0, 1: 1, 2: -1}[v] for v in x))) for x in patterns]
    for _ in range(rounds):
        seen = [[[0.5] * 3 for _ in range(len(patterns[0]))] for _ in range(2)]
        mass = [0.0, 0.0]
        for x, n, q in zip(patterns, counts, p):
            for c, w in enumerate((q * n, (1 - q) * n)):
                mass[c] += w
                for k, v in enumerate(x):
                    seen[c][k][v] += w
        odds = []
        for x in patterns:
            log = [math.log((mass[c] + 1) / (sum(mass) + 2)) + sum(math.log(seen[c][k][v] / sum(seen[c][k])) for k, v in enumerate(x)) for c in range(2)]
            odds.append(1 / (1 + math.exp(min(50, max(-50, log[1] - log[0])))))
        moved, p = max(abs(a - b) for a, b in zip(odds, p)), odds
        if moved < 1e-9:
            break
    return p


def test_posterior_and_score_by_hand(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    votes = [weak_label.votes(t or "") for _, t in rows]
    count = Counter(votes)
    patterns = sorted(count)
    post = dict(zip(patterns, plain_posterior(patterns, [count[x] for x in patterns])))
    table, weight, bias, _ = weak_label.fit(df)
    got = Counter((r.doc_id, round(r.posterior, 6), round(r.score, 6), r.kept) for r in weak_label.classify(df).collect())
    for (i, text), v in zip(rows[:50] + rows[-6:], votes[:50] + votes[-6:]):
        data = (text or "").encode()
        grams = [(int.from_bytes(data[k : k + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16 for k in range(min(len(data) - 3, 2_000_000))]
        score = 1 / (1 + math.exp(-(bias + weak_label.SCALE * sum(weight[g] for g in grams) / len(grams)))) if len(data) >= 4 else post[v]
        assert (i, round(post[v], 6), round(score, 6), score >= 0.5) in got
    # one fitter, step by step, on a table that one task holds
    assert table[weak_label._code(votes[0])] == pytest.approx(post[votes[0]], abs=1e-6)


def test_scorer_is_fitted_as_stated(spark, rows, monkeypatch):
    """Adagrad over all chosen rows in the order of their hash, in one fitter, by plain loops."""
    monkeypatch.setattr(weak_label, "FITTERS", 1)
    some = rows[:40]
    df = spark.createDataFrame(some, "doc_id long, text string")
    table, weight, bias, _ = weak_label.fit(df)
    order = [r.text for r in df.selectExpr("text", "xxhash64(doc_id, text) as h").orderBy("h").collect()]
    w, held, b, b_held = Counter(), Counter(), 0.0, 1e-8
    for _ in range(weak_label.EPOCHS):
        for text in order:
            data = text.encode()
            grams = Counter((int.from_bytes(data[k : k + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16 for k in range(len(data) - 3))
            x = {k: weak_label.SCALE * c / (len(data) - 3) for k, c in grams.items()}
            z = b + sum(w[k] * v for k, v in x.items())
            g = 1 / (1 + math.exp(-min(30, max(-30, z)))) - table[weak_label._code(weak_label.votes(text))]
            for k, v in x.items():
                held[k] += (g * v) ** 2
                w[k] -= weak_label.RATE * g * v / (held[k] + 1e-8) ** 0.5
            b_held += g * g
            b -= weak_label.RATE * g / b_held**0.5
    assert bias == pytest.approx(b, abs=1e-6) and all(weight[k] == pytest.approx(v, abs=1e-6) for k, v in w.items())


def test_clashing_columns_of_the_classifier_go(spark, rows):
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows[:20]], "doc_id long, text string, Score string, posterior string, kept string, other string")
    got = weak_label.classify(df, carry=True)
    assert got.columns == ["doc_id", "text", "other", "posterior", "score", "kept"] and got.count() == 20
    assert quality_rules.judge(df, np.zeros(1 << quality_rules.BITS), carry=True).columns[:3] == ["doc_id", "text", "Score"]
