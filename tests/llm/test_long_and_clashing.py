"""Very long texts and columns that clash, where other tests have none."""

import numpy as np
import pytest

from curatrix.llm import jaccard, quality_rules, secrets


def long_text(seed, words=150_000):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, 50_000, words))


def test_near_copies_of_long_texts_and_clashing_columns(spark):
    a = long_text(1)
    near, far = a.replace("w77 ", "other ").replace("w78 ", "words "), " ".join(a.split()[::-1])
    rows = [(1, a), (2, near), (3, far), (4, "short one"), (5, "short one"), (6, None)]
    df = spark.createDataFrame([(i, t, "x", 7, True) for i, t in rows], "doc_id long, text string, class_id string, N_links int, kept boolean")
    got = {r.doc_id: (r.class_id, r.n_links, r.kept) for r in jaccard.jaccard_classes(df).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (3, 0, True), 4: (4, 1, True), 5: (4, 1, False), 6: (6, 0, True)}
    left = jaccard.drop_near_copies(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 6]


def test_judging_long_texts_and_clashing_columns(spark):
    text = long_text(2) + "\n\n" + "again " * 5
    df = spark.createDataFrame([(1, text, "x", 2.0, "y")], "doc_id long, text string, N_words string, llr double, other string")
    got = quality_rules.judge(df, np.zeros(1 << quality_rules.BITS), carry=True)
    assert got.columns == ["doc_id", "text", "other", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    r = got.first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == (150_005, len(text.replace(" ", "").replace("\n", "")), 0, 0) and r.kept


def test_scanning_long_texts_and_clashing_columns(spark):
    text = long_text(3) + " password=hunter2hunter2 " + "x" * 1_000_000 + " AKIA" + "Q1W2E3R4T5Y6U7I8"
    df = spark.createDataFrame([(1, text, 5, "s", "r")], "doc_id long, text string, N_assign int, spans string, Redacted string")
    got = secrets.scan_secrets(df, carry=True)
    assert got.columns == ["doc_id", "text", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted"]
    r = got.first()
    at = text.index("password")
    assert (r.n_assign, r.n_access) == (1, 1) and r.spans.startswith(f"assign:{at}:{at + 23},access:{len(text) - 20}:{len(text)}")


@pytest.mark.parametrize("block", [2, 3, 50])
def test_blocks_of_a_subtree_find_what_one_block_does(spark, monkeypatch, block):
    """Chains of near copies in many small blocks on both levels."""
    rng = np.random.default_rng(4)
    base = [f"a{k}" for k in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.integers(0, 120, 1 + i % 2):
            words[k] = f"b{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"c{i}_{k}" for k in range(60))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, jaccard.jaccard_classes(df).collect()))
    for name in ("BUCKET_BLOCK", "COMPONENT_BLOCK"):
        monkeypatch.setattr(jaccard, name, block)
    assert sorted(map(tuple, jaccard.jaccard_classes(df).collect())) == want
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    for (i, _, n, _), mine in zip(want, sets):
        assert n == sum(len(mine & o) >= 0.8 * len(mine | o) for o in sets) - 1
