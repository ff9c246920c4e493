"""Stages of the pipeline on odd tables."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_lines int, component string"


def stages(spark, rows, d="/root/testdata/sf0.001"):
    docs, out = spark.createDataFrame([(i, t, "en", "s", 0, "clash", 0, "clash") for i, t in rows], SCHEMA), {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, d)
        out[name] = sorted((r.doc_id is not None, r.doc_id or 0) for r in got.select("doc_id").collect())
        if name != "packing":
            assert got.columns == corpus_pipeline.COLUMNS
    return out


def test_stages_of_odd_rows(spark):
    words = " ".join(f"word{i}" for i in range(90))
    rows = [(1, None), (2, ""), (3, words), (3, words), (4, words), (None, words), (5, "key " + "q9Zt7Lr2Wx5Vb8Nm3Kp6Jh1Gf4Ds0Ayz"), (6, "x" * 100_000)]
    got = stages(spark, rows)
    every = sorted((i is not None, i or 0) for i, _ in rows)
    assert set(got["packing"]) == set(every)
    assert got["line_dedup"] == every and got["secret_scan"] == every
    assert got["jaccard_join"] == [x for x in every if x != (True, 4)]  # one of 3 and 4; both rows of 3 stay
    assert not {(True, 1), (True, 2), (True, 6)} & set(got["quality_rules"])


def test_stages_of_an_empty_table(spark):
    assert all(v == [] for v in stages(spark, []).values())
