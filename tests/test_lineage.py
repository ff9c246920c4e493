"""Lineages of more rows than a recursive query may hold, of repeated and null ids, and of chains that do not end."""

import pytest

from curatrix.operators import taxonomy as X


def nodes_of(spark, rows):
    return spark.createDataFrame(rows, "taxid long, parent_taxid long, rank string")


def test_lineages_are_not_held_to_a_million_rows(spark):
    n = 600_000
    nodes = spark.range(n).selectExpr("id + 10 taxid", "2L parent_taxid", "'species' rank").unionAll(nodes_of(spark, [(1, 1, "no rank"), (2, 1, "genus")]))
    merged = spark.createDataFrame([], "old_taxid long, new_taxid long")
    out = X.lineage(nodes.where("rank = 'species'").select("taxid"), nodes, merged)
    assert {(r["depth"], r["rank"]): r["count"] for r in out.groupBy("depth", "rank").count().collect()} == {(0, "species"): n, (1, "genus"): n, (2, "no rank"): n}


def test_repeated_and_missing_rows(spark):
    nodes = nodes_of(spark, [(1, 1, "no rank"), (2, 1, "genus"), (2, 1, "genus"), (3, 2, "species"), (4, 99, "species"), (None, 2, "species"), (5, None, "species")])
    merged = spark.createDataFrame([(7, 3)], "old_taxid long, new_taxid long")
    ids = spark.createDataFrame([(7,), (7,), (3,), (4,), (None,), (8,), (5,)], "taxid long")
    found = sorted(tuple(r) for r in X.lineage(ids, nodes, merged).collect())
    up = [(0, 3, "species")] + [(1, 2, "genus")] * 2 + [(2, 1, "no rank")] * 2
    assert found == sorted([(t, a, r, d) for t in (3, 7) for d, a, r in up] + [(4, 4, "species", 0), (5, 5, "species", 0)])


def test_a_cycle_raises(spark, monkeypatch):
    monkeypatch.setattr(X, "MAX_DEPTH", 3)
    nodes = nodes_of(spark, [(1, 2, "a"), (2, 1, "b")])
    with pytest.raises(RuntimeError):
        X.lineage(nodes.select("taxid"), nodes, spark.createDataFrame([], "old_taxid long, new_taxid long")).count()
