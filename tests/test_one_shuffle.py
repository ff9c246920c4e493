"""Cells that are grouped by target go through one shuffle, by target, and their rows are made behind it."""

from curatrix.operators import expression as E
from curatrix.operators import ortholog as O


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ortholog_cells_are_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(O, "CELLS_A_TASK", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ortho = spark.createDataFrame([("b1", 0, "t1"), ("b1", 1, "t1"), ("b2", 0, "t2,t3"), ("b2", 1, "-"), ("b3", 1, "t4"), ("b4", None, "t1"), ("b1", 0, "t1")], "busco_id string, species int, sequence string")
        lines = spark.createDataFrame([(0, "t1", "x", 1.0), (0, "t1", "x", 2.0), (1, "t1", "y", 4.0), (0, "t2", "z", 5.0), (1, None, "w", 6.0)], "species int, target_id string, run string, value double")
        seen = []

        def dealt(tasks):
            seen.append(tasks)
            return lines.repartition(tasks, "target_id").groupBy("species", "target_id", "run").agg({"value": "sum"}).withColumnRenamed("sum(value)", "value")

        out = O.ortholog_expression(ortho, dealt, runs=lines)
        text = plan(out).split("== Initial Plan ==")[-1]
        # the lines, the genes beside them, and groups without a gene
        assert text.count("Exchange hashpartitioning(target_id") == 2 and text.count("Exchange hashpartitioning(busco_id") == 1 and text.count("Exchange hashpartitioning") == 3 and len(seen) == 1
        want = [("b1", 0, "x", 3.0), ("b1", 0, "z", None)] * 2 + [("b1", 1, "w", None), ("b1", 1, "y", 4.0), ("b2", 0, "x", None), ("b2", 0, "z", None)] + [(b, 1, r, None) for b in ("b2", "b3") for r in "wy"]
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
        assert sorted(map(str, map(tuple, O.ortholog_expression(ortho, dealt(3)).collect()))) == sorted(map(str, want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_dense_table_of_dealt_targets_is_not_shuffled_again(spark):
    lines = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("b", "y", 5.0), (None, "y", 7.0), ("b", None, 8.0)], "target_id string, run string, value double")
    counts = lines.repartition(5, "target_id").groupBy("target_id", "run").agg({"value": "sum"}).withColumnRenamed("sum(value)", "value")
    out = E.densify(counts, runs=lines.select("run").distinct())
    assert plan(out).split("BroadcastExchange")[0].count("Exchange hashpartitioning(target_id") == 1
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, map(tuple, E.densify(counts).collect())))
