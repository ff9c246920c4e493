"""Whole tables where a query or operator used to take a part."""

import inspect
import math

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from curatrix.operators import batch, corr, expression, filters, matrix, ortholog, reads, tmm
from curatrix.plans import bindings as B


def brute_tau(x, y):
    sx, sy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    den = math.sqrt((sx != 0).sum() * float((sy != 0).sum()))
    return (sx * sy).sum() / den if den else None


def test_kendall_over_all_runs(spark, sf_dir):
    wide = B.counts(spark, sf_dir).toPandas().pivot_table(index="target_id", columns="run", values="value")
    got = {(r.run_a, r.run_b): (r.n_pairs, r.r) for r in entry.queries()["correlation_matrix_kendall"](spark, sf_dir).collect()}
    runs = sorted(wide.columns)
    assert sorted(got) == [(a, b) for i, a in enumerate(runs) for b in runs[i + 1 :]]
    for (a, b), (n, r) in got.items():
        v = wide[[a, b]].dropna().to_numpy(float)
        assert n == len(v) and r == pytest.approx(brute_tau(v[:, 0], v[:, 1]), abs=1e-6)


def test_kendall_by_sorting_with_missing_cells_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    m = rng.integers(0, 7, (60, 9)).astype(float)
    m[rng.random(m.shape) < 0.2] = np.nan
    m[:, 8] = 3.0
    m[:, 7] = np.nan
    m[0, 7] = 1.0
    rows = [(f"t{i}", f"r{j}", float(m[i, j])) for i in range(60) for j in range(9) if not np.isnan(m[i, j])]
    monkeypatch.setattr(corr, "KENDALL_RUNS", 3)
    monkeypatch.setattr(corr, "KENDALL_CELLS", 120)
    got = {(r.run_a, r.run_b): (r.n_pairs, r.r) for r in corr.kendall_matrix(spark.createDataFrame(rows, "target_id string, run string, value double")).collect()}
    assert len(got) == 36
    for (a, b), (n, r) in got.items():
        v = m[:, [int(a[1:]), int(b[1:])]]
        v = v[~np.isnan(v).any(1)]
        want = brute_tau(v[:, 0], v[:, 1])
        assert n == len(v) and (r is None if want is None else r == pytest.approx(want, abs=1e-12))


def test_second_round_of_one_large_job_runs_in_ranges(spark):
    rows = [("a", 1, 100.0, 50, 50, 3000.0, 1.0), ("a", 2, 100.0, 40, 0, 1000.0, 1.0), ("b", 1, 100.0, 9, 0, 1000.0, 1.0), (None, 1, 100.0, 40, 0, 1000.0, 1.0)] + [("a", i, 100.0, 11, 0, 1000.0, 1.0) for i in range(3, 40)]
    schema = "job string, pos int, spot_length double, total_spots long, used_spots long, target_bp double, rate double"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = reads.second_round_ranges(spark.createDataFrame(rows, schema), "job")
        got = {(r.job, r.pos): r.reads for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    # a: 30 short; the second run takes 30
    assert got[("a", 1)] == 0 and got[("a", 2)] == 40 and all(got[("a", i)] == 10 for i in range(3, 40)) and got[("b", 1)] == 9 and got[(None, 1)] == 10
    rows = [("a", 1, 100.0, 50, 50, 3000.0, 1.0)] + [("a", i, 100.0, 11, 0, 1000.0, 1.0) for i in range(2, 60)]
    got = {r.pos: r.reads for r in reads.second_round_ranges(spark.createDataFrame(rows, schema), "job").collect()}
    assert [p for p, n in got.items() if n == 11] and sorted(p for p, n in got.items() if n == 11) == list(range(2, 32))


def test_mates_are_compared_as_whole_sequences(spark, tmp_path):
    rows = [(c, turn, role, text) for c, second in ((0, "ACGT"), (1, "ACGA"), (10, "ACGA"), (2, None)) for turn, role, text in ((0, "user", "ACGT"), (1, "assistant", second)) if text]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.run: (r.n_pairs, r.ratio, r.treat_as_single) for r in entry.queries()["identical_mate_ratio"](spark, str(tmp_path)).collect()}
    assert got == {"c0": (2, 0.5, False), "c1": (1, 0.0, False)}


def test_strict_rows_look_at_every_run(spark, sf_dir, tmp_path):
    spark.createDataFrame([(i, [float(i + p) for p in range(12)], 0) for i in (0, 5)], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = sorted((r.target_id, r.run, r.value) for r in expression.strict_rows(B.expr(spark, str(tmp_path))).collect())
    # g0 lacks a value in v0, g8 in v5
    assert got == sorted((f"g{p}", f"v{i}", float(i + p)) for p in range(12) for i in (0, 5) if p not in (0, 8))
    assert expression.strict_rows(B.expr(spark, sf_dir)).count() == 0


def test_queries_read_all_of_their_tables():
    assert not [k for k in entry.queries() if k.endswith("_whole")]
    sql = entry.oracle_sql()
    for name, cut in (("second_round_ranges", "l_suppkey = 3"), ("correlation_matrix_kendall", "% 5 = 0"), ("identical_mate_ratio", "left(seq"), ("strict_rows", "% 13")):
        assert name in sql and cut not in sql[name]


def test_surrogate_counts_do_not_depend_on_where_rows_lie(spark, sf_dir):
    c = B.counts(spark, sf_dir)
    got = []
    for n in (3, 7):
        m = matrix.RunMatrix(c.repartition(n))
        m.rows = m.rows.repartition(n)
        x = batch.design_matrix(batch.group_of(B.runs(spark, sf_dir), m.runs))
        got.append(batch.num_sv_be(m, x, b=5))
    assert got[0] == got[1]


def swapped(spark, folder):
    """Thirty runs of a species and project; six of the first group look like the second, one goes per round."""
    rng = np.random.default_rng(1)
    base = rng.random((2, 64))
    rows = [(20 * k, [float(v) for v in base[int(k < 6 or k >= 20)] + rng.random(64) * 0.1], int(k >= 20)) for k in range(30)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")


def test_ws_filter_goes_on_until_nothing_is_flagged(spark, tmp_path):
    swapped(spark, tmp_path)
    d = str(tmp_path)
    got = entry.queries()["wsfilter"](spark, d).where("exclusion <> 'no'").collect()
    assert {r.run for r in got} == {f"v{20 * k}" for k in range(6)}
    with pytest.raises(RuntimeError):
        filters.wsfilter(B.expr(spark, d), B.expr_meta(spark, d), 0.0, -1.5, max_rounds=3)


def test_kernel_queries_keep_the_bounds_of_the_reference(spark, sf_dir, monkeypatch):
    seen = {}

    def spy(module, name, *bounds):
        f = getattr(module, name)

        def run(*a, **b):
            given = inspect.signature(f).bind(*a, **b)
            given.apply_defaults()
            seen.setdefault(name, set()).add(tuple(given.arguments[x] for x in bounds))
            raise StopIteration

        monkeypatch.setattr(module, name, run)

    spy(matrix, "impute_low_rank", "rounds", "tol")
    spy(batch, "sva_factors", "rounds")
    spy(batch, "latent_factors", "rounds", "tol")
    monkeypatch.setattr(batch, "num_sv_be", lambda *a, **b: 1)
    for q in ("impute_em_pca", "impute_nipals", "sva_factors", "sva_correct", "latent_factors", "finalize"):
        with pytest.raises(StopIteration):
            entry.queries()[q](spark, sf_dir)
    assert seen == {"impute_low_rank": {(50, 1e-6)}, "sva_factors": {(5,)}, "latent_factors": {(200, 1e-5)}}


def test_the_sql_of_the_filter_has_as_many_rounds_as_the_data(tmp_path):
    """Twenty runs look like another group's, one goes per round."""
    rng = np.random.default_rng(1)
    base = rng.random((2, 64))
    rows = [{"vec_id": 20 * k, "embedding": [float(v) for v in base[int(k < 20 or k >= 66)] + rng.random(64) * 0.1], "label": int(k >= 66)} for k in range(100)]
    pq.write_table(pa.Table.from_pylist(rows), tmp_path / "embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"create view embeddings as from '{tmp_path}/embeddings.parquet'")
    got = {r for r, e in db.execute(entry.oracle_sql()["wsfilter"]).fetchall() if e != "no" and e != "manual"}
    assert got == {f"v{20 * k}" for k in range(20)}


@pytest.mark.parametrize("seed, zeros", [(1, 0.0), (2, 0.2), (3, 0.97)])
def test_factors_across_species_without_a_cell_for_each_missing_one(spark, monkeypatch, seed, zeros):
    rng = np.random.default_rng(seed)
    ortho, cells = [], []
    for b in range(70):
        for s in range(3):
            kind = rng.random()
            if kind > 0.1 or s == 0:  # else the species lacks the group
                ortho.append((f"o{b}", s, "-" if kind > 0.9 else f"g{b},h{b}" if kind > 0.8 else f"g{b}"))
    for s in range(3):
        for k in range(5):
            cells += [(s, f"g{b}", f"s{s}r{k}", 0.0 if rng.random() < zeros else float(rng.integers(1, 60))) for b in range(70) if rng.random() < 0.5]
            # libraries are powers of two, so that equal ratios are equal after division too
            cells.append((s, "other", f"s{s}r{k}", 2.0 ** (12 + k % 3) - sum(v for *_, run, v in cells if run == f"s{s}r{k}")))
    cells += [(1, "other", "s1r9", 64.0), (2, "g1", "s2r9", 0.0)]  # without orthologs; without counts
    ortho = spark.createDataFrame(ortho, "busco_id string, species int, sequence string")
    expr = spark.createDataFrame(cells, "species int, target_id string, run string, value double")
    libraries = tmm.library_sizes(expr).where("library_size > 0")
    dense = ortholog.ortholog_expression(ortho, expr).join(libraries.select("run"), "run", "left_semi").select(F.col("busco_id").alias("target_id"), "run", "value")
    want = {r.run: r.factor for r in tmm.tmm_normalize(expression.impute_row_mean(dense), libraries).collect()}

    def never(*_):
        raise AssertionError("makes missing cells")

    monkeypatch.setattr(ortholog, "ortholog_expression", never)
    monkeypatch.setattr(expression, "impute_row_mean", never)
    got = {r.run: r.factor for r in tmm.cstmm(ortholog.single_gene(ortho), expr).collect()}
    assert len(got) == 16 and got == pytest.approx(want, rel=1e-9)


def test_second_round_sorts_rows_once_and_numbers_them(spark):
    schema = "job string, at int, spot_length double, total_spots long, used_spots long, target_bp double, rate double"
    rng = np.random.default_rng(4)
    rows = [(j, int(k) * 3, 50.0 + 10 * int(rng.integers(1, 7)), int(rng.integers(10, 90)), int(rng.integers(0, 40)), float(rng.integers(1, 50)) * 100, 1 - int(rng.integers(0, 10)) / 100) for j in ("a", "b", None) for k in rng.permutation(40)]
    df = spark.createDataFrame(rows, schema)
    want = {}
    for j in ("a", "b", None):
        numbered = [(j, k + 1, *r[2:]) for k, r in enumerate(sorted(r for r in rows if r[0] == j))] if j else [(j, k + 1, *r[2:]) for k, r in enumerate(sorted((r for r in rows if r[0] is None), key=lambda r: r[1]))]
        want |= {(r.job, r.pos): r.reads for r in reads.second_round_ranges(spark.createDataFrame(numbered, schema.replace("at", "pos", 1)), "job").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = reads.second_round_ranges(df, "job", ["at"])
        got = {(r.job, r.pos): r.reads for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want and len(got) == 120



def test_tasks_that_group_lines_grow_in_number_not_in_size(spark, sf_dir, monkeypatch):
    want = sorted(entry.queries()["target_consistency"](spark, sf_dir).collect())
    monkeypatch.setattr(B, "LINES_A_TASK", 300)
    tasks = -(-B.table(spark, sf_dir, "lineitem").count() // 300)
    assert tasks > 15 and B.gene_expr(spark, sf_dir).rdd.getNumPartitions() == tasks
    seen = []
    real = expression.target_consistency
    monkeypatch.setattr(expression, "target_consistency", lambda df, keys, n: seen.append(n) or real(df, keys, n))
    assert sorted(entry.queries()["target_consistency"](spark, sf_dir).collect()) == want and seen == [tasks]
