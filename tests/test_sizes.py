"""What only shows on more runs, cells or files than the small tables have."""

import numpy as np

from curatrix.operators import batch as G
from curatrix.operators import corr as C
from curatrix.operators import expression as E
from curatrix.operators import matrix as X
from curatrix.sources import tables as S


def long(spark, x):
    return spark.createDataFrame([(f"t{i:02d}", f"r{j:05d}", None if np.isnan(v) else float(v)) for i, row in enumerate(x) for j, v in enumerate(row)], "target_id string, run string, value double")


def test_kernels_take_more_runs_than_a_gram_matrix_holds(spark):
    rng = np.random.default_rng(2)
    x = rng.poisson(50, (3, 3_200)).astype(float)
    groups = [str(j % 3) for j in range(x.shape[1])]
    m, design = X.RunMatrix(long(spark, x)), G.design_matrix(groups)
    got = {r.target_id: r.p for r in G.f_test(m, design, np.ones((m.n, 1))).collect()}
    means = np.stack([x[:, k::3].mean(1) for k in range(3)], 1)
    within = sum(((x[:, k::3] - means[:, [k]]) ** 2).sum(1) for k in range(3))
    total = ((x - x.mean(1, keepdims=True)) ** 2).sum(1)
    want = G.f_tail((total - within) / 2 / (within / (m.n - 3)), 2, m.n - 3)
    assert np.allclose([got[f"t{i:02d}"] for i in range(3)], want)


def test_few_targets_of_many_runs_are_summed_on_their_side(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(10, 2)) @ rng.normal(size=(2, 60)) * 3 + rng.normal(size=(10, 60)) * 0.3 + 9
    holes = np.where(rng.random(x.shape) < 0.1, np.nan, x)
    groups, batches = [str(j % 2) for j in range(60)], [str(j // 20) for j in range(60)]
    design = G.design_matrix(groups)
    basis = np.linalg.qr(rng.normal(size=(60, 3)))[0]

    def all_of():
        m = X.RunMatrix(long(spark, x))
        filled = [{(r.target_id, r.run): r.value for r in X.impute_low_rank(long(spark, holes), 2, 12, nipals=n).collect()} for n in (False, True)]
        return G.num_sv_be(m, design, 4), G.ruv_select_k(m, basis, groups, batches, 3), filled

    whole = all_of()
    for module in (X, G):
        monkeypatch.setattr(module, "GRAM_RUNS", 40)
    side = all_of()
    assert whole[:2] == side[:2] and whole[0] > 0
    for a, b in zip(whole[2], side[2]):
        assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-6
    monkeypatch.setattr(X, "GRAM_RUNS", 8)  # more targets and runs than that: components by passes
    passes = {(r.target_id, r.run): r.value for r in X.impute_low_rank(long(spark, holes), 2, 12).collect()}
    assert max(abs(passes[k] - v) for k, v in whole[2][0].items()) < 1e-6


def test_pairs_of_blocks_are_those_of_sums_over_chunks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(12, 40)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    rows = lambda df: {(r.run_a, r.run_b): (r.n_pairs, r.r) for r in df.collect()}
    monkeypatch.setattr(C, "TARGET_CHUNK", 5)  # more targets than that
    monkeypatch.setattr(C, "SIGNED_TARGETS", 5)
    want = rows(C.correlation_matrix(long(spark, x))), rows(C.kendall_matrix(long(spark, x)))
    matrix = C.correlation_matrix(long(spark, x)).cache()
    meta = spark.createDataFrame([(f"r{j:05d}", f"p{j % 3}", f"g{j % 2}") for j in range(40)], "run string, bioproject string, sample_group string")
    assert isinstance(C.run_pairs(long(spark, x)), type(matrix))
    monkeypatch.setattr(C, "TARGET_CHUNK", 12)
    monkeypatch.setattr(C, "SIGNED_TARGETS", 12)
    monkeypatch.setattr(C, "PAIR_RUNS", 7)
    monkeypatch.setattr(C, "STRIP", 20)
    pairs = C.run_pairs(long(spark, x))
    assert isinstance(pairs, C.RunPairs)  # no shuffle of pairs
    plan = pairs.table()._jdf.queryExecution().toString()
    assert "HashAggregate" not in plan.split("FlatMapGroupsInArrow")[0]
    for a, b in zip(want, (rows(pairs.table()), rows(C.kendall_matrix(long(spark, x))))):
        assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) < 1e-12 for k in a)
    # coordinates without a table of pairs
    monkeypatch.setattr(X, "GRAM_RUNS", 10)
    far = lambda df: (lambda a: np.linalg.norm(a[:, None] - a[None], axis=2))(np.array([r[1:] for r in df.orderBy("run").collect()]))
    for place in (X.pca_coordinates, X.mds_coordinates):
        assert np.allclose(far(place(pairs)), far(place(matrix)), atol=1e-7)
    # a median by counts in ever finer stretches
    monkeypatch.setattr(C, "LOOKED_AT", 3)
    monkeypatch.setattr(C, "BINS", 4)
    got = {r.pair_class: r for r in C.correlation_statistics(matrix, meta).collect()}
    for k in C.CLASSES:
        rs = [v[1] for (a, b), v in want[0].items() if (("wi" if int(a[1:]) % 3 == int(b[1:]) % 3 else "bw") + ("wi" if int(a[1:]) % 2 == int(b[1:]) % 2 else "bw")) == k]
        assert got[k].n == len(rs) and np.allclose([got[k]["mean"], got[k]["median"], got[k].variance], [np.mean(rs), np.median(rs), np.var(rs, ddof=1)], rtol=1e-9)


def test_a_dense_table_shuffles_only_what_is_there(spark):
    rows = [("a", "x", 1.0, 5), ("b", "y", 2.0, 6), ("b", "z", None, 7)]
    df = spark.createDataFrame(rows, "target_id string, run string, value double, more int")
    out = E.densify(df)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("a", "x", 1.0, 5), ("a", "y", 0.0, None), ("a", "z", 0.0, None), ("b", "x", 0.0, None), ("b", "y", 2.0, 6), ("b", "z", 0.0, 7)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_a_matrix_file_with_more_runs_than_a_csv_has_columns(spark, tmp_path):
    n, path = 21_000, str(tmp_path / "wide")
    df = spark.range(2 * n).selectExpr("if(id % 2 = 0, 'a', 'b') as target_id", "concat('r', cast(floor(id / 2) as string)) as run", "cast(id as double) as value").where("value <> 7")
    S.write_matrix(df, path, [f"r{k}" for k in range(n)])
    got = S.read_expression(spark, path)
    assert got.count() == 2 * n and got.where("value is not null").exceptAll(df).count() == 0 and got.where("value is null").collect() == [("b", "r3", None)]


def test_a_large_file_of_packages_is_read_by_many_tasks(spark, tmp_path):
    one = '<EXPERIMENT_PACKAGE><EXPERIMENT accession="X{0}"><TITLE>t{0} &lt;1&gt;</TITLE></EXPERIMENT><RUN_SET><RUN accession="R{0}"/></RUN_SET></EXPERIMENT_PACKAGE>\n'
    (tmp_path / "p.xml").write_text("<?xml version='1.0'?><EXPERIMENT_PACKAGE_SET>\n" + "".join(one.format(k) for k in range(500)) + "</EXPERIMENT_PACKAGE_SET>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        p = S.read_packages(spark, str(tmp_path / "p.xml"))
        assert p.rdd.getNumPartitions() >= 4
        assert sorted((r.run, r.exp_title) for r in p.select("run", "exp_title").collect()) == sorted((f"R{k}", f"t{k} <1>") for k in range(500))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
