"""Queries of the matrix kernels and of batch effects. Those with driver algebra are checked in the tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from curatrix.operators import batch as G
from curatrix.operators import corr as C
from curatrix.operators import matrix as X
from curatrix.plans import bindings as B
from curatrix.plans.bindings import cte, query


def _holes(spark, d):
    """Brand counts with some cells missing."""
    c = B.counts(spark, d)
    return c.withColumn("value", F.when(F.pmod(F.xxhash64("target_id", "run"), F.lit(19)) == 0, None).otherwise(F.col("value")))


def _design(spark, d):
    m = X.RunMatrix(B.counts(spark, d))
    meta = B.runs(spark, d)
    return m, meta, G.design_matrix(G.group_of(meta, m.runs))


@query()
def impute_em_pca(spark, d):
    return X.impute_low_rank(_holes(spark, d))


@query()
def impute_nipals(spark, d):
    return X.impute_low_rank(_holes(spark, d), nipals=True)


@query(cte("counts") + " select a.run as run_a, b.run as run_b, count(*) as n_pairs, corr(a.value, b.value) as r from counts a join counts b on a.target_id = b.target_id and a.run < b.run group by all")
def finite_block(spark, d):
    return X.finite_block(C.run_pairs(B.counts(spark, d)))


@query()
def pca_coordinates(spark, d):
    return X.pca_coordinates(C.run_pairs(B.counts(spark, d)))


#: Every cell of the matrix, absent ones zero.
FULL = "full_ as (select t.target_id, r.run, coalesce(cast(value as double), 0) as v from (select distinct target_id from counts) t cross join (select distinct run from counts) r left join counts using (target_id, run))"


@query(cte("counts") + f", {FULL} select a.run as run_a, b.run as run_b, sqrt(greatest(0, 2 - 2 * corr(a.v, b.v))) as distance from full_ a join full_ b on a.target_id = b.target_id and a.run < b.run group by all")
def pca_distances(spark, d):
    """What coordinates on all axes must keep: the distances of standardised runs."""
    return X.pca_distances(B.counts(spark, d))


@query()
def mds_coordinates(spark, d):
    return X.mds_coordinates(C.run_pairs(B.counts(spark, d)))


@query(cte("runs") + " select run, 1.0 as intercept, (sample_group = 'G1')::int::double as g1, (sample_group = 'G2')::int::double as g2 from runs where run in (select cast(l_suppkey as varchar) from lineitem)")
def design_matrix(spark, d):
    m, _, x = _design(spark, d)
    return spark.createDataFrame([(r, *map(float, row)) for r, row in zip(m.runs, x)], "run string, intercept double, g1 double, g2 double")


@query(cte("counts", "runs") + " select target_id, run, value - avg(value) over (partition by target_id, sample_group) as value from counts join runs using (run)")
def residualize(spark, d):
    m, meta, x = _design(spark, d)
    return G.residualize(m, x).select("target_id", "run", "value")


#: The tail of F with two degrees of freedom above has a closed form; there are three groups.
TAIL = "pow(1 + 2 * greatest(between_, 0) / 2 / (greatest(within_, 1e-300) / (n - 3)) / (n - 3), -(n - 3) / 2.0)"


@query(cte("counts", "runs") + f""", x as (select t.target_id, r.run, coalesce(value, 0) as v from (select distinct target_id from counts) t cross join (select distinct run from counts) r left join counts using (target_id, run)),
 g as (select target_id, sample_group, count(*) as n, sum(v) as s, sum(v * v) as q from x join runs using (run) group by all),
 t as (select target_id, sum(n) as n, sum(s * s / n) - sum(s) * sum(s) / sum(n) as between_, sum(q) - sum(s * s / n) as within_ from g group by 1) select target_id, {TAIL} as p from t""")
def f_test(spark, d):
    m, _, x = _design(spark, d)
    return G.f_test(m, x, np.ones((m.n, 1)))


@query()
def num_sv_be(spark, d):
    m, _, x = _design(spark, d)
    n = G.num_sv_be(m, x)
    return m.rows.agg(F.count(F.lit(1)).alias("n_targets")).withColumn("n_sv", F.lit(n).cast("int"))


@query()
def num_sv(spark, d):
    m, _, x = _design(spark, d)
    n, by = G.num_sv(m, x)
    return m.rows.agg(F.count(F.lit(1)).alias("n_targets")).withColumns({"n_sv": F.lit(n).cast("int"), "method": F.lit(by)})


@query()
def num_sv_leek(spark, d):
    m, _, x = _design(spark, d)
    return m.rows.agg(F.count(F.lit(1)).alias("n_targets")).withColumn("n_sv", F.lit(G.num_sv_leek(m, x)))


@query()
def local_fdr(spark, d):
    m, _, x = _design(spark, d)
    return G.Posterior(m, x, np.ones((m.n, 1))).rates()


@query()
def sva_factors(spark, d):
    m, _, x = _design(spark, d)
    sv = G.sva_factors(m, x, 2)
    return spark.createDataFrame([(r, *map(float, v)) for r, v in zip(m.runs, sv)], "run string, sv1 double, sv2 double")


@query()
def sva_correct(spark, d):
    m, _, x = _design(spark, d)
    return G.sva_correct(m, x, G.sva_factors(m, x, 1))


@query(cte("counts") + ", q as (select run, quantile_cont(value, 0.75) as q from counts where target_id in (select target_id from counts group by 1 having max(value) > 0) group by 1) select target_id, run, round(value / (q / (select avg(q) from q))) as value, q / (select avg(q) from q) as scale from counts join q using (run)")
def upper_quartile_normalize(spark, d):
    return G.upper_quartile_normalize(B.counts(spark, d)).select("target_id", "run", "value", "scale")


@query(cte("counts", "runs") + f""", g as (select target_id, sample_group, count(*) as n, sum(ln(1 + greatest(value, 0))) as s, sum(ln(1 + greatest(value, 0)) * ln(1 + greatest(value, 0))) as q from counts join runs using (run) group by all),
 t as (select target_id, sum(n) as n, sum(s * s / n) - sum(s) * sum(s) / sum(n) as between_, sum(q) - sum(s * s / n) as within_ from g group by 1) select target_id, {TAIL} as p from t""")
def anova_pvalue(spark, d):
    return G.anova_pvalue(B.counts(spark, d), B.runs(spark, d))


#: The group model with its refit: rates start as ratios of sums, and forty scoring steps settle them.
COUNT_MODEL = """, c as materialized (select target_id, run, sample_group as g, cast(value as double) as y, cast(sum(value) over (partition by run) as double) as lib from counts join runs using (run)),
 p as materialized (select target_id, g, sum(y) / sum(lib) as rate from c group by all),
 d as materialized (select target_id, case when count(*) > 1 and avg((pow(y - rate * lib, 2) - rate * lib) / greatest(pow(rate * lib, 2), 1e-12)) > 1e-6 then avg((pow(y - rate * lib, 2) - rate * lib) / greatest(pow(rate * lib, 2), 1e-12)) else 0 end as a from c join p using (target_id, g) where rate > 0 group by 1),
 f as (select target_id, g, 0 as it, rate from p union all select f.target_id, f.g, f.it + 1, any_value(f.rate) * exp(greatest(-1, least(1, sum((y - rate * lib) / (1 + a * rate * lib)) / sum(rate * lib / (1 + a * rate * lib))))) from f join d using (target_id) join c on c.target_id = f.target_id and c.g = f.g where it < 40 and rate > 0 group by f.target_id, f.g, f.it),
 fit as (select target_id, g, arg_max(rate, it) as rate from f group by all), cells as (select target_id, run, g, y, coalesce(a, 0) as a, rate * lib as mu from c join fit using (target_id, g) left join d using (target_id)),
 dev as (select *, case when y > 0 then y * ln(y / mu) else 0 end - case when a > 0 then (y + 1 / a) * (ln(1 + a * y) - ln(1 + a * mu)) else y - mu end as h from cells)"""


@query(cte("counts", "runs").replace("with ", "with recursive ", 1) + COUNT_MODEL + " select target_id, run, mu, sign(y - mu) * sqrt(greatest(2 * h, 0)) as value from dev")
def glm_residuals(spark, d):
    return G.CountModel(B.counts(spark, d), B.runs(spark, d)).residuals()


TESTS_SQL = cte("counts", "runs").replace("with ", "with recursive ", 1) + COUNT_MODEL + """, f0 as (select target_id, 0 as it, sum(y) / sum(lib) as rate from c group by 1 union all select f0.target_id, f0.it + 1, any_value(rate) * exp(greatest(-1, least(1, sum((y - rate * lib) / (1 + a * rate * lib)) / sum(rate * lib / (1 + a * rate * lib))))) from f0 join d using (target_id) join c on c.target_id = f0.target_id where it < 40 and rate > 0 group by f0.target_id, f0.it),
 fit0 as (select target_id, arg_max(rate, it) as rate from f0 group by 1),
 r as (select cells.target_id, any_value(a) as a, count(distinct cells.g) as k, sum(case when y > 0 then y * ln(mu / (rate * lib)) else 0 end - case when a > 0 then (y + 1 / a) * (ln(1 + a * mu) - ln(1 + a * rate * lib)) else mu - rate * lib end) as s from cells join (select target_id, run, lib from c) using (target_id, run) join fit0 on fit0.target_id = cells.target_id group by 1)
 select target_id, case k when 3 then exp(-greatest(s, 0)) when 1 then 1.0 end as p, a as dispersion, false as failed from r"""


#: The likelihood ratio of three groups has two degrees of freedom, so its tail is an exponential.
@query(TESTS_SQL)
def glm_tests(spark, d):
    return G.CountModel(B.counts(spark, d), B.runs(spark, d)).tests()


@query(f"select count(*) as n_targets, count(*) filter (dispersion > 1e-6) as n_refitted, count(*) filter (failed) as n_refit_failed, count(*) filter (p is null) as n_without_p, count(*) filter (failed) > 0 as fallback_used, '' as reasons from ({TESTS_SQL})")
def glm_diagnostics(spark, d):
    return G.fit_diagnostics(G.CountModel(B.counts(spark, d), B.runs(spark, d)).tests())


@query(cte("counts", "runs") + f""", g as (select target_id, sample_group, count(*) as n, sum(ln(1 + greatest(value, 0))) as s, sum(ln(1 + greatest(value, 0)) * ln(1 + greatest(value, 0))) as q from counts join runs using (run) group by all),
 t as (select target_id, sum(n) as n, sum(s * s / n) - sum(s) * sum(s) / sum(n) as between_, sum(q) - sum(s * s / n) as within_ from g group by 1), top as (select target_id from t order by {TAIL} desc, target_id limit 20),
 q as (select run, quantile_cont(value, 0.75) as q from counts group by 1), n as (select target_id, run, round(value / (q / (select avg(q) from q))) as v from counts join q using (run) where target_id in (from top)),
 mid as (select target_id, median(v) as mid from n group by 1), mad as (select target_id, median(abs(v - mid)) as mad from n join mid using (target_id) group by 1) select target_id from mad order by mad, target_id limit 10""")
def control_genes_top_n(spark, d):
    c, r = B.counts(spark, d), B.runs(spark, d)
    return G.control_targets(G.anova_pvalue(c, r), G.upper_quartile_normalize(c), 20, 5)


#: A factor of each run that is given, not estimated.
GIVEN = "fac as (select cast(s_suppkey as varchar) as run, cast(s_acctbal as double) / 10000 as f from supplier)"


def _given(spark, d, runs):
    found = dict(B.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string"), (F.col("s_acctbal").cast("double") / 10000)).collect())
    return np.array([[found[r]] for r in runs])


@query(cte("counts", "runs") + f""", {FULL}, {GIVEN}, y as (select target_id, run, f, ln(1 + greatest(v, 0)) as y, f - avg(f) over (partition by target_id, sample_group) as fg, ln(1 + greatest(v, 0)) - avg(ln(1 + greatest(v, 0))) over (partition by target_id, sample_group) as yg from full_ join runs using (run) join fac using (run)),
 b as (select target_id, sum(fg * yg) / sum(fg * fg) as beta from y group by 1) select target_id, run, greatest(exp(y - beta * f) - 1, 0) as value from y join b using (target_id)""")
def sva_correct_given(spark, d):
    """The correction for a known factor: its slope beside the groups is taken away, times the factor."""
    m, _, x = _design(spark, d)
    return G.sva_correct(m, x, _given(spark, d, m.runs)).select("target_id", "run", "value")


@query(cte("counts") + f""", {FULL}, {GIVEN}, y as (select target_id, run, f - avg(f) over (partition by target_id) as fg, ln(1 + v) as y from full_ join fac using (run)), b as (select target_id, sum(fg * y) / sum(fg * fg) as beta from y group by 1)
 select target_id, run, exp(y - beta * fg) - 1 as value from y join b using (target_id)""")
def ruv_residuals_given(spark, d):
    """What is left of log counts beside a known factor, back on the scale of counts; ``ruv_correct`` rounds it."""
    m = X.RunMatrix(B.counts(spark, d))
    return G.ruv_correct(m, _given(spark, d, m.runs), 1, whole=False).select("target_id", "run", "value")


@query()
def ruv_correct(spark, d):
    c, r = B.counts(spark, d), B.runs(spark, d)
    model = G.CountModel(c, r)
    controls = G.control_targets(model.tests(), G.upper_quartile_normalize(c), 20, 5)
    return G.ruv_correct(model.m, G.ruv_basis(model.residuals(), controls, model.m.runs, 2), 2)


@query()
def ruvseq(spark, d):
    return G.ruvseq(B.counts(spark, d), B.runs(spark, d))[0]


@query()
def latent_factors(spark, d):
    m, _, x = _design(spark, d)
    u, ok = G.latent_factors(m, x, k=2)
    return spark.createDataFrame([(r, *map(float, v), ok) for r, v in zip(m.runs, u)], "run string, f1 double, f2 double, settled boolean")


GATE = "k as (select *, count(*) over (partition by bioproject) as n from runs where exclusion = 'no'), u as (select count(distinct bioproject) as nb, count(distinct sample_group) as ng from k where n > 1), gate as (select run, bioproject, n > 1 and nb > 1 as corrected, case when nb = 0 then 'no_batch' when nb = 1 then 'one_batch' else '' end as skip_reason, ng > 1 as with_group from k cross join u)"


@query(cte("runs") + f", {GATE} select * from gate")
def combat_batch_gate(spark, d):
    return G.combat_batch_gate(B.runs(spark, d))


@query(cte("runs") + f", {GATE} select run, case when coalesce(corrected, false) then 'yes' else 'no' end as batch_corrected, case when coalesce(corrected, false) then 'combatseq' else 'none' end as batch_algorithm from runs left join gate using (run)")
def batch_annotate(spark, d):
    r = B.runs(spark, d)
    return G.batch_annotate(r, G.combat_batch_gate(r), "combatseq").select("run", "batch_corrected", "batch_algorithm")


@query(cte("runs") + f", {GATE} select count(*) as n_runs, count(*) filter (corrected) as n_corrected, count(distinct runs.bioproject) as n_batches, max(case when corrected then 'combatseq' else 'none' end) as algorithm from runs left join gate using (run)")
def batch_summary(spark, d):
    r = B.runs(spark, d)
    return G.batch_summary(G.batch_annotate(r, G.combat_batch_gate(r), "combatseq"))


@query(cte("counts", "runs") + """, f as (select target_id as factor, run, value, sample_group, bioproject, mapping_rate from counts join runs using (run)), c as (select factor, 'sample_group' as covariate, value, avg(value) over (partition by factor, sample_group) as gm, avg(value) over (partition by factor) as m from f union all select factor, 'bioproject', value, avg(value) over (partition by factor, bioproject), avg(value) over (partition by factor) from f)
 select factor, covariate, sum((gm - m) * (gm - m)) / sum((value - m) * (value - m)) as r2 from c group by all union all select factor, 'mapping_rate', corr(value, mapping_rate) * corr(value, mapping_rate) from f where mapping_rate is not null group by 1""")
def covariate_r2(spark, d):
    f = B.counts(spark, d).select(F.col("target_id").alias("factor"), "run", "value")
    return G.covariate_r2(f, B.runs(spark, d), ["sample_group", "bioproject"], ["mapping_rate"])


@query()
def finalize(spark, d):
    return G.finalize(B.counts(spark, d), B.runs(spark, d), "sva")[2]


@query()
def ruv_select_k(spark, d):
    c, r = B.counts(spark, d), B.runs(spark, d)
    model = G.CountModel(c, r)
    m = model.m
    basis = G.ruv_basis(model.residuals(), c.select("target_id").distinct(), m.runs, 3)
    k = G.ruv_select_k(m, basis, G.group_of(r, m.runs), G.group_of(r, m.runs, "bioproject"), 3)
    return m.rows.agg(F.count(F.lit(1)).alias("n_targets")).withColumn("k", F.lit(k))
