"""Queries on expression tables: merging, means, specificity, normalisation, correlation, filters, taxonomy and orthologs."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from curatrix.operators import corr as C
from curatrix.operators import expression as E
from curatrix.operators import filters as L
from curatrix.operators import ortholog as O
from curatrix.operators import taxonomy as X
from curatrix.operators import tmm as N
from curatrix.plans import bindings as B
from curatrix.plans.bindings import cte, query

KEPT = "exclusion = 'no'"
MEANS = f"means as (select target_id, sample_group, avg(value) as value from counts join runs using (run) where {KEPT} group by all)"


# merging and alignment


@query(cte("counts") + " select target_id, run, value from counts where run in (select run from counts group by run having count(*) = (select count(distinct target_id) from counts))")
def merge_abundance(spark, d):
    c = B.counts(spark, d)
    n = c.agg(F.count_distinct("target_id").alias("n"))
    full = c.groupBy("run").agg(F.count(F.lit(1)).alias("k")).crossJoin(F.broadcast(n)).where("k = n").select("run")
    same = c.join(full, "run", "left_semi").withColumn("species", F.lit("all"))
    return E.merge_abundance(same, ["species"]).select("target_id", "run", "value")


@query(cte("gene_expr") + """, r as (select species, run, count(*) as n, count(distinct target_id) as d from gene_expr group by all), t as (select species, count(distinct target_id) as n_targets from gene_expr group by 1)
 select cast(species as int) as species, count(*) as n_runs, n_targets, min(d) = n_targets and max(n - d) = 0 as consistent from r join t using (species) group by species, n_targets""")
def target_consistency(spark, d):
    return E.target_consistency(B.gene_expr(spark, d), ["species"], B.line_tasks(spark, d))


@query(cte("part_counts") + " select t.target_id, r.run, coalesce(value, 0.0) as value from (select distinct target_id from part_counts) t cross join (select distinct run from part_counts) r left join part_counts p on p.target_id = t.target_id and p.run = r.run")
def densify(spark, d):
    cells = B.table(spark, d, "part").count() * B.table(spark, d, "supplier").count()
    tasks = max(B.line_tasks(spark, d), min(O.MOST_TASKS, cells // O.CELLS_A_TASK))
    return E.densify(B.part_counts(spark, d, tasks), runs=B.part_runs(spark, d)).select("target_id", "run", "value")


@query(cte("counts", "runs") + " select c.target_id, c.run, value from counts c where run in (select run from runs where pos % 3 <> 0)")
def intersect_runs(spark, d):
    return E.intersect_runs(B.counts(spark, d), B.runs(spark, d).where("pos % 3 <> 0"))[0].select("target_id", "run", "value")


@query(cte("runs") + " select run, scientific_name, sample_group from runs where run in (select cast(l_suppkey as varchar) from lineitem)")
def align_metadata_to_runs(spark, d):
    return E.align_metadata(B.counts(spark, d), B.runs(spark, d)).select("run", "scientific_name", "sample_group")


@query(cte("counts", "lengths") + " select target_id, run, value, eff_length from counts join lengths using (target_id, run)")
def align_effective_length(spark, d):
    return E.align_effective_length(B.counts(spark, d), B.lengths(spark, d))


@query(cte("runs") + " select run, case when pos % 4 = 0 then 'none' else 'effective' end as length_model from runs")
def length_model_guard(spark, d):
    r = B.runs(spark, d)
    return E.length_model_guard(r.select("run"), r.select("run", F.when(F.col("pos") % 4 == 0, "none").otherwise("effective").alias("length_model")), "log2p1-none")


# group means and specificity


@query(cte("counts", "runs") + f", {MEANS} select * from means")
def sample_group_mean(spark, d):
    return E.sample_group_mean(B.counts(spark, d), B.runs(spark, d))


@query(cte("counts", "runs") + f" select target_id, sample_group, avg(m) as value from (select target_id, sample_group, bioproject, avg(value) as m from counts join runs using (run) where {KEPT} group by all) group by all")
def sample_group_mean_balanced(spark, d):
    return E.sample_group_mean(B.counts(spark, d), B.runs(spark, d), by_project=True)


TAU = "x as (select target_id, sample_group, greatest(value, 0) as x, max(greatest(value, 0)) over (partition by target_id) as top from means)"


@query(cte("counts", "runs") + f", {MEANS}, {TAU} select target_id, sum(1 - x / top) / ((select count(distinct sample_group) from means) - 1) as tau from x group by 1")
def tau(spark, d):
    return E.tau(E.sample_group_mean(B.counts(spark, d), B.runs(spark, d)))


@query(cte("counts", "runs") + f", {MEANS}, {TAU} select target_id, string_agg(sample_group, '|' order by x desc, sample_group) as ranking, arg_max(sample_group, x) as highest from x where x > 0 group by 1")
def tau_ranking(spark, d):
    return E.tau_ranking(E.sample_group_mean(B.counts(spark, d), B.runs(spark, d)))


@query(cte("part_counts") + " select target_id, sum(value) > 0 as expressed from (select target_id, case when cast(target_id as int) % 5 = 0 then 0 else value end as value from part_counts) group by 1")
def split_nonexpressed(spark, d):
    v = F.when(F.col("target_id").cast("int") % 5 == 0, 0.0).otherwise(F.col("value"))
    return E.split_nonexpressed(B.part_counts(spark, d).withColumn("value", v))


@query(cte("counts") + " select target_id, run, case when value % 2 = 0 then 0.0 else greatest(value - 600, 0) end as value from counts")
def maintain_zero(spark, d):
    c = B.counts(spark, d)
    raw = c.withColumn("value", F.when(F.col("value") % 2 == 0, 0.0).otherwise(F.col("value")))
    return E.maintain_zero(c.withColumn("value", F.col("value") - 600), raw, clip=True).select("target_id", "run", "value")


# abundance


ALIGNED = "al as (select target_id, run, value, eff_length from counts join lengths using (target_id, run))"


@query(cte("counts", "lengths") + f", {ALIGNED} select target_id, run, value / eff_length / sum(value) over (partition by run) * 1e9 as value from al")
def fpkm(spark, d):
    return E.fpkm(E.align_effective_length(B.counts(spark, d), B.lengths(spark, d))).select("target_id", "run", "value")


@query(cte("counts", "lengths") + f", {ALIGNED} select target_id, run, value / eff_length * 1e6 / sum(value / eff_length) over (partition by run) as value from al")
def tpm(spark, d):
    return E.tpm(E.align_effective_length(B.counts(spark, d), B.lengths(spark, d))).select("target_id", "run", "value")


@query(cte("counts", "lengths") + f", {ALIGNED} select target_id, run, log2(value / eff_length / sum(value) over (partition by run) * 1e9 + 1) as value from al")
def transform(spark, d):
    return E.transform(E.align_effective_length(B.counts(spark, d), B.lengths(spark, d)), "log2p1-fpkm").select("target_id", "run", "value")


@query(cte("counts") + " select target_id, run, value * 1e6 / sum(value) over (partition by run) as value from counts")
def counts_per_million(spark, d):
    return E.counts_per_million(B.counts(spark, d)).select("target_id", "run", "value")


@query(cte("counts") + ", r as (select run, avg(value) as mean_count, sum(value) as library_size from counts group by 1) select run, mean_count, library_size, mean_count / (library_size / (select median(library_size) from r)) as scaled_mean from r")
def library_summary(spark, d):
    return E.library_summary(B.counts(spark, d))


@query(cte("expr") + " select target_id, run, coalesce(value, avg(value) over (partition by target_id), 0.0) as value from expr")
def impute_row_mean(spark, d):
    return E.impute_row_mean(B.expr(spark, d)).select("target_id", "run", "value")


HOLES = "h as (select target_id, run, case when target_id like '%1%' and cast(run as int) % 7 = 0 then null else value end as value from counts)"


@query(cte("counts") + f", {HOLES} select target_id, run, value from h where target_id in (select target_id from h group by 1 having count(value) = (select count(distinct run) from h))")
def strict_rows(spark, d):
    """All runs, some of which lack brands with a 1."""
    lacks = F.col("target_id").contains("1") & (F.col("run").cast("int") % 7 == 0)
    return E.strict_rows(B.counts(spark, d).withColumn("value", F.when(~lacks, F.col("value")))).select("target_id", "run", "value")


# TMM


LIB = "lib as (select run, sum(value) as library_size from counts group by 1)"
UQ = f"{LIB}, pos as (select target_id from counts group by 1 having max(value) > 0), uq as (select run, quantile_cont(value, 0.75) / any_value(library_size) as factor from counts join pos using (target_id) join lib using (run) group by 1)"


def _tmm_sql(prefix: str, ref: str) -> str:
    """CTEs of factors against the run that ``ref`` selects."""
    return f"""{prefix}m as (select c.run, c.target_id, log2((c.value / l.library_size) / (r.value / rl.library_size)) as m, (log2(c.value / l.library_size) + log2(r.value / rl.library_size)) / 2 as a,
 (l.library_size - c.value) / l.library_size / c.value + (rl.library_size - r.value) / rl.library_size / r.value as v from counts c join lib l on l.run = c.run join counts r on r.target_id = c.target_id and r.run = {ref} join lib rl on rl.run = r.run where c.value > 0 and r.value > 0),
{prefix}k as (select *, count(*) over (partition by run) as n, max(abs(m)) over (partition by run) as most, rank() over (partition by run order by m) + (count(*) over (partition by run, m) - 1) / 2.0 as rm, rank() over (partition by run order by a) + (count(*) over (partition by run, a) - 1) / 2.0 as ra from {prefix}m),
{prefix}f as (select lib.run, coalesce(max(case when most < 1e-6 then 1.0 else f end), 1.0) as factor from lib left join (select run, any_value(most) as most, pow(2, sum(m / v) / sum(1 / v)) as f from {prefix}k where rm between floor(n * 0.3) + 1 and n - floor(n * 0.3) and ra between floor(n * 0.05) + 1 and n - floor(n * 0.05) group by run) x using (run) group by 1),
{prefix}g as (select run, factor / (select exp(avg(ln(factor))) from {prefix}f) as factor from {prefix}f)"""


REF1 = "(select run from uq order by abs(factor - (select avg(factor) from uq)), run limit 1)"
TMM = f"{UQ}, {_tmm_sql('a', REF1)}, {_tmm_sql('b', '(select run from ag order by abs(factor - (select median(factor) from ag)), run limit 1)')}"


@query(cte("counts") + f", {UQ} select run, factor from uq")
def upper_quartile_factor(spark, d):
    c = E.densify(B.counts(spark, d))
    return N.upper_quartile_factor(c, N.library_sizes(c))


@query(cte("counts") + f", {UQ} select {REF1} as run")
def tmm_reference_run(spark, d):
    c = B.counts(spark, d)
    f = N.upper_quartile_factor(c, N.library_sizes(c))
    return f.where(F.col("run") == N.reference_run(c, f)).select("run")


@query(cte("counts") + f", {UQ}, {_tmm_sql('a', REF1)} select run, factor from af")
def tmm_factor(spark, d):
    c = B.counts(spark, d)
    lib = N.library_sizes(c)
    return N.tmm_factor(c, lib, N.reference_run(c, N.upper_quartile_factor(c, lib)))


@query(cte("counts") + f", {TMM} select run, factor from bg")
def tmm_normalize(spark, d):
    return N.tmm_normalize(B.counts(spark, d))


@query(cte("counts") + f", {TMM} select target_id, run, value / factor as value from counts join bg using (run)")
def tmm_apply(spark, d):
    c = B.counts(spark, d)
    return N.tmm_apply(c, N.tmm_normalize(c)).select("target_id", "run", "value")


@query(cte("runs") + " select run, case when pos % 5 = 0 or pos % 7 = 0 then null else 1.0 + pos / 100.0 end as tmm_factor, case when exclusion = 'no' and mapping_rate = 0 then 'no_mapping' when exclusion = 'no' and pos % 5 = 0 then 'no_cstmm_output' when exclusion = 'no' and pos % 7 = 0 then 'cstmm_failed' else exclusion end as exclusion from runs")
def tmm_annotate(spark, d):
    r = B.runs(spark, d)
    f = r.where("pos % 5 <> 0").select("run", F.when(F.col("pos") % 7 != 0, 1.0 + F.col("pos") / 100.0).alias("factor"))
    return N.tmm_annotate(r, f).select("run", "tmm_factor", "exclusion")


@query(cte("counts") + f", {TMM} select run, avg(value) as before_all, avg(value / factor) as after_all, avg(value) filter (target_id like '%1%') as before_single, avg(value / factor) filter (target_id like '%1%') as after_single from counts join bg using (run) group by 1")
def mean_expression_before_after(spark, d):
    c = B.counts(spark, d)
    return E.mean_before_after(c, N.tmm_apply(c, N.tmm_normalize(c)), c.where("target_id like '%1%'").select("target_id").distinct())


@query(cte("counts") + " select run, rank() over (partition by run order by value) + (count(*) over (partition by run, value) - 1) / 2.0 as r, target_id from counts")
def average_ranks(spark, d):
    return B.counts(spark, d).select("run", N.average_rank(["run"], F.col("value")).alias("r"), "target_id")


SINGLE = "one as (select busco_id, count(*) filter (position(',' in sequence) = 0) * 100.0 / 5 as percent from ortho group by 1)"
CELLS = "cells as (select o.busco_id as target_id, r.run, g.value from ortho o join (select distinct species, run from gene_expr) r on r.species = o.species left join gene_expr g on g.species = o.species and g.run = r.run and g.target_id = o.sequence where o.busco_id in (select busco_id from one where percent >= 50))"


@query(cte("ortho", "gene_expr") + f", {SINGLE}, {CELLS}, lib as (select run, sum(value) as library_size from gene_expr group by 1), counts as (select target_id, run, coalesce(value, avg(value) over (partition by target_id), 0.0) as value from cells), {TMM.removeprefix(LIB + ', ')} select run, factor from bg")
def cstmm(spark, d):
    """Ortholog cells of all species against libraries of all genes."""
    g = B.gene_expr(spark, d)
    counts = O.single_copy(O.genecount(B.ortho(spark, d)), 5, 50.0)
    return N.cstmm(O.single_gene(B.ortho(spark, d).join(counts.select("busco_id"), "busco_id", "left_semi")), g)


# correlation

PAIR = "select a.run as run_a, b.run as run_b, count(*) as n_pairs, corr(a.value, b.value) as r from counts a join counts b on a.target_id = b.target_id and a.run < b.run group by all"


@query(cte("counts") + PAIR)
def correlation_matrix(spark, d):
    return C.correlation_matrix(B.counts(spark, d))


@query(cte("counts") + ", k as (select run, target_id, rank() over (partition by run order by value) + (count(*) over (partition by run, value) - 1) / 2.0 as value from counts) " + PAIR.replace("from counts a join counts b", "from k a join k b"))
def correlation_matrix_spearman(spark, d):
    return C.correlation_matrix(B.counts(spark, d), "spearman")


@query(cte("counts") + """, p as (select a.run as run_a, b.run as run_b, x.value as x1, y.value as x2, a.value as y0, b.value as y1 from counts a join counts b on a.target_id = b.target_id and a.run < b.run join counts x on x.run = a.run join counts y on y.run = b.run and y.target_id = x.target_id)
 select run_a, run_b, cast(sqrt(count(*)) as bigint) as n_pairs, sum(sign(x1 - y0) * sign(x2 - y1)) / sqrt(cast(count(*) filter (x1 <> y0) as double) * count(*) filter (x2 <> y1)) as r from p group by all""")
def correlation_matrix_kendall(spark, d):
    return C.kendall_matrix(B.counts(spark, d))


@query(cte("expr", "expr_meta") + """, m as (select target_id, avg(value) as ref from expr group by 1) select run, count(value) as n_pairs, case when count(value) > 1 and stddev_samp(value) > 1e-9 then corr(value, ref) end as r from expr join m using (target_id) group by 1""")
def safe_pearson(spark, d):
    e = B.expr(spark, d)
    return C.safe_pearson(e.join(e.groupBy("target_id").agg(F.avg("value").alias("ref")), "target_id"), ["run"], "value", "ref")


CLS = "case when p.bioproject = q.bioproject then 'wi' else 'bw' end || case when p.sample_group = q.sample_group then 'wi' else 'bw' end"


@query(cte("counts", "runs") + f", c as ({PAIR}), k as (select {CLS} as pair_class, r from c join runs p on p.run = run_a join runs q on q.run = run_b) select t.pair_class, count(r) as n, avg(r) as mean, median(r) as median, var_samp(r) as variance from (values ('bwbw'), ('wibw'), ('bwwi'), ('wiwi')) t(pair_class) left join k using (pair_class) group by 1")
def correlation_statistics(spark, d):
    return C.correlation_statistics(C.run_pairs(B.counts(spark, d)), B.runs(spark, d))


@query(cte("counts", "runs") + f", c as ({PAIR}), k as (select {CLS.replace('bioproject', 'species')} as pair_class, r from c join runs p on p.run = run_a join runs q on q.run = run_b) select t.pair_class, count(r) as n, avg(r) as mean, median(r) as median, var_samp(r) as variance from (values ('bwbw'), ('wibw'), ('bwwi'), ('wiwi')) t(pair_class) left join k using (pair_class) group by 1")
def group_pair_correlation_classes(spark, d):
    return C.correlation_statistics(C.run_pairs(B.counts(spark, d)), B.runs(spark, d), other="species")


@query(cte("expr", "expr_meta") + ", e as (select target_id, run, value, sample_group from expr join expr_meta using (run)), g as (select target_id, sample_group, sum(value) as s, count(value) as n from e group by all) select e.target_id, e.run, case when n - (value is not null)::int > 0 then (coalesce(s, 0) - coalesce(value, 0)) / (n - (value is not null)::int) end as reference from e join g using (target_id, sample_group)")
def loo_group_reference(spark, d):
    return C.loo_group_reference(B.expr(spark, d), B.expr_meta(spark, d)).select("target_id", "run", "reference")


WS = """k as (select run, species, sample_group from expr_meta where exclusion = 'no'), e as (select target_id, run, value, species, sample_group from expr join k using (run)),
g as (select species, target_id, sample_group as of_group, sum(value) as s, count(value) as n from e group by all),
p as (select e.species, e.run, e.sample_group, of_group, value, case when of_group <> e.sample_group then case when n > 0 then s / n end when n - (value is not null)::int > 0 then (coalesce(s, 0) - coalesce(value, 0)) / (n - (value is not null)::int) end as ref from e join g on g.species = e.species and g.target_id = e.target_id),
r as (select species, run, sample_group, of_group, case when count(*) filter (value is not null and ref is not null) > 1 and stddev_samp(value) filter (ref is not null) > 1e-9 then corr(value, ref) end as r from p group by all),
w as (select species, run, sample_group, max(r) filter (of_group = sample_group) as within, max(r) filter (of_group <> sample_group) as max_other from r group by all)"""


@query(cte("expr", "expr_meta") + f", {WS} select run, species, sample_group, within, max_other, within - max_other as margin from w")
def ws_correlation_metrics(spark, d):
    return C.ws_correlation_metrics(B.expr(spark, d), B.expr_meta(spark, d))


def _cs_sql(out: str, table: str = "expr") -> str:
    """CTEs of cross-species metrics of ``table``, the last one named ``out``."""
    return f"""{out}e as (select target_id, run, value, species, sample_group from {table} join (select * from expr_meta where exclusion = 'no') using (run)),
{out}g as (select target_id, species as of_species, sample_group as of_group, sum(value) as s, count(value) as n from {out}e group by all),
{out}p as (select e.run, e.species, e.sample_group, of_group, e.target_id, value, median(case when of_species = species and of_group = sample_group then case when n - (value is not null)::int > 0 then (s - coalesce(value, 0)) / (n - (value is not null)::int) end when n > 0 then s / n end) as ref from {out}e e join {out}g g using (target_id) group by all),
{out}r as (select species, run, sample_group, of_group, case when stddev_samp(value) filter (ref is not null) > 1e-9 then corr(value, ref) end as r from {out}p group by all),
{out} as (select species, run, sample_group, max(r) filter (of_group = sample_group) as within, max(r) filter (of_group <> sample_group) as max_other, max(r) filter (of_group = sample_group) - max(r) filter (of_group <> sample_group) as margin from {out}r group by all)"""


@query(cte("expr", "expr_meta") + f", {_cs_sql('cs')} select * from cs")
def cs_correlation_metrics(spark, d):
    return C.cs_correlation_metrics(B.expr(spark, d), B.expr_meta(spark, d))


@query(cte("expr", "expr_meta") + """, k as (select * from expr_meta where exclusion = 'no'), m as (select species, sample_group, avg(m) as mean_value from (select species, sample_group, target_id, avg(value) as m from expr join k using (run) group by all) group by all)
 select species, sample_group, count(distinct run) as n_runs, count(distinct bioproject) as n_projects, any_value(mean_value) as mean_value from k join m using (species, sample_group) group by all""")
def cross_species_group_means(spark, d):
    return C.cross_species_group_means(B.expr(spark, d), B.expr_meta(spark, d))


# outliers

RZ = """g as (select sample_group, median(mapping_rate) as mid, count(mapping_rate) as n, stddev_samp(mapping_rate) as sd from runs group by 1), h as (select runs.*, mid, n, sd from runs join g using (sample_group)),
mad as (select sample_group, median(abs(mapping_rate - mid)) as mad from h group by 1), z as (select h.*, case when n >= 3 and mapping_rate is not null then case when mad > 0 then (mapping_rate - mid) / (1.4826 * mad) when sd > 0 then (mapping_rate - mid) / sd else 0 end end as z from h join mad using (sample_group))"""


@query(cte("runs") + f", {RZ} select run, z from z")
def robust_z(spark, d):
    return L.robust_z(B.runs(spark, d), ["sample_group"], "mapping_rate").select("run", "z")


@query(cte("runs") + f", {RZ} select run, z, coalesce(mapping_rate < 30 and (coalesce(z <= -1, false) or z is null), false) as flag from z")
def flag_margin_outliers(spark, d):
    return L.flag_margin_outliers(B.runs(spark, d), ["sample_group"], "mapping_rate", 30.0, -1.0).select("run", "z", "flag")


@query(cte("runs") + " select run from (select *, row_number() over (partition by bioproject order by mapping_rate, run) as a, row_number() over (partition by sample_group order by mapping_rate, run) as b from runs where mapping_rate < 50) where a = 1 or b = 1")
def one_outlier_per_iteration(spark, d):
    return L.one_per_iteration(B.runs(spark, d).where("mapping_rate < 50"), [F.col("mapping_rate"), F.col("run")]).select("run")


def _flag_sql(out: str, table: str, keys: str, margin: str, z: float) -> str:
    """CTEs of margins under 0 whose robust z in a group is at most ``z``, or whose group is too small for one."""
    return f"""{out}m as (select {keys}, median({margin}) as mid, count({margin}) as n, stddev_samp({margin}) as sd from {table} group by all),
{out}h as (select t.*, mid, n, sd from {table} t join {out}m using ({keys})),
{out}d as (select {keys}, median(abs({margin} - mid)) as mad from {out}h group by all),
{out} as (select * from (select h.*, case when n >= 3 and {margin} is not null then case when mad > 0 then ({margin} - mid) / (1.4826 * mad) when sd > 0 then ({margin} - mid) / sd else 0 end end as z from {out}h h join {out}d using ({keys})) where {margin} < 0 and (z <= {z} or z is null))"""


#: More rounds than the given tables ask for.
ROUNDS = 16


def _ws_sql(rounds: int = ROUNDS) -> str:
    """CTEs of the filter's rounds one after the other; rounds after the last that flags a run change nothing. Round i starts
    with the runs ``k<i>`` and takes ``o<i>``."""
    out = ["k0 as materialized (select run, species, sample_group, bioproject from expr_meta where exclusion = 'no')"]
    for i in range(rounds):
        ws = re.sub(r"\b([egprw]) as \(", rf"\g<1>{i} as (", WS.split("\n", 1)[1])
        ws = re.sub(r"from e\b", f"from e{i}", re.sub(r"from p\b", f"from p{i}", re.sub(r"from r\b", f"from r{i}", ws)))
        ws = re.sub(r"join g\b", f"join g{i} g", ws).replace(f"from e{i} join", f"from e{i} e join")
        out += [
            f"e{i} as materialized (select target_id, run, value, species, sample_group from expr join k{i} using (run))", ws, f"v{i} as materialized (select run, species, sample_group, within - max_other as margin from w{i})",
            _flag_sql(f"f{i}", f"v{i}", "species, sample_group", "margin", -1.5),
            f"o{i} as (select run from (select run, row_number() over (partition by species, bioproject order by margin, run) as a, row_number() over (partition by species, f.sample_group order by margin, run) as b from (select f.*, bioproject from f{i} f join k{i} using (run)) f) where a = 1 or b = 1)",
            f"k{i + 1} as materialized (select * from k{i} where run not in (select run from o{i}))",
        ]
    return ", ".join(out)


def _log_sql(rounds: int = ROUNDS) -> str:
    """CTE ``log``: a row per species and round, until a round takes nothing."""
    took = [f"t{i} as (select species, count(*) as k, string_agg(run, ' ' order by run) as names from k{i} where run in (select run from o{i}) group by 1)" for i in range(rounds)]
    rows = [f"select 'within_group_filter' as step, n.species, {i} as round, case when k > 0 then 'low_within_sample_group_correlation' else 'no_outlier_detected' end as reason, cast(n.n as int) as num_runs_before, cast(n.n - coalesce(k, 0) as int) as num_runs_after, cast(coalesce(k, 0) as int) as num_runs_removed, coalesce(names, '') as removed_runs from (select species, count(*) as n from k{i} group by 1) n left join t{i} using (species)" + (f" where n.species in (select species from t{i - 1})" if i else "") for i in range(rounds)]
    return ", ".join(took) + ", log as materialized (" + " union all ".join(rows) + ")"


def _stats_sql(rounds: int = ROUNDS) -> str:
    """CTE ``st``: pair classes of each species before the filter (1) and after each of its rounds (2, 3, ...)."""
    both = "filter (a.value is not null and b.value is not null)"
    pairs = f"""pr as materialized (select a.species, a.run as run_a, b.run as run_b, case when a.bioproject = b.bioproject then 'wi' else 'bw' end || case when a.sample_group = b.sample_group then 'wi' else 'bw' end as pair_class,
 case when stddev_samp(a.value) {both} > 1e-9 and stddev_samp(b.value) {both} > 1e-9 then corr(a.value, b.value) end as r
 from (select * from expr join k0 using (run)) a join (select * from expr join k0 using (run)) b on a.species = b.species and a.target_id = b.target_id and a.run < b.run group by all)"""
    states = [f"select species, {q} as round, pair_class, r from pr where run_a in (select run from k{q - 1}) and run_b in (select run from k{q - 1})" for q in range(1, rounds + 1)]
    return f"""{pairs}, ls as (select species, max(round) + 2 as last from log group by 1), grid as (select species, unnest(range(1, last + 1)) as round from ls),
 al as ({' union all '.join(states)}),
 st as (select grid.species, cast(grid.round as int) as round, c.pair_class, count(r) as n, avg(r) as mean, var_samp(r) as variance from grid cross join (values ('bwbw'), ('wibw'), ('bwwi'), ('wiwi')) c(pair_class) left join al on al.species = grid.species and al.round = grid.round and al.pair_class = c.pair_class group by all)"""


#: The filter with as many rounds as the data ask for. ``k`` has every run before a round; a species goes on while a round takes
#: some of its runs, and those that are there in its last round are kept.
WS_ROUNDS = f"""{cte("expr", "expr_meta").replace("with ", "with recursive ", 1)}, k as (select 0 as it, run, species, sample_group, bioproject, true as there from expr_meta where exclusion = 'no' union all select it + 1, run, species, sample_group, bioproject, there from (
with now as materialized (select * from k where there), e as materialized (select target_id, run, value, species, sample_group from expr join now using (run)),
{WS.split(chr(10), 1)[1]}, v as materialized (select run, species, sample_group, within - max_other as margin from w), {_flag_sql('f', 'v', 'species, sample_group', 'margin', -1.5)},
o as materialized (select run, species from (select run, f.species, row_number() over (partition by f.species, now.bioproject order by margin, run) as a, row_number() over (partition by f.species, f.sample_group order by margin, run) as b from f join now using (run)) where a = 1 or b = 1)
select it, run, species, sample_group, bioproject, there and run not in (select run from o) as there from k where species in (select species from o)))"""


@query(WS_ROUNDS + " select run, case when exclusion = 'no' and run in (select run from k join (select species, max(it) as it from k group by 1) using (species, it) where not there) then 'low_within_sample_group_correlation' else exclusion end as exclusion from expr_meta")
def wsfilter(spark, d):
    """The loop has as many rounds as the data ask for, and so has its SQL."""
    return L.wsfilter(B.expr(spark, d), B.expr_meta(spark, d), 0.0, -1.5).select("run", "exclusion")


@query(cte("expr", "expr_meta") + ", " + _ws_sql() + ", " + _log_sql() + " select * from log")
def ws_round_log(spark, d):
    return L.WithinGroupFilter(B.expr(spark, d), B.expr_meta(spark, d), 0.0, -1.5).log


def _round_statistics(spark, d):
    e, m = B.expr(spark, d), B.expr_meta(spark, d)
    kept = m.where(KEPT)
    done = L.WithinGroupFilter(e, m, 0.0, -1.5)
    matrix = C.run_pairs(e.join(kept.select("run", "species"), "run"), within="species")
    return C.round_statistics(matrix, kept, done.dropped, done.log.groupBy("species").agg(F.max("round").alias("last_round")))


@query(cte("expr", "expr_meta") + ", " + _ws_sql() + ", " + _log_sql() + ", " + _stats_sql() + " select * from st")
def ws_round_statistics(spark, d):
    """Pair classes over the rounds of the within-group filter."""
    return _round_statistics(spark, d)


GAPS = """gaps as (select species, abs(max(mean) filter (pair_class = 'bwbw' and round = 1) - max(mean) filter (pair_class = 'wibw' and round = 1)) as between_first, abs(max(mean) filter (pair_class = 'bwbw' and round = last) - max(mean) filter (pair_class = 'wibw' and round = last)) as between_last,
 abs(max(mean) filter (pair_class = 'bwwi' and round = 1) - max(mean) filter (pair_class = 'wiwi' and round = 1)) as within_first, abs(max(mean) filter (pair_class = 'bwwi' and round = last) - max(mean) filter (pair_class = 'wiwi' and round = last)) as within_last from st join ls using (species) group by 1)"""
DELTA = cte("expr", "expr_meta") + ", " + _ws_sql() + ", " + _log_sql() + ", " + _stats_sql() + ", " + GAPS


@query(DELTA + " select * from gaps")
def delta_pcc(spark, d):
    """How far the filter's rounds moved the gaps between pair classes."""
    return C.delta_pcc(C.class_means(_round_statistics(spark, d)))


#: Two-sided tail of t with three degrees of freedom (four species), which has a closed form.
T3 = "1 - 2 / pi() * (atan(abs({0}) / sqrt(3)) + abs({0}) / sqrt(3) / (1 + {0} * {0} / 3))"


@query(DELTA + f" select *, {T3.format('t_between')} as p_between, {T3.format('t_within')} as p_within from (select count(*) as n, avg(between_first - between_last) * sqrt(count(*)) / stddev_samp(between_first - between_last) as t_between, avg(within_first - within_last) * sqrt(count(*)) / stddev_samp(within_first - within_last) as t_within from gaps)")
def delta_pcc_test(spark, d):
    return C.delta_test(C.delta_pcc(C.class_means(_round_statistics(spark, d))))


@query(cte("expr", "expr_meta") + f""", x as (select target_id, run, value * (1 + cast(substr(target_id, 2) as int) % 5) as value from expr), {_cs_sql('u')}, {_cs_sql('c', 'x')}, {_flag_sql('o', 'c', 'sample_group', 'margin', -1.5)}
select run, u.margin as margin_uncorrected, c.margin as margin_corrected, case when run in (select run from o) then 'low_cross_species_group_correlation' else exclusion end as exclusion from expr_meta left join u using (run) left join c using (run)""")
def csfilter(spark, d):
    e = B.expr(spark, d)
    corrected = e.withColumn("value", F.col("value") * (1 + F.substring("target_id", 2, 9).cast("int") % 5))
    return L.csfilter(e, corrected, B.expr_meta(spark, d), 0.0, -1.5).select("run", "margin_uncorrected", "margin_corrected", "exclusion")


# taxonomy

UP = """with recursive {taxa}, ids as (select taxid from nodes where rank = 'species' union all select old_taxid from merged),
st as (select ids.taxid, coalesce(new_taxid, ids.taxid) as cur from ids left join merged on old_taxid = ids.taxid),
up as (select taxid, cur as ancestor, 0 as depth from st union all select up.taxid, n.parent_taxid, depth + 1 from up join nodes n on n.taxid = up.ancestor where n.parent_taxid <> n.taxid)
""".format(taxa=B.SQL["taxa"])


def _ids(spark, d):
    nodes, names, merged = B.taxa(spark, d)
    return nodes.where("rank = 'species'").select("taxid").unionAll(merged.select("old_taxid")), nodes, names, merged


@query(UP + "select cast(up.taxid as bigint) as taxid, cast(ancestor as bigint) as ancestor, rank, depth from up join nodes n on n.taxid = up.ancestor")
def lineage(spark, d):
    ids, nodes, _, merged = _ids(spark, d)
    return X.lineage(ids, nodes, merged)


@query(UP + "select c_custkey, max(ancestor) filter (rank = 'phylum') as taxid_phylum, max(ancestor) filter (rank = 'genus') as taxid_genus, max(ancestor) filter (rank = 'species') as taxid_species from customer left join up on up.taxid = 1000 + c_custkey left join nodes n on n.taxid = up.ancestor group by 1")
def attach_lineage(spark, d):
    ids, nodes, _, merged = _ids(spark, d)
    cols = X.rank_columns(X.lineage(ids, nodes, merged))
    m = B.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") + 1000).alias("taxid"))
    return X.attach_lineage(m, cols).select("c_custkey", "taxid_phylum", "taxid_genus", "taxid_species")


@query(UP + "select cast(st.taxid as bigint) as taxid, name from st left join names on names.taxid = st.cur and is_scientific = 1")
def taxid_to_name(spark, d):
    ids, _, names, merged = _ids(spark, d)
    return X.taxid_to_name(ids, names, merged)


@query("with " + B.SQL["taxa"] + ", w as (select distinct upper(name) as name from names), h as (select w.name, taxid, is_scientific from w join names on lower(w.name) = lower(names.name)), r as (select *, row_number() over (partition by name order by is_scientific desc, taxid) as k from h) select r.name, r.taxid, (select count(distinct taxid) from h where h.name = r.name and h.is_scientific = r.is_scientific) as n_ids from r where k = 1")
def name_to_taxid(spark, d):
    _, _, names, _ = _ids(spark, d)
    return X.name_to_taxid(names.select(F.upper("name").alias("name")), names)


# orthologs

@query(cte("ortho") + " select busco_id, cast(species as int) as species, len(string_split(sequence, ',')) as n_genes from ortho")
def genecount(spark, d):
    return O.genecount(B.ortho(spark, d))


@query(cte("ortho") + """, d as (select cast(p_partkey // 2 as varchar) as busco_id, arg_min(p_name, species * 100000000 + p_partkey) filter (p_partkey % 4 <> 0) as description from part cross join (select unnest(range(0, 5)) as species) s where (p_partkey + species) % 3 <> 0 group by 1)
 select busco_id, cast(species as int) as species, coalesce(sequence, '-') as genes, '-' as orthodb_url, coalesce(description, '-') as description from d cross join (select unnest(range(0, 5)) as species) s left join ortho using (busco_id, species)""")
def orthogroup_table(spark, d):
    k = F.col("p_partkey")
    m = B.table(spark, d, "part").select("p_partkey", "p_name", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("species")).where("(p_partkey + species) % 3 <> 0")
    m = m.select(F.floor(k / 2).cast("string").alias("busco_id"), "species", k.cast("string").alias("sequence"), k.alias("pos"), F.lit("-").alias("orthodb_url"), F.when(k % 4 != 0, F.col("p_name")).otherwise("-").alias("description"))
    return O.described(O.orthogroup_table(m), m)


@query(cte("ortho") + f", {SINGLE} select * from one where percent >= 50")
def single_copy_mask(spark, d):
    return O.single_copy(O.genecount(B.ortho(spark, d)), 5, 50.0)


@query(cte("ortho", "gene_expr") + " select o.busco_id, cast(o.species as int) as species, r.run, g.value from ortho o join (select distinct species, run from gene_expr) r on r.species = o.species left join gene_expr g on g.species = o.species and g.run = r.run and g.target_id = o.sequence and position(',' in o.sequence) = 0")
def ortholog_expression(spark, d):
    return O.ortholog_expression(B.ortho(spark, d), lambda tasks: B.gene_expr(spark, d, tasks), runs=B.gene_runs(spark, d))


@query(cte("ortho", "gene_expr") + " select o.busco_id, cast(o.species as int) as species, r.run, g.value from ortho o join (select distinct species, run from gene_expr) r on r.species = o.species left join gene_expr g on g.species = o.species and g.run = r.run and g.target_id = o.sequence")
def ortholog_counts(spark, d):
    return O.ortholog_expression(B.ortho(spark, d), lambda tasks: B.gene_expr(spark, d, tasks), strict=False, runs=B.gene_runs(spark, d))


MARK = "mk as (select 'sp'||(p_partkey % 4) as species, p_name as busco_id, case when p_size < 20 then 'Complete' when p_size < 35 then 'Fragmented' else 'Missing' end as status from part)"


@query(f"with {MARK}, st as (select * from (values ('Single'), ('Duplicated'), ('Fragmented'), ('Missing')) t(state)), c as (select s.species, st.state, count(distinct busco_id) as n from (select distinct species from mk) s cross join st left join mk on mk.species = s.species and st.state = case mk.status when 'Complete' then 'Single' else mk.status end group by all) select species, state, n, n * 100.0 / (select max(t) from (select sum(n) as t from c group by species)) as percent from c")
def busco_status_counts(spark, d):
    m = B.table(spark, d, "part").select(F.concat(F.lit("sp"), F.col("p_partkey") % 4).alias("species"), F.col("p_name").alias("busco_id"), F.when(F.col("p_size") < 20, "Complete").when(F.col("p_size") < 35, "Fragmented").otherwise("Missing").alias("status"))
    return O.status_counts(m)
