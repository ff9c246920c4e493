"""Queries on sequencing runs, reads, file inventories and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.operators import quality as Q
from curatrix.operators import reads as R
from curatrix.plans import bindings as B
from curatrix.plans.bindings import cte, query


@query("select p_partkey, case when p_name like '%ring%' then 'ont' when p_partkey % 2 = 0 then 'illumina' when p_size * 40 <= 1000 then 'illumina' else 'unknown_long' end as platform, case when p_name like '%ring%' then 'ont_cdna' end as preset from part")
def infer_platform(spark, d):
    p = B.table(spark, d, "part")
    named = F.when(F.col("p_name").contains("ring"), "Oxford Nanopore MinION").otherwise(F.col("p_type"))
    out = p.select("p_partkey", R.infer_platform([named, F.col("p_brand")], F.when(F.col("p_partkey") % 2 == 0, "paired").otherwise("single"), (F.col("p_size") * 40).cast("string")).alias("platform"))
    return out.withColumn("preset", R.long_read_preset(F.col("platform"), [F.lit("cDNA")]))


@query("select p_partkey, case p_partkey % 4 when 0 then 'short_read' else 'long_read' end as backend from part")
def infer_backend(spark, d):
    k = F.col("p_partkey") % 4
    return B.table(spark, d, "part").select("p_partkey", R.infer_backend(F.when(k == 0, "illumina").when(k == 1, "ont").when(k == 2, "pacbio").otherwise("unknown_long")).alias("backend"))


@query(cte("meta") + """, s as (select pos, case when pos % 3 = 0 then 'single' else lib_layout end as layout, cast(total_spots as bigint) as total_spots, case when try_cast(spot_length as double) > 0 then cast(spot_length as double) else try_cast(total_bases as double) / cast(total_spots as double) end as spot_length from meta)
 select cast(pos as varchar) as run, layout, total_spots, spot_length, cast(floor(1000000.0 / spot_length) as bigint) as reads_per_run from s""")
def run_statistics(spark, d):
    m = B.meta(spark, d).withColumns({"layout_override": F.when(F.col("pos") % 3 == 0, "single").otherwise(""), "run": F.col("pos").cast("string")})
    return R.run_statistics(m, 1_000_000)


@query(cte("meta") + """ select cast(pos as varchar) as run, coalesce(case when pos % 4 = 0 then null else cast(total_spots as double) end, pos * 1.0) as total_spots, coalesce(try_cast(total_bases as double), pos * 300.0) as total_bases,
 coalesce(try_cast(spot_length as double), coalesce(try_cast(total_bases as double), pos * 300.0) / nullif(coalesce(case when pos % 4 = 0 then null else cast(total_spots as double) end, pos * 1.0), 0)) as spot_length from meta""")
def recover_run_statistics(spark, d):
    m = B.meta(spark, d).select(F.col("pos").cast("string").alias("run"), F.when(F.col("pos") % 4 == 0, "").otherwise(F.col("total_spots")).alias("total_spots"), "total_bases", "spot_length")
    s = B.meta(spark, d).select(F.col("pos").cast("string").alias("run"), F.col("pos").alias("num_spots"), (F.col("pos") * 300).alias("bp_dumped"), (F.col("pos") * 200).alias("bp_written"), (F.col("pos") * 100).alias("bp_final"))
    return R.recover_statistics(m, s)


@query("select p_partkey, case when p_size * 10 >= 200 then p_size * 10.0 else 200.0 end as fragment, case when p_size * 10 >= 200 then p_size * 10.0 else 200.0 end / 10 as sd from part")
def fragment_length(spark, d):
    f = R.fragment_length((F.col("p_size") * 10).cast("string"))
    return B.table(spark, d, "part").select("p_partkey", f.alias("fragment"), (f / 10).alias("sd"))


@query("select o_orderkey, case when t <= w then 1 when t > w + o then o when t > w then t - w + 1 else 1 end as s, case when t <= w then t when t > w + o then o + w - 1 when t > w then t else t end as e from (select o_orderkey, cast(floor(o_totalprice) as bigint) as t, 150000 + o_orderkey % 7 * 10000 as w, o_orderkey % 5 * 40000 as o from orders)")
def spot_range(spark, d):
    k = F.col("o_orderkey")
    r = R.spot_range(F.floor("o_totalprice").cast("long"), 150000 + k % 7 * 10000, k % 5 * 40000)
    return B.table(spark, d, "orders").select("o_orderkey", r.alias("r")).select("o_orderkey", F.col("r.start").alias("s"), F.col("r.end").alias("e"))


@query(cte("meta") + " select sum(t * 0.9) / sum(t) as rate, true as too_few, true as spots_left, true as needed from (select cast(total_spots as double) as t from meta)")
def second_round_needed(spark, d):
    t = F.col("total_spots").cast("double")
    return R.second_round_needed(B.meta(spark, d).select((t * 0.9).alias("bp_final"), t.alias("bp_target"), F.col("pos").alias("spots_left")), 5.0)


@query(cte("meta") + " select count(*) as n_runs, sum(try_cast(total_bases as double)) as total_bases, cast(floor(1e12 / count(*)) as bigint) as bp_per_run from meta")
def target_bp_per_run(spark, d):
    return R.target_bp_per_run(B.meta(spark, d), 1e12)


@query("""with r as (select l_suppkey, l_orderkey * 10 + l_linenumber as pos, l_partkey, 50.0 + l_linenumber * 10 as len, cast(floor(l_extendedprice) as bigint) as total, cast(floor(l_extendedprice / 2) as bigint) as used, l_quantity * 40000 as target, 1 - l_discount as rate from lineitem),
q as (select min(pos) as pos, len, total, used, target, rate, l_partkey, l_suppkey from r group by all), x as (select cast(row_number() over (partition by l_suppkey order by pos, l_partkey, total) as int) as pos, len, total, used, target, rate, l_suppkey from q),
a as (select *, cast(ceil(target / len / rate) as bigint) as need, greatest(total - used, 0) as free from x), b as (select *, least(need, free) as own from a), c as (select *, (need - own) * len as short, (free - own) * len as cap from b),
e as (select *, sum(short) over (partition by l_suppkey) - coalesce(sum(cap) over (partition by l_suppkey order by pos rows between unbounded preceding and 1 preceding), 0) as rest from c)
select l_suppkey, pos, own + cast(case when rest <= 0 then 0 when rest >= cap then free - own else ceil(rest / len) end as bigint) as reads from e""")
def second_round_ranges(spark, d):
    """Each supplier is a job."""
    return R.second_round_ranges(_lines(spark, d), "l_suppkey", ["p0", "l_partkey", "total_spots"]).select("l_suppkey", "pos", "reads")


def _lines(spark, d):
    """Lines as runs; equal ones count once."""
    li = B.table(spark, d, "lineitem").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("p0"), "l_partkey", (50.0 + F.col("l_linenumber") * 10).alias("spot_length"), F.floor("l_extendedprice").cast("long").alias("total_spots"),
        F.floor(F.col("l_extendedprice") / 2).cast("long").alias("used_spots"), (F.col("l_quantity") * 40000).alias("target_bp"), (1 - F.col("l_discount")).alias("rate"),
    )
    return li.groupBy(*[c for c in li.columns if c != "p0"]).agg(F.min("p0").alias("p0"))


@query("select p_partkey, case when n > 1 then 'f'||(p_partkey % 3)||'_'||p_name else p_name end || case when k > 1 then '_'||k else '' end as run from (select *, row_number() over (partition by case when n > 1 then 'f'||(p_partkey % 3)||'_'||p_name else p_name end order by p_partkey) as k from (select *, count(*) over (partition by p_name) as n from part))")
def unique_run_ids(spark, d):
    f = B.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("basename"), F.concat(F.lit("f"), F.col("p_partkey") % 3).alias("folder"), F.col("p_partkey").alias("path"))
    return R.unique_run_ids(f).select("p_partkey", "run")


@query(cte("reads") + " select run, core, mate, ordinal from reads where not (run in ('c0', 'c2', 'c4') and mate is null)")
def drop_singletons(spark, d):
    r = B.reads(spark, d).withColumn("layout", F.when(F.col("run").isin("c0", "c2", "c4"), "paired").otherwise("single"))
    return R.drop_singletons(r).select("run", "core", "mate", "ordinal")


@query(cte("reads") + " select core as run, case when bool_or(coalesce(mate = 1, false)) and bool_or(coalesce(mate = 2, false)) then 'paired' else 'single' end as layout from reads group by 1")
def layout_from_files(spark, d):
    return R.layout_from_files(B.reads(spark, d).select(F.col("core").alias("run"), "mate"))


@query(cte("meta") + " select pos from meta where lower(trim(exclusion)) = 'no' and is_sampled = 'yes' and run <> ''")
def quantifiable_runs(spark, d):
    from curatrix.operators import metadata as M

    return M.drop_missing_run(M.eligible_runs(B.meta(spark, d))).select("pos")


@query(cte("reads") + " select run, core, ordinal, mate from reads where cast(core as bigint) % 7 <> 0")
def contaminant_anti_join(spark, d):
    r = B.reads(spark, d)
    return R.contaminant_anti_join(r, r.where("cast(core as bigint) % 7 = 0").select("run", "core")).select("run", "core", "ordinal", "mate")


@query("select o_orderkey, cast(100 + c_nationkey as bigint) as rank_taxid from orders join customer on o_custkey = c_custkey where o_orderkey % 3 <> 0 and c_nationkey <> 5")
def classified_mismatch(spark, d):
    from curatrix.operators import taxonomy as X

    nodes, _, merged = B.taxa(spark, d)
    lin = X.lineage(nodes.where("rank = 'species'").select("taxid"), nodes, merged)
    a = B.table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey") + 1000).alias("taxid"))
    return R.classified_mismatch(a, lin, "genus", F.lit(105)).select("o_orderkey", "rank_taxid")


@query(cte("reads") + ", s as (select run, ordinal, max(core) filter (mate = 1) as c1, max(core) filter (mate = 2) as c2 from reads group by all) select run, count(c1) as n_first, count(c2) as n_second, count(*) filter (c1 is null or c2 is null) as n_lone, count(*) filter (c1 <> c2) as n_mismatch from s group by 1")
def paired_mates(spark, d):
    return R.paired_mates(B.reads(spark, d))


@query(cte("reads") + " select run, core, ordinal, mate from reads where ordinal between 5000 and 30000")
def read_slice(spark, d):
    return R.read_slice(B.reads(spark, d), 5000, 30000).select("run", "core", "ordinal", "mate")


@query(cte("reads") + " select run, max(n) as spots, cast(sum(b) as bigint) as bases, cast(sum(n) as bigint) as records from (select run, mate, count(*) as n, sum(length(seq)) as b from reads group by all) group by 1")
def read_totals(spark, d):
    return R.read_totals(B.reads(spark, d))


@query(cte("stats") + ", w as (select run, coalesce(sum(n) filter (stage = 'view'), 0) as a, coalesce(sum(n) filter (stage = 'click'), 0) as b from stats group by 1) select run, case when a > 0 then greatest(a - b, 0) * 100.0 / a end as pct from w")
def filtered_percent(spark, d):
    w = B.stats(spark, d).groupBy("run").agg(F.coalesce(F.sum(F.when(F.col("stage") == "view", F.col("n"))), F.lit(0)).alias("a"), F.coalesce(F.sum(F.when(F.col("stage") == "click", F.col("n"))), F.lit(0)).alias("b"))
    return w.select("run", R.filtered_percent(F.col("a"), F.col("b")).alias("pct"))


@query(cte("stats") + " select run, sum(metric * n) / sum(n) as metric from stats group by 1")
def weighted_metric_update(spark, d):
    return R.weighted_metric(B.stats(spark, d), ["run"], "metric", "n")


@query("select p_partkey, case when p_size > 10 and p_size % 3 = 0 then 'contam' when p_size > 20 and p_size % 5 = 0 then 'fastp' else '' end as stage from part")
def zero_output_stage(spark, d):
    s = F.col("p_size")
    p = B.table(spark, d, "part").select("p_partkey", s.alias("contam_in"), F.when(s > 10, s % 3).otherwise(1).alias("contam_out"), F.lit(1).alias("rrna_in"), F.lit(1).alias("rrna_out"), s.alias("fastp_in"), F.when(s > 20, s % 5).otherwise(1).alias("fastp_out"), F.lit(0).alias("extraction_in"), F.lit(0).alias("extraction_out"))
    return p.select("p_partkey", R.zero_output_stage().alias("stage"))


@query(cte("reads") + """, p as (select run, ordinal, max(seq) filter (mate = 1) as s1, max(seq) filter (mate = 2) as s2 from reads group by all having s1 is not null and s2 is not null), k as (select *, row_number() over (partition by run order by md5(run||'|'||ordinal), ordinal) as r from p)
 select run, count(*) as n_pairs, avg((s1 = s2)::int) as ratio, avg((s1 = s2)::int) >= 0.99 as treat_as_single from k where r <= 2000 group by 1""")
def identical_mate_ratio(spark, d):
    """Whole sequences of the first 2,000 pairs of a run by hash."""
    return R.identical_mate_ratio(B.reads(spark, d))


@query("with q as (select cast(l_suppkey as varchar) as run, 't'||l_partkey as target_id, 1.0 * l_linenumber as length, 1.0 as eff_length, l_quantity as est_counts from lineitem) select run, target_id, length, eff_length, est_counts, c * 100.0 / 1000000 as p_mapped from q join (select run, sum(est_counts) as c from q group by 1) using (run)")
def long_read_adapt(spark, d):
    li = B.table(spark, d, "lineitem")
    quant = li.select(F.col("l_suppkey").cast("string").alias("run"), F.concat(F.lit(" t"), "l_partkey").alias("tname"), F.col("l_linenumber").alias("len"), F.col("l_quantity").alias("num_reads"))
    return R.long_read_adapt(quant, quant.select("run").distinct().withColumn("total_spots", F.lit(1_000_000)))


@query("select l_suppkey as run, sum(greatest(l_quantity, l_linenumber * 10)) as dumped, cast(sum(l_linenumber * 10) as bigint) as written, sum(greatest(l_quantity, l_linenumber * 10) - l_linenumber * 10) as rejected, cast(sum(l_linenumber * 10 * 100) as bigint) as bp from lineitem group by 1")
def extraction_counts(spark, d):
    r = B.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("run"), F.col("l_quantity").alias("dumped"), (F.col("l_linenumber") * 10).alias("written"), F.lit(100).alias("spot_length"))
    return R.extraction_counts(r)


@query("select 'a' as stage, sum(l_quantity) as total from lineitem union all select 'b', sum(l_extendedprice) from lineitem")
def stage_totals(spark, d):
    return R.stage_totals(B.table(spark, d, "lineitem").select(F.col("l_quantity").alias("a"), F.col("l_extendedprice").alias("b")), ["a", "b"])


# quality


@query(cte("abundance") + """, i as (select run, target_id, count(*) as n, count(*) filter (length < 0) as a, count(*) filter (eff_length < 0) as b, count(*) filter (est_counts < 0) as c, count(*) filter (tpm < 0) as e from abundance group by all)
 select run, cast(sum(n) as bigint) as n_rows, cast(0 as bigint) as n_blank, cast(sum(n - 1) as bigint) as n_repeated, cast(sum(a) as bigint) as bad_length, cast(sum(b) as bigint) as bad_eff_length, cast(sum(c) as bigint) as bad_est_counts, cast(sum(e) as bigint) as bad_tpm, case when sum(n - 1) > 0 then 'repeated target_id' else '' end as problem from i group by 1""")
def check_table_contract(spark, d):
    return Q.check_table_contract(B.abundance(spark, d), ["run"])


FILES = "f as (select cast(core as varchar) as core, mate, length(seq) as size from reads)"


@query(cte("reads") + f", {FILES}, g as (select core, count(*) filter (mate = 1) as n1, count(*) filter (mate = 2) as n2, count(*) filter (mate is null) as n0, sum(size) as size from f group by 1) select 'd' as folder, core as run, case when n1 = 1 and n2 = 1 and n0 <= 1 then 'paired' when n1 + n0 = 1 and n2 = 0 then 'single' else 'error' end as layout, cast(size as bigint) as size from g")
def fastq_inventory(spark, d):
    name = F.concat("core", F.coalesce(F.concat(F.lit("_"), "mate"), F.lit("")), F.lit(".fq"))
    return Q.fastq_inventory(B.reads(spark, d).select(F.lit("d").alias("folder"), name.alias("name"), F.length("seq").cast("long").alias("size")))


@query(cte("reads") + " select run, max(n) as total_spots, cast(sum(b) as bigint) as total_bases, cast(sum(floor(b / n + 0.5)) as bigint) as spot_length from (select run, mate, count(*) as n, cast(sum(length(seq)) as double) as b from reads group by all) group by 1")
def fastq_run_stats(spark, d):
    return Q.fastq_run_stats(B.reads(spark, d))


@query(cte("reads") + " select run, count(*) as n_records, count(*) filter (ordinal % 10 = 3) as bad_header, cast(0 as bigint) as bad_separator, count(*) filter (ordinal % 10 <> 3 and ordinal % 7 = 2) as bad_length from reads group by 1")
def check_fastq(spark, d):
    o = F.col("ordinal")
    r = B.reads(spark, d).select("run", F.concat(F.when(o % 10 == 3, "x").otherwise("@"), "core").alias("header"), "seq", F.lit("+").alias("plus"), F.when(o % 7 == 2, F.concat("seq", F.lit("I"))).otherwise(F.col("seq")).alias("qual"))
    return Q.read_problems(r)


@query(cte("ortho", "runs") + " select run, pos % 7 in (select species from ortho) as ok from runs")
def check_busco(spark, d):
    r = B.runs(spark, d).select("run", (F.col("pos") % 7).cast("int").alias("species"))
    return r.join(Q.has_rows(B.ortho(spark, d).select("species"), r.select("species").distinct()), "species").select("run", "ok")


ISSUES = """ex as (select 'quant' as "check", run as target from runs), ob as (select 'quant' as "check", run as target, case when pos % 4 = 0 then timestamp '2020-01-01' else timestamp '2024-01-01' end as modified from runs where pos % 5 <> 0 union all select 'quant', 'extra'||run, timestamp '2024-01-01' from runs where pos % 9 = 0),
i as (select "check", target, case when ob.modified is null then 'missing_output' when ex.e is null then 'orphan_output' when modified < timestamp '2022-01-01' then 'stale_output' end as issue, case when ob.modified is null then 'error' else 'warning' end as severity from (select *, 1 as e from ex) ex full join ob using ("check", target)),
iss as (select * from i where issue is not null)"""


def _issues(spark, d):
    r = B.runs(spark, d)
    e = r.select(F.lit("quant").alias("check"), F.col("run").alias("target"))
    o = r.where("pos % 5 <> 0").select(F.lit("quant").alias("check"), F.col("run").alias("target"), F.when(F.col("pos") % 4 == 0, F.lit("2020-01-01")).otherwise(F.lit("2024-01-01")).cast("timestamp").alias("modified"))
    o = o.unionByName(r.where("pos % 9 = 0").select(F.lit("quant").alias("check"), F.concat(F.lit("extra"), "run").alias("target"), F.lit("2024-01-01").cast("timestamp").alias("modified")))
    return e, o, Q.quality_issues(e, o, "2022-01-01")


@query(cte("runs") + f", {ISSUES} select * from iss")
def quality_issues(spark, d):
    return _issues(spark, d)[2]


SUMMARY = """su as (select 'quant' as "check", (select count(*) from ex) as n_checked, (select count(*) from ex) - count(*) filter (severity = 'error') as n_available, count(*) filter (severity = 'error') as n_unavailable, count(*) filter (severity <> 'error') as n_warnings,
 array_to_string(list_slice(list_sort(list(target) filter (severity = 'error')), 1, 5), ',') as examples, 'error' as status from iss)"""


@query(cte("runs") + f", {ISSUES}, {SUMMARY} select * from su")
def quality_summary(spark, d):
    e, _, i = _issues(spark, d)
    return Q.quality_summary(e, i)


@query(cte("runs") + f", {ISSUES}, {SUMMARY} select \"check\", 'absent' as status_before, status as status_after, n_unavailable as delta_unavailable from su union all select 'merge', 'ok', 'absent', -2")
def quality_comparison(spark, d):
    e, _, i = _issues(spark, d)
    after = Q.quality_summary(e, i)
    return Q.quality_comparison(after.select(F.lit("merge").alias("check"), F.lit("ok").alias("status"), F.lit(2).cast("long").alias("n_unavailable")), after)


@query(cte("runs") + f", {ISSUES} select \"check\", target from iss where severity = 'error'")
def rerun_targets(spark, d):
    e, _, i = _issues(spark, d)
    return Q.rerun_targets(i, e)


@query(cte("runs") + f", {ISSUES} select \"check\", target from iss where target in (select run from runs)")
def quality_target_join(spark, d):
    _, _, i = _issues(spark, d)
    return Q.restrict_targets(i.select("check", "target"), B.runs(spark, d), "run").select("check", "target")


@query(cte("runs") + f", {ISSUES} select \"check\", target, target in (select target from ob) as available from ex")
def output_availability(spark, d):
    e, o, _ = _issues(spark, d)
    return Q.output_availability(e, o.select("check", "target"))


@query(cte("runs") + " select t.o as output, case when t.o = 'exclusion' then (select count(*) from runs where exclusion <> 'no') > 0 else true end as expected from (values ('mapping_rate'), ('layout'), ('expression'), ('exclusion')) t(o)")
def expected_outputs(spark, d):
    return Q.expected_outputs(B.runs(spark, d), B.counts(spark, d))


@query(cte("abundance") + " select run, target_id, est_counts from (select *, row_number() over (partition by run order by target_id, est_counts) as r from abundance) where r <= 5")
def preview(spark, d):
    return Q.first_rows(B.abundance(spark, d), ["run"], ["target_id", "est_counts"]).select("run", "target_id", "est_counts")
