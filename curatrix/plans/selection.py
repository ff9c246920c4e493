"""Queries on metadata: predicates, rules, sampling, joins, unions, orders, summaries and text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators import metadata as M
from curatrix.operators import rules as R
from curatrix.operators import sampling as S
from curatrix.operators import summaries as Y
from curatrix.plans import bindings as B
from curatrix.plans.bindings import cte, query
from curatrix.sources import tables as X

KEPT = "lower(trim(exclusion)) = 'no'"


@query(cte("meta") + f"select run, pos, {KEPT} as kept from meta")
def keep_predicate(spark, d):
    return B.meta(spark, d).select("run", "pos", T.is_kept(F.col("exclusion")).alias("kept"))


@query(cte("meta") + f"select run, pos from meta where {KEPT} and is_sampled = 'yes'")
def eligible_runs(spark, d):
    return M.eligible_runs(B.meta(spark, d)).select("run", "pos")


@query(cte("meta") + "select run, sample_group from meta where sample_group in ('1-URGENT', '5-LOW')")
def filter_sample_group(spark, d):
    return M.in_groups(B.meta(spark, d), "1-URGENT| 5-LOW").select("run", "sample_group")


@query(cte("meta") + "select count(*) as n_missing, (select coalesce(string_agg(p, ',' order by p), '') from (select cast(pos as varchar) as p from meta where run = '' order by 1 limit 10)) as examples from meta where run = ''")
def drop_missing_run(spark, d):
    return M.missing_run_report(B.meta(spark, d), F.col("pos"))


@query(cte("titles") + "select run, array_to_string(list_filter([title, kind], lambda x: x <> ''), '; ') as title from (select run, title, case when kind = title then '' else kind end as kind from titles)")
def aggregate_columns(spark, d):
    return M.aggregate_columns(B.titles(spark, d), "title", ["kind", "listed"]).select("run", "title")


ORGANS = {"ring": "ring", "widget": "widget|gadget", "bolt": "bolt|nut"}


def _rules() -> list[dict]:
    base = {"enabled": "yes", "scope_column": "", "scope_mode": "", "stop_on_match": "yes", "parameter_name": "", "parameter_value": "", "note": "", "target_column": "exclusion", "action": "set"}
    rows = [base | {"rule_id": f"n{i}", "stage": "normalize", "priority": i, "columns": "title,kind", "pattern": p, "outcome": g} for i, (g, p) in enumerate(ORGANS.items())]
    rows += [base | {"rule_id": "x1", "stage": "exclude", "priority": 1, "columns": "title,kind", "pattern": "^red|promo", "outcome": "red_or_promo", "stop_on_match": "no"}]
    rows += [base | {"rule_id": "x2", "stage": "exclude", "priority": 2, "columns": "kind", "pattern": "economy", "outcome": "economy"}]
    rows += [base | {"rule_id": "x3", "stage": "exclude", "priority": 3, "columns": "title", "pattern": "ring$", "outcome": "ring"}]
    rows += [base | {"rule_id": "c1", "stage": "control", "priority": 1, "columns": "title", "pattern": "small", "outcome": "non_control", "scope_column": "bioproject"}]
    rows += [base | {"rule_id": "f1", "stage": "filter", "priority": 1, "columns": "size", "pattern": "", "action": "below", "outcome": "low_size", "parameter_name": "min_size"}]
    rows += [base | {"rule_id": "f2", "stage": "filter", "priority": 2, "columns": "listed", "pattern": "", "action": "missing", "outcome": "no_list"}]
    return R.load_rules(rows)


@query("select * from (values ('n0', 'normalize', 0), ('n1', 'normalize', 1), ('n2', 'normalize', 2), ('x1', 'exclude', 1), ('x2', 'exclude', 2), ('x3', 'exclude', 3), ('c1', 'control', 1), ('f1', 'filter', 1), ('f2', 'filter', 2)) as t(rule_id, stage, priority) cross join (select count(*) as n_rows, count(*) filter (regexp_matches(p_name, 'small')) as n_small from part)")
def read_rules(spark, d):
    size = B.titles(spark, d).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(R.matches(F.col("title"), "small")).alias("n_small"))
    return spark.createDataFrame([(r["rule_id"], r["stage"], r["priority"]) for r in _rules()], "rule_id string, stage string, priority int").crossJoin(F.broadcast(size))


NORMALIZED = """n as (select run, pos, title, kind, case
 when regexp_matches(title, '(?i)ring') then struct_pack(g := 'ring', s := 'assigned', c := 'title', t := title, r := 'n0') when regexp_matches(kind, '(?i)ring') then struct_pack(g := 'ring', s := 'assigned', c := 'kind', t := kind, r := 'n0')
 when regexp_matches(title, '(?i)widget|gadget') then struct_pack(g := 'widget', s := 'assigned', c := 'title', t := title, r := 'n1') when regexp_matches(kind, '(?i)widget|gadget') then struct_pack(g := 'widget', s := 'assigned', c := 'kind', t := kind, r := 'n1')
 when regexp_matches(title, '(?i)bolt|nut') then struct_pack(g := 'bolt', s := 'assigned', c := 'title', t := title, r := 'n2') when regexp_matches(kind, '(?i)bolt|nut') then struct_pack(g := 'bolt', s := 'assigned', c := 'kind', t := kind, r := 'n2')
 else struct_pack(g := 'unknown', s := 'unknown', c := 'title', t := title, r := '') end as b from titles)"""


def _normalized(spark, d) -> DataFrame:
    return R.normalize_group(B.titles(spark, d), R.of_stage(_rules(), "normalize"), ["title", "kind"])


@query(cte("titles") + ", " + NORMALIZED + " select run, b.g as sample_group, b.s as group_status, b.c as group_source, b.t as group_text, b.r as group_rule from n")
def normalize_group(spark, d):
    return _normalized(spark, d).select("run", "sample_group", "group_status", "group_source", "group_text", "group_rule")


@query(cte("titles") + """, s as (select run, mixed_text, list_filter(list_transform(string_split(mixed_text, ' and '), lambda x: trim(x)), lambda x: x <> '') as parts from titles),
c as (select run, list_transform(parts, lambda x: case when regexp_matches(x, '(?i)ring') then 'ring' when regexp_matches(x, '(?i)widget|gadget') then 'widget' when regexp_matches(x, '(?i)bolt|nut') then 'bolt' when regexp_matches(x, '(?i)standard|economy') then 'ignore' else 'none' end) as k from s)
select run, case when len(k) > 1 and list_contains(k, 'none') then 'review' when len(list_filter(k, lambda x: x not in ('none', 'ignore', 'ring'))) > 0 then 'mixed' else 'assigned' end as verdict from c""")
def validate_segments(spark, d):
    return B.titles(spark, d).select("run", R.classify_segments(F.col("mixed_text"), F.lit("ring"), ORGANS, "standard|economy").alias("verdict"))


@query(cte("titles") + ", " + NORMALIZED + """ select run, b.g as sample_group, case when x <> '' then 'review' else b.s end as group_status, case when x <> '' then x else b.t end as group_text from (select *, case when b.s <> 'assigned' then ''
 when b.g <> 'ring' and b.c <> 'title' and regexp_matches(title, '(?i)ring') then 'assigned='||b.g||'; conflict=title=ring; previous_rule_id='||b.r when b.g <> 'widget' and b.c <> 'title' and regexp_matches(title, '(?i)widget|gadget') then 'assigned='||b.g||'; conflict=title=widget; previous_rule_id='||b.r
 when b.g <> 'bolt' and b.c <> 'title' and regexp_matches(title, '(?i)bolt|nut') then 'assigned='||b.g||'; conflict=title=bolt; previous_rule_id='||b.r when b.g <> 'ring' and b.c <> 'kind' and regexp_matches(kind, '(?i)ring') then 'assigned='||b.g||'; conflict=kind=ring; previous_rule_id='||b.r
 when b.g <> 'widget' and b.c <> 'kind' and regexp_matches(kind, '(?i)widget|gadget') then 'assigned='||b.g||'; conflict=kind=widget; previous_rule_id='||b.r when b.g <> 'bolt' and b.c <> 'kind' and regexp_matches(kind, '(?i)bolt|nut') then 'assigned='||b.g||'; conflict=kind=bolt; previous_rule_id='||b.r else '' end as x from n)""")
def cross_field_conflict(spark, d):
    return R.cross_field_conflict(_normalized(spark, d), ["title", "kind"], ORGANS).select("run", "sample_group", "group_status", "group_text")


EXCLUDED = """x as (select run, pos, title, kind, bioproject, size, listed, case when regexp_matches(kind, '(?i)economy') then 'economy' when regexp_matches(title, '(?i)ring$') then 'ring' when regexp_matches(title, '(?i)^red|promo') or regexp_matches(kind, '(?i)^red|promo') then 'red_or_promo' else '' end as exclusion from titles)"""


@query(cte("titles") + ", " + EXCLUDED + " select run, exclusion from x")
def exclude_rules(spark, d):
    return R.exclude_rules(B.titles(spark, d), R.of_stage(_rules(), "exclude")).select("run", "exclusion")


@query(cte("titles") + """ select run, case when try_cast(size as double) is null or try_cast(size as double) <= 0 or try_cast(size as double) < 10 then 'low_size' when listed = '' then 'no_list' else exclusion end as exclusion from titles""")
def filter_rules(spark, d):
    return R.filter_rules(B.titles(spark, d), R.of_stage(_rules(), "filter"), {"min_size": 10}).select("run", "exclusion")


@query(cte("titles") + ", " + EXCLUDED + """ select run, case when exclusion = '' and not hit and any_hit then 'non_control' else exclusion end as exclusion from (select *, bool_or(hit and exclusion = '') over (partition by bioproject) as any_hit from (select *, regexp_matches(title, '(?i)small') as hit from x))""")
def control_rules(spark, d):
    excluded = R.exclude_rules(B.titles(spark, d), R.of_stage(_rules(), "exclude"))
    return R.control_rules(excluded, R.of_stage(_rules(), "control")).select("run", "exclusion")


@query(cte("meta") + f""" select run, pos, case when ok and r > 1 then 'redundant_biosample' else exclusion end as exclusion from (select *, row_number() over (partition by ok, scientific_name, biosample order by try_cast(total_spots as bigint) desc, run, pos) as r from (select *, {KEPT} as ok from meta))""")
def dedup_best(spark, d):
    return R.dedup_best(B.meta(spark, d), ["scientific_name", "biosample"], "total_spots", "redundant_biosample", "pos").select("run", "pos", "exclusion")


@query(cte("runs") + " select run, case when exclusion = 'no' and not coalesce(mapping_rate >= 20, false) then 'low_mapping_rate' else exclusion end as exclusion from runs")
def mapping_rate_filter(spark, d):
    return M.mapping_rate_filter(B.runs(spark, d), 20.0).select("run", "exclusion")


@query(cte("runs", "counts") + " select run, case when exclusion = 'no' and run not in (select run from counts where run <> '5') then 'failed_quantification' else exclusion end as exclusion from runs where scientific_name = 'ASIA' and sample_group in ('G0', 'G2')")
def species_metadata(spark, d):
    return M.species_metadata(B.runs(spark, d), B.counts(spark, d).where("run <> '5'"), "ASIA", ["G0", "G2"]).select("run", "exclusion")


@query(cte("meta") + " select pos, case when total_bases = '' then 'not_provided' else total_bases end as total_bases, case when spot_length = '' then 'not_provided' else spot_length end as spot_length from meta")
def standardize_missing(spark, d):
    return M.standardize_missing(B.meta(spark, d), ["total_bases", "spot_length"]).select("pos", "total_bases", "spot_length")


@query("select page_id, regexp_replace(html, '[\\r\\n''\"|]', '', 'g') as html from pages")
def strip_special_chars(spark, d):
    return M.strip_special_chars(B.table(spark, d, "pages").select("page_id", "html"))


@query(cte("runs") + " select run, coalesce(case when pos % 3 = 0 then null else mapping_rate end, mapping_rate + 1) as margin from runs")
def coalesce_filter_columns(spark, d):
    r = B.runs(spark, d).select("run", F.when(F.col("pos") % 3 == 0, None).otherwise(F.col("mapping_rate")).alias("margin_corrected"), (F.col("mapping_rate") + 1).alias("margin_uncorrected"))
    return M.coalesce_pairs(r, ["margin"], ["_corrected", "_uncorrected"])


@query(cte("meta") + """ select pos, case when try_cast(total_bases as double) > 0 then try_cast(total_bases as bigint) else 999999999999 end as total_bases, case when try_cast(total_spots as double) > 0 then try_cast(total_spots as bigint)
 when try_cast(total_bases as double) > 0 and try_cast(spot_length as double) > 0 then cast(floor(try_cast(total_bases as double) / try_cast(spot_length as double)) as bigint) else 999999999999 end as total_spots from (select pos, total_bases, spot_length, case when pos % 4 = 0 then '' else total_spots end as total_spots from meta)""")
def fill_run_sizes(spark, d):
    m = B.meta(spark, d).withColumn("total_spots", F.when(F.col("pos") % 4 == 0, "").otherwise(F.col("total_spots")))
    return M.fill_run_sizes(m).select("pos", "total_bases", "total_spots")


@query(cte("meta") + f" select scientific_name as value, min(pos) as first_pos from meta where {KEPT} group by 1")
def selected_species(spark, d):
    return M.selected_values(B.meta(spark, d), "scientific_name", "pos")


@query(cte("meta") + f" select sample_group as value, min(pos) as first_pos from meta where {KEPT} group by 1")
def selected_groups(spark, d):
    return M.selected_values(B.meta(spark, d), "sample_group", "pos")


@query(cte("runs") + " select run, exclusion, regexp_replace(regexp_replace(regexp_replace(scientific_name, '[^0-9A-Za-z._-]', '_', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g') as species_token from runs where sample_group in ('G0', 'G1')")
def cross_species_metadata(spark, d):
    return M.cross_species_metadata(B.runs(spark, d), ["G0", "G1"]).select("run", "exclusion", "species_token")


@query(cte("runs") + " select run, case when pos % 2 = 0 and mapping_rate is not null then mapping_rate + 0.5 else mapping_rate end as mapping_rate, case when pos % 2 = 0 then 'batch'||(pos % 4) end as batch from runs")
def update_by_run(spark, d):
    r = B.runs(spark, d)
    u = r.where("pos % 2 = 0").select("run", (F.col("mapping_rate") + 0.5).alias("mapping_rate"), F.concat(F.lit("batch"), F.col("pos") % 4).alias("batch"))
    return M.update_by_run(r, u).select("run", "mapping_rate", "batch")


@query(cte("meta", "runs") + " select run, scientific_name, biosample, cast(null as double) as mapping_rate from meta union all select run, scientific_name, null, mapping_rate from runs")
def union_metadata(spark, d):
    return M.union_metadata([B.meta(spark, d).select("run", "scientific_name", "biosample"), B.runs(spark, d).select("run", "scientific_name", "mapping_rate")])


@query(cte("meta") + " select run, pos, src from (select *, row_number() over (partition by run order by src, pos) as r from (select run, pos, 'a' as src from meta where pos % 2 = 0 union all select run, pos, 'b' from meta where pos % 3 = 0)) where r = 1")
def union_distinct_run(spark, d):
    m = B.meta(spark, d).select("run", "pos")
    return M.union_distinct_run([m.where("pos % 2 = 0").withColumn("src", F.lit("a")), m.where("pos % 3 = 0").withColumn("src", F.lit("b"))], "pos")


@query(cte("runs") + " select run, scientific_name from runs union all select 'private'||run, scientific_name from runs where pos % 10 = 0")
def append_private_runs(spark, d):
    r = B.runs(spark, d).select("run", "scientific_name", "pos")
    p = r.where("pos % 10 = 0").select(F.concat(F.lit("private"), "run").alias("run"), "scientific_name")
    return M.append_private_runs(r.select("run", "scientific_name"), p)


@query(cte("meta") + " select distinct run from meta where run not in (select run from meta where pos % 3 = 0)")
def run_difference(spark, d):
    m = B.meta(spark, d)
    return M.run_difference(m, m.where("pos % 3 = 0"))


@query(cte("meta", "runs") + " select scientific_name from (select distinct case when pos % 2 = 0 then 'ASIA' else scientific_name end as scientific_name from meta) intersect select scientific_name from runs")
def species_intersection(spark, d):
    a = B.meta(spark, d).select(F.when(F.col("pos") % 2 == 0, "ASIA").otherwise(F.col("scientific_name")).alias("scientific_name"))
    return a.intersect(B.runs(spark, d).select("scientific_name"))


@query(cte("runs") + " select run, cast(row_number() over (order by sample_group, scientific_name, bioproject, pos) as int) as run_pos from runs")
def run_order(spark, d):
    return M.run_order(B.runs(spark, d), "pos").select("run", "run_pos")


@query(cte("meta") + " select run, pos from meta where scientific_name = (select distinct scientific_name from meta order by 1 limit 1 offset 1)")
def batch_slice(spark, d):
    return M.batch_slice(B.meta(spark, d), "species", 2, "pos").select("run", "pos")


@query(cte("meta") + " select (select count(*) from (values ('run'), ('scientific_name'), ('tissue')) w(c) where c not in (select column_name from (describe select * from meta))) as missing_columns, (select count(*) from meta where run = '') as blank_run, (select count(*) from meta where trim(scientific_name) = '') as blank_species, (select count(*) from (select run from meta where run <> '' group by 1 having count(*) > 1)) as duplicate_run")
def metadata_validate(spark, d):
    return M.metadata_problems(B.meta(spark, d), ["run", "scientific_name", "tissue"])


@query(cte("runs") + " select 50.0 as low, case when count(*) filter (pos % 5 = 0) > 0 then 70.0 else 50.0 end as high, count(*) filter (pos % 7 <> 0) as given, count(*) as n_rows, false as consistent from runs")
def threshold_consistency(spark, d):
    r = B.runs(spark, d).withColumn("t", F.when(F.col("pos") % 7 == 0, "").when(F.col("pos") % 5 == 0, "70").otherwise("50"))
    return M.threshold_consistency(r, "t")


# sampling

EL = f"e as (select *, {KEPT} as ok from meta)"


@query(cte("meta") + f""", {EL}, a as (select *, row_number() over (partition by scientific_name, sample_group, ok, bioproject order by md5(run||'|7'), run) as rd from e),
b as (select *, row_number() over (partition by scientific_name, sample_group, ok order by rd, md5(bioproject||'|'||rd||'|7'), bioproject) as r from a) select run, pos, case when ok and r <= 25 then 'yes' else 'no' end as is_sampled from b where run <> ''""")
def sample_max_diversity(spark, d):
    return S.sample_max_diversity(B.meta(spark, d), 25, 7).where("run <> ''").select("run", "pos", "is_sampled")


@query(cte("meta") + f""", {EL}, a as (select *, count(*) over (partition by scientific_name, sample_group, ok, bioproject) as sz from e),
b as (select *, row_number() over (partition by scientific_name, sample_group, ok order by sz desc, md5(bioproject||'|7'), bioproject, md5(run||'|7'), run) as r from a) select run, pos, case when ok and r <= 25 then 'yes' else 'no' end as is_sampled from b where run <> ''""")
def sample_by_project_size(spark, d):
    return S.sample_by_project_size(B.meta(spark, d), 25, 7).where("run <> ''").select("run", "pos", "is_sampled")


@query(cte("meta") + f""", {EL}, b as (select *, row_number() over (partition by scientific_name, sample_group, ok order by md5(run||'|7'), run) as r from e) select run, pos, case when ok and r <= 25 then 'yes' else 'no' end as is_sampled from b where run <> ''""")
def sample_random(spark, d):
    return S.sample_random(B.meta(spark, d), 25, 7).where("run <> ''").select("run", "pos", "is_sampled")


# summaries

TOP = "select item, value, n, cast(rank as int) as rank from (select *, row_number() over (partition by item order by n desc, value) as rank from (select item, value, count(*) as n from (select 'scientific_name' as item, scientific_name as value from meta union all select 'spot_length', spot_length from meta) where value <> '' group by all)) where rank <= 10"


@query(cte("meta") + f""" select 'rows' as item, '' as value, count(*) as n, 0 as rank from meta union all select 'runs', '', count(*) filter (run <> ''), 0 from meta union all select 'distinct_runs', '', count(distinct run) filter (run <> ''), 0 from meta
 union all select 'scientific_name:given', '', count(*) filter (scientific_name <> ''), 0 from meta union all select 'spot_length:given', '', count(*) filter (spot_length <> ''), 0 from meta union all {TOP}""")
def metadata_summary(spark, d):
    return Y.metadata_summary(B.meta(spark, d), ["scientific_name", "spot_length"])


@query(cte("meta") + TOP)
def top_values(spark, d):
    return Y.top_values(B.meta(spark, d), ["scientific_name", "spot_length"])


@query(cte("titles") + ", " + NORMALIZED + " select kind as scientific_name, b.g as sample_group, b.s as group_status, count(*) as n_rows from n group by all")
def normalization_summary(spark, d):
    return Y.normalization_summary(_normalized(spark, d).withColumn("scientific_name", F.col("kind")))


SEL = f"""s as (select scientific_name, sum(n) as n_rows, sum(q) as n_qualified, sum(sa) as n_sampled, sum(x) as n_excluded, min(sa) as least_sampled from (select scientific_name, sample_group, count(*) as n, count(*) filter (is_qualified = 'yes') as q, count(*) filter (is_sampled = 'yes') as sa, count(*) filter (not {KEPT}) as x from meta group by all) group by 1),
t as (select scientific_name, cast(n_rows as bigint) as n_rows, cast(n_qualified as bigint) as n_qualified, cast(n_sampled as bigint) as n_sampled, cast(n_excluded as bigint) as n_excluded, least_sampled, case when least_sampled >= 30 then 'full' when least_sampled >= 3 then 'partial' else 'insufficient' end as tier from s),
qu as (select *, cast(row_number() over (order by case tier when 'full' then 1 when 'partial' then 2 else 3 end, n_sampled desc, n_qualified desc, n_rows desc, scientific_name) as int) as queue_order from t)"""


@query(cte("meta") + f", {SEL} select * from t")
def selection_summary(spark, d):
    return Y.selection_summary(B.meta(spark, d), 50)


@query(cte("meta") + f", {SEL} select * from qu")
def select_queue(spark, d):
    return Y.select_queue(Y.selection_summary(B.meta(spark, d), 50))


@query(cte("meta") + f", {SEL} select queue_order, scientific_name, tier, case tier when 'full' then 'process' when 'partial' then 'review' else 'skip' end as action, 'batch_'||lpad(cast(queue_order as varchar), 3, '0') as batch from qu")
def select_manifest(spark, d):
    return Y.select_manifest(Y.select_queue(Y.selection_summary(B.meta(spark, d), 50)), "batch")


@query(cte("runs") + " select scientific_name, count(*) filter (exclusion = 'no') as n_kept, count(*) filter (exclusion <> 'no') as n_excluded, coalesce(string_agg(run, ' ' order by run) filter (exclusion = 'no'), '') as kept_runs, coalesce(string_agg(run, ' ' order by run) filter (exclusion <> 'no'), '') as excluded_runs from runs group by 1")
def curation_summary(spark, d):
    return Y.curation_summary(B.runs(spark, d))


@query(cte("meta") + " select a.scientific_name, b.exclusion, count(m.pos) as n from (select distinct scientific_name from meta) a cross join (select distinct exclusion from meta) b left join meta m on m.scientific_name = a.scientific_name and m.exclusion = b.exclusion group by 1, 2")
def exclusion_counts(spark, d):
    return Y.zero_filled_counts(B.meta(spark, d), "scientific_name", "exclusion")


@query(cte("runs") + " select a.scientific_name, b.sample_group, count(m.pos) as n_runs, log2(count(m.pos) + 1) as log2_runs from (select distinct scientific_name from runs) a cross join (select distinct sample_group from runs) b left join runs m on m.scientific_name = a.scientific_name and m.sample_group = b.sample_group and m.exclusion = 'no' group by 1, 2")
def sample_number_matrix(spark, d):
    return Y.sample_number_matrix(B.runs(spark, d))


@query(cte("meta") + f" select scientific_name, lib_layout, count(*) as n_runs from meta where {KEPT} group by all")
def layout_counts(spark, d):
    return Y.layout_counts(B.meta(spark, d))


@query(cte("meta") + f""" select scientific_name, count(distinct biosample) filter (sample_group = '1-URGENT') as "1-URGENT", count(distinct biosample) filter (sample_group = '5-LOW') as "5-LOW",
 cast(max(cast(sample_group = '1-URGENT' as int)) + max(cast(sample_group = '5-LOW' as int)) as int) as n_groups from meta where {KEPT} group by 1""")
def species_pivot(spark, d):
    return Y.species_pivot(B.meta(spark, d), ["1-URGENT", "5-LOW"])


@query(cte("runs") + " select sample_group, cast(case when mapping_rate = 100 then 9 else floor(mapping_rate / 10) end as int) as bin, count(*) as n from runs where mapping_rate between 0 and 100 group by all")
def histograms(spark, d):
    return Y.histogram(B.runs(spark, d), F.col("mapping_rate"), 0.0, 10.0, 10, ["sample_group"])


# text functions

@query(cte("titles") + " select run, trim(regexp_replace(replace(raw, '_', ' '), '\\s+', ' ', 'g')) as x from titles")
def normalize_text(spark, d):
    return B.titles(spark, d).select("run", T.normalize_text(F.col("raw")).alias("x"))


@query(cte("titles") + " select run, case when lower(title) in ('nan', 'none') then '' else trim(regexp_replace(title, '\\s+', ' ', 'g')) end as x, len(string_split(trim(title), ' ')) >= 2 as two from titles")
def normalize_scientific_name(spark, d):
    return B.titles(spark, d).select("run", T.normalize_scientific_name(F.col("title")).alias("x"), T.is_two_word_name(F.col("title")).alias("two"))


@query(cte("titles") + " select run, case when brand like '%1%' then 'explicit' else regexp_replace(regexp_replace(regexp_replace(brand||' '||title, '[^0-9A-Za-z._-]', '_', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g') end as token from titles")
def species_token(spark, d):
    explicit = F.when(F.col("brand").contains("1"), " explicit ").otherwise("")
    return B.titles(spark, d).select("run", T.species_token(F.concat_ws(" ", "brand", "title"), explicit).alias("token"))


@query(cte("titles") + " select run, case when listed = '' then '' when title = kind then title else title||'|'||kind end as parts from titles")
def unique_text(spark, d):
    return B.titles(spark, d).select("run", F.array_join(T.split_unique(F.col("listed"), ";"), "|").alias("parts"))


@query(cte("meta") + " select pos, is_sampled = 'yes' as flag from meta")
def to_flag(spark, d):
    return B.meta(spark, d).select("pos", T.to_flag(F.col("is_sampled")).alias("flag"))


@query(cte("meta") + " select pos, try_cast(total_bases as double) as x, try_cast(biosample as double) as y from meta")
def to_number(spark, d):
    return B.meta(spark, d).select("pos", T.to_number(F.col("total_bases")).alias("x"), T.to_number(F.col("biosample")).alias("y"))


@query(cte("titles") + " select run, 'Genus_'||replace(title, ' ', '-') as species from titles")
def busco_species(spark, d):
    return B.titles(spark, d).select("run", T.marker_species(F.concat(F.lit("run_"), F.lit("Genus_"), F.regexp_replace("title", " ", "-"), F.lit(".tsv"))).alias("species"))


@query(cte("reads") + """ select core, core || case ordinal % 4 when 0 then '' when 1 then '.lane' || ordinal % 7 when 2 then '_L' || mate when 3 then '_1_x' end as stem, mate from reads where mate is not null
union all select core, case ordinal % 2 when 0 then core || '_3' else core || '_1.sra' end as stem, null as mate from reads""")
def fastq_stem_mate(spark, d):
    """Stems with marks of their own before the mate's, of both spellings of the ending, and names without a mate."""
    r, k = B.reads(spark, d), F.col("ordinal") % 4
    inside = F.when(k == 0, "").when(k == 1, F.concat(F.lit(".lane"), F.col("ordinal") % 7)).when(k == 2, F.concat(F.lit("_L"), "mate")).otherwise("_1_x")
    ending = F.when(k < 2, ".fastq.gz").otherwise(".FQ")
    both = r.where("mate is not null").select("core", F.concat("core", inside, F.lit("_"), "mate", ending).alias("name"))
    lone = r.select("core", F.concat("core", F.when(F.col("ordinal") % 2 == 0, "_3.fq.gz").otherwise("_1.sra")).alias("name"))
    return both.unionByName(lone).select("core", T.read_file_stem(F.col("name")).alias("stem"), T.read_file_mate(F.col("name")).alias("mate"))


def _headers(spark, d):
    header = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("@"), "core", F.lit("/"), F.coalesce("mate", F.lit(1)), F.lit(" extra"))).otherwise(F.concat(F.lit("@"), "core", F.lit(" "), F.coalesce("mate", F.lit(1)), F.lit(":N:0")))
    return B.reads(spark, d).select(F.col("core").alias("id"), header.alias("header"))


@query(cte("reads") + " select core as id, core from reads")
def read_core(spark, d):
    return _headers(spark, d).select("id", T.read_core(F.col("header")).alias("core"))


@query(cte("reads") + " select core as id, coalesce(mate, 1) as mate from reads")
def read_mate(spark, d):
    return _headers(spark, d).select("id", T.read_mate(F.col("header")).alias("mate"))


@query(cte("reads") + " select core as id, '@'||core||'/'||coalesce(mate, 1) as renamed from reads")
def rename_header(spark, d):
    h = F.col("header")
    return _headers(spark, d).select("id", T.mate_header(T.read_core(h), T.read_mate(h)).alias("renamed"))


@query("select p_partkey, cast(floor(p_retailprice + 0.5) as bigint) as x from part")
def round_half_up(spark, d):
    return B.table(spark, d, "part").select("p_partkey", T.round_half_up(F.col("p_retailprice")).alias("x"))


@query("select p_partkey, ln(v + 1) as a, log2(v + 1) as b, case when v = 0 then -1000000.0 else ln(v) end as c, case when v = 0 then -1000000.0 else log2(v) end as e from (select p_partkey, cast(p_size % 10 as double) as v from part)")
def log_transform(spark, d):
    p = B.table(spark, d, "part").select("p_partkey", (F.col("p_size") % 10).cast("double").alias("v"))
    low = lambda c: F.greatest(c, F.lit(-1000000.0))
    v = F.col("v")
    return p.select("p_partkey", T.log_transform(v, "lognp1").alias("a"), T.log_transform(v, "log2p1").alias("b"), low(T.log_transform(v, "logn")).alias("c"), low(T.log_transform(v, "log2")).alias("e"))


@query(cte("runs") + " select run, case when pos % 3 = 0 then 'last' when pos % 3 = 1 then 'middle' else 'first' end as stage from runs")
def stage_pipeline_order(spark, d):
    return B.runs(spark, d).select("run", T.last_enabled([("a", F.lit("first")), ("b", F.when(F.col("pos") % 3 == 1, "middle")), ("c", F.when(F.col("pos") % 3 == 0, "last"))]).alias("stage"))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then 'https://x/DRX/DRX'||substr(lpad(cast(o_orderkey as varchar), 6, '0'), 1, 3)||'/DRX'||lpad(cast(o_orderkey as varchar), 6, '0')||'/DRR'||lpad(cast(o_orderkey as varchar), 6, '0')||'/DRR'||lpad(cast(o_orderkey as varchar), 6, '0')||'.sra' end as url from orders")
def ddbj_link(spark, d):
    k = F.lpad(F.col("o_orderkey").cast("string"), 6, "0")
    run = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("DRR"), k)).otherwise("private")
    return B.table(spark, d, "orders").select("o_orderkey", T.archive_link(run, F.concat(F.lit("DRX"), k), "https://x").alias("url"))


@query("select l_orderkey, l_linenumber, l_partkey, case when l_tax <> 0 and l_discount <> 0 then greatest(0.5, least(2.0, l_tax / l_discount)) end as x from lineitem")
def safe_ratio_clip(spark, d):
    return B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", T.safe_ratio_clip(F.col("l_tax"), F.col("l_discount")).alias("x"))


@query(cte("titles") + " select distinct 'run' as run, lower(regexp_replace(title, '[^0-9A-Za-z]', '_', 'g')) as name, string_agg(distinct kind, ' | ' order by kind) as value, count(*) as n_values from titles group by 2")
def sample_attributes_to_columns(spark, d):
    return X.attributes_to_columns(B.titles(spark, d).select(F.lit("run").alias("run"), F.concat(F.initcap("title"), F.lit(" (unit)")).alias("tag"), F.col("kind").alias("value")))


@query("with t as (select trim(p_name) as scientific_name, min(p_partkey) as pos from part group by 1) select scientific_name, pos, replace(scientific_name, ' ', '_') as species_token from t")
def read_species_list(spark, d):
    return X.read_species_list(B.table(spark, d, "part").select(F.concat(F.lit(" "), "p_name").alias("scientific_name"), F.col("p_partkey").alias("pos")))


@query(cte("meta") + f" select run, exclusion, pos from meta where not {KEPT}")
def write_excluded(spark, d):
    return X.excluded_rows(B.meta(spark, d), ["run", "exclusion", "absent", "pos"])
