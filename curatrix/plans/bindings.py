"""How the given tables are read as metadata, expression tables, reads and quality inputs; in Spark and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Columns whose last digits depend on the order of a sum; they are rounded on both sides.
ROUNDED = {
    "sample_group_mean": "value", "sample_group_mean_balanced": "value", "tau": "tau", "fpkm": "value", "tpm": "value", "transform": "value", "counts_per_million": "value",
    "library_summary": "mean_count library_size scaled_mean", "impute_row_mean": "value", "strict_rows": "value", "upper_quartile_factor": "factor", "tmm_factor": "factor", "tmm_normalize": "factor",
    "tmm_apply": "value", "tmm_annotate": "tmm_factor", "cstmm": "factor", "mean_expression_before_after": "before_all after_all before_single after_single", "correlation_matrix": "r", "correlation_matrix_spearman": "r",
    "correlation_matrix_kendall": "r", "safe_pearson": "r", "correlation_statistics": "mean median variance", "group_pair_correlation_classes": "mean median variance", "loo_group_reference": "reference",
    "ws_correlation_metrics": "within max_other margin", "cs_correlation_metrics": "within max_other margin", "cross_species_group_means": "mean_value", "delta_pcc": "between_first between_last within_first within_last",
    "ws_round_statistics": "mean variance", "pca_distances": "distance", "sva_correct_given": "value", "ruv_residuals_given": "value", "robust_z": "z", "flag_margin_outliers": "z", "single_copy_mask": "percent", "busco_status_counts": "percent", "align_effective_length": "eff_length", "sample_number_matrix": "log2_runs", "log_transform": "a b c e",
    "safe_ratio_clip": "x", "run_statistics": "spot_length", "recover_run_statistics": "spot_length total_bases total_spots", "second_round_needed": "rate", "target_bp_per_run": "total_bases", "filtered_percent": "pct",
    "weighted_metric_update": "metric", "identical_mate_ratio": "ratio", "long_read_adapt": "p_mapped", "stage_totals": "total", "extraction_counts": "dumped rejected", "csfilter": "margin_uncorrected margin_corrected",
    "update_by_run": "mapping_rate", "coalesce_filter_columns": "margin", "delta_pcc_test": "t_between t_within p_between p_within", "finite_block": "r", "residualize": "value", "upper_quartile_normalize": "scale", "glm_residuals": "mu value", "glm_tests": "p dispersion", "covariate_r2": "r2", "f_test": "p", "anova_pvalue": "p",
}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""
    def add(f):
        floats = ROUNDED.get(f.__name__, "").split()

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(spark, sf_dir)
            return out.withColumns({c: F.round(c, 6) for c in floats}) if floats else out

        QUERIES[f.__name__] = run
        if sql:
            rounded = ", ".join(f"round({c}, 6) as {c}" for c in floats)
            ORACLES[f.__name__] = f"select * replace ({rounded}) from ({sql})" if floats else sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: SQL of the bindings, by name.
SQL = {
    "expr": """expr as (select 'v'||vec_id as run, 'g'||p as target_id, case when (vec_id + p) % 13 = 0 then null when vec_id % 100 = 7 then 1.0 else cast(embedding[p + 1] as double) end as value
 from (select *, unnest(range(0, len(embedding))) as p from embeddings))""",
    "expr_meta": """expr_meta as (select 'v'||vec_id as run, vec_id as pos, 'L'||label as sample_group, 's'||(vec_id % 4) as species, 'b'||(vec_id % 20) as bioproject, case when vec_id % 50 = 3 then 'manual' else 'no' end as exclusion from embeddings)""",
    "counts": """counts as (select p_brand as target_id, cast(l_suppkey as varchar) as run, sum(l_quantity) as value from lineitem join part on l_partkey = p_partkey group by all)""",
    "part_counts": """part_counts as (select cast(l_partkey as varchar) as target_id, cast(l_suppkey as varchar) as run, sum(l_quantity) as value from lineitem group by all)""",
    "runs": """runs as (select cast(s_suppkey as varchar) as run, s_suppkey as pos, r_name as scientific_name, r_name as species, 'G'||(s_suppkey % 3) as sample_group, n_name as bioproject,
 case when s_acctbal < 0 then 'low_balance' else 'no' end as exclusion, case when s_suppkey % 11 = 0 then null else floor(abs(s_acctbal)) % 100 end as mapping_rate, case when s_suppkey % 2 = 0 then 'paired' else 'single' end as lib_layout
 from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
    "lengths": """lengths as (select target_id, run, eff_length from (select p_brand as target_id, avg(cast(p_size as double)) as eff_length from part group by 1) cross join (select cast(s_suppkey as varchar) as run from supplier))""",
    "meta": """meta as (select case when o_orderkey % 997 = 0 then '' else 'run'||o_orderkey end as run, o_orderkey as pos, c_mktsegment as scientific_name, o_orderpriority as sample_group, 'project'||c_nationkey as bioproject, 'sample'||o_custkey as biosample,
 cast(cast(floor(o_totalprice) as bigint) as varchar) as total_spots, case when o_orderkey % 17 = 0 then '' else cast(cast(floor(o_totalprice * 100) as bigint) as varchar) end as total_bases, case when o_orderkey % 5 = 0 then '' else cast(100 + o_orderkey % 4 * 50 as varchar) end as spot_length,
 case o_orderstatus when 'F' then 'no' when 'P' then 'pending' else '' end as exclusion, case when o_orderkey % 3 = 0 then 'yes' else 'no' end as is_sampled, case when o_orderkey % 2 = 0 then 'yes' else 'no' end as is_qualified,
 case when o_orderkey % 2 = 0 then 'paired' else 'single' end as lib_layout from orders join customer on o_custkey = c_custkey)""",
    "titles": """titles as (select 'run'||p_partkey as run, p_partkey as pos, p_name as title, p_type as kind, p_brand as brand, '_'||p_name||'  '||p_type||' ' as raw, case when p_partkey % 7 = 0 then '' else p_name||'; '||p_type||';'||p_name end as listed, '' as exclusion, 'b'||(p_partkey % 40) as bioproject,
 cast(p_size as varchar) as size, p_name||' and '||p_type as mixed_text from part)""",
    "taxa": """nodes as (select 1 as taxid, 1 as parent_taxid, 'no rank' as rank union all select 10 + r_regionkey, 1, 'phylum' from region union all select 100 + n_nationkey, 10 + n_regionkey, 'genus' from nation union all select 1000 + c_custkey, 100 + c_nationkey, 'species' from customer),
 names as (select 10 + r_regionkey as taxid, r_name as name, 1 as is_scientific from region union all select 100 + n_nationkey, n_name, 1 from nation union all select 1000 + c_custkey, c_name, 1 from customer union all select 1000 + c_custkey, 'segment '||c_mktsegment, 0 from customer),
 merged as (select 9000000 + c_custkey as old_taxid, 1000 + c_custkey as new_taxid from customer where c_custkey % 50 = 0)""",
    "ortho": """ortho as (select cast(p_partkey // 2 as varchar) as busco_id, species, string_agg(cast(p_partkey as varchar), ',' order by p_partkey) as sequence from part cross join (select unnest(range(0, 5)) as species) where (p_partkey + species) % 3 <> 0 group by all)""",
    "gene_expr": """gene_expr as (select s_nationkey % 5 as species, cast(l_partkey as varchar) as target_id, cast(l_suppkey as varchar) as run, sum(l_quantity) as value from lineitem join supplier on l_suppkey = s_suppkey group by all)""",
    "stats": """stats as (select 'u'||user_id as run, event_type as stage, count(*) as n, sum(cast(value as decimal(18,2))) as bp, avg(value) as metric from events group by all)""",
    "reads": """reads as (select 'c'||(conv_id % 10) as run, cast(conv_id as varchar) as core, case role when 'user' then 1 when 'assistant' then 2 else null end as mate, conv_id * 1000 + turn // 2 as ordinal, coalesce(text, '') as seq from conversations)""",
    "abundance": """abundance as (select cast(l_suppkey as varchar) as run, l_orderkey||'-'||l_linenumber as target_id, l_quantity as length, l_tax as eff_length, l_extendedprice as est_counts, l_discount as tpm from lineitem)""",
}


def cte(*names: str) -> str:
    return "with " + ",\n".join(SQL[n] for n in names) + "\n"


def expr(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "x"))
    v = F.when((F.col("vec_id") + F.col("p")) % 13 == 0, None).when(F.col("vec_id") % 100 == 7, 1.0).otherwise(F.col("x").cast("double"))
    return e.select(F.concat(F.lit("v"), "vec_id").alias("run"), F.concat(F.lit("g"), "p").alias("target_id"), v.alias("value"))


def expr_meta(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("vec_id")
    return table(spark, d, "embeddings").select(
        F.concat(F.lit("v"), i).alias("run"), i.alias("pos"), F.concat(F.lit("L"), "label").alias("sample_group"), F.concat(F.lit("s"), i % 4).alias("species"),
        F.concat(F.lit("b"), i % 20).alias("bioproject"), F.when(i % 50 == 3, "manual").otherwise("no").alias("exclusion"),
    )


def counts(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy(F.col("p_brand").alias("target_id"), F.col("l_suppkey").cast("string").alias("run")).agg(F.sum("l_quantity").alias("value"))


def part_counts(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    """With ``tasks``, lines are dealt over as many by target before they are grouped."""
    lines = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("target_id"), F.col("l_suppkey").cast("string").alias("run"), "l_quantity")
    return (lines.repartition(tasks, "target_id") if tasks else lines).groupBy("target_id", "run").agg(F.sum("l_quantity").alias("value"))


def part_runs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("run")).distinct()


def runs(spark: SparkSession, d: str) -> DataFrame:
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    j = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("s_suppkey")
    return j.select(
        k.cast("string").alias("run"), k.alias("pos"), F.col("r_name").alias("scientific_name"), F.col("r_name").alias("species"), F.concat(F.lit("G"), k % 3).alias("sample_group"), F.col("n_name").alias("bioproject"),
        F.when(F.col("s_acctbal") < 0, "low_balance").otherwise("no").alias("exclusion"), F.when(k % 11 == 0, None).otherwise(F.floor(F.abs("s_acctbal")).cast("double") % 100).alias("mapping_rate"),
        F.when(k % 2 == 0, "paired").otherwise("single").alias("lib_layout"),
    )


def lengths(spark: SparkSession, d: str) -> DataFrame:
    per = table(spark, d, "part").groupBy(F.col("p_brand").alias("target_id")).agg(F.avg(F.col("p_size").cast("double")).alias("eff_length"))
    # a length for each cell of the matrix
    return per.crossJoin(table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("run"))).select("target_id", "run", "eff_length")


def meta(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("o_orderkey")
    return j.select(
        F.when(k % 997 == 0, "").otherwise(F.concat(F.lit("run"), k)).alias("run"), k.alias("pos"), F.col("c_mktsegment").alias("scientific_name"), F.col("o_orderpriority").alias("sample_group"),
        F.concat(F.lit("project"), "c_nationkey").alias("bioproject"), F.concat(F.lit("sample"), "o_custkey").alias("biosample"), F.floor("o_totalprice").cast("long").cast("string").alias("total_spots"),
        F.when(k % 17 == 0, "").otherwise(F.floor(F.col("o_totalprice") * 100).cast("long").cast("string")).alias("total_bases"),
        F.when(k % 5 == 0, "").otherwise((100 + k % 4 * 50).cast("string")).alias("spot_length"),
        F.when(F.col("o_orderstatus") == "F", "no").when(F.col("o_orderstatus") == "P", "pending").otherwise("").alias("exclusion"),
        F.when(k % 3 == 0, "yes").otherwise("no").alias("is_sampled"), F.when(k % 2 == 0, "yes").otherwise("no").alias("is_qualified"), F.when(k % 2 == 0, "paired").otherwise("single").alias("lib_layout"),
    )


def titles(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.concat(F.lit("run"), k).alias("run"), k.alias("pos"), F.col("p_name").alias("title"), F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"),
        F.concat(F.lit("_"), "p_name", F.lit("  "), "p_type", F.lit(" ")).alias("raw"), F.when(k % 7 == 0, "").otherwise(F.concat("p_name", F.lit("; "), "p_type", F.lit(";"), "p_name")).alias("listed"),
        F.lit("").alias("exclusion"), F.concat(F.lit("b"), k % 40).alias("bioproject"), F.col("p_size").cast("string").alias("size"), F.concat("p_name", F.lit(" and "), "p_type").alias("mixed_text"),
    )


def taxa(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    r, n, c = (table(spark, d, t) for t in ("region", "nation", "customer"))
    nodes = spark.range(1, 2).selectExpr("1L taxid", "1L parent_taxid", "'no rank' rank")
    nodes = nodes.unionAll(r.selectExpr("10L + r_regionkey", "1L", "'phylum'")).unionAll(n.selectExpr("100L + n_nationkey", "10L + n_regionkey", "'genus'")).unionAll(c.selectExpr("1000L + c_custkey", "100L + c_nationkey", "'species'"))
    names = r.selectExpr("10L + r_regionkey taxid", "r_name name", "1 is_scientific").unionAll(n.selectExpr("100L + n_nationkey", "n_name", "1"))
    names = names.unionAll(c.selectExpr("1000L + c_custkey", "c_name", "1")).unionAll(c.selectExpr("1000L + c_custkey", "concat('segment ', c_mktsegment)", "0"))
    merged = c.where("c_custkey % 50 = 0").selectExpr("9000000L + c_custkey old_taxid", "1000L + c_custkey new_taxid")
    return nodes, names, merged


def ortho(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("species")).where("(p_partkey + species) % 3 <> 0")
    group = F.floor(F.col("p_partkey") / 2).cast("string")
    return p.groupBy(group.alias("busco_id"), "species").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p_partkey")), lambda x: x.cast("string")), ",").alias("sequence"))


#: Lines of a task that groups them by part and supplier: its memory does not grow with the table.
LINES_A_TASK = 500_000


def line_tasks(spark: SparkSession, d: str) -> int:
    """Tasks for groups of lines; the files know their number of rows."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, d, "lineitem").count() // LINES_A_TASK))


def gene_expr(spark: SparkSession, d: str, by_target: int | None = None) -> DataFrame:
    """Lines are dealt before they are grouped, as nearly every one is a group of its own; with ``by_target`` over as many tasks at
    least, by target, so that what groups cells by target needs no other shuffle."""
    s = F.broadcast(table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).alias("species")))  # two numbers per supplier
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    if by_target:
        lines = lines.select("l_suppkey", F.col("l_partkey").cast("string").alias("target_id"), "l_quantity").repartition(max(by_target, line_tasks(spark, d)), "target_id")
        sums = lines.join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("species", "target_id", "l_suppkey").agg(F.sum("l_quantity").alias("value"))
        return sums.select("species", "target_id", F.col("l_suppkey").cast("string").alias("run"), "value")
    sums = lines.repartition(line_tasks(spark, d), "l_suppkey", "l_partkey").join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("species", "l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("value"))
    return sums.select("species", F.col("l_partkey").cast("string").alias("target_id"), F.col("l_suppkey").cast("string").alias("run"), "value")


def gene_runs(spark: SparkSession, d: str) -> DataFrame:
    """``species, run`` of ``gene_expr``."""
    s = F.broadcast(table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") % 5).alias("species")))  # two numbers per supplier
    met = table(spark, d, "lineitem").select("l_suppkey").distinct().join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return met.select("species", F.col("l_suppkey").cast("string").alias("run")).distinct()


def stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.concat(F.lit("u"), "user_id").alias("run"), F.col("event_type").alias("stage")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("bp"), F.avg("value").alias("metric"))


def reads(spark: SparkSession, d: str) -> DataFrame:
    mate = F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2)
    return table(spark, d, "conversations").select(F.concat(F.lit("c"), F.col("conv_id") % 10).alias("run"), F.col("conv_id").cast("string").alias("core"), mate.alias("mate"), (F.col("conv_id") * 1000 + F.floor(F.col("turn") / 2)).alias("ordinal"), F.coalesce("text", F.lit("")).alias("seq"))


def abundance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("run"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("target_id"), F.col("l_quantity").alias("length"), F.col("l_tax").alias("eff_length"), F.col("l_extendedprice").alias("est_counts"), F.col("l_discount").alias("tpm"))
