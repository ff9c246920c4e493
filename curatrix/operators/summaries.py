"""Summaries of metadata and of selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.session import checkpointed


def metadata_summary(meta: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """``(item, value, n, rank)``: counts of the table, non-empty counts of columns, and their most frequent values."""
    facts = {"rows": F.count(F.lit(1)), "runs": F.count_if(~T.is_blank(F.col("run"))), "distinct_runs": F.count_distinct(F.when(~T.is_blank(F.col("run")), F.col("run")))}
    facts |= {f"{c}:given": F.count_if(~T.is_blank(F.col(c))) for c in columns}
    wide = meta.agg(*[v.alias(k) for k, v in facts.items()])
    long = wide.unpivot([], list(facts), "item", "n").select("item", F.lit("").alias("value"), "n", F.lit(0).alias("rank"))
    return long.unionByName(top_values(meta, columns, top))


def top_values(meta: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """The most frequent non-blank values of each column, ties by value."""
    pairs = meta.select(F.explode(F.array(*[F.struct(F.lit(c).alias("item"), T.trimmed(F.col(c)).alias("value")) for c in columns])).alias("x")).select("x.*").where("value <> ''")
    counted = pairs.groupBy("item", "value").agg(F.count(F.lit(1)).alias("n"))
    # first within slices of the values, so that a column with many values is not ranked in one task
    some = F.row_number().over(Window.partitionBy("item", "slice").orderBy(F.desc("n"), "value"))
    few = counted.withColumn("slice", F.pmod(F.xxhash64("value"), F.lit(64))).withColumn("_r", some).where(F.col("_r") <= top)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n"), "value"))
    return few.select("item", "value", "n", rank.alias("rank")).where(F.col("rank") <= top)


def normalization_summary(meta: DataFrame) -> DataFrame:
    return meta.groupBy("scientific_name", "sample_group", "group_status").agg(F.count(F.lit(1)).alias("n_rows"))


# How many samples make a full, and a minimal, selection.
FULL_TIER, LEAST_TIER = 30, 3


def selection_summary(meta: DataFrame, max_sample: int) -> DataFrame:
    """Per species: rows, qualified and sampled rows, excluded rows, the least sampled group, and the tier."""
    kept = T.is_kept(F.col("exclusion"))
    by_group = meta.groupBy("scientific_name", "sample_group").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_qualified") == "yes").alias("q"), F.count_if(F.col("is_sampled") == "yes").alias("s"), F.count_if(~kept).alias("x"),
    )
    out = by_group.groupBy("scientific_name").agg(F.sum("n").alias("n_rows"), F.sum("q").alias("n_qualified"), F.sum("s").alias("n_sampled"), F.sum("x").alias("n_excluded"), F.min("s").alias("least_sampled"))
    full, least = min(max_sample, FULL_TIER), min(max_sample, LEAST_TIER)
    tier = F.when(F.col("least_sampled") >= full, "full").when(F.col("least_sampled") >= least, "partial").otherwise("insufficient")
    return out.withColumn("tier", tier)


def select_queue(summary: DataFrame) -> DataFrame:
    """Species in the order in which they are worked on."""
    tier = F.when(F.col("tier") == "full", 1).when(F.col("tier") == "partial", 2).otherwise(3)
    order = Window.partitionBy(F.lit(0)).orderBy(tier, F.desc("n_sampled"), F.desc("n_qualified"), F.desc("n_rows"), "scientific_name")  # a row per species
    return summary.withColumn("queue_order", F.row_number().over(order))


def select_manifest(queue: DataFrame, label: str) -> DataFrame:
    action = F.when(F.col("tier") == "full", "process").when(F.col("tier") == "partial", "review").otherwise("skip")
    return queue.select("queue_order", "scientific_name", "tier", action.alias("action"), F.concat(F.lit(f"{label}_"), F.lpad(F.col("queue_order").cast("string"), 3, "0")).alias("batch"))


def curation_summary(meta: DataFrame) -> DataFrame:
    kept = T.is_kept(F.col("exclusion"))
    runs = lambda c: F.array_join(F.sort_array(F.collect_list(F.when(c, F.col("run")))), " ")
    return meta.groupBy("scientific_name").agg(F.count_if(kept).alias("n_kept"), F.count_if(~kept).alias("n_excluded"), runs(kept).alias("kept_runs"), runs(~kept).alias("excluded_runs"))


def every_pair(meta: DataFrame, rows: str, columns: str) -> DataFrame:
    """All pairs of the distinct values of two columns. Both lists are written first, so the planner knows their sizes and
    sends one to every task only if it is small."""
    return checkpointed(meta.select(rows).distinct(), "values").crossJoin(checkpointed(meta.select(columns).distinct(), "values"))


def zero_filled_counts(meta: DataFrame, rows: str, columns: str) -> DataFrame:
    """``(rows, columns, n)`` for every pair of values, 0 where there is none."""
    counted = meta.groupBy(rows, columns).agg(F.count(F.lit(1)).alias("n"))
    return every_pair(meta, rows, columns).join(counted, [rows, columns], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def sample_number_matrix(meta: DataFrame) -> DataFrame:
    flags = meta.withColumn("_k", T.is_kept(F.col("exclusion")))
    counted = flags.groupBy("scientific_name", "sample_group").agg(F.count_if("_k").alias("n"))
    return every_pair(meta, "scientific_name", "sample_group").join(counted, ["scientific_name", "sample_group"], "left").select("scientific_name", "sample_group", F.coalesce("n", F.lit(0)).alias("n_runs"), F.log2(F.coalesce("n", F.lit(0)) + 1).alias("log2_runs"))


def layout_counts(meta: DataFrame) -> DataFrame:
    return meta.where(T.is_kept(F.col("exclusion"))).groupBy("scientific_name", "lib_layout").agg(F.count(F.lit(1)).alias("n_runs"))


def species_pivot(meta: DataFrame, groups: list[str]) -> DataFrame:
    """Distinct biosamples per species and group, a column per group, widest-covered species first."""
    wide = meta.where(T.is_kept(F.col("exclusion"))).groupBy("scientific_name").pivot("sample_group", groups).agg(F.count_distinct("biosample"))
    filled = [F.coalesce(F.col(f"`{g}`"), F.lit(0)).alias(g) for g in groups]
    covered = sum((F.col(f"`{g}`").isNotNull()).cast("int") for g in groups)
    return wide.select("scientific_name", *filled, covered.alias("n_groups"))


def histogram(df: DataFrame, value: Column, low: float, width: float, bins: int, keys: list[str]) -> DataFrame:
    """``(keys, bin, n)`` over equal bins from ``low``; the last bin is closed."""
    at = F.floor((value - low) / width)
    at = F.when(value == low + width * bins, bins - 1).otherwise(at).cast("int")
    return df.withColumn("bin", at).where(F.col("bin").between(0, bins - 1)).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
