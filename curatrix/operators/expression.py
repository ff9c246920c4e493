"""Expression tables in long form: ``(species_token, target_id, run, value)``; runs and species are keys, never loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.operators.metadata import raise_if


def densify(expr: DataFrame, fill: float | None = 0.0, keys: list[str] | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Every (target, run) cell within ``keys``; absent ones get ``fill``.

    ``runs`` are the runs of ``expr`` where they can be had without making it; a table that is dealt by target is not shuffled again.
    """
    keys = keys or []
    rest = [c for c in expr.columns if c not in (*keys, "target_id", "run")]
    rows = expr.groupBy(*keys, "target_id").agg(F.collect_list(F.struct("run", *rest)).alias("cells"))
    # a matrix has a cell for each pair by definition, so cells without a value are made last, and are not shuffled
    lists = F.broadcast((expr if runs is None else runs).select(*keys, "run").distinct().groupBy(*keys).agg(F.collect_list("run").alias("runs")))  # a name per run
    met = rows.join(lists, keys) if keys else rows.crossJoin(lists)
    kind = rows.schema["cells"].dataType
    lacks = F.transform(F.array_except("runs", F.transform("cells", lambda x: x["run"])), lambda r: F.struct(r.alias("run"), *[F.lit(None).cast(expr.schema[c].dataType).alias(c) for c in rest]))
    out = met.select(*keys, "target_id", F.explode(F.concat("cells", lacks.cast(kind))).alias("c")).select(*keys, "target_id", "c.*")
    return out.withColumn("value", F.coalesce("value", F.lit(fill).cast("double")))


def merge_abundance(abundance: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of a species stacked to long form; runs whose target lists differ raise."""
    per_run = abundance.groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("target_id").alias("d"), F.sum(F.xxhash64("target_id").cast("decimal(38,0)")).alias("h"))
    odd = per_run.groupBy(*keys).agg(F.count_distinct("d", "h").alias("kinds"), F.max(F.col("n") - F.col("d")).alias("twice"))
    checked = raise_if(odd, (F.col("kinds") > 1) | (F.col("twice") > 0), "runs of a species have different targets").select(*keys)
    return abundance.join(F.broadcast(checked), keys, "left_semi")


def target_consistency(abundance: DataFrame, keys: list[str], tasks: int | None = None) -> DataFrame:
    """Per species: runs, targets over all runs, and whether every run has them all once.

    With ``tasks``, rows are dealt over as many by run, and by target, before distinct ones are kept, so that a task's memory is set by that number.
    """
    by_run = abundance.select(*keys, "run", "target_id")
    by_target = abundance.select(*keys, "target_id")
    if tasks:
        by_run, by_target = by_run.repartition(tasks, *keys, "run"), by_target.repartition(tasks, *keys, "target_id")
    per_run = by_run.groupBy(*keys, "run").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("target_id").alias("d"))
    a = per_run.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_runs"), F.min("d").alias("least"), F.max(F.col("n") - F.col("d")).alias("twice"))
    b = by_target.distinct().groupBy(*keys).agg(F.count("target_id").alias("n_targets"))
    return a.join(b, keys).select(*keys, "n_runs", "n_targets", ((F.col("least") == F.col("n_targets")) & (F.col("twice") == 0)).alias("consistent"))


def with_kept_groups(expr: DataFrame, meta: DataFrame) -> DataFrame:
    return expr.select("target_id", "run", "value").join(meta.where(T.is_kept(F.col("exclusion"))).select("run", "sample_group", "bioproject"), "run")


def sample_group_mean(expr: DataFrame, meta: DataFrame, by_project: bool = False) -> DataFrame:
    """Mean per (target, group) over kept runs, missing values skipped; by project first if asked.

    A group all of whose runs are excluded is absent.
    """
    rows = with_kept_groups(expr, meta).withColumn("value", T.finite(F.col("value")))
    if by_project:
        rows = rows.groupBy("target_id", "sample_group", "bioproject").agg(F.avg("value").alias("value"))
    return rows.groupBy("target_id", "sample_group").agg(F.avg("value").alias("value"))


def tau(means: DataFrame, log_method: str = "none") -> DataFrame:
    """Specificity: the sum of 1 - x / max over groups, over groups - 1, of back-transformed non-negative means.

    Missing with a single group or without any positive mean; all groups count.
    """
    x = F.greatest(T.inverse_log(F.col("value"), log_method), F.lit(0.0))
    n = means.agg(F.count_distinct("sample_group").alias("n_groups"))  # one row
    tops = means.withColumn("x", x).withColumn("top", F.max("x").over(Window.partitionBy("target_id")))
    terms = tops.groupBy("target_id").agg(F.sum(1 - F.try_divide("x", F.col("top"))).alias("s"))
    return terms.crossJoin(F.broadcast(n)).select("target_id", F.when(F.col("n_groups") > 1, F.col("s") / (F.col("n_groups") - 1)).alias("tau"))


def tau_ranking(means: DataFrame, log_method: str = "none") -> DataFrame:
    """The highest group and all groups above zero, highest first, ties by name."""
    x = F.greatest(T.inverse_log(F.col("value"), log_method), F.lit(0.0))
    sorted_ = F.sort_array(F.collect_list(F.when(F.col("x") > 0, F.struct((-F.col("x")).alias("x"), "sample_group"))))
    ranked = means.withColumn("x", x).groupBy("target_id").agg(F.array_join(F.transform(sorted_, lambda s: s["sample_group"]), "|").alias("ranking"))
    return ranked.withColumn("highest", F.substring_index("ranking", "|", 1))


def split_nonexpressed(expr: DataFrame) -> DataFrame:
    """``(target_id, expressed)``: whether the counts sum to more than zero."""
    return expr.groupBy("target_id").agg((F.coalesce(F.sum("value"), F.lit(0.0)) > 0).alias("expressed"))


def maintain_zero(corrected: DataFrame, raw: DataFrame, clip: bool = False) -> DataFrame:
    """Cells that were zero before a correction are zero after it; negatives are clipped if asked."""
    joined = corrected.join(raw.select("target_id", "run", F.col("value").alias("_raw")), ["target_id", "run"], "left")
    v = F.greatest(F.col("value"), F.lit(0.0)) if clip else F.col("value")
    return joined.withColumn("value", F.when(F.col("_raw") == 0, 0.0).otherwise(v)).drop("_raw")


def intersect_runs(expr: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    return expr.join(meta.select("run").distinct(), "run", "left_semi"), meta.join(expr.select("run").distinct(), "run", "left_semi")


def align_metadata(expr: DataFrame, meta: DataFrame) -> DataFrame:
    """One metadata row per run of the matrix; none or several raise."""
    runs = expr.select("run").distinct()
    n = meta.groupBy("run").agg(F.count(F.lit(1)).alias("_n"))
    checked = raise_if(runs.join(n, "run", "left"), F.coalesce("_n", F.lit(0)) != 1, "a run needs one metadata row")
    return checked.select("run").join(meta, "run")


def align_effective_length(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """Counts with their effective length. Cells without a count 0 need a positive length; else it is 1."""
    joined = counts.select("target_id", "run", "value").join(lengths.select("target_id", "run", "eff_length"), ["target_id", "run"], "left")
    length = T.finite(F.col("eff_length"))
    joined = raise_if(joined, (F.col("eff_length") < 0) | (F.abs("eff_length") == float("inf")), "effective length below zero or infinite")
    joined = raise_if(joined, (F.coalesce(length, F.lit(0.0)) == 0) & (F.col("value") != 0), "count without effective length")
    return joined.withColumn("eff_length", F.when((F.col("value") == 0) & (F.coalesce(length, F.lit(0.0)) == 0), 1.0).otherwise(length))


def length_model_guard(runs: DataFrame, models: DataFrame, method: str) -> DataFrame:
    """Runs with their length model; a length-based method on a run without lengths raises."""
    joined = runs.join(models.select("run", "length_model"), "run", "left")
    joined = raise_if(joined, F.col("length_model").isNull(), "run without quant model")
    return raise_if(joined, F.lit("fpkm" in method or "tpm" in method) & (F.col("length_model") == "none"), "method needs lengths")


def fpkm(aligned: DataFrame, library: DataFrame | None = None) -> DataFrame:
    """count / length / library * 1e9, where the library is the run's sum unless sizes are given; non-finite is 0."""
    if library is None:
        rows = aligned.withColumn("_lib", F.sum("value").over(Window.partitionBy("run")))
    else:
        rows = aligned.join(library.select("run", F.col("library_size").alias("_lib")), "run")
    v = F.try_divide(F.try_divide("value", F.col("eff_length")), F.col("_lib")) * 1e9
    return rows.withColumn("value", F.coalesce(T.finite(v), F.lit(0.0))).drop("_lib")


def tpm(aligned: DataFrame) -> DataFrame:
    rate = F.try_divide("value", F.col("eff_length"))
    rows = aligned.withColumn("_rate", rate).withColumn("_sum", F.sum("_rate").over(Window.partitionBy("run")))
    return rows.withColumn("value", F.coalesce(T.finite(F.try_divide(F.col("_rate") * 1e6, F.col("_sum"))), F.lit(0.0))).drop("_rate", "_sum")


def transform(aligned: DataFrame, method: str, library: DataFrame | None = None) -> DataFrame:
    """``log-abundance`` methods such as ``log2p1-fpkm``: abundance ``fpkm``, ``tpm`` or ``none``, then the log."""
    log, abundance = method.split("-")
    rows = fpkm(aligned, library) if abundance == "fpkm" else tpm(aligned) if abundance == "tpm" else aligned
    return rows.withColumn("value", T.log_transform(F.col("value"), log))


def counts_per_million(expr: DataFrame) -> DataFrame:
    v = F.when(F.col("value") >= 0, T.finite(F.col("value")))
    rows = expr.withColumn("_sum", F.coalesce(F.sum(v).over(Window.partitionBy("run")), F.lit(0.0)))
    return rows.withColumn("value", F.when(F.col("_sum") > 0, v * 1e6 / F.col("_sum")).otherwise(0.0)).drop("_sum")


def library_summary(expr: DataFrame) -> DataFrame:
    """Per run the mean count, the library size, and the mean scaled to the median library."""
    runs = expr.groupBy("run").agg(F.avg("value").alias("mean_count"), F.sum("value").alias("library_size"))
    mid = runs.agg(F.median("library_size").alias("mid"))
    factor = T.finite(F.try_divide("library_size", F.col("mid")))
    return runs.crossJoin(F.broadcast(mid)).withColumn("factor", F.when(factor > 0, factor).otherwise(1.0)).select("run", "mean_count", "library_size", (F.col("mean_count") / F.col("factor")).alias("scaled_mean"))


def impute_row_mean(expr: DataFrame, position: Column | None = None) -> DataFrame:
    """Missing cells get the mean of their target's finite cells, or 0."""
    v = T.finite(F.col("value"))
    return expr.withColumn("value", F.coalesce(v, F.avg(v).over(Window.partitionBy("target_id")), F.lit(0.0)))


def strict_rows(expr: DataFrame) -> DataFrame:
    """Only targets without a missing cell."""
    n = expr.agg(F.count_distinct("run").alias("n"))
    full = expr.groupBy("target_id").agg(F.count(T.finite(F.col("value"))).alias("have")).crossJoin(F.broadcast(n)).where("have = n").select("target_id")
    return expr.join(full, "target_id", "left_semi")


def mean_before_after(before: DataFrame, after: DataFrame, single_copy: DataFrame) -> DataFrame:
    """Mean count per run before and after a normalisation, for all targets and for single-copy ones."""
    both = before.select("target_id", "run", F.col("value").alias("b")).join(after.select("target_id", "run", F.col("value").alias("a")), ["target_id", "run"])
    marked = both.join(single_copy.select("target_id", F.lit(True).alias("s")), "target_id", "left")
    return marked.groupBy("run").agg(F.avg("b").alias("before_all"), F.avg("a").alias("after_all"), F.avg(F.when(F.col("s"), F.col("b"))).alias("before_single"), F.avg(F.when(F.col("s"), F.col("a"))).alias("after_single"))
