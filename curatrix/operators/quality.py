"""Inventories and quality reports as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T

# The numeric fields of an abundance table, in the order in which they are checked.
ABUNDANCE_FIELDS = ("length", "eff_length", "est_counts", "tpm")


def check_table_contract(rows: DataFrame, keys: list[str], required: tuple[str, ...] = ("target_id", *ABUNDANCE_FIELDS)) -> DataFrame:
    """Violation counts per table and the first failing rule: columns, rows, blank or repeated ids, numbers."""
    missing = [c for c in required if c not in rows.columns]
    if missing:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("problem", F.lit(f"missing columns: {', '.join(missing)}"))
    bad = {c: ~F.coalesce((T.to_number(F.col(c)) >= 0), F.lit(False)) for c in ABUNDANCE_FIELDS}
    per_id = rows.groupBy(*keys, T.trimmed(F.col("target_id")).alias("_id")).agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(v).alias(f"bad_{c}") for c, v in bad.items()])
    out = per_id.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), F.sum(F.when(F.col("_id") == "", F.col("_n")).otherwise(0)).alias("n_blank"),
        F.sum(F.when(F.col("_id") != "", F.col("_n") - 1).otherwise(0)).alias("n_repeated"), *[F.sum(f"bad_{c}").alias(f"bad_{c}") for c in ABUNDANCE_FIELDS],
    )
    problem = F.when(F.col("n_blank") > 0, "blank target_id").when(F.col("n_repeated") > 0, "repeated target_id")
    for c in ABUNDANCE_FIELDS:
        problem = problem.when(F.col(f"bad_{c}") > 0, f"invalid {c}")
    return out.withColumn("problem", problem.otherwise(""))


def fastq_inventory(files: DataFrame) -> DataFrame:
    """``(folder, name, size)`` to runs: mates make paired, one file single, a lone second mate is an error."""
    rows = files.withColumns({"run": T.read_file_stem(F.col("name")), "mate": T.read_file_mate(F.col("name"))})
    out = rows.groupBy("folder", "run").agg(F.count_if(F.col("mate") == 1).alias("n1"), F.count_if(F.col("mate") == 2).alias("n2"), F.count_if(F.col("mate").isNull()).alias("n0"), F.sum("size").alias("size"))
    layout = F.when((F.col("n1") == 1) & (F.col("n2") == 1) & (F.col("n0") <= 1), "paired").when((F.col("n1") + F.col("n0") == 1) & (F.col("n2") == 0), "single").otherwise("error")
    return out.select("folder", "run", layout.alias("layout"), "size")


def fastq_run_stats(reads: DataFrame) -> DataFrame:
    """Per run: spots, bases, half-up mean length of a spot."""
    per_mate = reads.groupBy("run", "mate").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(T.text(F.col("seq")))).alias("b"))
    return per_mate.groupBy("run").agg(F.max("n").alias("total_spots"), F.sum("b").alias("total_bases"), F.sum(T.round_half_up(F.col("b") / F.col("n"))).alias("spot_length"))


def read_problems(reads: DataFrame) -> DataFrame:
    """Records whose parts do not fit, per run."""
    bad = F.when(~F.col("header").startswith("@"), "header").when(~F.col("plus").startswith("+"), "separator").when(F.length("seq") != F.length("qual"), "length")
    return reads.groupBy("run").agg(F.count(F.lit(1)).alias("n_records"), *[F.count_if(F.coalesce(bad == k, F.lit(False))).alias(f"bad_{k}") for k in ("header", "separator", "length")])


def has_rows(table: DataFrame, keys: DataFrame) -> DataFrame:
    """For each key, whether the table has a row of it."""
    names = keys.columns
    return keys.join(table.select(*names, F.lit(True).alias("ok")).distinct(), names, "left").withColumn("ok", F.coalesce("ok", F.lit(False)))


def quality_issues(expected: DataFrame, observed: DataFrame, newer_than: str) -> DataFrame:
    """Expected against observed outputs ``(check, target)``: missing, orphan or older than the metadata."""
    e, o = expected.withColumn("_e", F.lit(True)), observed.withColumn("_o", F.lit(True))
    rows = e.join(o, ["check", "target"], "full")
    issue = F.when(F.col("_o").isNull(), "missing_output").when(F.col("_e").isNull(), "orphan_output").when(F.col("modified") < F.lit(newer_than).cast("timestamp"), "stale_output")
    severity = F.when(F.col("_o").isNull(), "error").otherwise("warning")
    return rows.select("check", "target", issue.alias("issue"), severity.alias("severity")).where("issue is not null")


#: Examples of a summary, and slices in which a check's targets are ranked first.
EXAMPLES, EXAMPLE_SLICES = 5, 256


def quality_summary(expected: DataFrame, issues: DataFrame) -> DataFrame:
    """Per check: targets, available, unavailable, warnings, status and the first examples; a global error takes all."""
    n = expected.groupBy("check").agg(F.count_distinct("target").alias("n_checked"))
    err = F.col("severity") == "error"
    targets = issues.where(err & (F.col("target") != "")).select("check", "target").distinct()
    # five of each slice of a check, then five of these, so that no check is gathered
    for by in (("check", F.pmod(F.xxhash64("target"), F.lit(EXAMPLE_SLICES))), ("check",)):
        targets_of = targets if by != ("check",) else first
        first = targets_of.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("target"))).where(F.col("_r") <= EXAMPLES).drop("_r")
    examples = first.groupBy("check").agg(F.array_join(F.sort_array(F.collect_list("target")), ",").alias("examples"))
    i = issues.groupBy("check").agg(F.max(err & (F.col("target") == "")).alias("_all"), F.count_if(~err).alias("n_warnings")).join(targets.groupBy("check").agg(F.count(F.lit(1)).alias("bad")), "check", "left").join(examples, "check", "left")
    rows = n.join(i, "check", "left")
    bad = F.when(F.coalesce("_all", F.lit(False)), F.col("n_checked")).otherwise(F.coalesce("bad", F.lit(0)))
    out = rows.select("check", "n_checked", (F.col("n_checked") - bad).alias("n_available"), bad.alias("n_unavailable"), F.coalesce("n_warnings", F.lit(0)).alias("n_warnings"), F.coalesce("examples", F.lit("")).alias("examples"))
    return out.withColumn("status", F.when(F.col("n_unavailable") > 0, "error").when(F.col("n_warnings") > 0, "warning").otherwise("ok"))


def quality_comparison(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two summaries side by side, with the change in unavailable targets."""
    b = before.select("check", F.col("status").alias("status_before"), F.col("n_unavailable").alias("b"))
    a = after.select("check", F.col("status").alias("status_after"), F.col("n_unavailable").alias("a"))
    return b.join(a, "check", "full").select("check", F.coalesce("status_before", F.lit("absent")).alias("status_before"), F.coalesce("status_after", F.lit("absent")).alias("status_after"), (F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("delta_unavailable"))


def rerun_targets(issues: DataFrame, everything: DataFrame, warnings: bool = False) -> DataFrame:
    """Failing targets per check; a global issue of a check takes everything of it."""
    wanted = issues if warnings else issues.where("severity = 'error'")
    own = wanted.where("target <> ''").select("check", "target")
    all_ = everything.join(wanted.where("target = ''").select("check").distinct(), "check", "left_semi").select("check", "target")
    return own.union(all_).distinct()


def restrict_targets(targets: DataFrame, meta: DataFrame, column: str) -> DataFrame:
    """Only targets that the metadata has."""
    return targets.join(meta.select(F.col(column).alias("target")).distinct(), "target", "left_semi")


def output_availability(expected: DataFrame, observed: DataFrame) -> DataFrame:
    return has_rows(observed, expected).withColumnRenamed("ok", "available")


def expected_outputs(meta: DataFrame, matched: DataFrame) -> DataFrame:
    """Which summary outputs should exist, given the data."""
    kept = T.is_kept(F.col("exclusion"))
    there = matched.select("run").distinct().withColumn("_m", F.lit(True))
    rows = meta.join(there, "run", "left")
    flags = {
        "mapping_rate": kept & T.finite(F.col("mapping_rate")).isNotNull(), "layout": kept & ~T.is_blank(F.col("lib_layout")),
        "expression": kept & F.coalesce("_m", F.lit(False)), "exclusion": ~kept,
    }
    return rows.agg(*[F.coalesce(F.bool_or(F.coalesce(v, F.lit(False))), F.lit(False)).alias(k) for k, v in flags.items()]).unpivot([], list(flags), "output", "expected")


def first_rows(table: DataFrame, keys: list[str], order: list[str], n: int = 5) -> DataFrame:
    """A preview of every table of a scan."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return table.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")
