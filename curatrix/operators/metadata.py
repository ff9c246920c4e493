"""Operators on run metadata: predicates, projections, update joins, unions and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.session import checkpointed


def raise_if(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """``df``, unless a row is ``bad``; checked lazily inside the plan."""
    return df.where(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def eligible_runs(meta: DataFrame) -> DataFrame:
    """Kept rows if any exclusion is given, and sampled rows if any sampling flag is; other flags raise."""
    given = meta.agg(F.max(~T.is_blank(F.col("exclusion"))).alias("_e"), F.max(~T.is_blank(F.col("is_sampled"))).alias("_s"))
    flag = F.lower(T.trimmed(F.col("is_sampled")))
    flag = F.when(flag.isin("yes", "no", ""), flag).otherwise(F.raise_error(F.lit("is_sampled must be yes or no")).cast("string"))
    joined = meta.crossJoin(F.broadcast(given))  # one row
    return joined.where((~F.coalesce("_e", F.lit(False)) | T.is_kept(F.col("exclusion"))) & (~F.coalesce("_s", F.lit(False)) | (flag == "yes"))).drop("_e", "_s")


def in_groups(meta: DataFrame, groups: str) -> DataFrame:
    wanted = [g.strip() for g in groups.replace("|", ",").split(",") if g.strip()]
    return meta.where(F.col("sample_group").isin(wanted))


def drop_missing_run(meta: DataFrame) -> DataFrame:
    return meta.where(~T.is_blank(F.col("run")))


def missing_run_report(meta: DataFrame, describe: Column, examples: int = 10) -> DataFrame:
    """How many rows have no run, and the first examples by text."""
    blank = meta.where(T.is_blank(F.col("run"))).select(describe.cast("string").alias("x"))
    few = blank.orderBy("x").limit(examples).agg(F.array_join(F.sort_array(F.collect_list("x")), ",").alias("examples"))
    return blank.agg(F.count(F.lit(1)).alias("n_missing")).crossJoin(few)


def aggregate_columns(meta: DataFrame, target: str, sources: list[str]) -> DataFrame:
    """Tokens of the sources are added to the target, joined by ``; ``, without repeats, in order."""
    joined = F.concat_ws(";", *[T.text(F.col(c)) for c in [target, *sources]])
    return meta.withColumn(target, F.array_join(T.split_unique(joined, ";"), "; "))


def standardize_missing(meta: DataFrame, columns: list[str]) -> DataFrame:
    return meta.withColumns({c: F.when(T.is_blank(F.col(c)), "not_provided").otherwise(F.col(c)) for c in columns})


def strip_special_chars(meta: DataFrame) -> DataFrame:
    return meta.withColumns({c: T.strip_special(F.col(c)) for c, k in meta.dtypes if k == "string"})


def coalesce_pairs(meta: DataFrame, names: list[str], suffixes: list[str]) -> DataFrame:
    """``name`` from its suffixed columns, first present and given wins; the suffixed columns go."""
    out = meta
    for n in names:
        have = [n + s for s in suffixes if n + s in meta.columns]
        if have:
            out = out.withColumn(n, F.coalesce(*have)).drop(*have)
    return out


def mapping_rate_filter(meta: DataFrame, cutoff: float) -> DataFrame:
    """Kept runs under the cutoff, or without a rate, are excluded."""
    if cutoff <= 0:
        return meta
    low = T.is_kept(F.col("exclusion")) & ~F.coalesce(F.col("mapping_rate") >= cutoff, F.lit(False))
    return meta.withColumn("exclusion", F.when(low, "low_mapping_rate").otherwise(F.col("exclusion")))


def species_metadata(meta: DataFrame, expr: DataFrame, species: str, groups: list[str]) -> DataFrame:
    """Rows of a species and its groups; kept runs that the matrix lacks failed quantification."""
    there = expr.select("run").distinct().withColumn("_there", F.lit(True))
    own = meta.where((F.col("scientific_name") == species) & F.col("sample_group").isin(groups)).join(there, "run", "left")
    return own.withColumn("exclusion", F.when(T.is_kept(F.col("exclusion")) & F.col("_there").isNull(), "failed_quantification").otherwise(F.col("exclusion"))).drop("_there")


def selected_values(meta: DataFrame, column: str, position: str) -> DataFrame:
    """Distinct non-blank values of kept rows with the place of the first one."""
    kept = meta.where(T.is_kept(F.col("exclusion")) & ~T.is_blank(F.col(column)))
    return kept.groupBy(T.trimmed(F.col(column)).alias("value")).agg(F.min(position).alias("first_pos"))


def cross_species_metadata(meta: DataFrame, groups: list[str]) -> DataFrame:
    """Trimmed text, strict exclusions (a blank one raises), the species token, wanted groups only."""
    out = meta.withColumns({c: T.trimmed(F.col(c)) for c, k in meta.dtypes if k == "string"})
    out = raise_if(out, F.col("exclusion") == "", "blank exclusion")
    return out.withColumn("species_token", T.species_token(F.col("scientific_name"))).where(F.col("sample_group").isin(groups))


def update_by_run(source: DataFrame, update: DataFrame) -> DataFrame:
    """Non-missing values of the update overwrite the source's by run; new columns are added.

    Blank or repeated runs on either side, and update runs that the source lacks, raise.
    """
    def unique(df: DataFrame, side: str) -> DataFrame:
        n = F.count(F.lit(1)).over(Window.partitionBy("run"))
        return raise_if(df.withColumn("_n", n), (F.col("_n") > 1) | T.is_blank(F.col("run")), f"{side}: runs must be given once").drop("_n")

    new = [c for c in update.columns if c != "run"]
    u = unique(update, "update").select("run", F.lit(True).alias("_u"), *[F.col(c).alias(f"_u_{c}") for c in new])
    s = unique(source, "source").withColumn("_s", F.lit(True))
    joined = raise_if(s.join(u, "run", "full"), F.col("_s").isNull(), "update: run not in source")
    cols = [F.coalesce(f"_u_{c}", c).alias(c) if c in new else F.col(c) for c in source.columns]
    return joined.select(*cols, *[F.col(f"_u_{c}").alias(c) for c in new if c not in source.columns])


def union_metadata(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def union_distinct_run(tables: list[DataFrame], position: str) -> DataFrame:
    """The first row of a run wins, by table then position."""
    marked = union_metadata([t.withColumn("_source", F.lit(i)) for i, t in enumerate(tables)])
    rank = F.row_number().over(Window.partitionBy("run").orderBy("_source", position))
    return marked.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_source")


def append_private_runs(meta: DataFrame, private: DataFrame) -> DataFrame:
    both = meta.unionByName(private, allowMissingColumns=True)
    n = F.count(F.lit(1)).over(Window.partitionBy("run"))
    return raise_if(both.withColumn("_n", n), F.col("_n") > 1, "run given twice").drop("_n")


def run_difference(before: DataFrame, after: DataFrame) -> DataFrame:
    return before.select("run").distinct().join(after.select("run"), "run", "left_anti")


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with their number (from 1) in a total order, without bringing them into one task.

    A range-sorted table is written with the place of each row; the driver gets a count per partition.
    """
    placed = df.orderBy(*order).withColumns({"_id": F.monotonically_increasing_id(), "_part": F.spark_partition_id()})
    rows = checkpointed(placed, "numbered")
    before, at = [], 0
    for part, n in sorted(rows.groupBy("_part").count().collect()):
        before.append((part, at))
        at += n
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before long")  # a row per partition
    number = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1) + 1
    return rows.join(F.broadcast(offsets), "_part").withColumn(name, number.cast("int")).drop("_id", "_part", "_before")


def run_order(meta: DataFrame, position: str) -> DataFrame:
    """The column order of a matrix: group, species, project, then the order given."""
    return numbered(meta, ["sample_group", "scientific_name", "bioproject", position], "run_pos")


def batch_slice(meta: DataFrame, scope: str, n: int, position: str) -> DataFrame:
    """Rows of the n-th species (sorted), or the n-th sampled run."""
    if scope == "species":
        nth = meta.select("scientific_name").distinct().orderBy("scientific_name").offset(n - 1).limit(1)
        return meta.join(F.broadcast(nth), "scientific_name", "left_semi")
    return meta.where("is_sampled = 'yes'").orderBy(position).offset(n - 1).limit(1)


def metadata_problems(meta: DataFrame, required: list[str]) -> DataFrame:
    """One row of violation counts."""
    missing = [c for c in required if c not in meta.columns]
    runs = meta.where(~T.is_blank(F.col("run"))).groupBy("run").count().agg(F.coalesce(F.sum(F.when(F.col("count") > 1, F.col("count") - 1)), F.lit(0)).alias("duplicate_run"))
    counts = meta.agg(F.lit(len(missing)).cast("long").alias("missing_columns"), F.count_if(T.is_blank(F.col("run"))).alias("blank_run"), F.count_if(T.is_blank(F.col("scientific_name"))).alias("blank_species"))
    return counts.crossJoin(runs)


def threshold_consistency(meta: DataFrame, column: str) -> DataFrame:
    """Whether one threshold is recorded, on all rows or none."""
    v = T.to_number(F.col(column))
    out = meta.agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count(v).alias("given"), F.count(F.lit(1)).alias("n_rows"))
    return out.withColumn("consistent", (F.col("given") == 0) | ((F.col("low") == F.col("high")) & (F.col("given") == F.col("n_rows"))))


def fill_run_sizes(meta: DataFrame) -> DataFrame:
    """Invalid totals get what can be derived, else the value that stands for unknown."""
    bases, spots, length = (T.to_number(F.col(c)) for c in ("total_bases", "total_spots", "spot_length"))
    fixed = F.when(bases > 0, bases).otherwise(float(T.SIZE_UNKNOWN))
    derived = F.when((bases > 0) & (length > 0), F.floor(bases / length)).otherwise(float(T.SIZE_UNKNOWN))
    return meta.withColumns({"total_bases": fixed.cast("long"), "total_spots": F.when(spots > 0, spots).otherwise(derived).cast("long")})
