"""Sampling of runs per species and group. Random order is a hash of the run and a seed, the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T


def random_key(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def _eligible(meta: DataFrame) -> DataFrame:
    return meta.withColumn("_ok", T.is_kept(F.col("exclusion")))


SLICES = 64


def _label(rows: DataFrame, order: list[Column], n: int) -> DataFrame:
    """``is_sampled`` for the first n eligible rows of each (species, group).

    Rows are ranked within slices of a group first; only those among a slice's first n are ranked against each other,
    so no task sorts a whole large group.
    """
    keys = ["scientific_name", "sample_group"]
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64("run", "bioproject"), F.lit(SLICES)))
    some = F.row_number().over(Window.partitionBy(*keys, "_ok", "_slice").orderBy(*order))
    cell = F.when(F.col("_ok") & (F.col("_some") <= n), -1).otherwise(F.col("_slice"))
    ranked = sliced.withColumn("_some", some).withColumn("_cell", cell)
    rank = F.row_number().over(Window.partitionBy(*keys, "_ok", "_cell").orderBy(*order))
    out = ranked.withColumn("_rank", rank).withColumn("is_sampled", F.when((F.col("_cell") == -1) & (F.col("_rank") <= n), "yes").otherwise("no"))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def sample_max_diversity(meta: DataFrame, n: int, seed: int) -> DataFrame:
    """Up to n runs per (species, group), round by round over the projects in random order."""
    inner = Window.partitionBy("scientific_name", "sample_group", "_ok", "bioproject").orderBy(random_key(seed, "run"), "run")
    rounds = _eligible(meta).withColumn("_round", F.row_number().over(inner))
    return _label(rounds, [F.col("_round"), random_key(seed, "bioproject", "_round"), F.col("bioproject")], n)


def sample_by_project_size(meta: DataFrame, n: int, seed: int, largest_first: bool = True) -> DataFrame:
    """Whole projects by size, ties in random order, until n runs are chosen."""
    size = F.count(F.lit(1)).over(Window.partitionBy("scientific_name", "sample_group", "_ok", "bioproject"))
    sized = _eligible(meta).withColumn("_size", size)
    by_size = F.desc("_size") if largest_first else F.asc("_size")
    return _label(sized, [by_size, random_key(seed, "bioproject"), F.col("bioproject"), random_key(seed, "run"), F.col("run")], n)


def sample_random(meta: DataFrame, n: int, seed: int) -> DataFrame:
    return _label(_eligible(meta), [random_key(seed, "run"), F.col("run")], n)
