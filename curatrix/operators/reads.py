"""Sequencing runs and reads: layouts, platforms, ranges, mates, contaminants and per-run statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from curatrix.functions import text as T
from curatrix.operators.metadata import raise_if
from curatrix.session import checkpointed

# Platform words, the shortest believable fragment, and when mates count as one read.
PLATFORMS = (("ont", r"nanopore|minion|gridion|promethion|\bont\b"), ("pacbio", r"pacbio|pacific biosciences|sequel|revio|\brs ii\b"), ("illumina", r"illumina|hiseq|nextseq|novaseq|miseq|genome analyzer"))
SHORT_READ, LEAST_FRAGMENT, SAME_MATES = 1000, 200, 0.99
STAGE_ORDER = ("contam", "rrna", "fastp", "extraction")


def infer_platform(texts: list[Column], layout: Column, spot_length: Column) -> Column:
    """Platform family from words in any text, else from layout and spot length."""
    words = F.lower(F.concat_ws(" ", *[T.text(c) for c in texts]))
    named = F.coalesce(*[F.when(words.rlike(p), name) for name, p in PLATFORMS])
    length = T.to_number(spot_length)
    return F.coalesce(named, F.when(F.lower(layout) == "paired", "illumina").when(length <= SHORT_READ, "illumina").when(length > SHORT_READ, "unknown_long").otherwise("unknown"))


def infer_backend(platform: Column) -> Column:
    bad = F.raise_error(F.concat(F.lit("no backend for platform "), platform)).cast("string")
    return F.when(platform == "illumina", "short_read").when(platform.isin("ont", "pacbio", "unknown_long"), "long_read").otherwise(bad)


def long_read_preset(platform: Column, texts: list[Column]) -> Column:
    words = F.lower(F.concat_ws(" ", *[T.text(c) for c in texts]))
    return F.when((platform == "ont") & words.rlike("direct.?rna"), "ont_direct_rna").when(platform == "ont", "ont_cdna").when((platform == "pacbio") & words.rlike("hifi|ccs"), "pacbio_hifi").when(platform == "pacbio", "pacbio")


def run_statistics(meta: DataFrame, target_bp: float) -> DataFrame:
    """Layout with its override, spot length given or derived, and reads for a target of base pairs."""
    spots, bases = T.to_number(F.col("total_spots")), T.to_number(F.col("total_bases"))
    out = raise_if(meta, spots.isNull() | (spots <= 0), "total_spots must be positive")
    given = T.to_number(F.col("spot_length"))
    length = F.when(given > 0, given).otherwise(F.try_divide(bases, spots))
    layout = F.when(~T.is_blank(F.col("layout_override")), F.col("layout_override")).otherwise(F.col("lib_layout"))
    return out.select("run", layout.alias("layout"), spots.cast("long").alias("total_spots"), length.alias("spot_length"), F.floor(F.try_divide(F.lit(float(target_bp)), length)).cast("long").alias("reads_per_run"))


def recover_statistics(meta: DataFrame, stats: DataFrame) -> DataFrame:
    """Missing spots, bases and spot length from extraction statistics (the largest base count that is given)."""
    s = stats.select("run", F.col("num_spots").alias("_s"), F.greatest("bp_dumped", "bp_written", "bp_final").alias("_b"))
    rows = meta.join(s, "run", "left")
    spots = F.coalesce(T.to_number(F.col("total_spots")), F.col("_s").cast("double"))
    bases = F.coalesce(T.to_number(F.col("total_bases")), F.col("_b").cast("double"))
    return rows.withColumns({"total_spots": spots, "total_bases": bases, "spot_length": F.coalesce(T.to_number(F.col("spot_length")), F.try_divide(bases, spots))}).drop("_s", "_b")


def fragment_length(nominal: Column) -> Column:
    v = T.to_number(nominal)
    return F.when(v >= LEAST_FRAGMENT, v).otherwise(float(LEAST_FRAGMENT))


def spot_range(total: Column, wanted: Column, offset: Column) -> Column:
    """``(start, end)``, from 1: all when few, else a window after the offset, else the tail, else all."""
    all_ = F.struct(F.lit(1).cast("long").alias("start"), total.alias("end"))
    window = F.struct(offset.alias("start"), (offset + wanted - 1).alias("end"))
    tail = F.struct((total - wanted + 1).alias("start"), total.alias("end"))
    return F.when(total <= wanted, all_).when(total > wanted + offset, window).when(total > wanted, tail).otherwise(all_)


def second_round_needed(totals: DataFrame, tolerance: float) -> DataFrame:
    """Whether too few base pairs came out, and whether any run has spots left."""
    return totals.agg(F.sum("bp_final").alias("bp_final"), F.sum("bp_target").alias("bp_target"), F.max(F.col("spots_left") > 0).alias("spots_left")).select(
        F.try_divide("bp_final", "bp_target").alias("rate"), (F.try_divide("bp_final", "bp_target") < 1 - tolerance / 100).alias("too_few"), "spots_left"
    ).withColumn("needed", F.col("too_few") & F.col("spots_left"))


def target_bp_per_run(meta: DataFrame, max_bp: float) -> DataFrame:
    out = meta.agg(F.count(F.lit(1)).alias("n_runs"), F.sum(T.to_number(F.col("total_bases"))).alias("total_bases"))
    each = F.floor(F.lit(float(max_bp)) / F.col("n_runs")).cast("long")
    return out.select("n_runs", "total_bases", each.alias("bp_per_run"))


def second_round_ranges(runs: DataFrame, job: str | None = None, order: list[str] | None = None) -> DataFrame:
    """Reads that each run still gives. Runs short of their own target leave a shortfall in base pairs, which others of
    the job take over in row order while they have spots; a running sum finds the run that takes the last part.

    ``runs``: pos, spot_length, total_spots, used_spots, target_bp, rate (share of base pairs that pass). All runs are
    one job unless a column names it. With ``order``, rows go by these columns and ``pos`` is their number in the job. Rows are shuffled
    once, into sorted ranges; sums run along a range as it is written, and the totals of the ranges before are
    added, so a large job is no single task.
    """
    need = F.ceil(F.col("target_bp") / F.col("spot_length") / F.col("rate")).cast("long")
    free = F.greatest(F.col("total_spots") - F.col("used_spots"), F.lit(0))
    rows = runs.withColumns({"_need": need, "_free": free, "_job": F.col(job) if job else F.lit(0)}).withColumn("_own", F.least("_need", "_free"))
    rows = rows.withColumns({"_short": ((F.col("_need") - F.col("_own")) * F.col("spot_length")).cast("double"), "_cap": ((F.col("_free") - F.col("_own")) * F.col("spot_length")).cast("double")}).drop("_need")
    rows = rows.orderBy("_job", *(order or ["pos"])).withColumn("_part", F.spark_partition_id())
    names = rows.columns

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, total = (), 0, 0.0  # of the job that a batch ends in
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column(names.index("_job")).dictionary_encode("encode")
            code = np.asarray(of.indices)
            starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            cap = np.nan_to_num(batch.column(names.index("_cap")).to_numpy(zero_copy_only=False))
            number, inside = np.empty(len(code), np.int64), np.empty(len(code))
            for first, end in zip(starts, np.append(starts[1:], len(code))):
                value = (of.dictionary[int(code[first])].as_py(),)
                if value != last:
                    last, n, total = value, 0, 0.0
                sums = total + np.cumsum(cap[first:end])
                number[first:end], inside[first], inside[first + 1 : end] = n + np.arange(end - first), total, sums[:-1]
                n, total = n + int(end - first), float(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(inside)], [*names, "_number", "_inside"])

    schema = StructType([*rows.schema.fields, StructField("_number", LongType()), StructField("_inside", DoubleType())])
    rows = checkpointed(rows.mapInArrow(along, schema), "ranges")
    parts = rows.groupBy("_job", "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("_short").alias("_short"), F.sum("_cap").alias("_cap"))
    before = lambda c: F.sum(c).over(Window.partitionBy("_job").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("_job").alias("_j"), F.col("_part").alias("_p"), F.coalesce(before("_n"), F.lit(0)).alias("_first"), F.coalesce(before("_cap"), F.lit(0.0)).alias("_earlier"), F.sum("_short").over(Window.partitionBy("_job")).alias("_all"))
    rows = rows.join(parts, F.col("_job").eqNullSafe(F.col("_j")) & (F.col("_part") == F.col("_p")))
    if order:
        rows = rows.withColumn("pos", (F.col("_first") + F.col("_number") + 1).cast("int"))
    rest = F.col("_all") - F.col("_earlier") - F.col("_inside")
    extra = F.when(rest <= 0, 0).when(rest >= F.col("_cap"), F.col("_free") - F.col("_own")).otherwise(F.ceil(rest / F.col("spot_length"))).cast("long")
    return rows.withColumn("reads", F.col("_own") + extra).drop("_free", "_own", "_short", "_cap", "_all", "_job", "_part", "_j", "_p", "_earlier", "_inside", "_number", "_first")


def unique_run_ids(files: DataFrame) -> DataFrame:
    """Repeated base names get their folder in front, then a number."""
    n = F.count(F.lit(1)).over(Window.partitionBy("basename"))
    named = files.withColumn("_id", F.when(n > 1, F.concat_ws("_", "folder", "basename")).otherwise(F.col("basename")))
    k = F.row_number().over(Window.partitionBy("_id").orderBy("path"))
    return named.withColumn("_k", k).withColumn("run", F.when(F.col("_k") > 1, F.concat_ws("_", "_id", "_k")).otherwise(F.col("_id"))).drop("_id", "_k")


def drop_singletons(reads: DataFrame, layout: str = "layout") -> DataFrame:
    return reads.where(~((F.col(layout) == "paired") & F.col("mate").isNull()))


def layout_from_files(files: DataFrame) -> DataFrame:
    """``(run, mate)`` rows: both mates make paired, else single."""
    return files.groupBy("run").agg(F.when(F.bool_or(F.coalesce(F.col("mate") == 1, F.lit(False))) & F.bool_or(F.coalesce(F.col("mate") == 2, F.lit(False))), "paired").otherwise("single").alias("layout"))


def contaminant_anti_join(reads: DataFrame, cores: DataFrame) -> DataFrame:
    """Reads whose core is to be removed go, with their mates."""
    return reads.join(cores.select("run", "core").distinct(), ["run", "core"], "left_anti")


def classified_mismatch(assignments: DataFrame, lineages: DataFrame, rank: str, target: Column) -> DataFrame:
    """Read cores whose id lies under another taxon at ``rank``; unclassified and unresolvable ones stay."""
    at = lineages.where(F.col("rank") == rank).select("taxid", F.col("ancestor").alias("rank_taxid"))
    return assignments.where("taxid > 0").join(at, "taxid").where(F.col("rank_taxid") != target)


def paired_mates(reads: DataFrame) -> DataFrame:
    """Per run: mates of each side, and positions where a mate or its core is missing."""
    sides = reads.groupBy("run", "ordinal").agg(F.max(F.when(F.col("mate") == 1, F.col("core"))).alias("c1"), F.max(F.when(F.col("mate") == 2, F.col("core"))).alias("c2"))
    return sides.groupBy("run").agg(F.count("c1").alias("n_first"), F.count("c2").alias("n_second"), F.count_if(F.col("c1").isNull() | F.col("c2").isNull()).alias("n_lone"), F.count_if(F.col("c1") != F.col("c2")).alias("n_mismatch"))


def read_slice(reads: DataFrame, start: int, end: int) -> DataFrame:
    return reads.where(F.col("ordinal").between(start, end))


def read_totals(reads: DataFrame) -> DataFrame:
    """Per run: spots (the larger mate) and bases (all mates)."""
    per_mate = reads.groupBy("run", "mate").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(T.text(F.col("seq")))).alias("bases"))
    return per_mate.groupBy("run").agg(F.max("n").alias("spots"), F.sum("bases").alias("bases"), F.sum("n").alias("records"))


def records_to_spots(records: Column, paired: Column) -> Column:
    return F.when(paired, F.ceil(records / 2)).otherwise(records)


def filtered_percent(before: Column, after: Column) -> Column:
    return F.when(before > 0, F.greatest(before - after, F.lit(0)) * 100.0 / before)


def weighted_metric(rounds: DataFrame, keys: list[str], metric: str, weight: str) -> DataFrame:
    """The weighted mean over rounds, missing ones skipped."""
    ok = F.col(metric).isNotNull() & F.col(weight).isNotNull()
    return rounds.groupBy(*keys).agg(F.try_divide(F.sum(F.when(ok, F.col(metric) * F.col(weight))), F.sum(F.when(ok, F.col(weight)))).alias(metric))


def zero_output_stage() -> Column:
    """The first stage that had input but no output, from ``<stage>_in`` and ``<stage>_out``."""
    return F.coalesce(*[F.when((F.col(f"{s}_in") > 0) & (F.coalesce(f"{s}_out", F.lit(0)) <= 0), s) for s in STAGE_ORDER], F.lit(""))


def identical_mate_ratio(reads: DataFrame, sample: int = 2000) -> DataFrame:
    """Per run, over the first pairs by hash: the share with equal sequences, and whether that means single."""
    pairs = reads.groupBy("run", "ordinal").agg(F.max(F.when(F.col("mate") == 1, F.col("seq"))).alias("s1"), F.max(F.when(F.col("mate") == 2, F.col("seq"))).alias("s2")).where("s1 is not null and s2 is not null")
    rank = F.row_number().over(Window.partitionBy("run").orderBy(F.md5(F.concat_ws("|", "run", "ordinal")), "ordinal"))
    out = pairs.withColumn("_r", rank).where(F.col("_r") <= sample).groupBy("run").agg(F.count(F.lit(1)).alias("n_pairs"), F.avg((F.col("s1") == F.col("s2")).cast("double")).alias("ratio"))
    return out.withColumn("treat_as_single", F.col("ratio") >= SAME_MATES)


def long_read_adapt(quant: DataFrame, spots: DataFrame) -> DataFrame:
    """Long-read counts in the short-read shape, with the share of spots that mapped; over 100 % raises."""
    q = quant.select("run", F.trim("tname").alias("target_id"), F.col("len").cast("double").alias("length"), F.lit(1.0).alias("eff_length"), F.col("num_reads").cast("double").alias("est_counts"))
    mapped = q.groupBy("run").agg(F.sum("est_counts").alias("c")).join(spots, "run").select("run", (F.col("c") * 100.0 / F.col("total_spots")).alias("p_mapped"))
    return q.join(raise_if(mapped, F.col("p_mapped") > 100.0, "more reads mapped than there are"), "run")


def extraction_counts(rounds: DataFrame) -> DataFrame:
    """Per run over rounds: dumped (at least written), written, rejected, base pairs."""
    dumped = F.greatest("dumped", "written")
    return rounds.groupBy("run").agg(F.sum(dumped).alias("dumped"), F.sum("written").alias("written"), F.sum(dumped - F.col("written")).alias("rejected"), F.sum(F.col("written") * F.col("spot_length")).alias("bp"))


def stage_totals(stats: DataFrame, stages: list[str]) -> DataFrame:
    return stats.agg(*[F.sum(s).alias(s) for s in stages]).unpivot([], stages, "stage", "total")
