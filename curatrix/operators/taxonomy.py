"""Taxonomy joins: lineages, scientific names and name lookups over nodes, names and merged ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.session import checkpointed, forget, scratch

# The standard ranks.
RANKS = ("domain", "kingdom", "phylum", "class", "order", "family", "genus", "species")
#: Steps that a chain of merges may have; a longer one is taken for a cycle.
MERGE_HOPS = 1000
MAX_DEPTH = 1000


def resolve_merged(ids: DataFrame, merged: DataFrame, hops: int = MERGE_HOPS) -> DataFrame:
    """``(taxid, current)``: each id, or what it was merged into in the end; chains that go on after ``hops`` steps raise."""
    out = ids.select("taxid").distinct().withColumn("current", F.col("taxid"))
    step = merged.select(F.col("old_taxid").alias("current"), F.col("new_taxid").alias("next"))
    for _ in range(hops):
        moved = out.join(step, "current", "left")
        if not moved.where("next is not null").limit(1).count():
            return out
        before, out = out, checkpointed(moved.select("taxid", F.coalesce("next", "current").alias("current")), "merged-ids")
        forget(before)
    raise RuntimeError(f"merged ids go on after {hops} steps")


def lineage(ids: DataFrame, nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """``(taxid, ancestor, rank, depth)`` from each id (depth 0) up to the root; a chain that goes on after MAX_DEPTH steps raises.

    A step up is a written table: a recursive query holds one million rows at most, however many ids there are.
    """
    spark = ids.sparkSession
    parent = nodes.select(F.col("taxid").alias("ancestor"), F.col("parent_taxid").alias("up"))
    ranks = nodes.select(F.col("taxid").alias("ancestor"), "rank")
    folder, at = scratch(spark, "lineage"), resolve_merged(ids, merged).select("taxid", F.col("current").alias("ancestor"))
    schema = at.schema.add("rank", ranks.schema["rank"].dataType)
    for depth in range(MAX_DEPTH + 1):
        level = at.join(parent, "ancestor").where(F.col("up") != F.col("ancestor")).select("taxid", F.col("up").cast(at.schema["ancestor"].dataType).alias("ancestor"))
        at.join(ranks, "ancestor").select("taxid", "ancestor", "rank").write.parquet(f"{folder}/depth={depth}")
        before, at = at, checkpointed(level, "one-up")
        forget(before)
        if at.isEmpty():
            forget(at)
            return spark.read.schema(schema.add("depth", "integer")).option("basePath", folder).parquet(folder)
    raise RuntimeError(f"lineages go on after {MAX_DEPTH} steps")


def rank_columns(lineages: DataFrame, ranks: tuple[str, ...] = RANKS) -> DataFrame:
    """A column per standard rank, the ancestor's id."""
    return lineages.groupBy("taxid").pivot("rank", list(ranks)).agg(F.first("ancestor")).select("taxid", *[F.col(f"`{r}`").alias(f"taxid_{r}") for r in ranks])


def attach_lineage(meta: DataFrame, columns: DataFrame) -> DataFrame:
    return meta.join(columns, "taxid", "left")


def taxid_to_name(ids: DataFrame, names: DataFrame, merged: DataFrame) -> DataFrame:
    """The scientific name of an id, or of what it was merged into."""
    scientific = names.where("is_scientific = 1").groupBy("taxid").agg(F.min("name").alias("name"))
    now = resolve_merged(ids, merged)
    own = now.join(scientific, "taxid", "left")
    other = scientific.select(F.col("taxid").alias("current"), F.col("name").alias("other"))
    return own.join(other, "current", "left").select("taxid", F.coalesce("name", "other").alias("name"))


def name_to_taxid(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """Ids of names, whatever their case: scientific names before synonyms, then the smallest id; ``n_ids`` tells ambiguity."""
    key = wanted.select("name").distinct().withColumn("key", F.lower(F.trim("name")))
    hit = key.join(names.select(F.lower("name").alias("key"), "taxid", "is_scientific").distinct(), "key")
    best = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("is_scientific"), "taxid"))
    ids = F.size(F.collect_set("taxid").over(Window.partitionBy("name", "is_scientific")))
    return hit.withColumn("_r", best).withColumn("n_ids", ids.cast("long")).where("_r = 1").select("name", "taxid", "n_ids")
