"""A corpus pipeline of five stages; each takes documents and returns documents, the last one the packing plan.

Every stage reads what its predecessor wrote. All but the last return the columns of ``documents``; other columns of an
input, whatever their names, end with the first stage that sees them. Null and empty texts go with the quality rules, texts
are worked on whole, and an empty table gives an empty one at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.common import materialize
from curatrix.llm.jaccard import drop_near_copies
from curatrix.llm.line_dedup import dedup_lines
from curatrix.llm.packing import pack_documents
from curatrix.llm.quality_rules import quality_rules
from curatrix.llm.secrets import scan_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the ratio. Repeated rows are judged alike; a null id is no trusted document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, labels, carry=True).where("kept").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that others hold; a text all of whose lines go is empty and stays."""
    return _recounted(dedup_lines(docs.select(COLUMNS), carry=True))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each class. All rows of a kept id stay, repeated ones too, and so do rows with a
    null id and empty texts, which link with nothing."""
    return drop_near_copies(docs.select(COLUMNS))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its secrets masked; a null text stays null."""
    return _recounted(scan_secrets(docs.select(COLUMNS), carry=True).withColumn("text", F.col("redacted")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of the packing plan; an empty text is a piece of one id."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Log-likelihood ratios, the forest and best-fit packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return stage_last(spark, docs, sf_dir)


def stage_last(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return STAGES[-1][1](spark, docs, sf_dir)
