"""Session defaults, and lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int, **conf: str) -> SparkSession:
    """A session on this machine; on a cluster the session comes from its launcher."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("curatrix")
    for k, v in (DEFAULTS | {"spark.sql.shuffle.partitions": str(cpus), "spark.ui.enabled": "false"} | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    if not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="curatrix-"))
    return (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()).rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and the plan starts anew.

    A table of files has no partitions of its own: what depends on the order or the partition of rows is taken down
    in columns before.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(df: DataFrame) -> None:
    """Delete what ``checkpointed`` wrote for ``df``, once a later table has taken its place; others are left alone."""
    path = getattr(df, "written_to", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
