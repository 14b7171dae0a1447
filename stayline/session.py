"""Session settings and the shared staging folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session. Skewed joins are split even where the next
# operator would have reused the join's partitioning.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Settings that must be there when the session is built. Recording the Python call site of every Column
# expression more than doubles the time to build a plan.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_local_root: str | None = None


def build_session(app: str = "stayline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def staging_root(spark: SparkSession) -> str:
    """The cluster's shared folder for staged tables.

    Read from ``spark.checkpoint.dir``. Only a local master may fall back to a folder of this machine.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="stayline-stage-")
    return _local_root


def staged_path(spark: SparkSession, label: str) -> str:
    return os.path.join(staging_root(spark), "stayline", f"{label}-{uuid.uuid4().hex}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The lineage ends at the written files, so lost executors cost a re-read and not a re-computation.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
