"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Joins are planned from measured sizes: a side is broadcast only below the threshold,
    # and a hot key is split while the join runs.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # Control tables hold wall-clock timestamps without a zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
}


def builder(app: str = "loadkeeper") -> SparkSession.Builder:
    """A session builder with the library's settings; master and sizes stay with the caller."""
    out = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set; name a folder all executors can reach")
    return folder.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """``shared_dir``; a session on one machine without that setting gets a temporary folder, set for the whole session."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
    return shared_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder; a lost executor never recomputes them, and they stay as they are."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession))
    return df.checkpoint()
