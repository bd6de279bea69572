"""Readiness over a stream of log rows: edges are marked met as rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loadkeeper.functions.text import same
from loadkeeper.operators.gates import ITEM, SEQUENCE, SUCCESS, active_edges
from loadkeeper.session import shared_dir

MET = "batch_id BIGINT, dependency_id BIGINT, epoch BIGINT"


def met_so_far(spark: SparkSession, state: str, latest: DataFrame) -> DataFrame:
    """Edges met so far in the batches of ``latest`` (batch_id), as they are when this is read."""
    met = spark.read.schema(MET).parquet(state)
    return met.join(latest.select("batch_id").distinct(), "batch_id", "left_semi").select("dependency_id").distinct()


def readiness(edges: DataFrame, met: DataFrame) -> DataFrame:
    """Per source, step and sequence: edges expected, edges met, all met."""
    return (
        active_edges(edges)
        .join(met.withColumn("_met", F.lit(1)), "dependency_id", "left")
        .groupBy("source_id", "job_id", F.col(SEQUENCE).alias("execution_sequence"))
        .agg(F.count("dependency_id").alias("expected"), F.count("_met").alias("done"))
        .withColumn("ready", F.col("expected") == F.col("done"))
    )


def watch_readiness(
    log: DataFrame, edges: DataFrame, *, folder: str | None = None, name: str = "log", available_now: bool = True
) -> StreamingQuery:
    """Follows a streamed log and keeps the edges met, by batch, under ``folder``/met, one folder per epoch.

    An epoch that is retried overwrites its own folder, so a lost executor or a restart leaves the
    state exact. Only what was not met before is written: the state has at most one row per batch and edge.
    Which batches count is decided when the state is read. Streams of different logs need different names.
    """
    spark = edges.sparkSession
    folder = folder or f"{shared_dir(spark)}/readiness/{name}"
    state = f"{folder}/met"
    spark.createDataFrame([], "batch_id BIGINT, dependency_id BIGINT").write.mode("overwrite").parquet(f"{state}/epoch=-1")
    wanted = active_edges(edges).select(F.col("dependency_id").cast("bigint"), F.col("dependent_job_object_id").alias(ITEM))

    def mark(rows: DataFrame, epoch: int) -> None:
        items = rows.filter(same("status", SUCCESS)).select(F.col("batch_id").cast("bigint"), ITEM).distinct()
        met = wanted.join(items, ITEM).select("batch_id", "dependency_id")
        known = rows.sparkSession.read.schema(MET).parquet(state).filter(F.col("epoch") < epoch)
        fresh = met.join(known.drop("epoch").distinct(), ["batch_id", "dependency_id"], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{state}/epoch={epoch}")

    writer = log.writeStream.foreachBatch(mark).option("checkpointLocation", f"{folder}/checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def log_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """A log folder as a stream of its new files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
