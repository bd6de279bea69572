"""Incremental ingest and change feeds as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loadkeeper.functions.clock import Moment
from loadkeeper.operators.changes import classify_changes
from loadkeeper.operators.window import window_filter
from loadkeeper.session import scratch_dir


def append_stream(rows: DataFrame, target: str, *, checkpoint: str | None = None, partition_by=()) -> StreamingQuery:
    """Appends a stream to a folder, once per source file, then stops when nothing is left."""
    checkpoint = checkpoint or f"{scratch_dir(rows.sparkSession)}/{target.strip('/').replace('/', '_')}"
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(target)


def ingest(
    spark: SparkSession, source: str, schema: StructType, target: str, *,
    checkpoint: str | None = None, column: str | None = None, lower=None, upper=None,
) -> StreamingQuery:
    """New files of a folder since the last call; the checkpoint is the watermark.

    With ``column`` the rows are also cut to the window [lower, upper) at minute precision.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    if column is not None:
        rows = window_filter(rows, column, lower, upper)
    return append_stream(rows, target, checkpoint=checkpoint)


def audit_changes(
    changes: DataFrame, target: str, *, user: str, now: Moment, checkpoint: str | None = None
) -> StreamingQuery:
    """A stream of (before, after) change rows to the audit table, as they come."""
    return append_stream(classify_changes(changes, user=user, now=now), target, checkpoint=checkpoint)


def audit_feed(
    changes: DataFrame, target: str, *, user: str, change_id: str, at: str, delay: str, checkpoint: str | None = None
) -> StreamingQuery:
    """A feed that may repeat itself and come out of order, to the audit table: each change once, dated by its own time.

    ``change_id`` names a change and ``at`` its time. A repeat is known as one while it is no later than ``delay`` behind the newest
    change seen; anything later than that is not taken in, and counted in the stream's progress. What is
    remembered is one id per change within the delay, whatever its key. ``modify_date`` and ``change_id`` give the order
    of a key's changes however they came in; ``changes.replay`` goes by them.
    """
    once = changes.withWatermark(at, delay).dropDuplicatesWithinWatermark([change_id])
    rows = classify_changes(once, user=user, now=F.col(at), keep=[change_id])
    return append_stream(rows, target, checkpoint=checkpoint)
