"""Readiness as keyed state over a streamed log: a source's step is announced once, when its last edge is met.

For every day the newest batch of each source counts. A success row of such a batch meets the edges that wait on its
item; an edge counts once a day, however often its item succeeds. Both kinds of state, the edges met (by day and
edge, so a source with very many edges is spread) and a number per day, source, step and sequence, go when
the day falls behind the newest one by more than ``keep``; rows of such a day are late and count no more.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loadkeeper.functions.text import same
from loadkeeper.operators.gates import ITEM, SEQUENCE, SUCCESS, active_edges
from loadkeeper.session import scratch_dir

GROUP = ["source_id", "job_id", "execution_sequence"]
READY = "day date, source_id bigint, job_id bigint, execution_sequence bigint, edges bigint"


def newest_batches(batches: DataFrame) -> DataFrame:
    """(batch_id, day): the newest batch of every source on each day that it has one."""
    days = batches.groupBy("source_id", F.to_date("batch_start_date").alias("day"))
    return days.agg(F.max("batch_id").alias("batch_id")).select("batch_id", "day")


def met_edges(log: DataFrame, edges: DataFrame, batches: DataFrame, success: str | None = SUCCESS) -> DataFrame:
    """One row per log row and edge it meets, with the number of edges its group waits for; batch or stream."""
    group = ["source_id", "job_id", F.col(SEQUENCE).alias("execution_sequence")]
    waiting = active_edges(edges).select("dependency_id", *group, F.col("dependent_job_object_id").alias(ITEM))
    expected = active_edges(edges).groupBy(*group).agg(F.count("dependency_id").alias("edges"))
    waiting = waiting.join(expected, GROUP)
    rows = log if success is None else log.filter(same("status", success))
    return rows.select("batch_id", ITEM).join(newest_batches(batches), "batch_id").join(waiting, ITEM)


def _announce(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts the edges of one group of a day; yields it when the last one has come."""
    if state.hasTimedOut:
        state.remove()
        return
    done, edges = state.get[0] if state.exists else 0, None
    for part in parts:
        done += len(part)
        edges = int(part["edges"].iloc[0])
    state.update((done,))
    number, at, *group = key
    if done == edges:
        day = datetime.date(1970, 1, 1) + datetime.timedelta(days=int(number))
        yield pd.DataFrame([(day, *group, edges)], columns=["day", *GROUP, "edges"])
    state.setTimeoutTimestamp(max(int(at), state.getCurrentWatermarkMs()) + 1)


def ready_steps(log: DataFrame, edges: DataFrame, batches: DataFrame, *, keep: str = "2 days", success: str | None = SUCCESS) -> DataFrame:
    """A streamed log to (day, source_id, job_id, execution_sequence, edges), one row when all edges are met.

    ``success`` None counts rows of any status. Edges are not to change while a day is open; steps without
    edges never appear, they wait for nothing.
    """
    met = met_edges(log, edges, batches, success).withColumn("start", F.col("day").cast("timestamp"))
    once = met.withWatermark("start", keep).dropDuplicates(["start", "dependency_id"])
    longs = [F.col(c).cast("bigint").alias(c) for c in (*GROUP, "edges")]
    once = once.select("start", F.unix_date("day").alias("number"), F.unix_millis("start").alias("at"), *longs)
    grouped = once.groupBy("number", "at", *GROUP)
    return grouped.applyInPandasWithState(_announce, READY, "done bigint", "append", GroupStateTimeout.EventTimeTimeout)


def watch(log: DataFrame, edges: DataFrame, batches: DataFrame, target: str, *, checkpoint: str | None = None, available_now: bool = True, **options) -> StreamingQuery:
    """Follows a log and appends what becomes ready to ``target``, each step once, also over restarts."""
    checkpoint = checkpoint or f"{scratch_dir(log.sparkSession)}/{target.strip('/').replace('/', '_')}"
    writer = ready_steps(log, edges, batches, **options).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(target)
