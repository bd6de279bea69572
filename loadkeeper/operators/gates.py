"""Readiness gates: restart filter, list dependencies, cross-source edges, drain test.

A *run* is one row (batch_id, source_id): a batch of a source that asks what to load next. All gates
take many runs at once, so a whole history of batches is one plan. The run log is the large side
everywhere: it is cut to the requested batches and reduced to distinct keys before it is joined, so
a work item with very many log rows costs one row per task after the partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import EASTERN, Moment, local_day, on_day
from loadkeeper.functions.text import entry_count, entry_keys, fold, same
from loadkeeper.operators.joins import not_in, shuffled

SUCCESS = "success"
DONE = "Successfully Completed"
ITEM = "job_object_id"
SEQUENCE = "ExecutionSequence"  # of an edge


def succeeded(log: DataFrame, runs: DataFrame | None = None, success: str = SUCCESS) -> DataFrame:
    """Distinct (batch_id, job_object_id) with a success row.

    Keys are filtered for NULL here, so that every join of the result plans the same reduction and
    the log is read and shuffled once per query.
    """
    rows = log.filter(same("status", success) & F.col("batch_id").isNotNull() & F.col(ITEM).isNotNull())
    if runs is not None:
        rows = rows.join(runs.select("batch_id").distinct(), "batch_id", "left_semi")
    return rows.select("batch_id", ITEM).distinct()


def pending(items: DataFrame, done: DataFrame) -> DataFrame:
    """Work items of a run that have not yet succeeded in its batch."""
    return items.join(done, ["batch_id", ITEM], "left_anti")


def upstream_done(items: DataFrame, all_items: DataFrame, done: DataFrame, upstream_job: int) -> DataFrame:
    """Items whose object succeeded in the upstream step of the same batch and source."""
    upstream = all_items.filter((F.col("job_id") == upstream_job) & (F.col("enabled") == 1))
    objects = (
        done.join(upstream.select(ITEM, "source_id", "object_id"), ITEM)
        .select("batch_id", "source_id", "object_id")
        .distinct()
    )
    return items.join(objects, ["batch_id", "source_id", "object_id"], "left_semi")


def list_gate_state(
    items: DataFrame,
    all_items: DataFrame,
    done: DataFrame,
    runs: DataFrame,
    *,
    name_col: str,
    jobs: Sequence[int],
    job_id: int | None = None,
    list_col: str = "dependent_table_list",
) -> DataFrame:
    """Per run and item: entries in its comma list, and succeeded items those entries name.

    An item has one name, so the distinct items a list names are the sum, over its distinct names,
    of the succeeded items with that name. Names are counted first; no (item, match) pairs arise.
    The lists are read from the item table itself (the items of ``job_id``, if given), so that side
    does not repeat the joins behind ``items``.
    """
    named = all_items.filter(F.col("job_id").isin(*jobs) & (F.col("enabled") == 1))
    # Sorted joins between the three reductions: a task holds the table of one of them at a time, and what is sorted can spill.
    counts = (
        done.join(shuffled(named.select(ITEM, "source_id", fold(name_col).alias("_name"))), ITEM)
        .join(runs.select("batch_id", "source_id").distinct(), ["batch_id", "source_id"], "left_semi")
        .groupBy("batch_id", "source_id", "_name")
        .agg(F.count("*").alias("_n"))
    )
    asked = all_items.filter(F.col(list_col).isNotNull() & (F.col("enabled") == 1))
    if job_id is not None:
        asked = asked.filter(F.col("job_id") == job_id)
    met = (
        asked.select("source_id", ITEM, F.explode(entry_keys(list_col)).alias("_name"))
        .join(shuffled(counts), ["source_id", "_name"])
        .groupBy("batch_id", ITEM)
        .agg(F.sum("_n").alias("_met"))
    )
    return (
        items.join(shuffled(met), ["batch_id", ITEM], "left")
        .withColumn("expected_count", entry_count(list_col).cast("bigint"))
        .withColumn("met_count", F.coalesce("_met", F.lit(0)).cast("bigint"))
        .drop("_met")
    )


def list_gate(items: DataFrame, all_items: DataFrame, done: DataFrame, runs: DataFrame, **options) -> DataFrame:
    """Enabled items whose list entries and succeeded namesakes are equal in number.

    Equal, not "at least": a missing list (NULL) is ready, an empty one ('') never is, a repeated
    name never is, and two succeeded items under one name hold the item back.
    """
    state = list_gate_state(items, all_items, done, runs, **options)
    return state.filter(F.col("expected_count") == F.col("met_count")).select(*items.columns)


def latest_batches(batches: DataFrame, now: Moment, zone: str = EASTERN) -> DataFrame:
    """The newest batch of every source among those started today on the zone's calendar.

    The start is compared as stored; only ``now`` is moved to the zone.
    """
    today = batches.filter(on_day("batch_start_date", local_day(now, zone)))
    return today.groupBy("source_id").agg(F.max("batch_id").alias("batch_id"))


def logged_items(log: DataFrame, latest: DataFrame, success: str | None = None) -> DataFrame:
    """Distinct items with any row (or a success row) in the given batches."""
    rows = log if success is None else log.filter(same("status", success))
    return rows.join(latest.select("batch_id"), "batch_id", "left_semi").select(ITEM).distinct()


def active_edges(edges: DataFrame, min_dependent_job: int | None = None) -> DataFrame:
    out = edges.filter(F.col("enabled"))
    return out if min_dependent_job is None else out.filter(F.col("dependent_job_id") >= min_dependent_job)


def edge_gate(
    items: DataFrame,
    edges: DataFrame,
    log: DataFrame,
    latest: DataFrame,
    *,
    sequence: Column,
    min_dependent_job: int | None = None,
) -> DataFrame:
    """Drop items that wait on another source.

    An edge is unmet while its upstream item has no log row of any status in the latest batches.
    The item key of an edge may be NULL; one unmet edge with a NULL key holds back every item of
    that source and sequence, as NOT IN does.
    """
    logged = logged_items(log, latest).withColumnRenamed(ITEM, "dependent_job_object_id")
    unmet = (
        active_edges(edges, min_dependent_job)
        .join(logged, "dependent_job_object_id", "left_anti")
        .select("source_id", F.col(SEQUENCE).alias("_sequence"), ITEM)
    )
    asked = items.withColumn("_sequence", sequence)
    return not_in(asked, unmet, ITEM, ["source_id", "_sequence"]).drop("_sequence")


def edge_status(
    edges: DataFrame,
    log: DataFrame,
    latest: DataFrame,
    *,
    require_success: bool = True,
    min_dependent_job: int | None = None,
) -> DataFrame:
    """Per source, step and sequence: edges expected, edges met, and whether all are met."""
    met = logged_items(log, latest, SUCCESS if require_success else None).select(
        F.col(ITEM).alias("dependent_job_object_id"), F.lit(1).alias("_met")
    )
    return (
        active_edges(edges, min_dependent_job)
        .join(met, "dependent_job_object_id", "left")
        .groupBy("source_id", "job_id", F.col(SEQUENCE).alias("execution_sequence"))
        .agg(F.count("dependency_id").alias("expected"), F.count("_met").alias("done"))
        .withColumn("ready", F.col("expected") == F.col("done"))
    )


def missing_edges(edges: DataFrame, log: DataFrame, latest: DataFrame, **options) -> DataFrame:
    """The unmet edges themselves, one row each."""
    success = SUCCESS if options.get("require_success", True) else None
    met = logged_items(log, latest, success).withColumnRenamed(ITEM, "dependent_job_object_id")
    chosen = active_edges(edges, options.get("min_dependent_job"))
    return chosen.join(met, "dependent_job_object_id", "left_anti")


def drain_days(batches: DataFrame) -> DataFrame:
    """Per trigger day and pipeline name: batches that have not completed; drained at zero.

    A NULL status is not counted. A pipeline without a batch on a day has no row and is drained.
    """
    open_batch = F.when(fold("batch_run_status") != DONE.lower(), 1)
    return (
        batches.groupBy(F.to_date("trigger_time").alias("trigger_day"), fold("pipeline_name").alias("_name"))
        .agg(F.min("pipeline_name").alias("pipeline_name"), F.count(open_batch).alias("open_batches"))
        .drop("_name")
        .withColumn("drained", F.col("open_batches") == 0)
    )


def drain_state(batches: DataFrame, now: Moment, zone: str = EASTERN) -> DataFrame:
    """``drain_days`` for today on the zone's calendar; the trigger time is compared as stored."""
    return drain_days(batches.filter(on_day("trigger_time", local_day(now, zone))))


def gate_days(log: DataFrame, gate_items: DataFrame) -> DataFrame:
    """Log rows of the gate items per log day."""
    rows = log.join(gate_items.select(ITEM).distinct(), ITEM, "left_semi")
    return rows.groupBy(F.to_date("log_date").alias("log_day")).agg(F.count("*").alias("n_rows"))


def rows_yesterday(log: DataFrame, gate_items: DataFrame, today: Column) -> Column:
    """Log rows of the gate items dated the day before ``today``, as a scalar."""
    rows = log.filter(on_day("log_date", F.date_sub(today, 1)))
    return rows.join(gate_items.select(ITEM).distinct(), ITEM, "left_semi").agg(F.count("*")).scalar()


def logged_yesterday(log: DataFrame, items: DataFrame, target: str, today: Column) -> Column:
    """True when the item with this target has any log row dated yesterday."""
    return rows_yesterday(log, items.filter(same("target_object_name", target)), today) > 0


def all_refreshed_yesterday(
    log: DataFrame, items: DataFrame, today: Column, *, source_id: int = 3, job_id: int = 5
) -> Column:
    """True when yesterday's log rows of the gate step equal its enabled items in number.

    Rows are counted, not distinct items, and any status counts; nothing expected and nothing
    logged is also equal.
    """
    gate = items.filter(
        (F.col("source_id") == source_id) & (F.col("job_id") == job_id) & (F.col("enabled") == 1)
    )
    return rows_yesterday(log, gate, today) == gate.agg(F.count(ITEM)).scalar()
