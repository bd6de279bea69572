"""Closing batches, and the reports of a step, each for many runs at once."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import Moment, local_day
from loadkeeper.functions.text import like, same
from loadkeeper.operators import batch, gates, report
from loadkeeper.operators.joins import Pieces
from loadkeeper.plans.worklists import GATE_TARGET, Control


def gate_refreshed(c: Control, now: Moment, gate_target: str = GATE_TARGET) -> Column:
    """Whether the gate table was logged yesterday, on the server's clock: what closing a batch goes by."""
    return gates.logged_yesterday(c.log, c.items, gate_target, local_day(now, "UTC"))


def close_batches(c: Control, closing: DataFrame, *, now: Moment, adhoc: bool = False, gate_target: str = GATE_TARGET) -> DataFrame:
    """``finish_batches`` with the items a complete batch contains worked out from the gate and the day."""
    refreshed = gate_refreshed(c, now, gate_target)
    return finish_batches(c, closing, batch.expected_adhoc(refreshed) if adhoc else batch.expected_regular(refreshed, now))


def finish_batches(c: Control, closing: DataFrame, expected: Column) -> DataFrame:
    """The batch table after the closing requests.

    ``closing`` has batch_id, batch_end_date, batch_log_message and batch_run_status. A request for
    the completed state is decided by the rollup; any other state is taken as given.
    """
    asked = closing.join(c.batches.select("batch_id", "source_id"), "batch_id")
    rolled = batch.batch_rollup(asked, c.log, c.items, expected).select(
        "batch_id", F.col("batch_run_status").alias("_rolled")
    )
    wants_rollup = F.coalesce(same("batch_run_status", gates.DONE), F.lit(False))
    decided = asked.join(rolled, "batch_id").select(
        "batch_id", "batch_end_date", "batch_log_message",
        F.when(wants_rollup, F.col("_rolled")).otherwise(F.col("batch_run_status")).alias("batch_run_status"),
    )
    return batch.close_batches(c.batches, decided)


def chosen_items(c: Control, job_id: int, layer: str | None, sequence: int | None) -> DataFrame:
    items = c.items.filter(F.col("job_id") == job_id)
    if layer is not None:
        items = items.filter(like("target_object_name", f"%{layer}%"))
    return items if sequence is None else items.filter(F.col("execution_sequence") == sequence)


def run_groups(runs: DataFrame, job_id: int, topic: str) -> DataFrame:
    return runs.select("batch_id", "source_id").distinct().withColumns(
        {"job_id": F.lit(job_id).cast("bigint"), "topic": F.lit(topic)}
    )


def sequence_text(sequence: int | None) -> str:
    return "" if sequence is None else f", ExecutionSequence: {sequence}"


def success_report(
    c: Control, runs: DataFrame, routing: DataFrame, *, job_id: int, topic: str, server: str, now: dt.datetime,
    layer: str | None = None, sequence: int | None = None, page_rows: int | Pieces | None = None, recon_rejects: bool = False,
) -> DataFrame:
    """What succeeded in one step. Steps from 4 on total only log rows of their chosen items."""
    items = chosen_items(c, job_id, layer, sequence)
    log = c.log.filter(same("status", report.SUCCESS) & (F.col("job_id") == job_id))
    counted = log if job_id < 4 else report.run_items(log, items.select("job_object_id", "source_id", "job_id"))
    summary = report.run_summary(counted, by=report.RUN)
    groups = run_groups(runs, job_id, topic).join(summary, report.RUN, "left")
    detail = report.success_detail(log, items, c.objects)
    pages = report.success_pages(detail, page_rows, recon_rejects=recon_rejects)
    return report.success_notification(
        groups, pages, routing, server=server, now=now, tail=sequence_text(sequence), recon_rejects=recon_rejects
    )


def failure_report(
    c: Control, errors: DataFrame, runs: DataFrame, routing: DataFrame, *, job_id: int, topic: str, server: str,
    now: dt.datetime, layer: str | None = None, sequence: int | None = None, page_rows: int | Pieces | None = None,
    gate_target: str = GATE_TARGET,
) -> DataFrame:
    """What failed or was skipped in one step.

    Steps 6 and 7 list failures only when the gate table was logged yesterday on the server's clock.
    """
    items = chosen_items(c, job_id, layer, sequence)
    detail = report.failure_detail(items, c.objects, c.log, errors, runs)
    if job_id in (6, 7):
        detail = detail.filter(gate_refreshed(c, now, gate_target))
    return report.failure_notification(
        run_groups(runs, job_id, topic), report.failure_pages(detail, page_rows), routing, server=server, now=now,
        tail=sequence_text(sequence),
    )
