"""The worklists of every load step, each for all requested runs at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import Moment, is_weekend, local_day, processing_month
from loadkeeper.functions.text import in_names, like
from loadkeeper.operators import gates, worklist

RAW, QUALITY, REFINED, CERTIFIED, CURATED, SUMMARIZED, RECON = range(1, 8)

# The gate table of the summarized step, the targets that reload in full after the
# ledger refresh, the targets the recon step keeps after it, and the source and step of that refresh.
GATE_TARGET = "dwh.rpt_general_ledger_fccs"
LEDGER_TARGETS = (
    "dwh.rpt_general_ledger_oracle",
    "dwh.rpt_general_ledger_sap",
    "dwh.rpt_general_ledger_oracle_sl",
)
RECON_KEEP = "dwh.recon_gl%"
REFRESH_SOURCE = 3


@dataclass(frozen=True)
class Control:
    """The control tables a worklist reads."""

    items: DataFrame
    sources: DataFrame
    jobs: DataFrame
    objects: DataFrame
    log: DataFrame
    batches: DataFrame | None = None
    edges: DataFrame | None = None

    def due(self, runs: DataFrame, job_id: int, names=None) -> DataFrame:
        """Enabled items of one step for the runs, narrowed to a name list if there is one."""
        items = self.items.filter(F.col("job_id") == job_id)
        rows = worklist.star(items, self.sources, self.jobs, self.objects)
        return worklist.for_runs(worklist.named(rows, names), runs)

    def done(self, runs: DataFrame) -> DataFrame:
        return gates.succeeded(self.log, runs)

    def latest(self, now: Moment) -> DataFrame:
        return gates.latest_batches(self.batches, now)


def has_names(names) -> bool:
    return names is not None and (isinstance(names, DataFrame) or len(names) > 0)


def raw(c: Control, runs: DataFrame, names=None) -> DataFrame:
    """Source to raw. A name list brings succeeded items back; without one, only pending items."""
    rows = c.due(runs, RAW, names)
    return rows if has_names(names) else gates.pending(rows, c.done(runs))


def after_step(c: Control, runs: DataFrame, job_id: int, upstream_job: int | None, names=None) -> DataFrame:
    """Pending items whose object succeeded in the upstream step; a name list lifts both tests."""
    rows = c.due(runs, job_id, names)
    if has_names(names):
        return rows
    done = c.done(runs)
    rows = gates.pending(rows, done)
    return rows if upstream_job is None else gates.upstream_done(rows, c.items, done, upstream_job)


def quality(c: Control, runs: DataFrame, names=None) -> DataFrame:
    """Raw to quality-checked."""
    return after_step(c, runs, QUALITY, RAW, names)


def refined(c: Control, runs: DataFrame, now: Moment, *, last_run=None, names=None, require_upstream=True) -> DataFrame:
    """Quality-checked to refined; production loads run without the upstream test."""
    rows = after_step(c, runs, REFINED, QUALITY if require_upstream else None, names)
    return worklist.with_bounds(rows, now, last_run)


def certified(
    c: Control, runs: DataFrame, now: Moment, *, layers=("dim", "fact"), last_run=None, names=None
) -> DataFrame:
    """Refined to certified: dimensions in sequence 1, facts in sequence 2."""
    done = c.done(runs)
    rows = worklist.in_layers(c.due(runs, CERTIFIED, names), layers)
    rows = gates.pending(rows, done)
    rows = gates.list_gate(
        rows, c.items, done, runs, job_id=CERTIFIED, name_col="source_object_name", jobs=(REFINED, CERTIFIED)
    )
    layer = F.lower("layer")
    sequence = F.when(layer == "dim", 1).when(layer == "fact", 2).otherwise(0)
    rows = gates.edge_gate(rows, c.edges, c.log, c.latest(now), sequence=sequence)
    return worklist.with_bounds(rows, now, last_run)


def full_load_flag(refreshed: Column, saturday: Column) -> Column:
    """1 on Saturday, or for the ledger targets once their refresh is in; else 0."""
    ledger = in_names("target_object_name", LEDGER_TARGETS)
    return F.when(saturday | (refreshed & ledger), 1).otherwise(0)


def curated(
    c: Control, runs: DataFrame, now: Moment, *, sequence=None, adhoc=False, last_run=None, names=None
) -> DataFrame:
    """Certified to curated; ad-hoc runs skip the list gate and always load in full."""
    done = c.done(runs)
    rows = c.due(runs, CURATED, names)
    if sequence is not None:
        rows = rows.filter(F.col("execution_sequence") == sequence)
    rows = gates.pending(rows, done)
    if not adhoc:
        rows = gates.list_gate(
            rows, c.items, done, runs, job_id=CURATED, name_col="target_object_name", jobs=(REFINED, CERTIFIED, CURATED)
        )
    rows = gates.edge_gate(
        rows, c.edges, c.log, c.latest(now),
        sequence=F.col("execution_sequence"), min_dependent_job=5 if adhoc else None,
    )
    if adhoc:
        flag = F.lit(1)
    else:
        refreshed = gates.all_refreshed_yesterday(c.log, c.items, local_day(now), source_id=REFRESH_SOURCE)
        flag = full_load_flag(refreshed, is_weekend(now))
    return (
        worklist.with_bounds(rows, now, last_run)
        .withColumn("processing_date", processing_month(now, adhoc))
        .withColumn("iscuratedfullload", flag)
    )


def summarized(
    c: Control, runs: DataFrame, now: Moment, *, adhoc=False, last_run=None, names=None, gate_target=GATE_TARGET
) -> DataFrame:
    """Summaries; a regular run needs the gate table logged yesterday and its lists complete."""
    done = c.done(runs)
    rows = gates.pending(c.due(runs, SUMMARIZED, names), done)
    if not adhoc:
        rows = rows.filter(gates.logged_yesterday(c.log, c.items, gate_target, local_day(now)))
        rows = gates.list_gate(
            rows, c.items, done, runs, job_id=SUMMARIZED, name_col="target_object_name", jobs=(REFINED, CERTIFIED, CURATED)
        )
    rows = gates.edge_gate(
        rows, c.edges, c.log, c.latest(now), sequence=F.lit(1), min_dependent_job=5 if adhoc else None
    )
    return worklist.with_bounds(rows, now, last_run)


def recon(c: Control, runs: DataFrame, now: Moment, *, adhoc=False, last_run=None, names=None) -> DataFrame:
    """Reconciliation jobs: after the refresh or on Saturday; the refreshing source itself always.

    Once the refresh is in, only the ledger targets are kept. Ad-hoc runs have no gates.
    """
    done = c.done(runs)
    rows = gates.pending(c.due(runs, RECON, names), done)
    if not adhoc:
        refreshed = gates.all_refreshed_yesterday(c.log, c.items, local_day(now), source_id=REFRESH_SOURCE)
        rows = rows.filter((F.col("source_id") == REFRESH_SOURCE) | refreshed | is_weekend(now))
        rows = rows.filter(~refreshed | like("target_object_name", RECON_KEEP))
        rows = gates.list_gate(
            rows, c.items, done, runs, job_id=RECON, name_col="target_object_name", jobs=(REFINED, CERTIFIED, CURATED, SUMMARIZED)
        )
        rows = gates.edge_gate(rows, c.edges, c.log, c.latest(now), sequence=F.lit(1))
    return worklist.with_bounds(rows, now, last_run)
