"""Every operator as a query over the sample tables. Each takes (spark, folder)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkeeper.functions import clock, text
from loadkeeper.operators import batch, changes, checks, gates, quality, recon, refresh, report, tables, window, worklist
from loadkeeper.operators.joins import Pieces
from loadkeeper.plans import journal, lifecycle, worklists
from loadkeeper.plans.extract import filter_codes, raw_extract
from loadkeeper.session import scratch_dir
from loadkeeper.sources import store, zones
from loadkeeper.sources.control import Tables
from loadkeeper.sources.schemas import SCHEMAS
from loadkeeper.streaming import ingest, readiness, ready

# Tuesday evening in the east; Saturday afternoon in the east (UTC readings).
NOW = "2024-01-03 03:00:00"
SATURDAY = "2024-01-06 20:00:00"
DATASET_BATCHES = list(range(1, 11))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Registers a query under its function name."""
    QUERIES[fn.__name__] = lambda spark, folder: fn(Tables(spark, folder))
    return fn


def of(c, *extra):
    """The columns every worklist query shows."""
    return c.select("batch_id", "job_object_id", "source_name", "table_name", *extra)


BOUNDS = ("target_schema_name", "target_table_name", "valid_last_run_time", "valid_current_run_time")

# ---------------------------------------------------------------- work selection


@query
def raw_worklist(t):
    return of(worklists.raw(t.control(), t.batches), "source_object_name")


@query
def raw_worklist_named(t):
    names = t.customer.select(F.concat(F.lit("Obj_"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("name"))
    return of(worklists.raw(t.control(), t.batches, names), "source_object_name")


@query
def dq_worklist(t):
    return of(worklists.quality(t.control(), t.batches), "source_object_name")


@query
def refined_worklist(t):
    return of(worklists.refined(t.control(), t.batches, NOW), *BOUNDS)


@query
def refined_worklist_unchecked(t):
    return of(
        worklists.refined(t.control(), t.batches, NOW, last_run="2023-12-30 10:20:30.4", require_upstream=False), *BOUNDS
    )


@query
def certified_worklist(t):
    return of(worklists.certified(t.control(), t.batches, NOW), "layer", *BOUNDS)


@query
def curated_worklist(t):
    rows = worklists.curated(t.control(), t.batches, NOW)
    return of(rows, *BOUNDS, F.col("processing_date").cast("string").alias("processing_date"), "iscuratedfullload")


@query
def curated_worklist_sequence(t):
    rows = worklists.curated(t.control(), t.batches, NOW, sequence=2)
    return of(rows, *BOUNDS, F.col("processing_date").cast("string").alias("processing_date"), "iscuratedfullload")


@query
def curated_worklist_saturday(t):
    rows = worklists.curated(t.control(), t.batches, SATURDAY, last_run="1900-01-01 00:00:00")
    return of(rows, *BOUNDS, F.col("processing_date").cast("string").alias("processing_date"), "iscuratedfullload")


@query
def curated_adhoc(t):
    rows = worklists.curated(t.control(), t.batches, NOW, adhoc=True)
    return of(rows, *BOUNDS, F.col("processing_date").cast("string").alias("processing_date"), "iscuratedfullload")


@query
def summarized_worklist(t):
    return of(worklists.summarized(t.control(), t.batches, NOW), *BOUNDS)


@query
def summarized_adhoc(t):
    return of(worklists.summarized(t.control(), t.batches, NOW, adhoc=True), *BOUNDS)


@query
def recon_worklist(t):
    return of(worklists.recon(t.control(), t.batches, NOW), *BOUNDS)


@query
def recon_worklist_saturday(t):
    return of(worklists.recon(t.control(), t.batches, SATURDAY), *BOUNDS)


@query
def recon_adhoc(t):
    return of(worklists.recon(t.control(), t.batches, NOW, adhoc=True), *BOUNDS)


@query
def active_files(t):
    return worklist.file_list(t.items, source_id=3)


@query
def enabled_items(t):
    return worklist.enabled_list(t.items, "enabled", "job_object_id", "source_object_name", "target_object_name")


# ---------------------------------------------------------------- gates


@query
def list_dependency_gate(t):
    c = t.control()
    items = worklist.for_runs(t.items.filter("job_id >= 5 AND enabled = 1"), t.batches)
    state = gates.list_gate_state(
        items, t.items, c.done(t.batches), t.batches, name_col="target_object_name", jobs=(3, 4, 5, 6)
    )
    ready = F.col("expected_count") == F.col("met_count")
    return state.select("batch_id", "job_object_id", "expected_count", "met_count", ready.alias("ready"))


@query
def latest_batch_today(t):
    return gates.latest_batches(t.batches, NOW)


@query
def edge_gate_null_aware(t):
    c = t.control("edges_null")
    items = worklist.for_runs(t.items.filter("job_id >= 4"), t.batches)
    kept = gates.edge_gate(items, c.edges, c.log, c.latest(NOW), sequence=F.col("execution_sequence"))
    return kept.select("batch_id", "job_object_id")


@query
def edges_complete(t):
    return gates.edge_status(t.edges, t.log, gates.latest_batches(t.batches, NOW))


@query
def edges_logged(t):
    return gates.edge_status(
        t.edges, t.log, gates.latest_batches(t.batches, NOW), require_success=False, min_dependent_job=5
    )


@query
def edges_missing(t):
    rows = gates.missing_edges(t.edges, t.log, gates.latest_batches(t.batches, NOW))
    return rows.select("dependency_id", "source_id", "job_object_id", "dependent_job_object_id")


@query
def drain_check(t):
    return gates.drain_days(t.history).withColumn("trigger_day", F.col("trigger_day").cast("string"))


# ---------------------------------------------------------------- incremental window


@query
def window_rows(t):
    rows = window.window_filter(t.events, "ts", "2024-01-05 06:30:59", "2024-01-20 18:45:30.5")
    return rows.select("event_id", "user_id", "event_type", clock.milli_text(F.col("ts")).alias("ts"))


@query
def two_column_window(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = window.window_filter(rows, "l_shipdate", "1998-01-01", "2000-06-30 12:00:00", extra_col="o_orderdate")
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n_rows"), F.sum("l_partkey").alias("sum_part"))


@query
def two_column_zones(t):
    folder = _scratch(t)
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_suppkey", "l_partkey", "l_shipdate", "o_orderdate")
    map_ = zones.Zones(t.spark, f"{folder}/data", f"{folder}/zones", ("l_shipdate", "o_orderdate"))
    # two loads, each of them in files by date; the map takes in the files of a load when it is refreshed
    for k in range(2):
        part = rows.filter(f"l_partkey % 2 = {k}").repartitionByRange(8, "l_shipdate")
        part.write.mode("append").parquet(f"{folder}/data")
        map_.refresh()
    found = map_.window("l_shipdate", "1998-01-01", "2000-06-30 12:00:00", extra_col="o_orderdate")
    return found.groupBy("l_suppkey").agg(F.count("*").alias("n_rows"), F.sum("l_partkey").alias("sum_part"))


def _extract(t, hist, two_columns=True, **bounds):
    rows = raw_extract(
        t.control(), t.batches, packed_codes=t.packed_codes, segment_codes=t.segment_codes, history_keys=t.history_keys,
        thresholds=t.thresholds, etl_start="2024-01-03 03:04:05.678", hist=hist, two_columns=two_columns, **bounds,
    )
    return rows.select(
        "batch_id", "job_object_id", "source_filter_final", "target_object_path_final", "threshold", "varCurrentRundt"
    )


@query
def window_query_text(t):
    return _extract(t, False)


@query
def window_query_text_bounds(t):
    return _extract(t, False, last_run="2023-06-01 10:20:30", current_run="2023-12-31 23:59:59.5")


@query
def window_query_text_hist(t):
    return _extract(t, True)


@query
def window_query_text_older(t):
    return _extract(t, True, two_columns=False)


@query
def code_list_text(t):
    codes = filter_codes(t.packed_codes, t.segment_codes)
    # items come from few splits of a small file; dealt out while they are narrow, before the texts are made
    rows = t.items.filter("source_filter IS NOT NULL").select("job_object_id", "source_filter").hint("rebalance")
    return rows.select("job_object_id", window.filter_text(codes).alias("filter_text"))


@query
def code_list_semi(t):
    rows = window.code_semi(t.lineitem, t.packed_codes, {"l_suppkey": "werks"})
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("sum_order"))


@query
def code_list_prefilter(t):
    """Codes as many as orders, against the larger table."""
    codes = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey")
    rows = window.code_semi(t.lineitem, codes, {"l_orderkey": "o_orderkey"}, prefilter=True)
    return rows.groupBy("l_suppkey").agg(F.count("*").alias("n_rows"), F.sum("l_orderkey").alias("sum_order"))


@query
def historical_union(t):
    columns = ["l_orderkey", "l_suppkey", "l_partkey", "l_linenumber"]
    recent = window.window_filter(t.lineitem, "l_shipdate", "2000-01-01", "2001-01-01").select(*columns)
    rows = window.with_history(
        t.lineitem, recent, code_col="l_suppkey", codes=t.supplier.filter("s_acctbal > 0").select("s_suppkey"),
        key_col="l_orderkey", keys=t.orders.filter("o_orderstatus = 'P'").select("o_orderkey"),
    )
    return rows.select(*columns)


@query
def shifted_bound(t):
    upper = F.to_timestamp_ntz(F.lit("2024-03-31 22:10:00"))
    return t.items.select("job_object_id", clock.milli_text(window.shifted_upper(upper)).alias("bound"))


@query
def target_path(t):
    return t.items.select("job_object_id", window.target_path("target_object_path", "2024-03-10 02:30:00").alias("path"))


def _loads(t):
    return t.log.select(
        "job_object_id", "source_row_count", "target_row_count", F.col("object_end_date").alias("batch_start_date")
    )


@query
def watermark_advance(t):
    rows = tables.advance_watermark(t.items, _loads(t))
    return rows.select("job_object_id", clock.milli_text(F.col("last_run_time")).alias("last_run_time"))


@query
def guarded_watermark(t):
    moved, _ = tables.advance_watermark_guarded(t.items, _loads(t))
    return moved.select("job_object_id", clock.milli_text(F.col("last_run_time")).alias("last_run_time"))


@query
def guarded_watermark_rejects(t):
    _, failed = tables.advance_watermark_guarded(t.items, _loads(t))
    return failed.groupBy("job_object_id", "error_message").agg(F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- calendar and flags


@query
def weekend_flag(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        clock.local_day(ts).cast("string").alias("eastern_day"),
        clock.is_weekend(ts).alias("is_saturday"),
        clock.is_weekend(ts, (clock.SATURDAY, clock.SUNDAY)).alias("is_weekend"),
    )


@query
def processing_month(t):
    return t.events.select("event_id", clock.processing_month(F.col("ts")).cast("string").alias("processing_month"))


@query
def refresh_flag(t):
    gate = t.items.filter("source_id = 3 AND job_id = 5 AND enabled = 1")
    expected = gate.agg(F.count("job_object_id")).scalar()
    days = gates.gate_days(t.log, gate)
    return days.select(
        F.date_add("log_day", 1).cast("string").alias("day"), "n_rows", (F.col("n_rows") > 0).alias("logged_yesterday"),
        (F.col("n_rows") == expected).alias("refreshed_yesterday"),
    )


@query
def load_mode(t):
    refreshed = gates.all_refreshed_yesterday(t.log, t.items, clock.local_day(NOW))
    return t.items.filter("job_id = 5").select(
        "job_object_id",
        worklists.full_load_flag(refreshed, clock.is_weekend(NOW)).alias("weekday_flag"),
        worklists.full_load_flag(refreshed, clock.is_weekend(SATURDAY)).alias("saturday_flag"),
    )


@query
def name_split(t):
    name = "target_object_name"
    return t.items.select(
        "job_object_id", text.schema_part(name).alias("schema_name"), text.table_part(name).alias("table_name")
    )


# ---------------------------------------------------------------- batch life cycle


def _requests(t):
    return t.sources.select(
        "source_id", (F.col("source_id") % 2).alias("is_rerun"),
        F.when(F.col("source_id") == 4, F.lit(None)).otherwise(F.lit("active ")).alias("requested_status"),
    )


@query
def batch_decision(t):
    return batch.batch_decision(t.history, _requests(t)).select(
        "source_id", "last_batch_id", "last_status", "decision", "batch_id"
    )


@query
def batch_open(t):
    return batch.open_batches(t.history, _requests(t), start=NOW).select("batch_id", "source_id", "batch_run_status")


def _rollup(t, expected):
    return batch.batch_rollup(t.batches, t.log, t.items, expected)


def _refreshed(t, now):
    return lifecycle.gate_refreshed(t.control(), now)


@query
def batch_rollup(t):
    return _rollup(t, batch.expected_regular(_refreshed(t, NOW), NOW))


@query
def batch_rollup_saturday(t):
    return _rollup(t, batch.expected_regular(_refreshed(t, SATURDAY), SATURDAY))


@query
def batch_rollup_weekday(t):
    return _rollup(t, batch.expected_regular(F.lit(False), NOW))


@query
def batch_rollup_adhoc(t):
    return _rollup(t, batch.expected_adhoc(_refreshed(t, NOW)))


@query
def dataset_rollup(t):
    return batch.dataset_rollup(t.batches, t.log, t.datasets, batch.expected_datasets(NOW))


@query
def dataset_rollup_weekend(t):
    return batch.dataset_rollup(t.batches, t.log, t.datasets, batch.expected_datasets("2024-01-07 20:00:00"))


@query
def batch_close(t):
    closing = t.lineitem.groupBy(F.col("l_orderkey").alias("batch_id")).agg(
        F.max("l_shipdate").alias("batch_end_date"),
        F.when(F.max("l_linenumber") > 5, F.lit("Failed")).alias("batch_run_status"),
    )
    history = t.history.withColumn("batch_end_date", F.lit(None).cast("timestamp_ntz"))
    rows = batch.close_batches(history, closing)
    return rows.select("batch_id", clock.milli_text(F.col("batch_end_date")).alias("batch_end_date"), "batch_run_status")


def _closing(t):
    """The control tables with open batches, and the requests to close them."""
    closing = t.batches.select(
        "batch_id", F.col("batch_start_date").alias("batch_end_date"), F.lit("done").alias("batch_log_message"),
        F.when(F.col("batch_id") % 3 == 0, "Failed").otherwise("successfully completed").alias("batch_run_status"),
    )
    batches = t.batches.withColumns(
        {"batch_end_date": F.lit(None).cast("timestamp_ntz"), "batch_log_message": F.lit(None).cast("string"),
         "batch_run_status": F.lit("Active")}
    )
    return replace(t.control(), batches=batches), closing


@query
def batch_close_rollup(t):
    c, closing = _closing(t)
    return lifecycle.close_batches(c, closing, now=NOW).select("batch_id", "batch_log_message", "batch_run_status")


@query
def batch_finish(t):
    c, closing = _closing(t)
    rows = lifecycle.finish_batches(c, closing, batch.expected_adhoc(F.lit(True)))
    return rows.withColumns({c: clock.milli_text(F.col(c)) for c in ("batch_start_date", "batch_end_date")})


@query
def failure_rows(t):
    failures = t.events.select(
        "event_id", F.concat(F.lit("step "), F.repeat("event_type", 12)).alias("activity"),
        F.lit(50010).alias("error_code"), F.repeat("props", 30).alias("error_message"),
    )
    rows = batch.failure_rows(failures, _datetime(NOW))
    return rows.withColumn("log_date", clock.milli_text(F.col("log_date")))


@query
def audit_rows(t):
    rows = store.conform(t.log.withColumn("log_id", F.lit(1)), SCHEMAS["audit_log"])
    shown = rows.groupBy("batch_id", "status", "log_id", "query").agg(
        F.sum("target_row_count").alias("target_row_count"), F.max("job_object_id").alias("job_object_id")
    )
    return shown


@query
def audit_fix(t):
    corrections = t.errors.select(
        "source_id", "job_id", "job_object_id", "batch_id", F.coalesce("error_subtype", F.lit("corrected")).alias("status"),
        F.struct("log_date", "error_log_id").alias("at"),
    )
    fixed = batch.fix_status(t.log, corrections, order="at")
    return fixed.groupBy("batch_id", "job_id", "status").agg(F.count("*").alias("n_rows"))


# ---------------------------------------------------------------- logs with several writers


def _scratch(t):
    """A folder of this query's own, in the one all executors share."""
    return f"{scratch_dir(t.spark)}/journals/{uuid.uuid4().hex}"


def _twice(commit):
    """A driver that is lost after its commit does the same again."""
    commit()
    commit()


def _appended(t, part="true"):
    """The sample log as an audit ledger, in three commits, each of them repeated."""
    log = journal.audit_log(t.spark, _scratch(t))
    for k in range(3):
        _twice(lambda k=k: log.append(t.log.filter(f"batch_id % 3 = {k} AND {part}"), f"load-{k}"))
    return log


@query
def audit_append(t):
    rows = _appended(t).read()
    return rows.select(
        "batch_id", F.col("job_object_id").cast("bigint").alias("job_object_id"), "status", "source_row_count", "target_row_count",
        "target_size", "query", clock.milli_text(F.col("object_end_date")).alias("object_end_date"),
    )


@query
def audit_identity(t):
    return _appended(t).read().agg(
        F.count("*").alias("n_rows"), F.countDistinct("log_id").alias("n_ids"),
        F.min("log_id").cast("bigint").alias("first_id"), F.max("log_id").cast("bigint").alias("last_id"),
    )


@query
def error_append(t):
    log = journal.error_log(t.spark, _scratch(t))
    _twice(lambda: log.append(t.errors.filter("batch_id <= 5"), "first"))
    _twice(lambda: log.append(t.errors.filter("batch_id > 5"), "second"))
    return log.read().select(
        "batch_id", F.col("job_object_id").cast("bigint").alias("job_object_id"), "error_type", "error_subtype", "method_name",
        clock.milli_text(F.col("log_date")).alias("log_date"),
    )


@query
def step_append(t):
    steps = t.log.select(
        "batch_id", "job_id", "job_object_id", F.concat(F.lit("step_"), F.col("job_id").cast("string")).alias("step_name"),
        F.col("object_start_date").alias("start_time"), F.col("object_end_date").alias("end_time"),
        F.col("target_row_count").alias("row_count"),
    )
    log = journal.step_log(t.spark, _scratch(t))
    _twice(lambda: log.append(steps, "timings"))
    shown = log.read().groupBy("batch_id", "step_name")
    return shown.agg(
        F.count("*").alias("n_rows"), F.sum("row_count").alias("row_count"),
        clock.milli_text(F.min("start_time")).alias("first_start"), clock.milli_text(F.max("end_time")).alias("last_end"),
    )


@query
def batch_open_writers(t):
    batches = journal.batch_table(t.spark, _scratch(t))
    batches.append(t.history, "history")
    _twice(lambda: journal.open_batches(batches, _requests(t), "first writer", start=NOW))
    journal.open_batches(batches, _requests(t), "second writer", start=NOW)
    return batches.read().select("batch_id", F.col("source_id").cast("bigint").alias("source_id"), "batch_run_status")


def _corrections(t):
    return t.errors.select(
        "source_id", "job_id", "job_object_id", "batch_id", F.coalesce("error_subtype", F.lit("corrected")).alias("status"),
        F.struct("log_date", "error_log_id").alias("at"),
    )


@query
def audit_fix_settings(t):
    log = _appended(t)
    _twice(lambda: journal.correct_status(log, _corrections(t), "corrections", order="at"))
    shown = log.read().groupBy("batch_id", F.col("job_id").cast("bigint").alias("job_id"), "status")
    return shown.agg(F.count("*").alias("n_rows"))


@query
def watermark_settings(t):
    items = journal.item_table(t.spark, _scratch(t))
    items.append(t.items, "items")
    journal.advance_watermarks(items, _loads(t).filter("job_object_id % 2 = 0"), "even loads")
    items.compact(share=0.0)
    journal.advance_watermarks(items, _loads(t).filter("job_object_id % 2 <> 0"), "odd loads")
    return items.read().select(
        F.col("job_object_id").cast("bigint").alias("job_object_id"), clock.milli_text(F.col("last_run_time")).alias("last_run_time")
    )


def _kept_gates(t):
    """Gate counts kept up to date from the commits: two loads, corrections of what they wrote, one more load."""
    root = _scratch(t)
    log = journal.audit_log(t.spark, root)
    kept = journal.Gates(log, root)
    for k in range(2):
        log.append(t.log.filter(f"batch_id % 3 = {k}"), f"load-{k}")
        kept.refresh()
    success = F.when(F.col("job_object_id") % 2 == 0, F.lit("SUCCESS ")).otherwise(F.col("status"))
    journal.correct_status(log, _corrections(t).withColumn("status", success), "corrections", order="at")
    log.append(t.log.filter("batch_id % 3 = 2"), "load-2")
    kept.refresh()
    return kept


@query
def gates_kept_edges(t):
    latest = gates.latest_batches(t.batches, NOW)
    return gates.edge_status(t.edges, _kept_gates(t).as_log(), latest)


@query
def gates_kept_items(t):
    rows = _kept_gates(t).as_log()
    return rows.select("batch_id", F.col("job_object_id").cast("bigint").alias("job_object_id"), F.col("status").isNotNull().alias("succeeded"))


# ---------------------------------------------------------------- streams


def _arrive(parts, folder):
    """Parts of a table as files that come one after the other, each of them seen by a stream that starts and ends."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        yield


@query
def ready_streamed(t):
    folder = _scratch(t)
    rows = t.log.select("batch_id", "job_object_id", "status")
    # the first load comes twice, and every load is met by a stream that starts where the last one stopped
    for _ in _arrive([rows.filter(f"batch_id % 3 = {k}") for k in (0, 0, 1, 2)], f"{folder}/log"):
        log = readiness.log_stream(t.spark, f"{folder}/log", rows.schema)
        ready.watch(log, t.edges, t.batches, f"{folder}/ready", checkpoint=f"{folder}/state").awaitTermination()
    found = t.spark.read.schema(ready.READY).parquet(f"{folder}/ready")
    return found.withColumn("day", F.col("day").cast("string"))


def _feed(t):
    """Orders as change rows: each comes in, finished ones are updated a day later, the rest of them go a day after that."""
    row = lambda status: F.struct("o_orderkey", "o_custkey", status.alias("o_orderstatus"))
    new, old = F.col("o_orderstatus"), F.lit("O")
    no_row = F.when(F.lit(False), row(old))
    day = lambda n: F.col("o_orderdate") + F.make_dt_interval(days=F.lit(n))
    steps = F.array(
        F.struct(F.lit(0).alias("step"), day(0).alias("at"), no_row.alias("before"), row(old).alias("after")),
        F.struct(F.lit(1).alias("step"), day(1).alias("at"), row(old).alias("before"), row(new).alias("after")),
        F.struct(F.lit(2).alias("step"), day(2).alias("at"), row(new).alias("before"), no_row.alias("after")),
    )
    kept = F.filter(steps, lambda s: (s["step"] == 0) | ((s["step"] == 1) & (new != "O")) | ((s["step"] == 2) & (new == "P")))
    rows = t.orders.select("o_orderkey", F.inline(kept))
    return rows.select(
        "before", "after", F.col("at").cast("timestamp").alias("changed_at"),
        F.format_string("%d-%d", "o_orderkey", "step").alias("change_id"),
    )


def _fed(t):
    """The audit rows of a feed whose rows come up to twenty days late, and some of them twice."""
    folder, feed = _scratch(t), _feed(t)
    late = F.crc32(F.col("change_id").cast("binary")) % 3
    # a row comes with its own quarter of the time, or with that of twenty days later, or with both
    day = F.unix_date(F.to_date("changed_at"))
    first, last = feed.agg(F.min(day), F.max(day) + 20).first()
    quarter = lambda days: F.floor((day + days - first) * 4 / (last - first + 1))
    parts = (
        feed.filter((quarter(0) == n) & (late != 1)).unionByName(feed.filter((quarter(20) == n) & (late != 0))) for n in range(4)
    )
    for _ in _arrive(parts, f"{folder}/feed"):
        stream = t.spark.readStream.schema(feed.schema).parquet(f"{folder}/feed")
        ingest.audit_feed(
            stream, f"{folder}/audit", user="feed", change_id="change_id", at="changed_at", delay="30 days", checkpoint=f"{folder}/state"
        ).awaitTermination()
    return t.spark.read.parquet(f"{folder}/audit")


@query
def change_feed(t):
    return _fed(t).withColumn("modify_date", clock.milli_text(F.col("modify_date").cast("timestamp_ntz")))


@query
def change_feed_replay(t):
    return changes.replay(_fed(t), ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def ingest_stream(t):
    folder = _scratch(t)
    rows = t.events.select("event_id", "user_id", "event_type", "ts")
    for _ in _arrive([rows.filter(f"event_id % 3 = {k}") for k in range(3)], f"{folder}/in"):
        ingest.ingest(
            t.spark, f"{folder}/in", rows.schema, f"{folder}/out", checkpoint=f"{folder}/state", column="ts",
            lower="2024-01-05 06:30:59", upper="2024-01-20 18:45:30.5",
        ).awaitTermination()
    found = t.spark.read.schema(rows.schema).parquet(f"{folder}/out")
    return found.withColumn("ts", clock.milli_text(F.col("ts")))


def _changes(t, compare):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    old = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01 00:00:00'").select(*columns)
    new = t.orders.filter("o_orderpriority <> '5-LOW'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus"))
    )
    rows = compare(old, new.select(*columns), ["o_orderkey"], user="loader", now=NOW, skip=["o_custkey"])
    return rows.withColumn("modify_date", clock.milli_text(F.col("modify_date")))


@query
def row_change_audit(t):
    return _changes(t, changes.row_changes)


@query
def row_change_ranges(t):
    return _changes(t, changes.row_changes_by_range)


@query
def schema_drift(t):
    base = t.part.select(
        F.col("p_type").alias("owner"), F.concat(F.lit("tab_"), (F.col("p_partkey") % 40).cast("string")).alias("table_name"),
        F.concat(F.lit("c_"), F.col("p_partkey").cast("string")).alias("column_name"), "p_partkey",
        F.col("p_size").alias("data_length"), F.lit("Y").alias("nullable"),
    )
    old = base.filter("p_partkey % 13 <> 1").withColumn("data_type", F.lit("varchar"))
    new = (
        base.filter("p_partkey % 11 <> 2")
        .withColumn("column_name", F.upper("column_name"))
        .withColumn("data_type", F.when(F.col("p_partkey") % 7 == 0, "number").otherwise("VARCHAR"))
    )
    return changes.schema_drift(old, new)


@query
def domain_check(t):
    rows = changes.domain_violations(
        t.errors, {"error_type": changes.ERROR_TYPES, "error_subtype": changes.ERROR_SUBTYPES}
    )
    return rows.select("error_log_id", "error_type", "error_subtype", F.concat_ws(",", "violations").alias("violations"))


# ---------------------------------------------------------------- reconciliation and reports


@query
def stage_reconcile(t):
    return recon.stage_reconcile(t.stage_log, t.items, t.objects)


@query
def stage_verdict(t):
    return recon.stage_verdict(recon.stage_compare(t.stage_log, t.items, t.objects))


def _three_layers(t):
    rows = t.lineitem
    layers = {
        "rpt": rows,
        "certified": rows.filter("NOT (l_returnflag = 'R' AND l_linenumber = 7)"),
        "refined": rows.filter("l_linestatus = 'F' OR l_discount < 0.1"),
    }
    measures = {
        "cum_acquisition_value": F.floor("l_extendedprice"),
        "accum_depreciation": F.floor("l_quantity"),
        "depreciation": F.col("l_linenumber"),
    }
    return recon.layer_reconcile(layers, ["l_suppkey"], measures, tolerance="1500")


@query
def three_layer_recon(t):
    return _three_layers(t)


@query
def three_layer_report(t):
    return report.layer_pages(_three_layers(t), "l_suppkey", "cum_acquisition_value", page_rows=40)


@query
def run_summary(t):
    return report.run_summary(t.log)


@query
def run_summary_by_sequence(t):
    rows = report.run_items(
        t.log.filter(text.same("status", "success")),
        t.items.select("job_object_id", "source_id", "job_id", "execution_sequence", "target_object_name"),
    )
    rows = worklist.in_layers(rows, ("dim", "fact", "rpt"))
    return report.run_summary(rows, by=("batch_id", "source_id", "job_id", "execution_sequence", "layer"))


@query
def success_detail(t):
    rows = report.success_detail(t.log, t.items, t.objects, null_counts_as_zero=True)
    return rows.drop("target_object_name", "execution_sequence")


@query
def failure_detail(t):
    return report.failure_detail(t.items, t.objects, t.log, t.errors, t.batches).drop("target_object_name")


@query
def dataset_success(t):
    return report.dataset_success(_dataset_log(t.log), t.datasets)


@query
def dataset_failure(t):
    return report.dataset_failure(
        t.datasets, _dataset_log(t.log), _dataset_log(t.errors), DATASET_BATCHES, source_id=99, months=refresh.from_month("2024-01-03 03:00:00")
    )


def _topics(groups):
    return groups.withColumn("topic", F.concat(F.lit("Step_"), F.col("job_id").cast("string")))


def _failed_notification(t, cut=None):
    detail = report.failure_detail(t.items, t.objects, t.log, t.errors, t.batches)
    groups = _topics(
        t.batches.select("batch_id", "source_id").join(t.items.select("source_id", "job_id").distinct(), "source_id")
    )
    return report.failure_notification(
        groups, report.failure_pages(detail, cut), t.routing, server="srv", now=_datetime(NOW)
    )


@query
def notification_failed(t):
    return _failed_notification(t)


@query
def notification_failed_pieces(t):
    return _failed_notification(t, Pieces(25))


def _success_notification(t, cut=None):
    detail = report.success_detail(t.log, t.items, t.objects)
    groups = _topics(report.run_summary(t.log).filter("status = 'success'").drop("status"))
    return report.success_notification(
        groups, report.success_pages(detail, cut), t.routing, server="srv", now=_datetime(NOW)
    )


@query
def notification_success(t):
    return _success_notification(t)


@query
def notification_success_pieces(t):
    return _success_notification(t, Pieces(25))


@query
def step_success_report(t):
    return lifecycle.success_report(
        t.control(), t.batches, t.routing, job_id=5, topic="step_5", server="srv", now=_datetime(NOW), layer="rpt", sequence=1
    )


@query
def recon_success_report(t):
    return lifecycle.success_report(
        t.control(), t.batches, t.routing, job_id=7, topic="step_7", server="srv", now=_datetime(NOW), recon_rejects=True
    )


@query
def step_failure_report(t):
    return lifecycle.failure_report(
        t.control(), t.errors, t.batches, t.routing, job_id=7, topic="step_7", server="srv", now=_datetime("2024-01-02 03:00:00")
    )


@query
def stage_notification(t):
    compared = recon.stage_compare(t.stage_log, t.items, t.objects)
    pages = report.stage_pages(compared.filter("raw_dq_differ OR dq_refined_differ"))
    return report.stage_notification(
        recon.stage_verdict(compared, t.batches), pages, t.routing, topic="step_3", status="failed", server="srv", now=_datetime(NOW)
    )


def _dataset_log(df):
    """Log rows keyed by dataset entry: seven steps of an object stand for one entry."""
    return df.withColumn("job_object_id", F.floor(F.col("job_object_id") / 7)).withColumn("source_id", F.lit(99).cast("bigint"))


@query
def dataset_notification_success(t):
    log = _dataset_log(t.log)
    groups = (
        t.batches.select("batch_id").join(report.dataset_summary(log, t.datasets), "batch_id", "left")
        .withColumns({"source_id": F.lit(99), "topic": F.lit("step_1")})
    )
    pages = report.dataset_pages(report.dataset_success(log, t.datasets), failed=False)
    return report.dataset_notification(groups, pages, t.routing, failed=False, server="srv", now=_datetime(NOW))


@query
def dataset_notification_failed(t):
    detail = report.dataset_failure(t.datasets, _dataset_log(t.log), _dataset_log(t.errors), DATASET_BATCHES, source_id=99)
    groups = t.batches.select("batch_id").withColumns({"source_id": F.lit(99), "topic": F.lit("step_1")})
    pages = report.dataset_pages(detail, failed=True)
    return report.dataset_notification(groups, pages, t.routing, failed=True, server="srv", now=_datetime(NOW))


def _datetime(value: str) -> dt.datetime:
    return dt.datetime.fromisoformat(value)


@query
def lineage(t):
    return report.lineage(t.items, t.jobs, t.sources, t.objects, t.log, t.errors, t.mapping, t.batches)


@query
def unknown_names(t):
    names = t.customer.select(F.concat(F.lit("Obj_"), (F.col("c_custkey") * 2).cast("string")).alias("name"))
    return report.unknown_names(names, t.objects, "table_name")


@query
def name_check(t):
    names = t.customer.select(F.concat(F.lit("Obj_"), (F.col("c_custkey") * 2).cast("string")).alias("name"))
    return report.name_check(names, t.objects, "table_name")


def _files(t):
    expected = worklist.file_list(t.items, source_id=3)
    arrived = t.customer.select(F.concat(F.lit("OBJ_"), F.col("c_custkey").cast("string"), F.lit("_1")).alias("filename"))
    return report.file_arrival(expected, arrived)


@query
def file_arrival(t):
    return _files(t)


@query
def arrival_message(t):
    return report.arrival_message(_files(t))


# ---------------------------------------------------------------- dataset refresh


@query
def dataset_list(t):
    return refresh.dataset_list(t.datasets, t.log, DATASET_BATCHES, saturday=False)


@query
def dataset_list_saturday(t):
    return refresh.dataset_list(t.datasets, t.log, DATASET_BATCHES, saturday=True)


@query
def refresh_plan_full(t):
    return refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES)


@query
def refresh_plan_month(t):
    return refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES, mode="months", now="2024-01-03 03:00:00")


@query
def refresh_plan_partition(t):
    return refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES, mode="partition", partition="2023-7")


@query
def refresh_plan_quarter(t):
    return refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES, mode="quarters")


@query
def recalc_list(t):
    return refresh.recalc_entries(t.datasets, t.log, DATASET_BATCHES)


@query
def refresh_payload(t):
    entries = refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES)
    return refresh.full_payload(entries, t.datasets)


@query
def refresh_payload_asked(t):
    entries = refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES, mode="partition", partition="2023-7")
    return refresh.full_payload(entries, t.datasets, asked=refresh.for_batches(t.datasets, DATASET_BATCHES))


@query
def refresh_payload_paged(t):
    entries = refresh.plan_entries(t.datasets, t.log, DATASET_BATCHES)
    return refresh.full_payload(entries, t.datasets, max_objects=7)


@query
def refresh_payload_quarter(t):
    return refresh.quarter_plan(t.datasets, DATASET_BATCHES)


@query
def recalc_payload(t):
    return refresh.calculate_payload(refresh.recalc_entries(t.datasets, t.log, DATASET_BATCHES))


# ---------------------------------------------------------------- text, quality, upsert


@query
def camel_case(t):
    return t.documents.select("doc_id", text.camel_case("text").alias("camel"))


DOCUMENT_RULES = [
    quality.Rule("text", nullable=False, length=3000, column_id=1),
    quality.Rule("lang", nullable=False, alphanumeric=True, column_id=2),
    quality.Rule("source", alphanumeric=True, column_id=3),
    quality.Rule("n_chars", data_type="smallint", range_expression="n_chars between 100 and 9000", column_id=4),
]


@query
def dq_split(t):
    _, rejected = quality.quality_split(t.documents, DOCUMENT_RULES)
    return rejected.select("doc_id", F.concat_ws(",", "dq_errors").alias("dq_errors"))


@query
def dq_counts(t):
    rules = [
        quality.Rule("l_quantity", range_expression="l_quantity between 3 and 48"),
        quality.Rule("l_returnflag", nullable=False, length=1),
        quality.Rule("l_shipdate", range_expression="l_shipdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00'"),
    ]
    return quality.quality_counts(quality.quality_errors(t.lineitem, rules), by=["l_suppkey"])


LINE_KEY = ["l_orderkey", "l_linenumber"]


@query
def dq_duplicates(t):
    rows = t.lineitem.select(*LINE_KEY, "l_shipdate", "l_partkey", "l_suppkey")
    kept = quality.keep_first(rows, LINE_KEY, ["l_shipdate", "l_partkey"])
    return kept.withColumn("l_shipdate", clock.milli_text(F.col("l_shipdate")))


@query
def dq_duplicate_counts(t):
    return quality.duplicate_counts(t.lineitem, LINE_KEY)


@query
def dq_duplicate_rejects(t):
    rows = t.lineitem.select(*LINE_KEY, "l_shipdate", "l_partkey", "l_suppkey")
    rejected = quality.rejected_duplicates(rows, LINE_KEY, ["l_shipdate", "l_partkey"])
    return rejected.withColumn("l_shipdate", clock.milli_text(F.col("l_shipdate")))


ORDER_RULES = [
    quality.Rule("o_orderkey", target="order_id", data_type="bigint", column_id=1),
    quality.Rule("o_orderpriority", target="priority_code", expression="split(o_orderpriority, '-')[0]", data_type="int", column_id=2),
    quality.Rule("o_orderstatus", target="status", expression="lower(o_orderstatus)", column_id=3),
    quality.Rule("o_orderdate", target="order_year", expression="year(o_orderdate)", data_type="bigint", column_id=4),
]


@query
def mapping_projection(t):
    return quality.map_columns(t.orders, ORDER_RULES)


def _upsert(t):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'").select(*columns)
    new = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus"))
    )
    return quality.upsert(target, new.select(*columns), ["o_orderkey"])


@query
def upsert_rows(t):
    return _upsert(t)


@query
def upsert_history(t):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    target = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'").select(
        *columns, F.col("o_orderdate").alias("valid_from"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate")).alias("valid_to"),
    )
    new = t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus"))
    )
    rows = quality.upsert_history(target, new.select(*columns), ["o_orderkey"], now=clock.wall(NOW))
    return rows.withColumns({c: clock.milli_text(F.col(c)) for c in ("valid_from", "valid_to")})


@query
def upsert_counts(t):
    return quality.upsert_counts(_upsert(t))


@query
def delete_by_identifier(t):
    rows = quality.delete_rows(t.log, "status = 'failed'")
    return rows.groupBy("batch_id", "status").agg(F.count("*").alias("n_rows"))


@query
def upsert_latest(t):
    """Lines since 1996 as changes of what each supplier last delivered of a part; of many changes the last shipped counts."""
    columns, key = ["l_partkey", "l_suppkey", "l_quantity", "l_returnflag"], ["l_partkey", "l_suppkey"]
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    old = t.lineitem.filter("l_shipdate < TIMESTAMP_NTZ '1997-01-01 00:00:00'")
    target = tables.last_changes(old, key, columns[2:], order, "row").select(*key, "row.*")
    changed = t.lineitem.filter("l_shipdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00'").select(*columns, *order)
    return quality.upsert(target, changed, key, order=order)


@query
def parameter_checks(t):
    """A requested run per order, judged by the known batches and steps, its flags and dates."""
    number, day = F.col("o_orderkey"), F.col("o_orderdate")
    text_of = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    requests = t.orders.select(
        F.col("o_orderkey").alias("request_id"),
        F.when(number % 17 != 0, number % 14).alias("batch_id"),
        (number % 7).alias("source_id"),
        (number % 5 + 1).alias("job_id"),
        F.when(number % 11 == 0, "running").when(number % 3 == 0, "Failed ").otherwise("success").alias("status"),
        F.when(number % 23 == 0, 2).when(number % 2 == 0, 1).alias("is_rerun"),
        F.when(F.col("o_orderstatus") != "P", day).alias("etl_start"),
        F.when(number % 13 == 0, "yesterday").when(number % 4 != 0, text_of(day + F.expr("make_dt_interval(CAST(o_orderkey % 9 AS INT) - 7)"))).alias("last_run"),
        F.when(number % 19 == 0, "31.12.").when(number % 5 != 0, text_of(day + F.expr("make_dt_interval(CAST(o_orderkey % 8 AS INT) - 5)"))).alias("current_run"),
    )
    judged = checks.verdicts(requests, t.batches, t.items)
    return judged.select("request_id", "message", "code")


def _mapping(t):
    """The mapping rows of three order columns, as the metadata table holds them."""
    schema = SCHEMAS["object_column_mapping"]
    flags = {
        "o_orderkey": {"is_nullable": "N", "range_expression": "o_orderkey % 97 <> 0", "range_key_flag": 1},
        "o_orderstatus": {"null_check_nk_combination_flag": 1, "alphanumeric_key_flag": 1},
        "o_clerk": {"null_check_nk_combination_flag": 1, "length": 14, "length_key_flag": 1},
    }
    rows = [
        {"col_mapping_key": n, "job_object_id": 1, "object_id": 1, "actv_flg": "Y", "source_column_name": c, "target_column_name": c, "column_id": n} | more
        for n, (c, more) in enumerate(flags.items(), 1)
    ]
    return t.orders.sparkSession.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def _mapped(t):
    """Orders checked by their mapping rows and written once, the failed ones apart."""
    gone = lambda c, value: F.when(F.col(c) != value, F.col(c)).alias(c)
    clerk = F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("Clerk#"), F.col("o_custkey").cast("string"), F.lit("-"), F.substring("o_orderpriority", 1, 5)))
    orders = t.orders.select("o_orderkey", gone("o_orderstatus", "O"), clerk.alias("o_clerk"))
    checked = quality.quality_errors(orders, quality.rules_from(_mapping(t)))
    return quality.write_checked(checked, f"{scratch_dir(t.orders.sparkSession)}/checked-{uuid.uuid4().hex}")


@query
def dq_mapped_rejects(t):
    _, rejected, _ = _mapped(t)
    return rejected.select("o_orderkey", F.concat_ws(",", "dq_errors").alias("dq_errors"))


@query
def dq_mapped_counts(t):
    return _mapped(t)[2]
