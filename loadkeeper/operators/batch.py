"""Batch life cycle: open or resume, close with a status rollup, corrections and error rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import SATURDAY, SUNDAY, Moment, is_weekend, wall
from loadkeeper.functions.text import fold, like
from loadkeeper.operators.gates import DONE, ITEM, succeeded
from loadkeeper.operators.tables import update_rows

# The states of a batch.
ACTIVE, FAILED, PARTIAL = "Active", "Failed", "Partially Failed"


def batch_decision(batches: DataFrame, requests: DataFrame) -> DataFrame:
    """What a request to start a source's batch leads to, for many sources at once.

    ``requests`` has source_id, is_rerun and requested_status. The newest batch of the source
    decides: running rejects, failed is resumed under its id unless this is a rerun, anything else
    opens a new batch, which must be requested as Active.
    """
    newest = batches.groupBy("source_id").agg(
        F.max("batch_id").alias("last_batch_id"),
        F.max_by("batch_run_status", "batch_id").alias("last_status"),
    )
    status = fold("last_status")
    failed = status.isin(FAILED.lower(), PARTIAL.lower())
    decision = (
        F.when(status == ACTIVE.lower(), "reject_running")
        .when(failed & (F.col("is_rerun") == 0), "resume")
        .when(F.coalesce(fold("requested_status"), F.lit("")) != ACTIVE.lower(), "reject_status")
        .otherwise("new")
    )
    return (
        requests.join(newest, "source_id", "left")
        .withColumn("decision", decision)
        .withColumn("batch_id", F.when(F.col("decision") == "resume", F.col("last_batch_id")))
    )


def opening(batches: DataFrame, requests: DataFrame, *, start: Moment, trigger_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """What the requests lead to: (batch_id, batch_run_status) of resumed batches, and the new batches.

    Several requests for one source are one: a re-run if any of them is, with the largest status text asked for. New ids
    follow the largest old one in the order of the sources, so the same requests give the same ids.
    """
    asked = requests.groupBy("source_id").agg(F.max("is_rerun").alias("is_rerun"), F.max("requested_status").alias("requested_status"))
    decided = batch_decision(batches, asked)
    resumed = decided.filter("decision = 'resume'").select("batch_id", F.lit(ACTIVE).alias("batch_run_status"))
    top = batches.agg(F.coalesce(F.max("batch_id"), F.lit(0))).scalar()
    new = decided.filter("decision = 'new'")
    # one id for each source, so the list is as short as the table of sources
    sources = new.agg(F.sort_array(F.collect_set("source_id"))).scalar()
    added = new.select(
        (top + F.array_position(sources, F.col("source_id"))).cast("bigint").alias("batch_id"),
        "source_id",
        wall(start).alias("batch_start_date"),
        F.lit(ACTIVE).alias("batch_run_status"),
        F.lit(trigger_id).cast("string").alias("trigger_id"),
    )
    return resumed, added


def open_batches(batches: DataFrame, requests: DataFrame, *, start: Moment, trigger_id: str | None = None) -> DataFrame:
    """The batch table after the requests: resumed batches Active, new ones added."""
    resumed, added = opening(batches, requests, start=start, trigger_id=trigger_id)
    return update_rows(batches, resumed, "batch_id").unionByName(added, allowMissingColumns=True).select(*batches.columns)


# ---------------------------------------------------------------- what a complete batch contains


def expected_regular(refreshed: Column, now: Moment, recon_keep: str = "dwh.recon_gl%") -> Column:
    """Items a regular batch must finish: after the refresh all steps, of step 7 only the ledger
    targets; on Saturday all but step 6; else all but steps 6 and 7."""
    job = F.col("job_id")
    after = job.isin(1, 2, 3, 4, 5, 6) | ((job == 7) & like("target_object_name", recon_keep))
    return F.when(refreshed, after).when(is_weekend(now), ~job.isin(6)).otherwise(~job.isin(6, 7))


def expected_adhoc(refreshed: Column) -> Column:
    """Items an ad-hoc batch must finish: all after the refresh, else all but steps 6 and 7."""
    return F.when(refreshed, F.lit(True)).otherwise(~F.col("job_id").isin(6, 7))


def expected_datasets(now: Moment) -> Column:
    """Dataset entries a dataset batch must finish: all on weekends, else only the daily ones."""
    return is_weekend(now, (SATURDAY, SUNDAY)) | (fold("job_frequency") == "d")


def rollup_status(done: Column, expected: Column) -> Column:
    return F.when(done == expected, F.lit(DONE)).otherwise(F.lit(PARTIAL))


def batch_rollup(batches: DataFrame, log: DataFrame, items: DataFrame, expected: Column) -> DataFrame:
    """Closing status per batch: complete when distinct succeeded items equal the expected ones.

    The succeeded count takes every item of the batch's log, of any source, enabled or not.
    """
    done = succeeded(log, batches).groupBy("batch_id").agg(F.count(ITEM).alias("_done"))
    wanted = (
        items.filter((F.col("enabled") == 1) & expected).groupBy("source_id").agg(F.countDistinct(ITEM).alias("_expected"))
    )
    return _rolled(batches.join(done, "batch_id", "left").join(wanted, "source_id", "left"))


def dataset_rollup(batches: DataFrame, log: DataFrame, config: DataFrame, expected: Column) -> DataFrame:
    """``batch_rollup`` for dataset batches: the expected side is the distinct enabled domains."""
    done = succeeded(log, batches).groupBy("batch_id").agg(F.count(ITEM).alias("_done"))
    wanted = config.filter(F.col("enabled") & expected).agg(F.countDistinct("domain_id")).scalar()
    return _rolled(batches.join(done, "batch_id", "left").withColumn("_expected", wanted))


def _rolled(df: DataFrame) -> DataFrame:
    return df.select(
        "batch_id",
        "source_id",
        F.coalesce("_done", F.lit(0)).cast("bigint").alias("done_items"),
        F.coalesce("_expected", F.lit(0)).cast("bigint").alias("expected_items"),
    ).withColumn("batch_run_status", rollup_status(F.col("done_items"), F.col("expected_items")))


def close_batches(batches: DataFrame, closing: DataFrame) -> DataFrame:
    """The batch table with end, message and status of ``closing`` (one row per batch_id) put in."""
    return update_rows(batches, closing, "batch_id")


def fix_status(log: DataFrame, corrections: DataFrame, *, order: str | None = None) -> DataFrame:
    """The log with the status of the corrected rows replaced; the key is the full four-part key.

    Of several corrections of one key the last by ``order`` counts. Without an order they have to agree.
    """
    key = ["source_id", "job_id", ITEM, "batch_id"]
    if order is not None:
        last = F.max(F.struct(F.col(order).alias("at"), "status"))["status"]
    else:
        conflict = F.raise_error(F.lit("corrections of one log row differ; give their order")).cast("string")
        last = F.when(F.min("status") == F.max("status"), F.max("status")).when(F.count("status") > 0, conflict)
    return update_rows(log, corrections.groupBy(*key).agg(last.alias("status")), key)


def failure_rows(failures: DataFrame, now: dt.datetime, *, widths: tuple[int, int, int] | None = None) -> DataFrame:
    """Error rows for failed runs of the library itself.

    ``failures`` has activity, error_code, error_message and any of source_id, job_id, batch_id.
    The log date has no time of day. ``widths`` cuts activity, code and message to a table's widths.
    """
    cut = lambda c, i: c if widths is None else F.substring(c, 1, widths[i])
    return failures.withColumns(
        {
            "activity": cut(F.col("activity"), 0),
            "error_code": cut(F.col("error_code").cast("string"), 1),
            "error_message": cut(F.col("error_message"), 2),
            "error_type": F.lit("TechnicalError"),
            "error_subtype": F.lit("LogicalError"),
            "log_date": F.to_date(wall(now)).cast("timestamp_ntz"),
        }
    )
