"""Parameter checks before a run; a failed check raises with the message callers know."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.text import fold
from loadkeeper.operators.report import unknown_names


class ParameterError(ValueError):
    """A parameter is missing or wrong."""

    code = 50010


# The messages of the checks.
MESSAGES = {
    "no batch": "batch_id cannot be null",
    "unknown batch": "Please pass valid batch number",
    "source step": "Please pass correct values to parameters source_id, job_id",
    "source": "Please pass valid Source Id ",
    "history flag": "is_hist_load can only be 1 or 0",
    "rerun flag": "paramSpIsReRun can only be 1 or 0",
    "status": "paramSpStatus can only be success or failed",
    "no start": "etl_startdt or current_rundt should be given",
    "last after current": " last_rundt should be less than current_rundt ",
    "current after start": " current_rundt should be less than EtlStartdt ",
    "last after start": " paramSpEtlStartdt should be less than paramSpLastRundt ",
    "last run": " Please enter date in valid format for paramSpLastRunDate",
    "current run": " Please enter date in valid format for paramSpCurrentRunDate",
    "tables": "Please pass correct table names , issue table names are: ",
    "datasets": "Please pass correct dataset ids , issue dataset ids are: ",
}


def require(ok: bool, message: str, detail: str = "") -> None:
    if not ok:
        raise ParameterError(MESSAGES[message] + detail)


def moment(value: dt.datetime | str | None, message: str) -> dt.datetime | None:
    """A date parameter, from a datetime or an ISO text."""
    if value is None or isinstance(value, dt.datetime):
        return value
    try:
        return dt.datetime.fromisoformat(value)
    except ValueError:
        raise ParameterError(MESSAGES[message]) from None


def check_dates(etl_start=None, last_run=None, current_run=None) -> None:
    """A start or current run is given, and last run <= current run <= start."""
    start = moment(etl_start, "current run")
    last, current = moment(last_run, "last run"), moment(current_run, "current run")
    require(start is not None or current is not None, "no start")
    require(last is None or current is None or last <= current, "last after current")
    require(start is None or current is None or start >= current, "current after start")
    require(start is None or last is None or start >= last, "last after start")


def check_flag(value: int | None, message: str = "rerun flag") -> None:
    require(value in (0, 1, None), message)


def check_status(value: str) -> None:
    require(value.rstrip(" ").lower() in ("success", "failed"), "status")


def check_batch(batches: DataFrame, batch_id: int | None) -> None:
    require(batch_id not in (None, 0), "no batch")
    require(not batches.filter(F.col("batch_id") == batch_id).isEmpty(), "unknown batch")


def check_source_step(items: DataFrame, source_id: int, job_id: int) -> None:
    found = items.filter((F.col("source_id") == source_id) & (F.col("job_id") == job_id))
    require(not found.isEmpty(), "source step")


def check_names(names: str | None, known: DataFrame, col: str, message: str = "tables") -> None:
    """Every name of the caller's comma list is known, and none is given twice."""
    if names is None or names.rstrip(" ") == "":
        return
    given = names.split(",")
    listed = known.sparkSession.createDataFrame([(n,) for n in given], "name string")
    unknown = sorted(r["name"] for r in unknown_names(listed, known, col).collect())
    repeated = len({n.rstrip(" ").lower() for n in given}) != len(given)
    require(not unknown and not repeated, message, ",".join(unknown))


def date_message(etl_start: Column, last_run: Column, current_run: Column) -> Column:
    """The message of the first date check that fails, or NULL; the two runs are texts, an empty one is no date."""
    last, current = (c.try_cast("timestamp_ntz") for c in (last_run, current_run))
    say = lambda name: F.lit(MESSAGES[name])
    return (
        F.when(last_run.isNotNull() & last.isNull(), say("last run"))
        .when(current_run.isNotNull() & current.isNull(), say("current run"))
        .when(etl_start.isNull() & current.isNull(), say("no start"))
        .when(last > current, say("last after current"))
        .when(current > etl_start, say("current after start"))
        .when(last > etl_start, say("last after start"))
    )


def verdicts(requests: DataFrame, batches: DataFrame, items: DataFrame) -> DataFrame:
    """Requested runs (batch_id, source_id, job_id, status, is_rerun, etl_start, last_run, current_run) with the
    ``message`` of the first check each fails, NULL for an accepted one, and the ``code`` of a failure.

    The form of the checks above for many requests at once: known batches and steps are distinct keys before they are joined.
    """
    known = batches.select("batch_id").distinct().withColumn("_batch", F.lit(True))
    steps = items.select("source_id", "job_id").distinct().withColumn("_step", F.lit(True))
    say = lambda name: F.lit(MESSAGES[name])
    message = (
        F.when(F.coalesce("batch_id", F.lit(0)) == 0, say("no batch"))
        .when(F.col("_batch").isNull(), say("unknown batch"))
        .when(F.col("_step").isNull(), say("source step"))
        .when(~F.col("is_rerun").isin(0, 1), say("rerun flag"))
        .when(~F.coalesce(fold("status").isin("success", "failed"), F.lit(False)), say("status"))
        .otherwise(date_message(F.col("etl_start"), F.col("last_run"), F.col("current_run")))
    )
    joined = requests.join(known, "batch_id", "left").join(steps, ["source_id", "job_id"], "left")
    judged = joined.withColumn("message", message).select(*requests.columns, "message")
    return judged.withColumn("code", F.when(F.col("message").isNotNull(), ParameterError.code))
