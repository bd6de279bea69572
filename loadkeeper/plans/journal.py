"""The control logs as ledgers: audit, error and timing rows, batches and watermarks, with any number of writers.

Every call names its run; the same call repeated, as after a lost driver, leaves one copy. Status corrections, closings
and watermarks are written as settings by key, so they cost what they change. ``Gates`` keeps what the readiness gates
need from the audit log up to date from its new commits alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loadkeeper.functions.clock import Moment
from loadkeeper.functions.text import same
from loadkeeper.operators import batch
from loadkeeper.operators.gates import ITEM, SUCCESS
from loadkeeper.sources.ledger import VERSION, Change, Ledger
from loadkeeper.sources.schemas import SCHEMAS

#: The full key of an audit row, by which its status is corrected.
AUDIT_KEY = ("source_id", "job_id", ITEM, "batch_id")


def audit_log(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/audit_log", SCHEMAS["audit_log"], key=AUDIT_KEY, identity="log_id")


def error_log(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/error_log", SCHEMAS["error_log"], identity="error_log_id")


def step_log(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/execution_log", SCHEMAS["execution_log_details"], identity="log_id")


def batch_table(spark: SparkSession, root: str) -> Ledger:
    return Ledger(spark, f"{root}/batch_run_details", SCHEMAS["batch_run_details"], key=["batch_id"])


def item_table(spark: SparkSession, root: str, schema: StructType | None = None) -> Ledger:
    return Ledger(spark, f"{root}/job_object_details", schema or SCHEMAS["job_object_details"], key=[ITEM])


def open_batches(batches: Ledger, requests: DataFrame, run: str, *, start: Moment, trigger_id: str | None = None) -> int:
    """Opens or resumes batches, also while others do: whoever comes second decides on what the first has left.

    So a source never has two Active batches, and no id is given twice.
    """

    def decide(now: DataFrame) -> Change:
        resumed, added = batch.opening(now, requests, start=start, trigger_id=trigger_id)
        return Change(rows=added, settings=resumed)

    return batches.transact(decide, run)


def correct_status(log: Ledger, corrections: DataFrame, run: str, order: str | None = None) -> int:
    """Sets the status of the audit rows there are under the full key; of several corrections the last by ``order``."""
    columns = [*AUDIT_KEY, "status", *([order] if order else [])]
    return log.set_columns(corrections.select(*columns), run, order)


def advance_watermarks(items: Ledger, done: DataFrame, run: str) -> int:
    """Sets ``last_run_time`` of the loaded items; writes one row for each of them, and no other column."""
    latest = done.groupBy(ITEM).agg(F.max("batch_start_date").alias("last_run_time"))
    return items.set_columns(latest, run)


_COUNTS = StructType(
    [f for f in SCHEMAS["audit_log"].fields if f.name in AUDIT_KEY]
    + [f for f in SCHEMAS["execution_log_details"].fields if f.name == "row_count"]
).add("success_count", "long")


@dataclass
class Gates:
    """Per item and batch how many audit rows there are and how many of success, kept up to date from new commits.

    The view is a ledger of differences: a refresh sums the rows appended since the last one, and for corrected keys
    takes back what they counted before. Polls read the view, which has one line per key and refresh
    until it is compacted, and never the log.
    """

    log: Ledger
    root: str

    def __post_init__(self) -> None:
        self.view = Ledger(self.log.spark, f"{self.root}/gate_counts", _COUNTS)

    def upto(self) -> int:
        """The version of the log that the view has taken in; -1 for none."""
        return max((c.notes["upto"] for c in self.view.commits() if "upto" in c.notes), default=-1)

    def refresh(self) -> int:
        """Takes in the log's commits since the last refresh; a refresh that another one has overtaken changes nothing."""
        seen, now = self.upto(), self.log.version()
        if seen < now:
            self.view.append(self._difference(seen, now), f"after-{seen}", {"upto": now})
        return self.upto()

    def _difference(self, after: int, upto: int) -> DataFrame:
        key = list(AUDIT_KEY)
        ok = same("status", SUCCESS)
        added = self.log.added(after, upto).groupBy(*key, VERSION).agg(
            F.count("*").alias("n"), F.count_if(ok).alias("s")
        )
        if not any(c.settings for c in self.log.commits() if after < c.version <= upto):
            return added.groupBy(*key).agg(F.sum("n").alias("row_count"), F.sum("s").alias("success_count"))
        corrected = self.log.settings(after, upto).filter(F.array_contains("_sets", "status"))
        last = corrected.groupBy(*key).agg(F.max(F.struct(VERSION, F.coalesce(ok, F.lit(False)).alias("ok"))).alias("c"))
        # rows written before the last correction of their key have its status, later ones their own
        before = F.col(VERSION) < F.col("c")[VERSION]
        sums = added.join(last, key, "left").select(
            *key, "n", F.when(before, F.col("c")["ok"].cast("bigint") * F.col("n")).otherwise(F.col("s")).alias("s")
        )
        # and what the view has counted for a corrected key so far is put right
        old = self._totals().join(last, key).select(
            *key, F.lit(0).cast("bigint").alias("n"), (F.col("c")["ok"].cast("bigint") * F.col("row_count") - F.col("success_count")).alias("s")
        )
        return sums.unionByName(old).groupBy(*key).agg(F.sum("n").alias("row_count"), F.sum("s").alias("success_count"))

    def _totals(self) -> DataFrame:
        return self.view.read().groupBy(*AUDIT_KEY).agg(F.sum("row_count").alias("row_count"), F.sum("success_count").alias("success_count"))

    def compact(self, most: int = 100) -> int | None:
        """Writes the view as one line per key once it has had more refreshes than ``most``."""
        return self.view.compact(most=most, fold=lambda rows: rows.groupBy(*AUDIT_KEY).agg(
            F.sum("row_count").alias("row_count"), F.sum("success_count").alias("success_count")
        ))

    def as_log(self) -> DataFrame:
        """(batch_id, job_object_id, status): one row per item and batch, which every gate takes in place of the log.

        The status is success if any row of the item in the batch has it, and otherwise NULL.
        """
        succeeded: Column = F.sum("success_count") > 0
        rows = self.view.read().groupBy("batch_id", ITEM).agg(F.sum("row_count").alias("n"), succeeded.alias("ok"))
        return rows.filter("n > 0").select("batch_id", ITEM, F.when(F.col("ok"), F.lit(SUCCESS)).alias("status"))
