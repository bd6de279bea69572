"""Row updates on control tables, as new versions of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_changes(changes: DataFrame, key: Sequence[str], columns: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """One row per key: ``columns`` of its change with the greatest ``order``, as a struct.

    A change without an order value comes before all with one; of equal ones the largest row counts, compared
    column by column. The maximum is taken before and after the shuffle, so a key of many changes costs a row a task.
    """
    best = F.max(F.struct(*order, F.struct(*columns).alias("_row")))
    return changes.groupBy(*key).agg(best.getField("_row").alias(name))


def update_rows(table: DataFrame, changes: DataFrame, key: Sequence[str] | str, *, order: Sequence[str] = ()) -> DataFrame:
    """``table`` with the non-key columns of ``changes`` put in where the key matches.

    A NULL in the change is written as NULL; NULL key parts match nothing. Of several changes of one
    key the last by ``order`` counts, and without an order the largest row, compared column by column. Order columns that
    the table does not have are not put in.
    """
    key = [key] if isinstance(key, str) else list(key)
    new = [c for c in changes.columns if c not in key and not (c in order and c not in table.columns)]
    one = last_changes(changes, key, new, order, "_new") if new else changes.select(*key).distinct()
    marked = one.select(*key, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in new], F.lit(True).alias("_hit"))
    joined = table.join(marked, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in table.columns
        ]
    )


def advance_watermark(items: DataFrame, done: DataFrame) -> DataFrame:
    """Items with ``last_run_time`` moved to the load start of ``done`` (job_object_id, batch_start_date)."""
    latest = done.groupBy("job_object_id").agg(F.max("batch_start_date").alias("last_run_time"))
    return update_rows(items, latest, "job_object_id")


def counts_match(done: DataFrame) -> DataFrame:
    """Adds ``counts_equal``: source and target count as the same text; NULL counts never match."""
    source, target = F.col("source_row_count").cast("string"), F.col("target_row_count").cast("string")
    return done.withColumn("counts_equal", F.coalesce(F.rtrim(source) == F.rtrim(target), F.lit(False)))


def advance_watermark_guarded(items: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``advance_watermark`` for loads with equal counts; the others come back as error rows."""
    checked = counts_match(done)
    moved = advance_watermark(items, checked.filter("counts_equal"))
    failed = checked.filter("NOT counts_equal").drop("counts_equal")
    return moved, failed.withColumn("error_message", F.lit("Source and target count mismatch"))
