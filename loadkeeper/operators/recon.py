"""Count and measure reconciliation between load layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.text import fold

STAGES = ("raw", "dq", "refined")
COUNTS = ("source_rows", "target_rows", "rejected_rows")


def stage_counts(log: DataFrame, items: DataFrame) -> DataFrame:
    """Row counts per batch, source, object, step and source name; every attempt adds up.

    The log is first reduced to one row per batch and item, then meets the item table, where step,
    source and name live. Callers that filter the result by step share that one reduction.
    """
    return (
        log.filter(F.col("batch_id").isNotNull() & F.col("job_object_id").isNotNull())
        .select("batch_id", "job_object_id", "source_row_count", "target_row_count", "rejected_duplicate_count")
        .groupBy("batch_id", "job_object_id")
        .agg(
            F.sum("source_row_count").alias("source_rows"),
            F.sum("target_row_count").alias("target_rows"),
            F.sum("rejected_duplicate_count").alias("rejected_rows"),
        )
        .join(
            items.filter(F.col("enabled") == 1).select(
                "job_object_id", "source_id", "job_id", "object_id", "source_object_name"
            ),
            "job_object_id",
        )
    )


def stage_compare(
    log: DataFrame, items: DataFrame, objects: DataFrame, stages: Sequence[int] = (1, 2, 3)
) -> DataFrame:
    """Counts of the three first layers side by side, one row per batch, source and object.

    The raw layer leads: objects without a raw row do not show. The second and third layer add up
    per source name, without case and trailing blanks, so an object read under two names shows one row per name.
    """
    per_item = stage_counts(log, items).filter(F.col("job_id").isin(*stages)).withColumn("_name", fold("source_object_name"))
    key = ["batch_id", "source_id", "object_id"]

    def layer(step: int, tag: str, by: Sequence[str]) -> DataFrame:
        rows = per_item.filter(F.col("job_id") == step).groupBy(*key, *by)
        sums = rows.agg(*[F.sum(c).alias(f"{tag}_{c}") for c in COUNTS])
        return sums.drop(*by)

    raw, dq, refined = (
        layer(step, tag, by) for step, tag, by in zip(stages, STAGES, ([], ["_name"], ["_name"]))
    )
    compared = raw.join(dq, key, "left").join(refined, key, "left").join(objects.select("object_id", "table_name"), "object_id")
    counts = [f"{tag}_{c}" for tag in STAGES for c in COUNTS]
    compared = compared.select(*key, "table_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
    return compared.withColumns(
        {
            "raw_dq_differ": F.col("raw_target_rows") != F.col("dq_target_rows"),
            "dq_refined_differ": F.col("dq_target_rows") != F.col("refined_target_rows"),
        }
    )


def stage_reconcile(log: DataFrame, items: DataFrame, objects: DataFrame, stages: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """The objects whose target counts differ between neighbouring layers."""
    compared = stage_compare(log, items, objects, stages)
    return compared.filter(F.col("raw_dq_differ") | F.col("dq_refined_differ"))


def stage_verdict(compared: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Mismatched objects per batch and source, and the verdict; with ``runs`` also for runs without any row."""
    differs = F.col("raw_dq_differ") | F.col("dq_refined_differ")
    counts = compared.groupBy("batch_id", "source_id").agg(F.count(F.when(differs, 1)).alias("tablecount"))
    if runs is not None:
        asked = runs.select("batch_id", "source_id").distinct().join(counts, ["batch_id", "source_id"], "left")
        counts = asked.withColumn("tablecount", F.coalesce("tablecount", F.lit(0)).cast("bigint"))
    return counts.withColumn("verdict", F.when(F.col("tablecount") == 0, "count matched").otherwise("count mismatched"))


def layer_reconcile(
    layers: Mapping[str, DataFrame], key: Sequence[str], measures: Mapping[str, Column], *, tolerance: str = "0"
) -> DataFrame:
    """Measures per entity in every layer, with a Y/N match flag per measure.

    ``layers`` maps a layer name to its rows. All layers go through one sum: every row carries its
    layer's name, so entities missing from a layer show with NULL and do not match.
    """
    names = list(layers)
    rows = None
    for name, df in layers.items():
        part = df.select(*key, F.lit(name).alias("_layer"), *[m.cast("decimal(38,7)").alias(c) for c, m in measures.items()])
        rows = part if rows is None else rows.unionByName(part)
    sums = rows.groupBy(*key).agg(
        *[
            F.sum(F.when(F.col("_layer") == name, F.col(m))).cast("decimal(38,7)").alias(f"{m}_{name}")
            for m in measures
            for name in names
        ]
    )
    limit = F.lit(tolerance).cast("decimal(38,7)")

    def match(m: str) -> Column:
        first = F.col(f"{m}_{names[0]}")
        equal = [F.abs(first - F.col(f"{m}_{n}")) <= limit for n in names[1:]]
        together = equal[0]
        for e in equal[1:]:
            together = together & e
        return F.when(together, "Y").otherwise("N")

    columns = [c for m in measures for c in [*[F.col(f"{m}_{n}") for n in names], match(m).alias(f"{m}_match")]]
    return sums.select(*key, *columns)
