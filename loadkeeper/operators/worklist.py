"""Work selection: which items of a run are due.

Items arrive joined with their source, step and object; the filters below narrow them. Options are
chosen in Python, so a plan never carries an OR over unused parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkeeper.functions.clock import Moment, milli_text, wall
from loadkeeper.functions.text import fold, in_names, like, replace_any_case, schema_part, table_part
from loadkeeper.operators.joins import spread_join


def star(items: DataFrame, sources: DataFrame, jobs: DataFrame, objects: DataFrame) -> DataFrame:
    """Enabled items with source name and table name; source and step must be enabled too.

    The four tables declare no foreign keys, so an item without its dimension row drops out.
    """
    return (
        items.filter(F.col("enabled") == 1)
        .join(sources.filter("enabled").select("source_id", "source_name"), "source_id")
        .join(jobs.filter("enabled").select("job_id"), "job_id")
        .join(objects.select("object_id", "table_name"), "object_id")
    )


def for_runs(items: DataFrame, runs: DataFrame) -> DataFrame:
    """Every item once per requested run of its source.

    A source may hold a large part of all items, so its items are spread over several tasks.
    """
    asked = runs.select("batch_id", "source_id").distinct()
    return spread_join(items, asked, ["source_id"], salt=F.hash("job_object_id"), how="inner")


def named(items: DataFrame, names: str | Sequence[str] | DataFrame | None, col: str = "table_name") -> DataFrame:
    """Items whose name is in the list; no list (None or '') means all items.

    A DataFrame of names (one column) is the form for long lists.
    """
    if names is None or (isinstance(names, (str, list, tuple)) and len(names) == 0):
        return items
    if isinstance(names, DataFrame):
        keys = names.select(fold(names.columns[0]).alias("_name")).distinct()
        return items.withColumn("_name", fold(col)).join(keys, "_name", "left_semi").drop("_name")
    return items.filter(in_names(col, names))


def in_layers(items: DataFrame, layers: Sequence[str]) -> DataFrame:
    """Items per layer whose target name contains the layer word; one pass for all layers."""
    per_layer = items.withColumn("layer", F.explode(F.array(*[F.lit(x) for x in layers])))
    match = F.like(F.lower("target_object_name"), F.concat(F.lit("%"), F.lower("layer"), F.lit("%")))
    return per_layer.filter(match)


def target_like(items: DataFrame, pattern: str) -> DataFrame:
    return items.filter(like("target_object_name", pattern))


def with_bounds(items: DataFrame, now: Moment, last_run: Moment | None = None) -> DataFrame:
    """Target name in two parts, and the run bounds as text with milliseconds."""
    return items.withColumns(
        {
            "target_schema_name": schema_part("target_object_name"),
            "target_table_name": table_part("target_object_name"),
            "valid_last_run_time": milli_text(lower_bound(last_run)),
            "valid_current_run_time": milli_text(wall(now)),
        }
    )


def lower_bound(last_run: Moment | None, stored: str = "last_run_time") -> Column:
    """The given last run, else the item's stored one; 1900-01-01 counts as not given."""
    if last_run is None:
        return F.col(stored)
    return F.coalesce(F.nullif(wall(last_run), wall("1900-01-01 00:00:00")), F.col(stored))


def nothing(df: DataFrame) -> DataFrame:
    """The same columns without rows, for runs that no rule applies to."""
    return df.filter(F.lit(False))


def enabled_list(config: DataFrame, flag: str, *columns: str) -> DataFrame:
    """The enabled rows of a plain config table."""
    rows = config.filter(F.col(flag) == 1)
    return rows.select(*columns) if columns else rows


def file_list(items: DataFrame, *, source_id: int, job_id: int = 1) -> DataFrame:
    """Distinct file names a source is expected to deliver.

    Exported metadata files go by their path without the folder and the archive ending.
    """
    # The name pattern of exports, and the texts cut from their path.
    export, folder, ending = "ExportedMetadata_%", "fccs_files/", ".zip"
    path = replace_any_case(replace_any_case("source_object_path", folder, ""), ending, "")
    name = F.when(like("source_object_name", export), path).otherwise(F.col("source_object_name"))
    wanted = items.filter(
        (F.col("job_id") == job_id) & (F.col("source_id") == source_id) & (F.col("enabled") == 1)
    )
    # Names that differ only by case are one file; the smallest spelling stands for them.
    return (
        wanted.select(name.alias("filename"))
        .groupBy(fold("filename").alias("_key"))
        .agg(F.min("filename").alias("filename"))
        .select("filename")
    )
