"""Zone maps: the least and greatest value of the change columns of every file, so that a window opens only files it can touch.

An OR of two columns cannot prune a scan. With the zones of both columns it becomes two disjoint sets of files: those
the first column may select from, read with the whole condition, and those only the second one may, read with a
condition the scan can push down. Files that are not in the map yet are read like those of the first set.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkeeper.operators.window import bound, moment, window_filter


def _named(files: Sequence[str]) -> list[str]:
    """File names as rows of a file show them: a local one with a single slash."""
    return ["file:/" + f.removeprefix("file:///") if f.startswith("file:///") else f for f in files]


@dataclass(frozen=True)
class Zones:
    """The zone map of the Parquet files under ``data``, kept under ``sidecar``: one row per file."""

    spark: SparkSession
    data: str
    sidecar: str
    columns: tuple[str, ...]

    def _files(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.data)
        except AnalysisException as none:
            if "UNABLE_TO_INFER_SCHEMA" in str(none) or "PATH_NOT_FOUND" in str(none):
                return None
            raise

    def read(self) -> DataFrame | None:
        """(file, n_rows, <column>_least, <column>_most), or None before the first refresh."""
        try:
            return self.spark.read.parquet(self.sidecar)
        except AnalysisException as none:
            if "UNABLE_TO_INFER_SCHEMA" in str(none) or "PATH_NOT_FOUND" in str(none):
                return None
            raise

    def refresh(self) -> None:
        """Adds the files that are not in the map; files never change once written."""
        rows = self._files()
        if rows is None:
            return
        known = self.read()
        new = _named(rows.inputFiles())
        if known is not None:
            listed = {r["file"] for r in known.select("file").collect()}
            new = [f for f in new if f not in listed]
        if not new:
            return
        sides = [f(c).alias(f"{c}_{side}") for c in self.columns for f, side in ((F.min, "least"), (F.max, "most"))]
        read = self.spark.read.schema(rows.schema).parquet(*map(unquote, new)).withColumn("file", F.col("_metadata.file_path"))
        zones = read.groupBy("file").agg(F.count("*").alias("n_rows"), *sides)
        zones.coalesce(1).write.mode("append").parquet(self.sidecar)

    def window(self, column: str, lower, upper, extra_col: str | None = None) -> DataFrame:
        """The rows ``window_filter`` gives over all files, read from those that can hold one."""
        rows = self._files()
        if rows is None:
            raise FileNotFoundError(f"no files under {self.data}")
        first, second = self._chosen(rows, column, lower, upper, extra_col)
        read = lambda files: self.spark.read.schema(rows.schema).parquet(*map(unquote, files))
        parts = []
        if first:
            parts.append(window_filter(read(first), column, lower, upper, extra_col))
        if second:
            late = read(second)
            # no row of these files has reached the bound by the first column
            parts.append(late.filter((moment(late, extra_col) >= bound(late, extra_col, lower)) & (moment(late, column) < bound(late, column, upper))))
        if not parts:
            return self.spark.createDataFrame([], rows.schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _chosen(self, rows: DataFrame, column: str, lower, upper, extra_col: str | None) -> tuple[Sequence[str], Sequence[str]]:
        """Files to read with the whole condition, and files only the second column selects from."""
        present, zones = _named(rows.inputFiles()), self.read()
        if zones is None:
            return present, []

        def reaches(name: str, side: str, value, compare) -> Column:
            # a file without any value in the column holds no row for this condition
            return F.coalesce(compare(moment(zones, f"{name}_{side}"), bound(zones, f"{name}_{side}", value)), F.lit(False))

        before = reaches(column, "least", upper, lambda a, b: a < b)
        by_first = reaches(column, "most", lower, lambda a, b: a >= b)
        by_second = F.lit(False) if extra_col is None else reaches(extra_col, "most", lower, lambda a, b: a >= b)
        told = zones.select("file", F.when(before & by_first, 1).when(before & by_second, 2).otherwise(0).alias("set")).distinct()
        sets = {r["file"]: r["set"] for r in told.collect()}
        return [f for f in present if sets.get(f, 1) == 1], [f for f in present if sets.get(f, 1) == 2]
