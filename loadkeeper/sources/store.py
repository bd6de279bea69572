"""Control tables on plain files: typed appends, and new versions instead of updates in place.

A version is complete once its writer has left the _SUCCESS mark, so a job that loses executors or
dies leaves the previous version current. Nothing ever overwrites the files it reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the schema in order, cast to their types; absent ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Default values for columns that are absent or NULL, as the table declares them."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), v) if c.lower() in have else v for c, v in defaults.items()})


def append_log(rows: DataFrame, path: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """Appends typed rows to a log; ``partition_by`` lets readers prune by batch or day."""
    conform(rows, schema).write.mode("append").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> None:
    """Saves a catalog table bucketed and sorted by its join key.

    Tables saved with the same key and number of buckets join and aggregate on it without a shuffle;
    meant for the log and the work items once both are large.
    """
    writer = df.write.mode("error").bucketBy(buckets, key).sortBy(key)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions of a table, oldest first."""
    fs, folder = _folder(spark, root)
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(done):
            out.append(int(name[1:]))
    return sorted(out)


def write_version(df: DataFrame, root: str) -> str:
    """Writes the next version of a table and returns its folder.

    A table has one writer at a time; a second one on the same version fails on the existing folder.
    """
    spark = df.sparkSession
    fs, folder = _folder(spark, root)
    taken = [-1]
    if fs.exists(folder):
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        taken += [int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()]
    path = f"{root.rstrip('/')}/v{max(taken) + 1:08d}"
    df.write.mode("error").parquet(path)
    return path


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest complete version of a table, or a given one."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v{known[-1] if version is None else version:08d}")
