"""Reading and writing loaded data the way a work item declares it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Declared formats by the reader that takes them.
FORMATS = {"parquet": "parquet", "orc": "orc", "json": "json", "csv": "csv", "txt": "csv", "text": "csv", "avro": "avro"}


def _format(declared: str | None) -> str:
    name = (declared or "parquet").strip().lower()
    if name not in FORMATS:
        raise ValueError(f"format {declared!r} needs a connector that is not part of Spark")
    return FORMATS[name]


def _path(item: Mapping, side: str, base: str) -> str:
    parts = [base.rstrip("/"), item.get(f"{side}_container_name"), item.get(f"{side}_object_path")]
    return "/".join(p.strip("/") if i else p for i, p in enumerate(parts) if p)


def read_item(spark: SparkSession, item: Mapping, base: str, schema=None) -> DataFrame:
    """The source files of a work item: format, delimiter and path from its config row."""
    fmt = _format(item.get("source_format"))
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", item.get("source_object_delimiter") or ",")
    return reader.load(_path(item, "source", base))


def write_item(df: DataFrame, item: Mapping, base: str, mode: str = "append") -> str:
    """Writes to the target a work item declares and returns the path."""
    fmt = _format(item.get("target_format"))
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("sep", item.get("target_object_delimiter") or ",")
    if item.get("target_partitioned_by"):
        writer = writer.partitionBy(*[c.strip() for c in item["target_partitioned_by"].split(",")])
    path = _path(item, "target", base)
    writer.save(path)
    return path


def read_query(spark: SparkSession, query: str, options: Mapping[str, str]) -> DataFrame:
    """The rows of a generated window query, run by the source database over JDBC."""
    return spark.read.format("jdbc").options(**options).option("query", query).load()
