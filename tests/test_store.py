import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators.tables import update_rows
from loadkeeper.session import shared_dir
from loadkeeper.sources import files, store
from loadkeeper.sources.schemas import SCHEMAS


def test_append_is_typed_and_fills_missing_columns(spark, table, tmp_path):
    path = str(tmp_path / "log")
    rows = table("batch_id int, JOB_ID int, status string, log_date timestamp_ntz", (1, 2, "success", dt.datetime(2024, 1, 1)))
    store.append_log(rows.selectExpr("*", "1 AS log_id"), path, SCHEMAS["audit_log"], partition_by=["batch_id"])
    store.append_log(rows.selectExpr("*", "2 AS log_id"), path, SCHEMAS["audit_log"], partition_by=["batch_id"])
    got = store.read_log(spark, path, SCHEMAS["audit_log"])
    assert got.count() == 2 and got.first()["job_id"] == 2 and got.first()["query"] is None
    plan = got.filter("batch_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan


def test_versions_never_touch_what_is_read(spark, table, tmp_path, rows):
    root = str(tmp_path / "items")
    store.write_version(table("k int, v string", (1, "a"), (2, "b")), root)
    current = store.read_version(spark, root)
    store.write_version(update_rows(current, table("k int, v string", (2, "c")), "k"), root)
    assert rows(store.read_version(spark, root)) == [(1, "a"), (2, "c")]
    assert rows(store.read_version(spark, root, 0)) == [(1, "a"), (2, "b")]
    (tmp_path / "items" / "v00000001" / "_SUCCESS").unlink()  # a writer that died
    assert rows(store.read_version(spark, root)) == [(1, "a"), (2, "b")]
    store.write_version(table("k int, v string", (9, "z")), root)
    assert store.versions(spark, root) == [0, 2]
    with pytest.raises(FileNotFoundError):
        store.read_version(spark, str(tmp_path / "none"))


def test_declared_formats(spark, table, tmp_path, rows):
    df = table("k int, v string", (1, "a"), (2, "b"))
    item = {"target_format": "CSV", "target_object_delimiter": "|", "target_object_path": "x/y", "target_container_name": "c"}
    path = files.write_item(df, item, str(tmp_path))
    assert path == f"{tmp_path}/c/x/y"
    back = {"source_format": "txt", "source_object_delimiter": "|", "source_object_path": "x/y", "source_container_name": "c"}
    assert rows(files.read_item(spark, back, str(tmp_path), schema="k int, v string")) == [(1, "a"), (2, "b")]
    files.write_item(df, {"target_object_path": "p", "target_partitioned_by": "k"}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/p").filter("k = 2").first()["v"] == "b"
    with pytest.raises(ValueError, match="connector"):
        files.read_item(spark, {"source_format": "xlsx"}, str(tmp_path))


def test_defaults_fill_absent_and_null(table, rows):
    df = table("k int, d int", (1, None), (2, 5))
    got = store.with_defaults(df, {"D": F.lit(7), "e": F.lit("x")})
    assert rows(got) == [(1, 7, "x"), (2, 5, "x")]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    names = ("bucketed_log", "bucketed_items")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS loads LOCATION '{tmp_path}/loads'")
            store.save_bucketed(spark.range(1000).withColumnRenamed("id", "job_object_id"), f"loads.{name}", "job_object_id", 4)
        log, items = (spark.table(f"loads.{n}") for n in names)
        joined = log.groupBy("job_object_id").count().join(items, "job_object_id")
        assert joined.count() == 1000
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE IF EXISTS loads CASCADE")


def test_schemas():
    assert len(SCHEMAS["job_object_details"]) == 41 and len(SCHEMAS["audit_log"]) == 24
    assert len(SCHEMAS["job_object_details_audit"]) == 43 and len(SCHEMAS["recon_fa_sap_records"]) == 14
    assert len(SCHEMAS["object_column_mapping"]) == 28 and len(SCHEMAS["powerbi_dataset_details_older"]) == 14


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
