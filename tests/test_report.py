import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import recon, report
from loadkeeper.operators.joins import paged_text

AT = dt.datetime(2024, 1, 1)
ITEMS = "job_object_id bigint, source_id int, job_id int, object_id int, enabled int, source_object_name string, target_object_name string, execution_sequence int"
LOG = "batch_id bigint, job_object_id bigint, source_id int, job_id int, status string"
ERRORS = "batch_id bigint, job_object_id bigint, source_id int, job_id int, error_log_id bigint, log_date timestamp_ntz"
OBJECTS = "object_id int, table_name string"


def stage(table, *counts, items=None):
    items = items or [(j, 1, j, 1, 1, f"n{j}", "t", 1) for j in (1, 2, 3)]
    log = table(
        "batch_id bigint, job_object_id bigint, source_row_count int, target_row_count int, rejected_duplicate_count int", *counts
    )
    return recon.stage_compare(log, table(ITEMS, *items), table(OBJECTS, (1, "T")))


@pytest.mark.parametrize(
    "counts, differ",
    [
        ([(1, 1, 5, 5, 0), (1, 2, 5, 5, 0), (1, 3, 5, 5, 0)], (False, False)),
        ([(1, 1, 5, 5, 0), (1, 2, 5, 4, 1), (1, 3, 4, 4, 0)], (True, False)),
        ([(1, 1, 5, 5, 0), (1, 2, 5, 5, 0), (1, 3, 5, 4, 0)], (False, True)),
        ([(1, 1, 5, 5, 0), (1, 3, 5, 5, 0)], (True, True)),  # a missing layer counts as 0
        ([(1, 1, 0, 0, 0)], (False, False)),
        ([(1, 1, 5, 5, 0), (1, 1, 5, 5, 0), (1, 2, 5, 10, 0), (1, 3, 9, 10, 0)], (False, False)),  # attempts add up
        ([(1, 1, None, None, None), (1, 2, 1, 0, None)], (False, False)),
    ],
)
def test_stage_compare(table, counts, differ):
    row = stage(table, *counts).first()
    assert (row["raw_dq_differ"], row["dq_refined_differ"]) == differ


def test_objects_without_raw_row_do_not_show(table):
    assert stage(table, (1, 2, 5, 5, 0)).isEmpty()


def test_an_object_read_under_two_names_shows_per_name(table, rows):
    items = [(1, 1, 1, 1, 1, "a", "t", 1), (2, 1, 2, 1, 1, "a", "t", 1), (4, 1, 2, 1, 1, "b", "t", 1), (3, 1, 3, 1, 1, "a", "t", 1), (5, 1, 3, 1, 0, "z", "t", 1)]
    got = stage(table, (1, 1, 5, 5, 0), (1, 2, 5, 5, 0), (1, 4, 5, 3, 0), (1, 3, 5, 5, 0), (1, 5, 9, 9, 0), items=items)
    assert rows(got, "raw_target_rows", "dq_target_rows", "refined_target_rows") == [(5, 3, 5), (5, 5, 5)]
    assert rows(recon.stage_verdict(got), "tablecount", "verdict") == [(1, "count mismatched")]


def test_spellings_of_a_name_are_one(table, rows):
    items = [(1, 1, 1, 1, 1, "abc", "t", 1), (2, 1, 2, 1, 1, "Abc", "t", 1), (4, 1, 2, 1, 1, "abc ", "t", 1), (3, 1, 3, 1, 1, "abc", "t", 1)]
    got = stage(table, (1, 1, 10, 10, 0), (1, 2, 6, 6, 0), (1, 4, 4, 4, 0), (1, 3, 10, 10, 0), items=items)
    assert rows(got, "raw_target_rows", "dq_target_rows", "refined_target_rows") == [(10, 10, 10)]
    assert rows(recon.stage_verdict(got), "tablecount") == [(0,)]


def test_layers_match_within_tolerance(table, rows):
    layer = lambda *r: table("e string, m decimal(38,7)", *r)
    from decimal import Decimal as D

    layers = {"rpt": layer(("a", D(1)), ("a", D(2)), ("b", D(5)), ("c", D(1))), "certified": layer(("a", D("3.4")), ("b", D(6))), "refined": layer(("a", D(3)), ("b", D(5)))}
    got = recon.layer_reconcile(layers, ["e"], {"x": F.col("m")}, tolerance="0.5")
    assert got.columns == ["e", "x_rpt", "x_certified", "x_refined", "x_match"]
    assert rows(got, "e", "x_match") == [("a", "Y"), ("b", "N"), ("c", "N")]
    assert got.schema["x_rpt"].dataType.simpleString() == "decimal(38,7)"


def test_failure_classes_and_first_error(table, rows):
    items = table(ITEMS, *[(i, 1, 1, i, 1, "n", "t", 1) for i in range(1, 7)], (7, 1, 1, 7, 0, "n", "t", 1), (8, 1, 1, 99, 1, "n", "t", 1))
    objects = table(OBJECTS, *[(i, f"T{i}") for i in range(1, 8)])
    log = table(
        LOG, (1, 1, 1, 1, "Success"), (1, 1, 1, 1, "failed"), (1, 2, 1, 1, "failed"), (1, 3, 1, 1, None), (1, 4, 2, 1, "failed"),
        (2, 5, 1, 1, "success"),
    )
    errors = table(
        ERRORS, (1, 5, 1, 1, 9, AT), (1, 5, 1, 1, 8, AT), (1, 5, 1, 1, 1, AT.replace(year=2025)), (1, 6, 1, 2, 7, AT), (1, 1, 1, 1, 3, AT),
    )
    got = report.failure_detail(items, objects, log, errors, table("batch_id bigint, source_id int", (1, 1)))
    assert rows(got, "job_object_id", "is_failed", "error_log_id") == [
        (2, "Failed", ""), (3, "Failed", ""), (4, "Skipped", ""), (5, "Failed", "8"), (6, "Skipped", ""),
    ]


def test_html_row(one):
    assert one(report.html_row(F.lit("a&b<c"), F.lit(1))) == "<tr><td>a&amp;b<c</td><td>1</td></tr>"
    assert one(report.html_row(F.lit("a"), F.lit(None).cast("string"))) == "<tr/>"


def test_datetime_text():
    assert report.datetime_text(dt.datetime(2024, 1, 3, 0, 5)) == "Jan  3 2024 12:05AM"
    assert report.datetime_text(dt.datetime(2024, 11, 13, 15, 5)) == "Nov 13 2024  3:05PM"


def test_notification_without_records(table):
    groups = table("batch_id bigint, source_id int, job_id int, topic string", (1, 2, 3, "Topic"))
    pages = table("batch_id bigint, source_id int, job_id int, page bigint, body string")
    routing = table("topic string, status string, tolist string", ("topic ", "FAILED", "x"), ("topic", "success", "y"))
    row = report.failure_notification(groups, pages, routing, server="s", now=AT).first()
    assert row["tolist"] == "x" and row["subject"] == "SourceID: 2 Topic execution failed status, servername: s - Jan  1 2024 12:00AM"
    assert row["body"].startswith("Hi Team, <br/><br/> There is no failure records") and row["body"].endswith("Data Team")


def test_success_bodies_by_step(table):
    detail = table(
        """batch_id bigint, source_id int, job_id int, job_object_id bigint, table_name string, source_object_name string,
        time_taken string, size_gb string, source_row_count int, target_row_count int, rejected_row_count int,
        rejected_duplicate_count int, status string""",
        *[(1, 1, j, 5, "T", "src", "00:00:01", "0.5", 3, None, 1, 2, "success") for j in (1, 2, 4)],
    )
    groups = table(
        "batch_id bigint, source_id int, job_id int, topic string, table_count bigint, total_time string",
        *[(1, 1, j, "t", 1, "00:01") for j in (1, 2, 4, 5)], (2, 1, 2, "t", None, None), (2, 1, 4, "t", None, None),
    )
    routing = table("topic string, status string, tolist string", ("t", "success", "x"))
    got = {
        (r["batch_id"], r["job_id"]): r["body"]
        for r in report.success_notification(groups, report.success_pages(detail), routing, server="s", now=AT).collect()
    }
    assert got[1, 1].endswith("<th>Status</th></tr><tr/></table><br> Thanks, <br> Data Team")  # a NULL count empties the row
    assert "SizeInGB" in got[1, 1] and "<tr/>" in got[1, 2] and "rejected_duplicate_count" in got[1, 2]
    assert "<tr><td>T</td><td>00:00:01</td><td>3</td><td>0</td><td>success</td></tr>" in got[1, 4]
    assert "Total table processed = 1<br/> Total execution time  &nbsp;= 00:01 (HH:MM)" in got[1, 4]
    assert got[1, 5] is None  # counted, but without a row to show
    assert "current execution -- SourceID: 1 , BatchID: 2<br/><br/><br> Thanks" in got[2, 2]
    assert "current execution <br/><br/><br> Thanks" in got[2, 4]


def test_stage_notification(table):
    verdict = table("batch_id bigint, source_id int, tablecount bigint", (1, 1, 0), (1, 2, 1), (1, 9, 0))
    pages = table("batch_id bigint, source_id int, page bigint, body string, n_rows bigint", (1, 2, 0, "<tr/>", 1))
    routing = table("topic string, status string, tolist string", ("r", "failed", "x"))
    got = {
        r["source_id"]: r
        for r in report.stage_notification(verdict, pages, routing, topic="R", status="failed", server="s", now=AT).collect()
    }
    assert "is matching" in got[1]["body"] and "Source : Oracle and  Batchid: 1" in got[1]["body"]
    assert got[2]["subject"].startswith("SourceID: 2 DI vs DQ vs RF- count mismatched") and "<tr/></table>" in got[2]["body"]
    assert got[9]["body"] is None  # a source without a known name


def test_verdict_for_runs_without_rows(table, rows):
    none = stage(table).filter("false")
    runs = table("batch_id bigint, source_id int", (1, 1), (1, 1), (2, 1))
    assert rows(recon.stage_verdict(none, runs)) == [(1, 1, 0, "count matched"), (2, 1, 0, "count matched")]


def test_plain_notices(table):
    routing = table("topic string, status string, tolist string", ("Run", "Failed ", "x"), ("run", "success", "y"))
    row = report.failed_run_notice(routing, topic="run", status="failed", source_id=3, server="s", now=AT).first()
    assert row["tolist"] == "x" and row["subject"] == "run execution failed status, servername: s - Jan  1 2024 12:00AM"
    assert row["body"] == "Hi Team, <br/><br/> Pipeline failed for SourceID: 3 <br/><br/><br> Thanks, <br> Data Team"
    row = report.deleted_files_notice(routing, topic="run", status="success", deleted=4, server="s", now=AT).first()
    assert row["body"] == "Hi Team, <br/><br/> Please find run execution success status  FilesDeleted: 4<br/><br/>"


def test_pages_hold_every_row_once(spark):
    rows = spark.range(1000).selectExpr("id % 2 AS g", "cast(id AS string) AS t")
    pages = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=50, sep=",").collect()
    assert len(pages) > 10 and max(p["n_rows"] for p in pages) < 100
    assert sorted(int(x) for p in pages for x in p["body"].split(",")) == list(range(1000))
    whole = paged_text(rows, ["g"], key=F.col("t"), text=F.col("t"), page_rows=500, sep=",").collect()
    assert sorted((p["g"], p["page"], p["n_rows"]) for p in whole) == [(0, 0, 500), (1, 0, 500)]


def test_lineage_counts_the_product(table, rows):
    items = table(ITEMS, (1, 1, 1, 1, 1, "n", "t", 1))
    ones = "batch_id bigint, job_object_id bigint, source_id int, job_id int"
    got = report.lineage(
        items, table("job_id int", (1,)), table("source_id int", (1,)), table(OBJECTS, (1, "T")),
        table(ones, (1, 1, 1, 1), (1, 1, 1, 1), (1, 1, 2, 1), (2, 1, 1, 1)), table(ones, *[(1, 1, 1, 1)] * 3),
        table("job_object_id bigint, object_id int", (1, 1), (1, 1)), table("batch_id bigint, source_id int", (1, 1), (2, 1)),
    )
    assert rows(got, "log_source_id", "n_rows") == [(1, 12), (2, 6)]
    assert report.expand_rows(got).count() == 18


def test_names(table, rows):
    known = table("table_name string", ("A",), ("b",), ("B ",))
    check = lambda *n: tuple(report.name_check(table("n string", *[(x,) for x in n]), known, "table_name").first())
    assert check("a", "B") == (2, 2, True)
    assert check("a", "a") == (2, 1, False)
    assert check("a", "c") == (2, 1, False)
    assert rows(report.unknown_names(table("n string", ("a",), ("C",), ("c",), (" b",)), known, "table_name")) == [(" b",), ("C",)]


@pytest.mark.parametrize(
    "arrived, verdict", [(["a", "B"], "validated"), (["a"], "not received"), (["a", "x"], "name issue"), (["x"], "not received")]
)
def test_file_arrival(table, arrived, verdict):
    files = report.file_arrival(table("f string", ("a",), ("b",)), table("f string", *[(x,) for x in arrived]))
    message = report.arrival_message(files).collect()
    assert len(message) == 1 and message[0]["verdict"] == verdict
    if verdict == "name issue":
        assert "metadata: <br/><br/> x<br/><br/> Please" in message[0]["body"]


def seven_steps(spark, n=50):
    """Items as seven rows of each of a few small ones, their objects, and a log: the engine takes all of them for small."""
    items = spark.range(n).selectExpr("id AS object_id", "explode(sequence(1L, 7L)) AS job_id").selectExpr(
        "object_id * 7 + job_id AS job_object_id", "1L AS source_id", "job_id", "object_id", "'s' AS source_object_name",
        "'dim_' || object_id AS target_object_name", "1L AS execution_sequence", "1 AS enabled",
    )
    objects = spark.range(n).selectExpr("id AS object_id", "'t' || id AS table_name")
    log = items.selectExpr(
        "1L AS batch_id", "source_id", "job_id", "job_object_id", "'success' AS status", "10L AS target_size", "1 AS source_row_count",
        "1 AS target_row_count", "0 AS rejeted_row_count", "0 AS rejected_duplicate_count",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS object_start_date", "TIMESTAMP_NTZ '2024-01-01 00:01:00' AS object_end_date",
    )
    return items, objects, log


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_and_objects_never_go_whole_through_the_driver(spark):
    items, objects, log = seven_steps(spark)
    detail = report.success_detail(log, items, objects)
    summary = report.run_summary(report.run_items(log, items.select("job_object_id", "source_id", "job_id")), by=report.RUN)
    for df in (detail, summary):
        assert "Broadcast" not in planned(df)
    assert detail.count() == 350 and sum(r["table_count"] for r in summary.collect()) == 350


def test_lineage_broadcasts_steps_sources_and_batches_only(spark):
    items, objects, log = seven_steps(spark)
    few = spark.range(1, 8).selectExpr("id AS job_id", "id AS source_id", "id AS batch_id")
    errors = log.selectExpr("batch_id", "source_id", "job_id", "job_object_id")
    got = report.lineage(items, few, few, objects, log, errors, items, few)
    assert planned(got).count("BroadcastExchange") <= 3 and got.count() == 350
