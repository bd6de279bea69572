import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import batch, tables
from loadkeeper.plans import lifecycle
from loadkeeper.plans.worklists import GATE_TARGET, Control

AT = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
BATCHES = "batch_id bigint, source_id int, batch_start_date timestamp_ntz, batch_run_status string, trigger_id string"


@pytest.mark.parametrize(
    "status, rerun, asked, decision",
    [
        (None, 0, "Active", "new"),  # no batch yet
        ("ACTIVE ", 0, "Active", "reject_running"),
        ("Active", 1, "Active", "reject_running"),
        ("Failed", 0, None, "resume"),
        ("partially failed", 0, "Active", "resume"),
        ("Failed", 1, "Active", "new"),
        ("Failed", None, "Active", "new"),
        ("Failed", 1, "Failed", "reject_status"),
        ("Successfully Completed", 0, None, "reject_status"),
        ("Successfully Completed", 0, "active", "new"),
    ],
)
def test_decision(table, status, rerun, asked, decision):
    batches = table(BATCHES, (5, 1, AT, status, None), (4, 1, AT, "Active", None)) if status else table(BATCHES)
    requests = table("source_id int, is_rerun int, requested_status string", (1, rerun, asked))
    got = batch.batch_decision(batches, requests).first()
    assert got["decision"] == decision
    assert got["batch_id"] == (5 if decision == "resume" else None)


def test_open_close_open_keeps_one_active_batch(table, rows):
    batches = table(BATCHES, (5, 1, AT, "Failed", None), (6, 2, AT, "Successfully Completed", None), (7, 3, AT, "Active", None))
    requests = table("source_id int, is_rerun int, requested_status string", *[(s, 0, "Active") for s in (1, 2, 3, 4)])
    opened = batch.open_batches(batches, requests, start=AT, trigger_id="t")
    active = opened.filter("batch_run_status = 'Active'")
    assert rows(active.groupBy("source_id").count()) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    assert opened.count() == 5 and opened.select("batch_id").distinct().count() == 5
    assert opened.agg(F.min("batch_id")).first()[0] == 5 and opened.filter("batch_id > 7").count() == 2
    again = batch.open_batches(opened, requests, start=AT)
    assert rows(again.filter("batch_run_status = 'Active'").groupBy("source_id").count()) == [(s, 1) for s in (1, 2, 3, 4)]


def test_rollup_counts_every_success_of_the_batch(table, rows):
    batches = table("batch_id bigint, source_id int", (1, 1), (2, 1), (3, 2))
    items = table(
        "job_object_id bigint, source_id int, job_id int, enabled int, target_object_name string",
        (1, 1, 1, 1, "a"), (2, 1, 5, 1, "a"), (3, 1, 6, 1, "a"), (4, 1, 7, 1, "DWH.Recon_GL_x"), (5, 1, 7, 1, "b"), (6, 1, 1, 0, "a"),
    )
    log = table(
        "batch_id bigint, job_object_id bigint, status string",
        (1, 1, "success"), (1, 1, "Success"), (1, 2, "success"), (2, 1, "success"), (2, 2, "failed"), (2, 99, "success"),
        (1, None, "success"),
    )
    monday = "2024-01-01 12:00:00"
    roll = lambda e: rows(batch.batch_rollup(batches, log, items, e), "batch_id", "done_items", "expected_items", "batch_run_status")
    done, part = "Successfully Completed", "Partially Failed"
    regular = roll(batch.expected_regular(F.lit(False), monday))
    # the success of a foreign item counts; a batch with nothing done and nothing expected is complete
    assert regular == [(1, 2, 2, done), (2, 2, 2, done), (3, 0, 0, done)]
    assert roll(batch.expected_regular(F.lit(True), monday))[0] == (1, 2, 4, part)
    assert roll(batch.expected_regular(F.lit(False), "2024-01-06 20:00:00"))[0] == (1, 2, 4, part)
    assert roll(batch.expected_adhoc(F.lit(True)))[0] == (1, 2, 5, part)


def test_dataset_rollup_by_day(table, rows):
    config = table("domain_id bigint, enabled boolean, job_frequency string", (1, True, "D"), (1, True, "D"), (2, True, "W"), (3, True, None), (4, False, "D"))
    batches = table("batch_id bigint, source_id int", (1, 99))
    log = table("batch_id bigint, job_object_id bigint, status string", (1, 1, "success"))
    roll = lambda now: rows(batch.dataset_rollup(batches, log, config, batch.expected_datasets(now)), "expected_items", "batch_run_status")
    assert roll("2024-01-01 12:00:00") == [(1, "Successfully Completed")]
    assert roll("2024-01-07 20:00:00") == [(3, "Partially Failed")]


def test_updates_write_null_and_skip_null_keys(table, rows):
    t = table("k int, j int, v string, w string", (1, 1, "a", "x"), (2, None, "b", "y"))
    got = tables.update_rows(t, table("k int, j int, v string", (1, 1, None), (2, None, "z")), ["k", "j"])
    assert rows(got, "k", "v", "w") == [(1, None, "x"), (2, "b", "y")]


def test_guarded_watermark_compares_text(table, rows):
    items = table("job_object_id bigint, last_run_time timestamp_ntz", *[(i, None) for i in range(1, 5)])
    done = table(
        "job_object_id bigint, batch_start_date timestamp_ntz, source_row_count string, target_row_count string",
        (1, AT, "10", "10"), (2, AT, "10", "010"), (3, AT, None, None),
    )
    moved, failed = tables.advance_watermark_guarded(items, done)
    assert rows(moved) == [(1, AT), (2, None), (3, None), (4, None)]
    assert rows(failed, "job_object_id", "error_message") == [(i, "Source and target count mismatch") for i in (2, 3)]


def test_failure_rows_are_whole_unless_widths_are_given(table):
    failure = table("activity string, error_code int, error_message string", ("a" * 80, 50010, "m" * 400))
    whole = batch.failure_rows(failure, AT).first()
    assert (len(whole["activity"]), len(whole["error_message"]), whole["error_code"]) == (80, 400, "50010")
    row = batch.failure_rows(failure, AT, widths=(50, 100, 250)).first()
    assert (len(row["activity"]), len(row["error_message"]), row["error_code"]) == (50, 250, "50010")
    assert (row["error_type"], row["error_subtype"], row["log_date"]) == ("TechnicalError", "LogicalError", dt.datetime(2024, 1, 2))


def test_repeated_requests_open_one_batch_with_the_same_id(table, rows):
    batches = table(BATCHES, (5, 1, AT, "Successfully Completed", None))
    requests = table("source_id int, is_rerun int, requested_status string", (2, 0, "Active"), (1, 0, "Active"), (1, 0, "active"), (9, 0, "Active"))
    opened = batch.open_batches(batches, requests, start=AT)
    assert rows(opened.filter("batch_id > 5"), "batch_id", "source_id") == [(6, 1), (7, 2), (8, 9)]
    assert rows(opened) == rows(batch.open_batches(batches, requests.repartition(3, "is_rerun"), start=AT))


def test_a_repeated_change_leaves_one_row(table, rows):
    t = table("k int, v string, w int", (1, "a", 1), (2, "b", 2))
    got = tables.update_rows(t, table("k int, v string, w int", (1, "x", 9), (1, "y", 3), (1, None, 4)), "k")
    assert rows(got) == [(1, "y", 3), (2, "b", 2)]


def test_corrections_have_an_order_or_agree(table, rows):
    ddl = "source_id int, job_id int, job_object_id bigint, batch_id bigint, status string"
    log = table(ddl, (1, 1, 1, 1, "running"), (1, 1, 2, 1, "running"))
    twice = table(f"{ddl}, at int", (1, 1, 1, 1, "success", 1), (1, 1, 1, 1, "failed", 2))
    assert rows(batch.fix_status(log, twice, order="at"), "job_object_id", "status") == [(1, "failed"), (2, "running")]
    agreed = twice.filter("at = 1").unionByName(twice.filter("at = 1")).drop("at")
    assert rows(batch.fix_status(log, agreed), "job_object_id", "status") == [(1, "success"), (2, "running")]
    with pytest.raises(Exception, match="give their order"):
        batch.fix_status(log, twice.drop("at")).collect()


def test_the_gate_of_a_closing_batch_goes_by_the_servers_day(table):
    control = Control(
        items=table("job_object_id bigint, target_object_name string", (1, GATE_TARGET)), sources=None, jobs=None, objects=None,
        log=table("job_object_id bigint, log_date timestamp_ntz", (1, dt.datetime(2024, 1, 2, 5))), batches=None, edges=None,
    )
    # 3 January on the server, still the 2nd in the east
    seen = table("x int", (1,)).select(lifecycle.gate_refreshed(control, "2024-01-03 03:00:00").alias("g")).first()["g"]
    before = table("x int", (1,)).select(lifecycle.gate_refreshed(control, "2024-01-02 23:00:00").alias("g")).first()["g"]
    assert seen and not before
