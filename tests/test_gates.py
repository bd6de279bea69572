from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import gates, worklist
from loadkeeper.operators.joins import not_in
from loadkeeper.functions.clock import local_day
from loadkeeper.plans import worklists
from loadkeeper.plans.worklists import Control

ITEMS = """job_object_id bigint, job_id int, source_id int, object_id int, source_object_name string,
  target_object_name string, enabled int, dependent_table_list string, execution_sequence int, last_run_time timestamp_ntz"""
LOG = "batch_id bigint, job_object_id bigint, source_id int, job_id int, status string, log_date timestamp_ntz"
EDGES = """dependency_id int, source_id int, job_id int, job_object_id bigint, ExecutionSequence int,
  dependent_job_id int, dependent_job_object_id bigint, enabled boolean"""
BATCHES = "batch_id bigint, source_id int, batch_start_date timestamp_ntz"
NOW = "2024-01-03 03:00:00"  # 2 January, 22:00 in the east


def item(id, job=4, source=1, name=None, deps=None, enabled=1, sequence=1, target=None):
    return (id, job, source, id, name or f"n{id}", target or f"dwh.t{id}", enabled, deps, sequence, None)


def ok(id, batch=1, status="success", source=1, job=3, day=None):
    import datetime as dt

    return (batch, id, source, job, status, dt.datetime.fromisoformat(day) if day else None)


@pytest.mark.parametrize(
    "deps, ready",
    [
        (None, True),  # no list
        ("", False),  # one empty entry, nothing met
        ("a", True),
        ("A ", True),  # case and trailing blanks
        (" a", False),  # leading blanks count
        ("a,b", True),
        ("a,c", False),  # c has not succeeded
        ("a,a", False),  # two entries, one match
        ("twin", False),  # one entry, two succeeded items under the name
        ("twin,missing", True),  # two entries, two matches
        ("off", False),  # its item is disabled
        ("other", False),  # item of another source
        ("late", False),  # item of a step that does not count
    ],
)
def test_list_gate(spark, table, rows, deps, ready):
    items = table(
        ITEMS, item(1, job=4, deps=deps), item(10, 3, name="a"), item(11, 3, name="B"), item(12, 3, name="c"),
        item(13, 3, name="twin"), item(14, 4, name="twin"), item(15, 3, name="off", enabled=0),
        item(16, 3, source=2, name="other"), item(17, 5, name="late"),
    )
    log = table(LOG, *[ok(i) for i in (10, 11, 13, 14, 15, 16, 17)], ok(10), ok(12, status="failed"), ok(12, batch=2))
    runs = table("batch_id bigint, source_id int", (1, 1))
    asked = worklist.for_runs(items.filter("job_object_id = 1"), runs)
    kept = gates.list_gate(
        asked, items, gates.succeeded(log, runs), runs, job_id=4, name_col="source_object_name", jobs=(3, 4)
    )
    assert (kept.count() == 1) is ready


def test_pending_reads_status_without_case_and_keeps_null(table, rows):
    items = table("batch_id bigint, job_object_id bigint", (1, 1), (1, 2), (1, 3), (2, 1))
    log = table(LOG, ok(1, status="SUCCESS "), ok(2, status=None), ok(1, status="failed"))
    assert rows(gates.pending(items, gates.succeeded(log))) == [(1, 2), (1, 3), (2, 1)]


@pytest.mark.parametrize(
    "right, kept",
    [
        ([], [1, 2, None]),
        ([1], [2]),
        ([None], []),
        ([1, None], []),
    ],
)
def test_not_in_follows_sql(spark, table, right, kept):
    left = table("g int, k int", (7, 1), (7, 2), (7, None))
    keys = table("g int, k int", *[(7, k) for k in right], (8, 5))
    got = {r["k"] for r in not_in(left, keys, "k", ["g"]).collect()}
    assert got == set(kept)
    got = {r["k"] for r in not_in(left, keys.filter("g = 7"), "k").collect()}
    assert got == set(kept)
    left.createOrReplaceTempView("l")
    keys.createOrReplaceTempView("r")
    assert {r["k"] for r in spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT k FROM r WHERE g = 7)").collect()} == set(kept)


def edge_case(table, *edges, log=()):
    items = table("batch_id bigint, source_id int, job_object_id bigint, execution_sequence int", (6, 1, 1, 1), (6, 1, 2, 1), (6, 1, 3, 2))
    batches = _batches(table)
    latest = gates.latest_batches(batches, NOW)
    kept = gates.edge_gate(
        items, table(EDGES, *edges), table(LOG, *log), latest, sequence=F.col("execution_sequence")
    )
    return sorted(r["job_object_id"] for r in kept.collect())


def _batches(table):
    import datetime as dt

    at = dt.datetime.fromisoformat
    return table(
        BATCHES, (1, 1, at("2024-01-01 23:00:00")), (6, 1, at("2024-01-02 01:00:00")), (7, 1, at("2024-01-02 05:00:00")),
        (8, 2, at("2024-01-02 23:59:59")), (9, 2, at("2024-01-03 00:00:00")),
    )


def test_latest_batches_use_the_eastern_day(table, rows):
    assert rows(gates.latest_batches(_batches(table), NOW), "source_id", "batch_id") == [(1, 7), (2, 8)]


def test_edge_is_met_by_any_row_in_a_latest_batch(table):
    edge = (1, 1, 4, 1, 1, 5, 50, True)
    assert edge_case(table, edge) == [2, 3]
    assert edge_case(table, edge, log=[ok(50, batch=8, status="failed")]) == [1, 2, 3]
    assert edge_case(table, edge, log=[ok(50, batch=6)]) == [2, 3]


def test_unmet_edge_without_item_holds_back_its_sequence(table):
    unknown = (1, 1, 4, None, 1, 5, 50, True)
    assert edge_case(table, unknown) == [3]
    assert edge_case(table, unknown, log=[ok(50, batch=8)]) == [1, 2, 3]
    assert edge_case(table, (1, 1, 4, None, 1, 5, 50, False)) == [1, 2, 3]


def test_edge_status_and_missing(table, rows):
    edges = table(EDGES, (1, 1, 4, 1, 1, 3, 50, True), (2, 1, 4, 2, 1, 5, 51, True), (3, 2, 4, 2, 1, 5, 51, True), (4, 1, 4, 2, 1, 5, 52, False))
    log = table(LOG, ok(50, batch=7), ok(51, batch=8, status="failed"))
    latest = gates.latest_batches(_batches(table), NOW)
    state = lambda **o: rows(gates.edge_status(edges, log, latest, **o), "source_id", "expected", "done", "ready")
    assert state() == [(1, 2, 1, False), (2, 1, 0, False)]
    assert state(require_success=False) == [(1, 2, 2, True), (2, 1, 1, True)]
    assert state(require_success=False, min_dependent_job=5) == [(1, 1, 1, True), (2, 1, 1, True)]
    assert rows(gates.missing_edges(edges, log, latest), "dependency_id") == [(2,), (3,)]


def test_drain_ignores_null_status_and_other_days(table, rows):
    import datetime as dt

    at = dt.datetime.fromisoformat("2024-01-02 08:00:00")
    batches = table(
        "trigger_time timestamp_ntz, pipeline_name string, batch_run_status string",
        (at, "a", "successfully completed "), (at, "A ", None), (at, "b", "Active"), (at, "B ", "Active"), (at.replace(day=1), "a", "Failed"),
    )
    got = rows(gates.drain_state(batches, NOW), "pipeline_name", "open_batches", "drained")
    assert got == [("A ", 0, True), ("B ", 2, False)]


def flags(spark, table, items, log):
    items, log = table(ITEMS, *items), table(LOG, *log)
    today = local_day(NOW)
    return spark.range(1).select(
        gates.logged_yesterday(log, items, "DWH.gate", today).alias("a"),
        gates.all_refreshed_yesterday(log, items, today).alias("b"),
    ).first()


def test_refresh_counts_rows_of_any_status(spark, table):
    gate = [item(1, 5, 3, target="dwh.gate"), item(2, 5, 3)]
    assert tuple(flags(spark, table, gate, [])) == (False, False)
    assert tuple(flags(spark, table, gate, [ok(1, day="2024-01-01 10:00:00")])) == (True, False)
    twice = [ok(1, day="2024-01-01 10:00:00"), ok(1, status="failed", day="2024-01-01 11:00:00")]
    assert tuple(flags(spark, table, gate, twice)) == (True, True)
    assert tuple(flags(spark, table, gate, [ok(1, day="2024-01-02 10:00:00")])) == (False, False)
    assert flags(spark, table, [item(1, 5, 1)], [])["b"] is True  # nothing expected, nothing logged


@pytest.fixture
def control(table):
    items = table(
        ITEMS, item(1, 1), item(2, 1), item(3, 1, enabled=0), item(4, 1, source=9), item(5, 1, source=2),
        item(11, 7, source=1, target="dwh.recon_gl_a"), item(12, 7, source=1, target="dwh.other"), item(13, 7, source=3),
        item(30, 5, 3),
    )
    return lambda log: Control(
        items=items,
        sources=table("source_id int, source_name string, enabled boolean", (1, "a", True), (2, "b", False), (3, "c", True)),
        jobs=table("job_id int, enabled boolean", (1, True), (7, True)),
        objects=items.select("object_id", F.concat(F.lit("T"), "object_id").alias("table_name")),
        log=table(LOG, *log), batches=_batches(table), edges=table(EDGES),
    )


def ids(df):
    return sorted(r["job_object_id"] for r in df.collect())


def test_raw_worklist_and_names(control, table):
    runs = table("batch_id bigint, source_id int", (1, 1), (2, 2))
    c = control([ok(1)])
    assert ids(worklists.raw(c, runs)) == [2]
    assert ids(worklists.raw(c, runs, "t1,t9")) == [1]  # a name list brings succeeded items back
    assert ids(worklists.raw(c, runs, "t1 ,T2")) == [1, 2]
    assert ids(worklists.raw(c, runs, "")) == [2]


def test_recon_worklist_by_refresh_and_day(control, table):
    runs = table("batch_id bigint, source_id int", (7, 1), (9, 3))
    saturday = "2024-01-06 20:00:00"
    assert ids(worklists.recon(control([]), runs, NOW)) == [13]  # not refreshed: only the source itself
    assert ids(worklists.recon(control([]), runs, saturday)) == [11, 12, 13]
    after = control([ok(30, day="2024-01-01 10:00:00", source=3, job=5)])
    assert ids(worklists.recon(after, runs, NOW)) == [11]  # refreshed: only the ledger targets
    assert ids(worklists.recon(control([ok(11, batch=7)]), runs, NOW, adhoc=True)) == [12, 13]


def test_nothing_keeps_the_columns(control):
    empty = worklist.nothing(control([]).items)
    assert empty.count() == 0 and "job_object_id" in empty.columns


def test_finish_batches_rolls_up_only_completed_requests(control, table, rows):
    import datetime as dt

    from loadkeeper.operators import batch
    from loadkeeper.plans import lifecycle

    at = dt.datetime(2024, 1, 2)
    c = control([ok(1, batch=6), ok(2, batch=6), ok(1, batch=7)])
    state = c.batches.withColumns({"batch_end_date": F.lit(None).cast("timestamp_ntz"), "batch_log_message": F.lit(""), "batch_run_status": F.lit("Active")})
    closing = table(
        "batch_id bigint, batch_end_date timestamp_ntz, batch_log_message string, batch_run_status string",
        (6, at, "m", "successfully completed"), (7, at, "m", "Successfully Completed"), (8, at, None, "Failed"),
    )
    expected = batch.expected_regular(F.lit(False), NOW)
    got = lifecycle.finish_batches(replace(c, batches=state), closing, expected)
    assert rows(got, "batch_id", "batch_run_status", "batch_log_message") == [
        (1, "Active", ""), (6, "Successfully Completed", "m"), (7, "Partially Failed", "m"), (8, "Failed", None), (9, "Active", ""),
    ]


def test_late_failures_need_the_gate_table(control, table):
    import datetime as dt

    from loadkeeper.plans import lifecycle

    errors = table("batch_id bigint, job_object_id bigint, source_id int, job_id int, error_log_id bigint, log_date timestamp_ntz")
    routing = table("topic string, status string, tolist string", ("recon", "failed", "x"))
    runs = table("batch_id bigint, source_id int", (7, 1))

    def body(*log):
        c = control(log)
        items = c.items.withColumn(
            "target_object_name", F.when(F.col("job_object_id") == 30, worklists.GATE_TARGET).otherwise(F.col("target_object_name"))
        )
        return lifecycle.failure_report(
            replace(c, items=items), errors, runs, routing, job_id=7, topic="recon", server="s", now=dt.datetime(2024, 1, 2, 3)
        ).first()["body"]

    assert "There is no failure records" in body()
    assert "<td>T11</td><td>Skipped</td><td></td></tr><tr><td>T12</td>" in body(ok(30, day="2024-01-01 23:00:00"))


def test_named_items_and_counts_of_a_list_gate_are_shuffled(spark):
    """Items made of a few rows look small to the engine, however many they are."""
    items = spark.range(50).selectExpr("id AS object_id", "explode(sequence(4L, 7L)) AS job_id").selectExpr(
        "object_id * 7 + job_id AS job_object_id", "1L AS source_id", "job_id", "1 AS enabled", "1L AS batch_id",
        "'n_' || object_id || '_' || job_id AS target_object_name", "'n_' || object_id || '_' || (job_id - 1) AS dependent_table_list",
    )
    runs = spark.range(1).selectExpr("1L AS batch_id", "1L AS source_id")
    done = items.filter("job_id = 4").select("batch_id", "job_object_id").distinct()
    state = gates.list_gate_state(items, items, done, runs, name_col="target_object_name", jobs=(3, 4, 5, 6))
    joins = [x for x in state._jdf.queryExecution().executedPlan().toString().split("\n") if "BroadcastHashJoin" in x]
    assert not [x for x in joins if "BroadcastHashJoin [job_object_id" in x or "_name" in x]
    assert state.count() == 200 and state.filter("met_count = 1").count() == 50 == state.filter("met_count = 1 AND job_id = 5").count()
