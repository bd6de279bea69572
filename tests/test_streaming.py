import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import changes, gates
from loadkeeper.streaming import ingest, readiness, ready

LOG = "batch_id bigint, job_object_id bigint, status string"
EDGES = """dependency_id int, source_id int, job_id int, job_object_id bigint, ExecutionSequence int, dependent_job_id int,
  dependent_job_object_id bigint, enabled boolean"""


def schema(table, ddl):
    return table(ddl).schema


def test_readiness_turns_true_as_rows_arrive(spark, table, tmp_path, rows):
    logs, folder = str(tmp_path / "log"), str(tmp_path / "state")
    edges = table(EDGES, (1, 1, 4, 1, 1, 3, 50, True), (2, 1, 4, 2, 1, 3, 51, True), (3, 2, 4, 3, 1, 3, 51, True), (4, 2, 4, 3, 1, 3, 99, False))

    def arrive(*new, batch=7):
        table(LOG, *new).write.mode("append").parquet(logs)
        stream = readiness.log_stream(spark, logs, schema(table, LOG), files_per_batch=1)
        readiness.watch_readiness(stream, edges, folder=folder).awaitTermination()
        met = readiness.met_so_far(spark, f"{folder}/met", table("source_id int, batch_id bigint", (1, batch)))
        return rows(readiness.readiness(edges, met), "source_id", "expected", "done", "ready")

    assert arrive((7, 50, "failed"), (6, 51, "success")) == [(1, 2, 0, False), (2, 1, 0, False)]
    assert arrive((7, 50, "Success"), (7, 50, "success")) == [(1, 2, 1, False), (2, 1, 0, False)]
    assert arrive((7, 51, "success"), (7, 50, "success")) == [(1, 2, 2, True), (2, 1, 1, True)]
    state = spark.read.parquet(f"{folder}/met")
    assert state.count() == state.select("batch_id", "dependency_id").distinct().count() == 5
    # the next day's batch starts from nothing
    assert arrive((8, 51, "success"), batch=8) == [(1, 2, 1, False), (2, 1, 1, True)]


def test_ingest_reads_every_file_once(spark, table, tmp_path):
    source, target, ddl = str(tmp_path / "in"), str(tmp_path / "out"), "id int, ts timestamp_ntz"
    at = dt.datetime(2024, 1, 1, 10)

    def load(*new):
        table(ddl, *new).write.mode("append").parquet(source)
        ingest.ingest(
            spark, source, schema(table, ddl), target, checkpoint=str(tmp_path / "cp"), column="ts",
            lower="2024-01-01 00:00:00", upper="2024-01-02 00:00:00",
        ).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(target).collect())

    assert load((1, at), (2, at.replace(year=2023))) == [1]
    assert load((3, at)) == [1, 3]


def test_change_feed(spark, table, tmp_path, rows):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    ddl = "before struct<k: int, v: string>, after struct<k: int, v: string>"
    table(ddl, (None, (1, "a")), ((1, "a"), (1, "b")), ((2, "x"), None)).write.parquet(source)
    feed = spark.readStream.schema(schema(table, ddl)).parquet(source)
    ingest.audit_changes(feed, target, user="me", now="2024-01-01 00:00:00").awaitTermination()
    assert rows(spark.read.parquet(target), "Activity", "k", "v") == [("DELETE", 2, "x"), ("INSERT", 1, "a"), ("UPDATE", 1, "b")]


@pytest.fixture
def followed(spark, table, tmp_path):
    """Rows arrive as files; each call follows the log until nothing is left and returns all that was announced so far."""
    logs, out, state = (str(tmp_path / n) for n in ("log", "ready", "state"))
    edges = table(EDGES, (1, 1, 4, 1, 1, 3, 50, True), (2, 1, 4, 2, 1, 3, 51, True), (3, 2, 4, 3, 1, 3, 51, True), (4, 2, 4, 3, 1, 3, 99, False))
    day = lambda n: dt.datetime(2024, 1, n, 4)
    batches = table("batch_id bigint, source_id int, batch_start_date timestamp_ntz", (7, 1, day(1)), (8, 2, day(1)), (6, 1, day(1)), (17, 1, day(2)), (27, 1, day(9)), (37, 1, day(10)))
    seen = []

    def arrive(*new, files_per_batch=1):
        for row in new:
            table(LOG, row).coalesce(1).write.mode("append").parquet(logs)
        stream = readiness.log_stream(spark, logs, schema(table, LOG), files_per_batch=files_per_batch)
        query = ready.watch(stream, edges, batches, out, checkpoint=state)
        query.awaitTermination()
        seen.extend(query.recentProgress)
        found = spark.read.schema(ready.READY).parquet(out)
        return sorted((r["day"].day, r["source_id"], r["edges"]) for r in found.collect())

    arrive.progress, arrive.state = seen, tmp_path / "state"
    return arrive


def test_a_step_is_announced_once_when_its_last_edge_is_met(followed):
    assert followed((7, 50, "failed"), (6, 51, "success"), (7, 50, "Success ")) == []  # 6 is not the newest batch of its source
    assert followed((7, 50, "success"), (8, 51, "success")) == [(1, 1, 2), (1, 2, 1)]
    assert followed((8, 51, "success"), (7, 51, "success")) == [(1, 1, 2), (1, 2, 1)]
    assert followed((17, 51, "success")) == [(1, 1, 2), (1, 2, 1), (2, 2, 1)]  # the next day starts from nothing


def test_a_driver_lost_between_two_epochs_changes_nothing(followed):
    whole = [(7, 50, "success"), (8, 51, "success"), (17, 51, "success"), (17, 50, "success")]
    followed(*whole[:2])
    commits = sorted((followed.state / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for lost in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):  # written, but never marked as done
        lost.unlink(missing_ok=True)
    assert followed(*whole[2:]) == [(1, 1, 2), (1, 2, 1), (2, 1, 2), (2, 2, 1)]


def test_state_follows_the_open_days(followed):
    followed((7, 50, "success"), (8, 51, "success"))
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in followed.progress]
    assert max(held) == 5  # three edges, two groups
    assert followed((27, 50, "success"), (27, 51, "success"), (37, 50, "success"))[2:] == [(9, 1, 2), (9, 2, 1)]
    assert sum(o["numRowsTotal"] for o in followed.progress[-1]["stateOperators"]) == 7  # four edges, three groups, nothing of the first day
    before = followed((7, 51, "success"), (8, 51, "success"))
    assert before[:2] == [(1, 1, 2), (1, 2, 1)] and len(before) == 4  # late rows announce nothing again


def test_streamed_readiness_equals_the_gate_of_each_day(spark, table, tmp_path, rows):
    """Random logs in random order against the batch form over the whole log."""
    dice = random.Random(8)
    edges = table(EDGES, *[(i, dice.randrange(3), 4, i, 1, 3, dice.randrange(12), True) for i in range(20)])
    batches = table("batch_id bigint, source_id int, batch_start_date timestamp_ntz", *[(b, b % 3, dt.datetime(2024, 1, 1 + b // 6)) for b in range(12)])
    log = [(dice.randrange(12), dice.randrange(12), dice.choice(["success", "success", "failed"])) for _ in range(160)]
    for k in range(3):
        table(LOG, *log[k::3]).write.mode("append").parquet(str(tmp_path / "log"))
        stream = readiness.log_stream(spark, str(tmp_path / "log"), schema(table, LOG))
        ready.watch(stream, edges, batches, str(tmp_path / "out"), checkpoint=str(tmp_path / "state")).awaitTermination()
    got = spark.read.schema(ready.READY).parquet(str(tmp_path / "out"))
    expected = []
    for day in (1, 2):
        latest = gates.latest_batches(batches.filter(F.dayofmonth("batch_start_date") == day), f"2024-01-0{day} 12:00:00", "UTC")
        state = gates.edge_status(edges, table(LOG, *log), latest)
        expected += [(day, r["source_id"], r["expected"]) for r in state.filter("ready").collect()]
    assert sorted((r["day"].day, r["source_id"], r["edges"]) for r in got.collect()) == sorted(expected) != []


FEED = "before struct<k: int, v: string>, after struct<k: int, v: string>, changed_at timestamp, change_id string"


def test_a_feed_with_repeats_and_late_rows(spark, table, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "audit")
    at = lambda d: dt.datetime(2024, 1, d)
    seen = []

    def arrive(*new):
        table(FEED, *new).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema(table, FEED)).parquet(feed)
        query = ingest.audit_feed(
            stream, out, user="me", change_id="change_id", at="changed_at", delay="5 days", checkpoint=str(tmp_path / "state")
        )
        query.awaitTermination()
        seen.extend(query.recentProgress)
        return spark.read.parquet(out)

    came, updated, gone = (None, (1, "a"), at(1), "c1"), ((1, "a"), (1, "b"), at(3), "c2"), ((2, "x"), None, at(4), "c3")
    arrive(updated, came, came)
    got = arrive(came, gone, (None, (2, "x"), at(2), "c0"), updated)
    assert sorted((r["change_id"], r["Activity"], r["k"], r["v"], r["modify_date"].day) for r in got.collect()) == [
        ("c0", "INSERT", 2, "x", 2), ("c1", "INSERT", 1, "a", 1), ("c2", "UPDATE", 1, "b", 3), ("c3", "DELETE", 2, "x", 4)
    ]
    assert [tuple(r) for r in changes.replay(got.drop("change_id"), ["k"]).collect()] == [(1, "b")]
    arrive((None, (9, "z"), at(20), "c9"))
    last = arrive(came, (None, (3, "late"), at(5), "c5"))  # fifteen days behind: not taken in, but counted
    assert sorted(r["change_id"] for r in last.collect()) == ["c0", "c1", "c2", "c3", "c9"]
    assert sum(o["numRowsDroppedByWatermark"] for p in seen for o in p["stateOperators"]) == 2


def test_replay_of_nothing_and_of_ties(table):
    ddl = "k int, v string, Activity string, change_doneBy string, modify_date timestamp_ntz, n int"
    at = dt.datetime(2024, 1, 1)
    rows = table(ddl, (1, "a", "INSERT", "u", at, 1), (1, "b", "UPDATE", "u", at, 2), (2, None, "INSERT", "u", at, 1), (3, "c", "DELETE", "u", at, 2))
    assert sorted(map(tuple, changes.replay(rows, ["k"], ["modify_date", "n"]).collect())) == [(1, "b"), (2, None)]
    assert changes.replay(rows.limit(0), ["k"], ["n"]).collect() == []
