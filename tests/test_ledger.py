"""Ledgers: repeated and competing writers, settings over rows, compaction, and gates kept from new commits."""

import random
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loadkeeper.operators import gates
from loadkeeper.plans import journal
from loadkeeper.sources import ledger as ledgers
from loadkeeper.sources.ledger import Change, Conflict, Ledger
from loadkeeper.sources.schemas import _struct

SCHEMA = _struct("id INT, k BIGINT, v STRING, w STRING")
ROWS = "k bigint, v string, w string"


@pytest.fixture
def made(spark, tmp_path):
    def make(name="t", **options):
        return Ledger(spark, str(tmp_path / name), SCHEMA, **{"key": ["k"], "identity": "id"} | options)

    return make


def shown(ledger, version=None):
    return sorted((tuple(r) for r in ledger.read(version).collect()), key=repr)


def test_a_repeated_run_leaves_one_copy(made, table):
    log, rows = made(), table(ROWS, (1, "a", "x"), (2, "b", None))
    assert log.read().count() == 0 and log.version() == -1
    assert [log.append(rows, "first"), log.append(rows, "first"), made().append(rows, "first")] == [0, 0, 0]
    assert log.append(rows, "second") == 1 and log.append(rows, "first") == 0
    assert [r[0] for r in shown(log)] == [1, 2, 3, 4] and log.read(0).count() == 2


def test_readers_see_committed_files_only(spark, made, table, tmp_path):
    log, rows = made(), table(ROWS, (1, "a", "x"))
    log.append(rows, "first")
    log._write(rows)  # a writer that died before its commit
    (tmp_path / "t" / "commits" / "x.json.tmp").write_text("{")
    (tmp_path / "t" / "commits" / f"{7:020d}.json").write_text("{")  # a listing that is ahead of the ones before
    log._known[7] = None
    assert shown(log) == [(1, 1, "a", "x")]


def test_a_number_is_taken_once(made, table, monkeypatch):
    rows = table(ROWS, (1, "a", "x"))
    for scheme in ("file", "none"):  # by a second name for a file, and by a rename that does not replace
        monkeypatch.setattr(ledgers, "LOCAL", scheme)
        log = made(scheme)
        commit = ledgers.Commit(0, "r", log._write(rows))
        assert log._publish(commit) and not log._publish(commit) and log.version() == 0


def test_many_appenders_at_once(made, table):
    def write(i):
        return made().append(table(ROWS, (i, str(i), None)), f"run-{i}")

    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(write, range(12)))
    assert sorted(versions) == list(range(12))
    got = shown(made())
    assert sorted(r[0] for r in got) == list(range(1, 13))
    assert sorted(r[1] for r in got) == list(range(12))


def test_two_writers_open_batches_at_once(spark, table, tmp_path):
    """Both read the same table before either has written: the second decides again."""
    seed = table("batch_id bigint, source_id int, batch_run_status string", (5, 1, "Successfully Completed"), (6, 2, "Failed"), (7, 3, "Active"))
    journal.batch_table(spark, str(tmp_path)).append(seed, "seed")
    requests = table("source_id int, is_rerun int, requested_status string", *[(s, 0, "Active") for s in (1, 2, 3, 4)])
    meet, tries = threading.Barrier(2), []

    def write(run):
        batches, first = journal.batch_table(spark, str(tmp_path)), [True]
        read = batches.read

        def slow(version=None):
            out = read(version)
            tries.append(run)
            if first.pop() if first else False:
                meet.wait(60)
            return out

        batches.read = slow
        return journal.open_batches(batches, requests, run, start="2024-01-01 00:00:00")

    with ThreadPoolExecutor(2) as pool:
        versions = list(pool.map(write, ("a", "b")))
    assert sorted(versions) == [1, 2] and len(tries) == 3
    rows = journal.batch_table(spark, str(tmp_path)).read().collect()
    active = [r["source_id"] for r in rows if r["batch_run_status"] == "Active"]
    assert sorted(active) == [1, 2, 3, 4] and len({r["batch_id"] for r in rows}) == len(rows) == 5


def test_a_decision_that_always_comes_second_gives_up(made, table):
    log, n = made(), iter(range(100))

    def decide(now):
        made().append(table(ROWS, (1, "a", "b")), f"other-{next(n)}")
        return Change(rows=now.limit(0))

    with pytest.raises(Conflict):
        log.transact(decide, "mine", attempts=3)


@pytest.mark.parametrize("seed", [1, 2])
def test_settings_against_a_plain_table(made, table, seed):
    """Random appends, settings of one or both columns, and compactions; every version as a list of rows would be."""
    dice, log = random.Random(seed), made()
    rows, history = [], {}
    for step in range(14):
        kind = dice.choice(["append", "append", "v", "w", "both", "compact"])
        if kind == "append":
            new = [(dice.choice([None, 1, 2, 3, 4]), f"v{step}", f"w{step}") for _ in range(dice.randrange(1, 4))]
            log.append(table(ROWS, *new).coalesce(1), f"run-{step}")
            rows = rows + [[len(rows) + i + 1, *r] for i, r in enumerate(new)]
        elif kind == "compact":
            before = log.version()
            if log.compact(share=0.0) is None:
                continue
            assert log.version() == before + 1
        else:
            columns = ["v", "w"] if kind == "both" else [kind]
            to = {k: [dice.choice([None, f"{c}-{step}"]) for c in columns] for k in (dice.randrange(1, 5), 2)}
            ddl = "k bigint, " + ", ".join(f"{c} string" for c in columns)
            log.set_columns(table(ddl, *[(k, *x) for k, x in to.items()], (None, *["no"] * len(columns))), f"run-{step}")
            rows = [[i, k, *[dict(zip(columns, to[k])).get(c, x) if k in to else x for c, x in zip("vw", values)]] for i, k, *values in rows]
        history[log.version()] = [tuple(r) for r in rows]
    # files are written in their order, so ids follow it
    for version, expected in history.items():
        assert shown(log, version) == sorted(expected, key=repr)


def test_order_of_settings(made, table):
    log = made()
    log.append(table(ROWS, (1, "a", "x")), "rows")
    several = table("k bigint, v string, at int", (1, "z", 1), (1, None, 2))
    log.set_columns(several, "ordered", order="at")
    assert shown(log) == [(1, 1, None, "x")]
    with pytest.raises(PySparkException, match="differ"):
        log.set_columns(several.drop("at"), "unordered")
    log.set_columns(table("k bigint, v string", (1, "q"), (1, "q")), "agreed")
    assert shown(log) == [(1, 1, "q", "x")]


def test_bytes_written_follow_the_settings(spark, made):
    log = made(identity=None)
    log.append(spark.range(200_000).selectExpr("id AS k", "uuid() AS v", "uuid() AS w"), "rows")
    log.set_columns(spark.sql("SELECT 77L AS k, 'new' AS v"), "one")
    table, one = log.commits()
    assert sum(f.bytes for f in one.settings) < 5_000 < 10_000_000 < sum(f.bytes for f in table.added) and not one.added
    assert log.read().filter("k = 77").first()["v"] == "new" and log.compact() is None
    assert log.read().filter("k = 78").count() == 1


def test_writers_go_on_while_a_table_is_rewritten(made, table):
    log = made()
    log.append(table(ROWS, (1, "a", "x")), "rows")
    log.set_columns(table("k bigint, v string", (1, "b")), "before")
    write = log._write

    def slow(rows):
        out = write(rows)
        made().set_columns(table("k bigint, w string", (1, "y")), "meanwhile")
        made().append(table(ROWS, (2, "c", "z")), "more")
        return out

    log._write = slow
    assert log.compact(share=0.0) == 4
    log._write = write
    assert shown(log) == [(1, 1, "b", "y"), (2, 2, "c", "z")]
    assert log.append(table(ROWS, (3, "d", "q")), "rows") == 0 and log.append(table(ROWS, (3, "d", "q")), "last") == 5
    assert [r[0] for r in shown(log)] == [1, 2, 3]


AUDIT = "batch_id bigint, source_id int, job_id int, job_object_id int, status string"


def test_gates_follow_any_sequence_of_appends_and_corrections(spark, table, tmp_path):
    dice, root = random.Random(4), str(tmp_path)
    log = journal.audit_log(spark, root)
    kept = journal.Gates(log, root)
    assert kept.refresh() == -1
    for step in range(10):
        keys = [(dice.choice([1, 2, None]), dice.choice([1, None]), 1, dice.randrange(1, 5)) for _ in range(4)]
        if dice.random() < 0.6:
            rows = [(b, s, j, i, dice.choice(["Success ", "failed", None])) for b, s, j, i in keys]
            log.append(table(AUDIT, *rows), f"run-{step}")
        else:
            fixed = {k: dice.choice(["success", "failed", None]) for k in keys}
            log.set_columns(table(AUDIT, *[(*k, x) for k, x in fixed.items()]).select("source_id", "job_id", "job_object_id", "batch_id", "status"), f"run-{step}")
        if dice.random() < 0.6:
            seen = kept.upto()
            if any(f.rows for c in log.commits()[seen + 1 :] for f in (*c.added, *c.settings)):
                new = {f.name for c in log.commits()[seen + 1 :] for f in (*c.added, *c.settings)}
                read = {p.rsplit("/", 1)[1] for p in kept._difference(seen, log.version()).inputFiles() if "audit_log" in p}
                assert read == new
            kept.refresh()
            if step == 6:
                kept.compact(most=0)
    kept.refresh()
    whole, view = log.read(), kept.as_log()
    for done in (gates.succeeded,):
        assert sorted(map(tuple, done(whole).collect())) == sorted(map(tuple, done(view).collect()))
    every = whole.filter("batch_id IS NOT NULL").select("batch_id", F.col("job_object_id")).distinct()
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, view.filter("batch_id IS NOT NULL").select("batch_id", "job_object_id").collect()))
    assert kept.refresh() == log.version() and len(kept.view.commits()) == len({c.run for c in kept.view.commits()})


def test_a_refresh_that_was_overtaken_counts_nothing_twice(spark, table, tmp_path):
    root = str(tmp_path)
    log = journal.audit_log(spark, root)
    log.append(table(AUDIT, (1, 1, 1, 9, "success")), "a")
    one, other = journal.Gates(log, root), journal.Gates(log, root)
    difference = one._difference(-1, 0)
    assert other.refresh() == 0
    one.view.append(difference, "after--1", {"upto": 0})
    assert [tuple(r) for r in one._totals().select("row_count", "success_count").collect()] == [(1, 1)]


def test_logs_are_typed_and_numbered(spark, table, tmp_path):
    errors = journal.error_log(spark, str(tmp_path))
    errors.append(table("batch_id int, SOURCE_ID int, error_message string, other int", (1, 2, "x" * 5000, 3)), "a")
    row = errors.read().first()
    assert (row["error_log_id"], row["batch_id"], row["source_iD"], len(row["error_message"]), row["activity"]) == (1, 1, 2, 5000, None)
    steps = journal.step_log(spark, str(tmp_path))
    steps.append(table("step_name string, row_count int", ("copy", 4), ("check", None)).coalesce(1), "a")
    assert [(r["log_id"], r["step_name"], r["row_count"]) for r in steps.read().orderBy("log_id").collect()] == [(1, "copy", 4), (2, "check", None)]


def test_rows_of_a_file_stay_in_the_tasks_that_read_it(spark, made, table):
    """Joined by file in a shuffle, as large tables would be, all rows of a file would meet in one task."""
    log = made(identity=None)
    log.append(table(ROWS, *[(k, "a", "x") for k in range(20)]), "first")
    log.set_columns(table("k bigint, v string", (1, "b")), "second")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = log.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(_file" not in plan and plan.count("BroadcastHashJoin [_file") == 2
    assert sorted(r["v"] for r in log.read().collect()) == ["a"] * 19 + ["b"]
