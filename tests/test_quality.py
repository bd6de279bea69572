import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import checks, quality, tables
from loadkeeper.operators.quality import Rule


def test_rules_and_split(table, rows):
    df = table("id string, n string, a string, b string", ("x1", "5", "q", None), ("x-", "abc", None, None), (None, None, "toolong", "z"))
    rules = [
        Rule("id", nullable=False, alphanumeric=True), Rule("n", data_type="int", range_expression="try_cast(n as int) < 9"),
        Rule("a", length=3, null_combination=True), Rule("b", null_combination=True),
    ]
    good, bad = quality.quality_split(df, rules)
    assert rows(good, "id") == [("x1",)]
    assert rows(bad, "id", "dq_errors") == [
        ("x-", ["TypeCheckError:id alphanumeric", "TypeCheckError:n", "NullCheckError:a+b"]),
        (None, ["NullCheckError:id", "LengthCheckError:a"]),
    ]
    counts = quality.quality_counts(quality.quality_errors(df, rules)).first()
    assert tuple(counts) == (3, 1, 2)


def test_rules_from_mapping(spark):
    from loadkeeper.sources.schemas import SCHEMAS

    schema = SCHEMAS["object_column_mapping"]
    def row(**v):
        base = {f.name: None for f in schema.fields} | dict(col_mapping_key=1, job_object_id=1, object_id=1, actv_flg="Y")
        return tuple((base | v).values())

    df = spark.createDataFrame(
        [
            row(source_column_name="b", target_column_name="tb", target_column_data_type="int", is_nullable="N", column_id=2),
            row(source_column_name="a", length=5, length_key_flag=1, range_expression="a > 1", range_key_flag=0, column_id=1),
            row(source_column_name="c", actv_flg="N"),
        ],
        schema,
    )
    first, second = quality.rules_from(df)
    assert (first.column, first.length, first.range_expression, first.nullable) == ("a", 5, None, True)
    assert (second.target, second.data_type, second.nullable) == ("tb", "int", False)


def test_duplicates(table, rows):
    df = table("k int, o int, v string", (1, 2, "b"), (1, 1, "a"), (1, 1, "a"), (2, 1, None), (None, 1, "n"), (None, 2, "m"))
    assert rows(quality.keep_first(df, ["k"], ["o"]), "k", "v", "n_rows") == [(1, "a", 3), (2, None, 1), (None, "n", 2)]
    assert rows(quality.duplicate_counts(df, ["k"])) == [(1, 2), (None, 1)]
    assert rows(quality.rejected_duplicates(df, ["k"], ["o"])) == [(1, 1, "a", 1), (1, 2, "b", 1), (None, 2, "m", 1)]


def test_mapping(table, rows):
    df = table("a string, b int", ("7", 2))
    got = quality.map_columns(df, [Rule("a", target="x", data_type="int"), Rule("b", expression="b * 2")])
    assert got.dtypes == [("x", "int"), ("b", "int")] and rows(got) == [(7, 4)]


def test_upsert(table, rows):
    target = table("k int, v string", (1, "a"), (2, "b"), (3, None))
    got = quality.upsert(target, table("k int, v string", (2, "B"), (3, None), (4, "d")), ["k"])
    assert rows(got) == [(1, "a", "keep"), (2, "B", "update"), (3, None, "same"), (4, "d", "insert")]
    assert tuple(quality.upsert_counts(got).first()) == (1, 1)


def test_row_history(table, rows):
    t = lambda n: dt.datetime(2024, 1, n)
    target = table(
        "k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz",
        (1, "a", t(1), None), (2, "b", t(1), None), (3, "old", t(1), t(2)), (3, "c", t(2), None), (4, "gone", t(1), t(2)),
    )
    changes = table("k int, v string", (2, "B"), (3, "c"), (4, "back"), (5, "new"))
    got = quality.upsert_history(target, changes, ["k"], now=F.lit("2024-01-09").cast("timestamp_ntz"))
    assert rows(got) == [
        (1, "a", t(1), None), (2, "B", t(9), None), (2, "b", t(1), t(9)), (3, "c", t(2), None), (3, "old", t(1), t(2)),
        (4, "back", t(9), None), (4, "gone", t(1), t(2)), (5, "new", t(9), None),
    ]


def test_checked_rows_are_written_once(table, rows, tmp_path):
    df = table("id int, v string", (1, "a"), (2, None), (3, "c"))
    checked = quality.quality_errors(df, [Rule("v", nullable=False)])
    good, bad, counts = quality.write_checked(checked, str(tmp_path / "out"))
    assert rows(good) == [(1, "a"), (3, "c")] and rows(bad, "id", "dq_errors") == [(2, ["NullCheckError:v"])]
    assert tuple(counts.first()) == (3, 2, 1)


def test_delete_keeps_unknown(table, rows):
    df = table("k int, s string", (1, "D"), (2, None), (3, "x"))
    assert rows(quality.delete_rows(df, "s = 'D'"), "k") == [(2,), (3,)]


def raises(message, call, *args):
    with pytest.raises(checks.ParameterError) as e:
        call(*args)
    assert str(e.value) == message and e.value.code == 50010


def test_parameter_checks(table):
    d = lambda n: dt.datetime(2024, 1, n)
    checks.check_dates(d(3), d(1), d(2))
    checks.check_dates(None, None, "2024-01-02 03:04:05")
    raises("etl_startdt or current_rundt should be given", checks.check_dates, None, d(1), None)
    raises(" last_rundt should be less than current_rundt ", checks.check_dates, None, d(3), d(2))
    raises(" current_rundt should be less than EtlStartdt ", checks.check_dates, d(1), None, d(2))
    raises(" paramSpEtlStartdt should be less than paramSpLastRundt ", checks.check_dates, d(1), d(2), None)
    raises(" Please enter date in valid format for paramSpLastRunDate", checks.check_dates, d(1), "soon", None)
    checks.check_flag(None)
    raises("is_hist_load can only be 1 or 0", checks.check_flag, 2, "history flag")
    raises("paramSpStatus can only be success or failed", checks.check_status, "done")
    batches = table("batch_id bigint", (5,))
    checks.check_batch(batches, 5)
    raises("batch_id cannot be null", checks.check_batch, batches, 0)
    raises("Please pass valid batch number", checks.check_batch, batches, 6)
    raises("Please pass correct values to parameters source_id, job_id", checks.check_source_step, table("source_id int, job_id int", (1, 1)), 1, 2)


def test_name_checks(table):
    known = table("t string", ("a",), ("b",))
    checks.check_names("A,b", known, "t")
    checks.check_names("", known, "t")
    raises("Please pass correct table names , issue table names are: c,d", checks.check_names, "d,a,c", known, "t")
    raises("Please pass correct table names , issue table names are: ", checks.check_names, "a,a", known, "t")


def test_alphanumeric_sees_line_ends(table, rows):
    df = table("v string", ("abc",), ("abc\n",), ("a b",), ("",), (None,))
    ok, _ = quality.quality_split(df, [Rule("v", alphanumeric=True)])
    assert rows(ok) == [("abc",), (None,)]


def test_repeated_changes_leave_one_row(table, rows):
    target, ddl = table("k int, v string", (1, "a"), (2, "b")), "k int, v string"
    assert rows(quality.upsert(target, table(ddl, (1, "y"), (1, "x"), (3, "n"), (3, "n")), ["k"])) == [(1, "x", "update"), (2, "b", "keep"), (3, "n", "insert")]
    history = table("k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz", (1, "a", dt.datetime(2024, 1, 1), None))
    got = quality.upsert_history(history, table(ddl, (1, "y"), (1, "x")), ["k"], now=F.lit("2024-02-01").cast("timestamp_ntz"))
    assert rows(got, "k", "v") == [(1, "a"), (1, "x")]


def test_null_combination(table, rows):
    df = table("a int, b int", (None, None), (1, None), (None, 2))
    _, bad = quality.quality_split(df, [Rule("a", null_combination=True), Rule("b", null_combination=True)])
    assert rows(bad) == [(None, None, ["NullCheckError:a+b"])]


def test_of_several_changes_the_last_by_order_counts(table, rows):
    target = table("k int, v string", (1, "a"), (2, "b"))
    changes = table("k int, v string, at int", (1, "z", 1), (1, "c", 3), (1, "d", 2), (2, "x", None), (2, "b", 1), (3, None, 1), (3, "q", 1))
    got = quality.upsert(target, changes, ["k"], order=["at"])
    assert rows(got, "k", "v", "action") == [(1, "c", "update"), (2, "b", "same"), (3, "q", "insert")]
    assert rows(tables.update_rows(target, changes, "k", order=["at"])) == [(1, "c"), (2, "b")]
    dated = table("k int, v string, valid_from timestamp_ntz, valid_to timestamp_ntz", (1, "a", dt.datetime(2024, 1, 1), None))
    now = F.lit("2024-02-01").cast("timestamp_ntz")
    history = quality.upsert_history(dated, changes, ["k"], now=now, order=["at"])
    assert rows(history.filter("valid_to IS NULL"), "k", "v") == [(1, "c"), (2, "b"), (3, "q")]
    assert history.count() == 4


def test_requests_get_the_message_a_single_check_raises(table):
    batches, items = table("batch_id bigint", (1,), (1,)), table("source_id bigint, job_id bigint", (1, 2), (1, 2))
    day = dt.datetime(2024, 1, 5)
    schema = "n int, batch_id bigint, source_id bigint, job_id bigint, status string, is_rerun int, etl_start timestamp_ntz, last_run string, current_run string"
    good = (1, 1, 2, "Success ", 0, day, "2024-01-01", "2024-01-04 10:00:00")
    odd = [
        good, (None, *good[1:]), (0, *good[1:]), (9, *good[1:]), (1, 1, None, *good[3:]), (*good[:3], None, *good[4:]), (*good[:3], "done", *good[4:]),
        (*good[:4], 2, *good[5:]), (*good[:4], None, *good[5:]), (*good[:6], "x", None), (*good[:7], "x"), (*good[:5], None, None, None),
        (*good[:5], None, "2024-01-05", "2024-01-04"), (*good[:7], "2024-01-06"), (*good[:6], "2024-01-06", None),
    ]
    got = {r["n"]: (r["message"], r["code"]) for r in checks.verdicts(table(schema, *((n, *r) for n, r in enumerate(odd))), batches, items).collect()}
    for n, (batch_id, source_id, job_id, status, rerun, start, last, current) in enumerate(odd):
        try:
            checks.check_batch(batches, batch_id)
            checks.check_source_step(items, source_id or -1, job_id or -1)
            checks.check_flag(rerun)
            checks.check_status(status or "")
            checks.check_dates(start, last, current)
            expected = (None, None)
        except checks.ParameterError as e:
            expected = (str(e), e.code)
        assert got[n] == expected, odd[n]
