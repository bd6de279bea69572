import datetime as dt

from pyspark.sql import functions as F

from loadkeeper.operators import changes

NOW = "2024-01-02 03:04:05"
ROW = "k int, v string, Source_column_mapping string"


def test_changes_turn_old_into_new(table, rows):
    old = table(ROW, (1, "a", "x"), (2, "b", "x"), (3, None, "x"), (4, "d", "x"))
    new = table(ROW, (1, "a", "x"), (2, "B", "x"), (3, None, "x"), (5, None, "x"))
    got = changes.row_changes(old, new, ["k"], user="me", now=NOW, skip=["Source_column_mapping"])
    assert got.columns == ["k", "v", "Activity", "change_doneBy", "modify_date"]
    assert rows(got, "k", "v", "Activity") == [(2, "B", "UPDATE"), (4, "d", "DELETE"), (5, None, "INSERT")]
    after = {r["k"]: r["v"] for r in old.collect()}
    for r in got.collect():
        after.pop(r["k"], None)
        if r["Activity"] != "DELETE":
            after[r["k"]] = r["v"]
    assert after == {r["k"]: r["v"] for r in new.collect()}


def test_no_changes_no_rows(table):
    old = table(ROW, (1, None, None))
    assert changes.row_changes(old, old, ["k"], user="me", now=NOW).isEmpty()


def test_feed_keeps_updates_without_effect(table, rows):
    feed = table(
        "before struct<k: int, v: string>, after struct<k: int, v: string>",
        (None, (1, "a")), ((1, "a"), (1, "a")), ((1, "a"), None), (None, None),
    )
    got = changes.classify_changes(feed, user="me", now=NOW)
    assert rows(got, "Activity", "k", "v") == [("DELETE", 1, "a"), ("INSERT", 1, "a"), ("UPDATE", 1, "a")]
    assert got.first()["modify_date"] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_schema_drift(table, rows, spark):
    cat = "owner string, table_name string, column_name string, column_id int, data_length int, data_type string, nullable string"
    old = table(cat, ("o", "t", "a", 1, 4, "int", "Y"), ("o", "t", "b", 2, 4, "int", "Y"), ("o", "t", "c", 3, None, "int", "Y"))
    new = table(cat, ("O", "t", "A", 1, 4, "INT", "y"), ("o", "t", "b", 2, 8, "int", "Y"), ("o", "t", "d", 3, 4, "date", "N"))
    assert rows(changes.schema_drift(old, new), "event_type", "command_text") == [
        ("ADD", "ALTER TABLE o.t ADD d date"), ("ALTER", "ALTER TABLE o.t ALTER COLUMN b int"), ("DROP", "ALTER TABLE o.t DROP COLUMN c"),
    ]
    listed = changes.schema_rows(old, "me", "cat")
    assert rows(listed, "column_name", "column_id")[0] == ("column_id", 4)


def test_domains_pass_null(table, rows):
    df = table("a string, b string", ("x", "y"), ("X ", None), ("z", "y"), ("z", "q"))
    got = changes.domain_violations(df, {"a": ["x"], "b": ["Y"]})
    assert rows(got, "a", "b", "violations") == [("z", "q", ["a", "b"]), ("z", "y", ["a"])]


def test_only_ranges_that_differ_are_compared(spark):
    old = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.when(F.col("id") % 2 == 0, "x").alias("w"))
    new = old.withColumn("v", F.when(F.col("k") == 777, -1).otherwise(F.col("v"))).filter("k <> 888")
    left, right = changes.changed_ranges(old, new, ["k"])
    assert 2 <= left.count() <= 2 * 2 * 100_000 / 2**changes.FINE + 10 and right.count() == left.count() - 1
    got = changes.row_changes_by_range(old, new, ["k"], user="u", now="2024-01-01 00:00:00")
    assert sorted((r["k"], r["v"], r["Activity"]) for r in got.collect()) == [(777, -1, "UPDATE"), (888, 1776, "DELETE")]
    same = changes.changed_ranges(old, old, ["k"])
    assert same[0].isEmpty() and same[1].isEmpty()


def test_ranges_give_the_changes_of_the_whole_comparison(table, rows):
    ddl = "k int, j string, v string, w string"
    old = table(ddl, (1, "a", "x", None), (2, "a", None, "x"), (3, "a", "q", "q"), (None, "a", "n", "n"), (4, "b", "y", "z"))
    new = table(ddl, (1, "a", None, "x"), (2, "a", None, "x"), (None, "a", "n", "n"), (4, "b", "z", "y"), (5, "b", None, None))
    for a, b in ((old, new), (new, old), (old.limit(0), new), (old, new.limit(0)), (old.limit(0), new.limit(0))):
        whole = changes.row_changes(a, b, ["k", "j"], user="u", now="2024-01-01 00:00:00")
        assert rows(changes.row_changes_by_range(a, b, ["k", "j"], user="u", now="2024-01-01 00:00:00")) == rows(whole)
