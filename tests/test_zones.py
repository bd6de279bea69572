"""Files a window opens, and rows a filter of bits lets through."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadkeeper.operators import bits, window
from loadkeeper.sources.zones import Zones

DDL = "id int, a timestamp_ntz, b timestamp_ntz"


def day(n, minute=0):
    return dt.datetime(2024, 1, 1, 0, minute) + dt.timedelta(days=n)


@pytest.fixture
def loaded(spark, table, tmp_path):
    """One file per list of rows, under a path with a blank in it."""

    def load(*files):
        for rows in files:
            table(DDL, *rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "some data"))
        return Zones(spark, str(tmp_path / "some data"), str(tmp_path / "zones"), ("a", "b"))

    return load


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_files_read_are_those_that_can_hold_a_row(loaded):
    zones = loaded(
        [(1, day(1), day(1)), (2, day(2), day(1))],  # too early in both columns
        [(3, day(12), day(3)), (4, day(9), None)],  # by the first column
        [(5, day(4), day(15)), (6, day(5), day(2))],  # by the second one only
        [(7, day(40), day(40))],  # not before the upper bound
        [(8, None, day(15))],  # no value in the first
        [(9, day(8), day(8)), (10, day(30), day(50))],  # spans the window, holds a row by the second column only
    )
    zones.refresh()
    zones.refresh()
    assert zones.read().count() == 6
    got = zones.window("a", "2024-01-11 00:00:30", "2024-01-21 00:00:00", extra_col="b")
    assert ids(got) == [3, 5] and len(got.inputFiles()) == 3
    plain = zones.window("a", "2024-01-11 00:00:00", "2024-01-21 00:00:00")
    assert ids(plain) == [3] and len(plain.inputFiles()) == 2
    later = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "PushedFilters" in line]
    assert any("Or(" not in line and "GreaterThanOrEqual(b" in line for line in later)  # the second set's condition is pushed down
    assert zones.window("a", "2025-01-11", "2025-01-21").collect() == []


def test_files_that_are_not_in_the_map_are_read(loaded):
    zones = loaded([(1, day(1), day(1))])
    assert ids(zones.window("a", "2024-01-02", "2024-01-03")) == [1]
    zones.refresh()
    zones = loaded([(2, day(1), day(1))], [(3, day(9), day(9))])
    assert ids(zones.window("a", "2024-01-02", "2024-01-03", extra_col="b")) == [1, 2]
    zones.refresh()
    assert len(zones.window("a", "2024-01-02", "2024-01-03", extra_col="b").inputFiles()) == 2


def test_no_files(spark, tmp_path):
    zones = Zones(spark, str(tmp_path / "none"), str(tmp_path / "zones"), ("a",))
    zones.refresh()
    with pytest.raises(FileNotFoundError):
        zones.window("a", "2024-01-02", "2024-01-03")


def test_random_windows_equal_the_plain_filter(spark, loaded):
    dice = random.Random(3)
    when = lambda: dice.choice([None, *[day(dice.randrange(20), dice.randrange(60)) for _ in range(6)]])
    zones = loaded(*[[(n * 100 + i, when(), when()) for i in range(3)] for n in range(8)])
    zones.refresh()
    rows = spark.read.parquet(zones.data)
    for _ in range(8):
        low = day(dice.randrange(20), dice.randrange(60))
        bounds = (low, low + dt.timedelta(hours=dice.randrange(200)))
        for extra in (None, "b"):
            assert ids(zones.window("a", *bounds, extra_col=extra)) == ids(window.window_filter(rows, "a", *bounds, extra))


def test_a_set_of_bits_turns_away_most_and_never_a_key(spark):
    keys = spark.range(0, 60_000, 3).select(F.col("id").cast("string").alias("k"))
    held = bits.of(keys, "k")
    rows = spark.range(60_000).select(F.col("id"), F.col("id").cast("string").alias("k"))
    kept = rows.filter(bits.may_hold(held, F.col("k")))
    assert kept.filter("id % 3 = 0").count() == 20_000 and kept.count() < 20_100
    none = bits.of(keys.limit(0), "k")
    assert rows.filter(bits.may_hold(none, F.col("k"))).count() == 0
    assert rows.filter(bits.may_hold(held, F.when(F.col("id") < 0, F.col("k")))).count() == 60_000  # NULL decides nothing
    numbers = bits.numbers(spark.range(0, 256, 5), F.col("id"), 8)
    assert [r["id"] for r in spark.range(256).filter(bits.holds(numbers, F.col("id"))).collect()] == list(range(0, 256, 5))


def test_code_lists_with_and_without_the_filter(table, rows):
    df = table("c int", (1,), (2,), (12345,), (None,), (7,))
    codes = table("code string", ("0001",), ("12345",), (None,), ("0009",))
    plain = rows(window.code_semi(df, codes, {"c": "code"}))
    assert plain == rows(window.code_semi(df, codes, {"c": "code"}, prefilter=True)) == [(1,), (12345,)]
    assert rows(window.code_semi(df, codes.limit(0), {"c": "code"}, prefilter=True)) == []
