import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadkeeper.functions import clock, text


def test_fold_ignores_case_and_trailing_blanks(one):
    assert one(text.same(F.lit("ABC  "), "abc")) is True
    assert one(text.same(F.lit(" abc"), "abc")) is False
    assert one(text.like(F.lit("DWH.recon_gl_x"), "dwh.recon_gl%")) is True
    assert one(text.like(F.lit("dwhXrecon-glY"), "dwh_recon_gl%")) is True


@pytest.mark.parametrize(
    "value, count, keys",
    [(None, 0, None), ("", 1, [""]), ("a,b", 2, ["a", "b"]), ("a,a", 2, ["a"]), ("A ,b", 2, ["a", "b"]), (" a", 1, [" a"])],
)
def test_list_entries(one, value, count, keys):
    c = F.lit(value).cast("string")
    assert one(text.entry_count(c)) == count
    assert one(text.entry_keys(c)) == keys


@pytest.mark.parametrize("value, shown", [(3, "0003"), (1234, "1234"), (12345, "000*"), (None, None), (-12, "0-12")])
def test_code4(one, value, shown):
    assert one(text.code4(F.lit(value).cast("int"))) == shown


def test_replace_any_case_is_literal(one):
    assert one(text.replace_any_case(F.lit("a @VKORG b @vkorg"), "@vkorg", F.lit("$1\\"))) == "a $1\\ b $1\\"
    assert one(text.replace_any_case(F.lit("nothing"), "@x", F.lit(None).cast("string"))) is None


def test_two_part_names(one):
    assert one(text.schema_part(F.lit("dwh.a.b"))) == "dwh"
    assert one(text.table_part(F.lit("dwh.a.b"))) == "a.b"
    assert one(text.schema_part(F.lit("plain"))) is None


@pytest.mark.parametrize(
    "value, shown",
    [
        ("hARi nARAyan shARMa", "Hari Narayan Sharma"),
        ("  two  blanks  ", "  Two  Blanks"),
        ("o'brien x-y", "O'brien X-y"),
        ("ßa éa\nb", "ßa Éa\nb"),
        ("", ""),
        (None, None),
    ],
)
def test_camel_case(one, value, shown):
    assert one(text.camel_case(F.lit(value).cast("string"))) == shown


def test_camel_case_width(one):
    long = "ab " * 1000
    assert len(one(text.camel_case(F.lit(long), max_chars=2000))) == 2000
    assert len(one(text.camel_case(F.lit(long)))) == 2999


def test_local_follows_the_clock_change(one):
    assert one(clock.local("2024-03-10 06:59:59")) == dt.datetime(2024, 3, 10, 1, 59, 59)
    assert one(clock.local("2024-03-10 07:00:00")) == dt.datetime(2024, 3, 10, 3, 0, 0)
    assert one(clock.local("2024-07-01 02:00:00")) == dt.datetime(2024, 6, 30, 22, 0, 0)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, one, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = clock.wall("2024-03-10 02:30:15.25")
        assert one(clock.milli_text(at)) == "2024-03-10 02:30:15.250"
        assert one(clock.wall_text(at, "dd-MM-yyyy HH:mm")) == "10-03-2024 02:30"
        assert one(clock.wall_text(at, "yyyyMMddHHmm")) == "202403100230"
        assert one(clock.seconds_between(clock.wall("2024-03-10 01:30:00"), clock.wall("2024-03-10 03:30:00"))) == 7200
        assert one(clock.minute_floor(at)) == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_seconds_count_boundaries(one):
    assert one(clock.seconds_between(clock.wall("2024-01-01 00:00:00.9"), clock.wall("2024-01-01 00:00:01.1"))) == 1


@pytest.mark.parametrize(
    "start, end, shown",
    [
        ("2024-01-01 00:00:00.9", "2024-01-01 00:00:01.1", "00:00:00"),
        ("2024-01-01 00:00:00", "2024-01-02 01:02:03", "01:02:03"),
        ("2024-01-01 00:00:00", "2024-01-01 23:59:59.6", "00:00:00"),
    ],
)
def test_duration_is_rounded_and_wraps(one, start, end, shown):
    assert one(clock.duration_text(clock.wall(start), clock.wall(end))) == shown


def test_duration_of_an_open_row_is_null(one):
    assert one(clock.duration_text(clock.wall("2024-01-01"), F.lit(None).cast("timestamp_ntz"))) is None


def test_hours_keep_two_digits(one):
    assert one(clock.hours_minutes(F.lit(61.5))) == "01:01"
    assert one(clock.hours_minutes(F.lit(6010))) == "00:10"


def test_friday_evening_in_the_east_is_not_yet_saturday(one):
    assert one(clock.is_weekend("2024-01-06 04:00:00")) is False
    assert one(clock.is_weekend("2024-01-06 05:00:00")) is True
    assert one(clock.is_weekend("2024-01-07 12:00:00")) is False
    assert one(clock.is_weekend("2024-01-07 12:00:00", (clock.SATURDAY, clock.SUNDAY))) is True


def test_processing_month(one):
    assert one(clock.processing_month("2024-01-03 03:00:00")) == dt.date(2023, 12, 1)
    assert one(clock.processing_month("2024-01-06 20:00:00")) is None
    assert one(clock.processing_month("2024-01-03 03:00:00", adhoc=True)) is None


@pytest.mark.parametrize("value, shown", [("2023-7", "202307"), ("2023-07", "202307"), ("2023-12", "202312"), ("", "00")])
def test_month_key(one, value, shown):
    assert one(clock.month_key(F.lit(value))) == shown


def test_month_keys_cross_the_year(spark):
    keys = clock.month_keys("2023-12-31 10:00:00", -1, 2)
    assert list(spark.range(1).select(*keys).first()) == ["202311", "202312", "202401", "202402"]


@pytest.mark.parametrize("put", ["'0001','0002'", "a$1", "b\\\\c", "", "$\\", None])
def test_a_replacement_is_taken_as_it_is(spark, put):
    """Marks of patterns are protected, and looked for by a pattern only in texts that hold one."""
    df = spark.createDataFrame([("x in (@CODE) or @code", put)], "v string, p string").select(text.replace_any_case("v", "@code", F.col("p")).alias("r"))
    assert df.first()["r"] == (None if put is None else f"x in ({put}) or {put}")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (Contains(p" in plan or "CASE WHEN (contains(p" in plan.lower()
