"""Wall-clock and calendar functions.

Control tables hold timestamps without a zone. Spark's ``date_format`` and ``unix_timestamp``
read such values in the session zone and shift them on days with a clock change, so the functions
here work on the wall clock itself and give the same result under every session zone.

``now`` is always an argument: a UTC ``datetime`` or a column of UTC wall-clock values.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkeeper.functions.text import col

EASTERN = "America/New_York"
SATURDAY, SUNDAY = 7, 1

Moment = Column | dt.datetime | str

# Position of every field in the text form of a timestamp, "2024-01-02 03:04:05".
_FIELDS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}


def wall(value: Moment) -> Column:
    """A zone-free timestamp from a datetime, an ISO text, or a column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def local(now: Moment, zone: str = EASTERN) -> Column:
    """UTC wall clock to the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), wall(now))


def local_day(now: Moment, zone: str = EASTERN) -> Column:
    return F.to_date(local(now, zone))


def on_day(value: Column | str, day: Column) -> Column:
    """True when ``value`` falls on ``day``; a plain range, so it reaches the file scan."""
    value = col(value)
    return (value >= day.cast("timestamp_ntz")) & (value < F.date_add(day, 1).cast("timestamp_ntz"))


def is_weekend(now: Moment, days: tuple[int, ...] = (SATURDAY,), zone: str = EASTERN) -> Column:
    return F.dayofweek(local(now, zone)).isin(*days)


def processing_month(now: Moment, adhoc: bool = False, zone: str = EASTERN) -> Column:
    """First day of the previous month, NULL on Saturday and in ad-hoc runs."""
    month = F.trunc(F.add_months(local_day(now, zone), -1), "MM")
    none = F.lit(None).cast("date")
    return none if adhoc else F.when(is_weekend(now, zone=zone), none).otherwise(month)


def wall_text(value: Moment, pattern: str) -> Column:
    """A timestamp as text; fields yyyy MM dd HH mm ss SSS, all else literal."""
    shown = (value if isinstance(value, Column) else wall(value)).cast("timestamp_ntz").cast("string")
    parts = []
    for piece in re.split(r"(yyyy|SSS|MM|dd|HH|mm|ss)", pattern):
        if piece == "SSS":
            parts.append(F.rpad(F.substring(shown, 21, 3), 3, "0"))
        elif piece in _FIELDS:
            parts.append(F.substring(shown, *_FIELDS[piece]))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def milli_text(value: Moment) -> Column:
    return wall_text(value, "yyyy-MM-dd HH:mm:ss.SSS")


def minute_floor(value: Moment) -> Column:
    """The timestamp cut to the minute."""
    return wall_text(value, "yyyy-MM-dd HH:mm").cast("timestamp_ntz")


def wall_seconds(value: Column | str) -> Column:
    """Whole seconds on the wall clock since year 1; the difference of two counts boundaries."""
    since = col(value) - wall("0001-01-01 00:00:00")
    return since.cast("interval second").cast("bigint")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries between two timestamps."""
    return wall_seconds(end) - wall_seconds(start)


def duration_text(start: Column | str, end: Column | str) -> Column:
    """Elapsed time as HH:MM:SS, rounded to the second, modulo 24 hours.

    The elapsed time is put on the clock face of a fixed day, half a second late; cutting the
    fraction then rounds, and full days (also negative ones) fall away by themselves.
    """
    face = wall("1900-01-01 00:00:00") + (col(end) - col(start)) + F.expr("INTERVAL '0.5' SECOND")
    return F.substring(face.cast("string"), 12, 8)


def hours_minutes(minutes: Column) -> Column:
    """Minutes as HH:MM with the last two digits of the hours."""
    whole = F.floor(minutes).cast("bigint")
    hours = F.right(F.concat(F.lit("0"), F.floor(whole / 60).cast("string")), F.lit(2))
    rest = F.right(F.concat(F.lit("0"), (whole % 60).cast("string")), F.lit(2))
    return F.concat(hours, F.lit(":"), rest)


def month_key(value: Column | str) -> Column:
    """'2023-7' or '2023-07' to '202307': first four characters, then the rest after the dash as two digits."""
    value = col(value)
    last = F.right(F.concat(F.lit("00"), value.substr(F.lit(6), F.length(value))), F.lit(2))
    return F.concat(F.substring(value, 1, 4), last)


def month_keys(now: Moment, first: int, last: int) -> list[Column]:
    """The month keys from ``first`` to ``last`` months around ``now``."""
    day = F.to_date(wall(now))
    return [wall_text(F.add_months(day, k).cast("timestamp_ntz"), "yyyyMM") for k in range(first, last + 1)]
