"""Incremental extraction windows: on data as filters, for other databases as query text."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType

from loadkeeper.functions.clock import EASTERN, Moment, local, wall, wall_text
from loadkeeper.functions.text import code4, code_key, col, empty, fill, fold, like, replace_any_case, same
from loadkeeper.operators import bits
from loadkeeper.operators.joins import not_in
from loadkeeper.operators.worklist import lower_bound

# How each kind of source writes a window. {c} is the change column, {d} the second
# one, {lo} and {hi} the bounds in the pattern given with each text.
PACKED = ("yyyyMMddHHmm", "{c} >= {lo}00.000000 and {c} < {hi}00.000000")
SAME_YEAR = ("yyyy", "{c} = '{lo}'")
YEARS = ("yyyy", "{c} >= '{lo}' and {c} <= '{hi}'")
DAYS = ("yyyyMMdd", "{c}  >= '{lo}' and {c} < '{hi}'")
MINUTE = "yyyy-MM-dd HH:mm"
CHAR = (MINUTE, " TO_CHAR({c}, 'yyyy-MM-dd HH24:MI') >= '{lo}' and TO_CHAR({c}, 'yyyy-MM-dd HH24:MI') < '{hi}'")
CHAR_A = (MINUTE, " TO_CHAR(A.{c}, 'yyyy-MM-dd HH24:MI') >=  '{lo}' and TO_CHAR(A.{c}, 'yyyy-MM-dd HH24:MI') < '{hi}'")
CHAR_B = (MINUTE, " TO_CHAR(B.{c}, 'yyyy-MM-dd HH24:MI') >=  '{lo}' and TO_CHAR(B.{c}, 'yyyy-MM-dd HH24:MI') < '{hi}'")
CHAR_TWO = (
    MINUTE,
    "( TO_CHAR({d}, 'yyyy-MM-dd HH24:MI') >=  '{lo}' or TO_CHAR({c}, 'yyyy-MM-dd HH24:MI') >= '{lo}')"
    " and TO_CHAR({c}, 'yyyy-MM-dd HH24:MI') < '{hi}'",
)
CHAR_TWO_A = (
    MINUTE,
    "( TO_CHAR(A.{d}, 'yyyy-MM-dd HH24:MI') >=  '{lo}' or TO_CHAR(A.{c}, 'yyyy-MM-dd HH24:MI') >=  '{lo}')"
    " and TO_CHAR(A.{c}, 'yyyy-MM-dd HH24:MI') < '{hi}'",
)
DATE_FIRST = "dd-MM-yyyy HH:mm"
DATE = (DATE_FIRST, "{c} >=  TO_DATE('{lo}', 'dd-MM-yyyy HH24:MI') and {c} < TO_DATE('{hi}', 'dd-MM-yyyy HH24:MI')")
DATE_HIST = (DATE_FIRST, "{c} >= TO_DATE('{lo}', 'dd-MM-yyyy HH24:MI') and {c} < TO_DATE('{hi}', 'dd-MM-yyyy HH24:MI')")
HISTORY = " union all SELECT * FROM slt_ods.VBRP WHERE MANDT='100' AND WERKS NOT IN ({werks}) and VBELN in ({vbeln})"

# Change columns by meaning, the tables with rules of their own, the code
# placeholders of a filter text, and the source id that speaks each dialect.
YEAR_COLUMNS = ("ryear", "gjahr")
DAY_COLUMNS = ("budat", "aedat", "audat", "erdat", "fkdat", "cpudt")
STREAM_COLUMNS = ("slt_update",)
SHIFTED_COLUMNS = ("budat", "fkdat", "aedat", "audat")
ALIAS_B_TABLE = "apps.xla_distribution_links"
HISTORY_TABLES = "%VBRP%"
PACKED_CODES = ("vkorg", "werks", "bukrs", "bwkey")
SEGMENT_CODES = ("segment1", "segment2")
DIALECTS = {"char": 1, "packed": 2, "date": 4}


# ---------------------------------------------------------------- bounds


def upper_bound(etl_start: Moment | None, current_run: Moment | None = None, zone: str = EASTERN) -> Column:
    """The given current run, else the load start on the zone's clock; 1900-01-01 is not given."""
    start = local(etl_start, zone) if etl_start is not None else F.lit(None).cast("timestamp_ntz")
    if current_run is None:
        return start
    return F.coalesce(F.nullif(wall(current_run), wall("1900-01-01 00:00:00")), start)


def shifted_upper(upper: Column, identifier: Column | str = "source_update_identifier_hist") -> Column:
    """The bound to report back: one month earlier for posting and document dates."""
    month = F.expr("INTERVAL '1' MONTH")
    return F.when(fold(identifier).isin(*SHIFTED_COLUMNS), upper - month).otherwise(upper)


def target_path(path: Column | str, etl_start: Moment) -> Column:
    return fill("/{path}/{at}/", path=F.lower(col(path)), at=wall_text(etl_start, "yyyyMMdd_HHmm"))


def with_threshold(items: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Row threshold of the item's table, 0 when none is set."""
    limits = thresholds.select(fold("table_name").alias("_name"), "threshold")
    return (
        items.withColumn("_name", fold("table_name"))
        .join(limits, "_name", "left")
        .withColumn("threshold", F.coalesce("threshold", F.lit(0)))
        .drop("_name")
    )


# ---------------------------------------------------------------- windows on data


def bound(df: DataFrame, column: str, value: dt.datetime | str | None) -> Column:
    if value is None:
        raise ValueError(f"no bound given for the window on {column}")
    at = (dt.datetime.fromisoformat(value) if isinstance(value, str) else value).replace(second=0, microsecond=0)
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        # a day is at its midnight: it has reached a bound within a day only from the next day on
        at += dt.timedelta(days=at.time() > dt.time.min)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz" if isinstance(kind, StringType) else kind)


def moment(df: DataFrame, column: str) -> Column:
    """The bare column; text as a timestamp."""
    return F.col(column).try_cast("timestamp_ntz") if isinstance(df.schema[column].dataType, StringType) else F.col(column)


def window_filter(df: DataFrame, column: str, lower, upper, extra_col: str | None = None) -> DataFrame:
    """Rows of the half-open window [lower, upper) at minute precision.

    Bounds are cut to the minute and compared with the bare column, which selects the same rows as
    cutting the column and lets the file scan skip row groups. With ``extra_col`` a row also counts
    when only that second column has reached the lower bound.
    """
    value = moment(df, column)
    started = value >= bound(df, column, lower)
    if extra_col is not None:
        started = started | (moment(df, extra_col) >= bound(df, extra_col, lower))
    return df.filter(started & (value < bound(df, column, upper)))


def code_semi(df: DataFrame, codes: DataFrame, pairs: Mapping[str, str], *, prefilter: bool = False) -> DataFrame:
    """Rows whose code columns are all in the code table; ``pairs`` maps data column to code column.

    This is the form of a code filter that grows with the table: a join, no inlined list. Codes of up to
    four characters are padded on both sides; a wider one matches itself only. ``prefilter`` is for codes too many to
    send to every task: a filter of fixed size over them turns rows away before they are shuffled; the join decides.
    """
    for data_col, code_col in pairs.items():
        keys = codes.select(code_key(code_col).alias("_code")).filter("_code IS NOT NULL").distinct()
        df = df.withColumn("_code", code_key(data_col))
        if prefilter:
            df = df.filter(bits.may_hold(bits.of(keys, "_code"), F.col("_code")))
        df = df.join(keys, "_code", "left_semi").drop("_code")
    return df


def with_history(
    df: DataFrame,
    in_window: DataFrame,
    *,
    code_col: str,
    codes: DataFrame,
    key_col: str,
    keys: DataFrame,
) -> DataFrame:
    """The window's rows plus the historical rows kept for keys outside the code list.

    A historical row has a listed key and a code NOT IN the list; the two parts are added with
    UNION ALL, so a row in both comes twice.
    """
    wanted = keys.select(F.col(keys.columns[0]).alias(key_col)).distinct()
    kept = df.join(wanted, key_col, "left_semi")
    kept = not_in(kept, codes.select(F.col(codes.columns[0]).alias(code_col)), code_col)
    return in_window.unionByName(kept.select(*in_window.columns))


# ---------------------------------------------------------------- query text


def code_texts(codes: DataFrame, names: Sequence[str], *, pad: bool = True) -> dict[str, Column]:
    """The codes of every named column as one quoted comma text, as scalars; NULL without codes.

    Text is for lists that a database accepts inline; ``code_semi`` and ``with_history`` join
    instead. All columns come from one pass over the table.
    """
    shown = {n: code4(n) if pad else F.col(n).cast("string") for n in names}
    rows = codes.select(*[c.alias(n) for n, c in shown.items()])

    def listed(n: str) -> Column:
        quoted = F.concat(F.lit("'"), F.array_join(F.sort_array(F.collect_list(n)), "','"), F.lit("'"))
        return F.when(F.count(n) > 0, quoted)

    texts = rows.agg(F.struct(*[listed(n).alias(n) for n in names])).scalar()
    return {n: texts[n] for n in names}


def base_text() -> Column:
    """The item's own query, else a plain select; both in upper case."""
    return F.coalesce(
        F.upper("source_query"), F.concat(F.lit("SELECT * FROM "), F.upper("source_object_name"))
    )


def filter_text(codes: Mapping[str, Column]) -> Column:
    """The item's filter with the code lists put in, in upper case.

    Any code list that is NULL makes the text NULL, named or not.
    """
    text = F.col("source_filter")
    for name, listed in codes.items():
        text = replace_any_case(text, "@" + name, listed)
    return F.upper(text)


def where_text(full_load: Column, codes: Mapping[str, Column]) -> Column:
    """The text between base query and window, by filter and load flag; no flag, no WHERE."""
    incremental, bare = F.coalesce(full_load == 0, F.lit(False)), empty("source_filter")
    filtered = F.coalesce(full_load.isin(0, 1), F.lit(False)) & ~bare
    return F.concat(
        F.when(incremental | filtered, " WHERE ").otherwise(""),
        F.when(filtered, filter_text(codes)).otherwise(""),
        F.when(incremental & ~bare, " and ").otherwise(""),
    )


def _window(form: tuple[str, str], column: Column, lower: Column, upper: Column, second: Column | None = None) -> Column:
    pattern, text = form
    return fill(
        text, c=F.upper(column), d=F.upper(second) if second is not None else F.lit(""),
        lo=wall_text(lower, pattern), hi=wall_text(upper, pattern),
    )


def predicate_text(
    column: Column, lower: Column, upper: Column, *, hist: bool, two_columns: bool = True,
    dialects: Mapping[str, int] = DIALECTS,
) -> Column:
    """The window in the words of the item's source; '' where a source or column has no rule.

    ``two_columns`` lets a second change column widen historical windows; older loads do without.
    """
    source, has_query = F.col("source_id"), F.col("source_query").isNotNull()
    form = lambda f, second=None: _window(f, column, lower, upper, second)
    char = source == dialects["char"]
    packed = source == dialects["packed"]
    aliased = char & has_query

    if hist:
        kind = fold(column)
        one_year = wall_text(lower, "yyyy") == wall_text(upper, "yyyy")
        different_years = F.coalesce(~one_year, F.lit(False))
        out = (
            F.when(packed & kind.isin(*YEAR_COLUMNS) & different_years, form(YEARS))
            .when(packed & kind.isin(*YEAR_COLUMNS), form(SAME_YEAR))
            .when(packed & kind.isin(*DAY_COLUMNS), form(DAYS))
            .when(packed & kind.isin(*STREAM_COLUMNS), form(PACKED))
        )
    else:
        out = F.when(packed, form(PACKED))
    out = out.when(aliased & same("source_object_name", ALIAS_B_TABLE), form(CHAR_B))
    if hist and two_columns:
        second = F.col("source_filter_add")
        two = second.isNotNull() & ~F.coalesce(like("source_object_name", HISTORY_TABLES), F.lit(False))
        out = out.when(aliased & two, form(CHAR_TWO_A, second)).when(char & ~has_query & two, form(CHAR_TWO, second))
    return (
        out.when(aliased, form(CHAR_A))
        .when(char, form(CHAR))
        .when(source == dialects["date"], form(DATE_HIST if hist else DATE))
        .otherwise(F.lit(""))
    )


def window_text(
    items: DataFrame,
    codes: Mapping[str, Column],
    *,
    upper: Column,
    last_run: Moment | None = None,
    hist: bool = False,
    history_keys: Column | None = None,
    two_columns: bool = True,
    dialects: Mapping[str, int] = DIALECTS,
) -> DataFrame:
    """Adds ``source_filter_final``, the next query of every item in its source's own words.

    Historical loads read the ``_hist`` columns; tables named like the billing table then also get
    the fixed slice of old keys. Any missing part (bound, name, code list) makes the text NULL.
    """
    suffix = "_hist" if hist else ""
    full_load = F.col("is_full_load" + suffix)
    column = F.col("source_update_identifier" + suffix)
    window = predicate_text(column, lower_bound(last_run), upper, hist=hist, two_columns=two_columns, dialects=dialects)
    text = F.concat(base_text(), where_text(full_load, codes), F.when(full_load == 0, window).otherwise(F.lit("")))
    if hist and history_keys is not None:
        with_slice = F.concat(text, fill(HISTORY, werks=codes["werks"], vbeln=history_keys))
        text = F.when(like("source_object_name", HISTORY_TABLES), with_slice).otherwise(text)
    return items.withColumn("source_filter_final", text)
