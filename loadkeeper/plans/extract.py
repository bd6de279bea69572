"""Source extraction: the raw worklist with query text, target path, threshold and reported bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from loadkeeper.functions.clock import Moment, milli_text
from loadkeeper.operators import window
from loadkeeper.plans import worklists
from loadkeeper.plans.worklists import Control


def filter_codes(packed: DataFrame, segments: DataFrame) -> dict[str, Column]:
    """The texts of all placeholders a filter may name."""
    return window.code_texts(packed, window.PACKED_CODES) | window.code_texts(segments, window.SEGMENT_CODES)


def raw_extract(
    c: Control, runs: DataFrame, *, packed_codes: DataFrame, segment_codes: DataFrame, history_keys: DataFrame,
    thresholds: DataFrame, etl_start: Moment, last_run: Moment | None = None, current_run: Moment | None = None,
    hist: bool = False, two_columns: bool = True, names=None,
) -> DataFrame:
    """What to read next from every source, and where to put it."""
    upper = window.upper_bound(etl_start, current_run)
    rows = window.with_threshold(worklists.raw(c, runs, names), thresholds)
    rows = window.window_text(
        rows, filter_codes(packed_codes, segment_codes), upper=upper, last_run=last_run, hist=hist, two_columns=two_columns,
        history_keys=window.code_texts(history_keys, ["vbeln"], pad=False)["vbeln"] if hist else None,
    )
    reported = window.shifted_upper(upper) if hist else upper
    return rows.withColumns(
        {
            "target_object_path_final": window.target_path("target_object_path", etl_start),
            "varCurrentRundt": milli_text(reported),
        }
    )
