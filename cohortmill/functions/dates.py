"""Time expressions: inclusive windows, floored day counts, Monday weeks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import AnalysisWindow

DAY_MICROS = 86_400_000_000

# Accepted spellings, most frequent first: a failed parse is the costly case.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
)


def utc_literal(moment: datetime) -> Column:
    """Timestamp literal of a UTC moment (naive means UTC), whatever zone the host is in."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def in_window(ts: Column, window: AnalysisWindow) -> Column:
    """Both ends included, compared as instants so that the filter is pushed to the scan."""
    return ts.between(utc_literal(window.start_ts), utc_literal(window.end_ts))


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First format that fits; NULL when none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def whole_days_before(end: datetime, ts: Column) -> Column:
    """Whole days from ``ts`` to ``end``, floored (negative once ``ts`` is later).

    Not ``datediff``, which counts midnights: 23:00 of the day before is 0 days away.
    """
    gap = F.unix_micros(utc_literal(end)) - F.unix_micros(ts)
    return F.floor(gap / DAY_MICROS)


def monday_of(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date")


def cutoff_week(ts: Column, cutoff: str) -> Column:
    """Monday of the first week whose cumulative count includes a sign-up at ``ts``.

    ``sunday_start``: a week counts sign-ups up to its Sunday 00:00 inclusive, so anything
    later on that Sunday falls to the next week. ``week_end``: the whole week counts.
    """
    if cutoff == "week_end":
        return monday_of(ts)
    if cutoff != "sunday_start":
        raise ValueError(f"unknown sign-up cutoff: {cutoff}")
    day = F.to_date(ts)
    midnight_on_or_after = F.when(day.cast("timestamp") == ts, day).otherwise(F.date_add(day, 1))
    return F.date_sub(F.next_day(F.date_sub(midnight_on_or_after, 1), "SUN"), 6)


def week_label(week_start: Column, first: Column) -> Column:
    """``2023-05-29 (W1)``; the ordinal is arithmetic, so no window is needed."""
    ordinal = (F.datediff(week_start, first) / 7).cast("int") + 1
    return F.concat(F.date_format(week_start, "yyyy-MM-dd"), F.lit(" (W"), ordinal.cast("string"), F.lit(")"))
