"""Timestamp parsing and formatting (FN-6..FN-14).

All table timestamps are ``timestamp_ntz`` holding UTC wall-clock time.  Text
with an offset is converted to UTC (the session runs in UTC).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _try_ts(col) -> Column:
    # The string -> timestamp cast reads ISO-8601 with or without a zone
    # (``Z``, ``+02:00``, ``+0200``) and applies the offset; it returns NULL
    # instead of throwing, and needs no pattern formatter.  In the UTC session
    # the timestamp_ntz cast then keeps the UTC wall clock.
    return _c(col).try_cast("timestamp").cast("timestamp_ntz")


def parse_jira_ts(col) -> Column:
    """FN-12 (issue tracker text ``2024-01-31T10:00:00.000+0000``); NULL if it does not parse."""
    return _try_ts(col)


def parse_iso_utc(col) -> Column:
    """FN-6/12 (code host text ``2024-01-31T10:00:00Z``).  Text that does not parse
    fails the query (ANSI cast), so no row loses its time unnoticed."""
    return _c(col).cast("timestamp").cast("timestamp_ntz")


def try_parse_iso_utc(col) -> Column:
    """FN-7: like ``errors='coerce'`` — text that is not ISO-8601 becomes NULL."""
    return _try_ts(col)


def epoch_seconds_between(later, earlier) -> Column:
    """FN-8: ``EXTRACT(EPOCH FROM later - earlier)`` as double seconds."""
    return (F.timestamp_diff("MICROSECOND", _c(earlier), _c(later)).cast("double") / 1e6)


def iso_z(col) -> Column:
    """FN-14: ``2024-01-31T10:00:00Z``."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def minute_text(col) -> Column:
    """FN-13: ``2024-01-31 10:00`` (minute precision, offset dropped)."""
    return F.date_format(_c(col), "yyyy-MM-dd HH:mm")


def truncate_minute(col) -> Column:
    return F.date_trunc("minute", _c(col)).cast("timestamp_ntz")


def as_of_lit(as_of) -> Column:
    """FN-9: a fixed ``now()``; ``None`` means the current time."""
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return F.lit(as_of).cast("timestamp_ntz")


def days_before(ts: Column, days: int) -> Column:
    """FN-11: ``ts - INTERVAL <days> DAYS``."""
    return ts - F.expr(f"INTERVAL {int(days)} DAYS")
