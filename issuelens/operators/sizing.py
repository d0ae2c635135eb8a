"""Row counts that choose a plan."""

from __future__ import annotations

from pyspark.sql import DataFrame


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    One partially aggregated count: every split is read (without columns where
    the source allows it), and only one number per task is shuffled.
    """
    return df.count() <= max_rows
