"""String helpers (FN-5, FN-15..FN-17)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def issue_key_in(title: str | Column, project: str, upper: bool = False, max_digits: int = 5) -> Column:
    """FN-5: first ``<project>-<1..max_digits digits>`` in the text, case-insensitive.

    ``''`` when absent, NULL for NULL input; the key keeps the case it has in
    the text unless ``upper``.  Digits beyond ``max_digits`` are left off.
    """
    c = F.col(title) if isinstance(title, str) else title
    literal = re.sub(r"([^0-9A-Za-z])", r"\\\1", project)
    key = F.regexp_extract(c, f"(?i)({literal}-[0-9]{{1,{max_digits}}})", 1)
    return F.upper(key) if upper else key


def strip_quotes(col: str | Column) -> Column:
    """FN-15: drop leading and trailing double quotes."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, '^"+|"+$', "")


def join_chain(cols) -> Column:
    """FN-16: ``" > "``-joined text."""
    return F.concat_ws(" > ", *cols)


def or_empty(col: str | Column) -> Column:
    """FN-17: a missing value becomes ``''``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))
