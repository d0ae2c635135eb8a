"""Status timeline (Q1), first / last time in each status (AGG-4/5) and the
single-issue pivot (Q5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.jsonpath import ISSUE_FIELD_COLUMNS, parsed_issue_fields
from issuelens.functions.timefmt import parse_jira_ts
from issuelens.operators.filters import status_changes
from issuelens.operators.pivot import distinct_values, pivot_by_value, pivot_values

ATTRS = ["key", "summary", "current_status", "issue_type", "assignee"]


def issue_attributes(issues: DataFrame) -> DataFrame:
    """PRJ-7: typed attributes read from ``fields`` (FN-1..3, FN-12), with one
    JSON parse per issue."""
    f = issues.select("key", parsed_issue_fields("fields").alias("_f"))
    col = {k: F.col("_f." + v) for k, v in ISSUE_FIELD_COLUMNS.items()}
    return f.select(
        "key", col["summary"].alias("summary"), col["current_status"].alias("current_status"),
        col["issue_type"].alias("issue_type"), col["assignee"].alias("assignee"),
        parse_jira_ts(col["created"]).alias("created"),
        parse_jira_ts(col["updated"]).alias("updated"))


def status_rows(changelog: DataFrame) -> DataFrame:
    """FLT-5: ``(issue_key, status, created)`` of status changes."""
    return status_changes(changelog).select(
        "issue_key", F.col("to_string").alias("status"), "created")


def status_values(changelog: DataFrame) -> DataFrame:
    """AGG-3: distinct statuses (sort at the sink: NULL last)."""
    return distinct_values(status_rows(changelog), "status")


def _statuses(rows: DataFrame, statuses: Sequence[str] | None) -> list[str]:
    if statuses is not None:
        return [s for s in statuses if s is not None]
    return pivot_values(rows, "status")


def _attach(issues: DataFrame, per_issue: DataFrame, attrs: Sequence[str]) -> DataFrame:
    # Aggregate first, then join: the history collapses to one row per issue
    # before it meets the issues (inner, as in the LEFT JOIN + WHERE).
    a = issue_attributes(issues).select(*attrs)
    return a.join(per_issue, a["key"] == per_issue["issue_key"], "inner").drop("issue_key")


def status_timeline(issues: DataFrame, changelog: DataFrame,
                    statuses: Sequence[str] | None = None) -> DataFrame:
    """Q1: issue attributes and ``<status>_min`` / ``<status>_max`` per status."""
    rows = status_rows(changelog)
    vals = _statuses(rows, statuses)
    if not vals:
        return issue_attributes(issues).select(*ATTRS).filter(F.lit(False))
    piv = pivot_by_value(rows, ["issue_key"], "status", vals,
                         [F.min("created").alias("min"), F.max("created").alias("max")])
    return _attach(issues, piv, ATTRS)


def status_times(changelog: DataFrame) -> DataFrame:
    """AGG-3..6 without columns per status: (issue_key, times), a map from each status of
    the issue to the first and last time it was entered.  Two aggregates, per issue and
    status and then per issue; no list of statuses is collected, statuses are data
    (any number of them, also such that differ only by case), and an issue's map is
    as large as its own statuses.  A NULL status has no entry."""
    per_status = status_rows(changelog).where(F.col("status").isNotNull()).groupBy("issue_key", "status").agg(
        F.struct(F.min("created").alias("first"), F.max("created").alias("last")).alias("seen"))
    return per_status.groupBy("issue_key").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "seen")))).alias("times"))


def status_timeline_map(issues: DataFrame, changelog: DataFrame) -> DataFrame:
    """Q1 with ``times`` in place of the columns per status."""
    return _attach(issues, status_times(changelog), ATTRS)


def status_first_seen(issues: DataFrame, changelog: DataFrame,
                      statuses: Sequence[str] | None = None) -> DataFrame:
    """AGG-4: first time each issue entered each status (columns named by status)."""
    rows = status_rows(changelog)
    vals = _statuses(rows, statuses)
    if not vals:
        return issue_attributes(issues).select(*ATTRS).filter(F.lit(False))
    piv = pivot_by_value(rows, ["issue_key"], "status", vals, [F.min("created")])
    return _attach(issues, piv, ATTRS)


def status_last_seen(issues: DataFrame, changelog: DataFrame,
                     statuses: Sequence[str] | None = None) -> DataFrame:
    """AGG-5: last time each issue entered each status."""
    rows = status_rows(changelog)
    vals = _statuses(rows, statuses)
    if not vals:
        return issues.select("key").filter(F.lit(False))
    piv = pivot_by_value(rows, ["issue_key"], "status", vals, [F.max("created")])
    return _attach(issues, piv, ["key"])


def single_issue_status(issues: DataFrame, changelog: DataFrame, key: str,
                        statuses: Sequence[str] | None = None) -> DataFrame:
    """Q5: first time one issue entered each status (one column per status)."""
    rows = status_rows(changelog)
    vals = _statuses(rows, statuses)
    one = rows.filter(F.col("issue_key") == F.lit(key))
    if not vals:
        return issues.select("key").filter(F.lit(False))
    piv = pivot_by_value(one, ["issue_key"], "status", vals, [F.min("created")])
    keys = issues.select("key").filter(F.col("key") == F.lit(key))
    return keys.join(piv, keys["key"] == piv["issue_key"], "inner").drop("issue_key")
