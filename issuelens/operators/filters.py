"""Row filters (FLT-1..FLT-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.functions.timefmt import as_of_lit, days_before, truncate_minute, parse_jira_ts
from issuelens.functions.jsonpath import json_text, ISSUE_PATHS


def _ts(value) -> Column:
    return value if isinstance(value, Column) else as_of_lit(value)


def newer_than(df: DataFrame, watermark, ts_col: str = "updated_at") -> DataFrame:
    """FLT-1/2: rows strictly newer than the watermark (order-free form of the early stop)."""
    return df.filter(F.col(ts_col) > _ts(watermark))


def since_minute(df: DataFrame, watermark, ts_col: Column | str = "updated") -> DataFrame:
    """FLT-3: rows at or after the watermark truncated to the minute."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return df.filter(c >= truncate_minute(_ts(watermark)))


def for_project(issues: DataFrame, project: str) -> DataFrame:
    """FLT-4: issues of one project."""
    return issues.filter(json_text("fields", ISSUE_PATHS["project"]) == F.lit(project))


def status_changes(changelog: DataFrame) -> DataFrame:
    """FLT-5: status rows of the changelog (pushed to the Parquet scan)."""
    return changelog.filter(F.col("field") == F.lit("status"))


def merged_only(prs: DataFrame) -> DataFrame:
    """FLT-6: closed and merged pull requests."""
    return prs.filter(F.col("state").isin("closed") & F.col("merged_at").isNotNull())


def with_issue_key(df: DataFrame, col: str = "jira_key") -> DataFrame:
    """FLT-7: a key was found (``''`` and NULL drop)."""
    return df.filter(F.col(col) != F.lit(""))


def one_issue(df: DataFrame, key: str, col: str = "key") -> DataFrame:
    """FLT-8."""
    return df.filter(F.col(col) == F.lit(key))


def one_pull_request(prs: DataFrame, number: int) -> DataFrame:
    """FLT-9."""
    return prs.filter(F.col("number") == F.lit(int(number)))


def updated_within(issues: DataFrame, days: int, as_of=None) -> DataFrame:
    """FLT-10: issues whose ``fields.updated`` is within ``days`` of ``as_of`` (parsed, not text)."""
    updated = parse_jira_ts(json_text("fields", ISSUE_PATHS["updated"]))
    return issues.filter(updated >= days_before(as_of_lit(as_of), days))


def first_per_group(df: DataFrame, keys, order) -> DataFrame:
    """FLT-12/WIN-2: the first row of each group in ``order`` (``row_num = 1``),
    as an aggregate so a hot group is reduced map-side."""
    from issuelens.operators.upsert import dedupe_first
    return dedupe_first(df, keys, order).select(*df.columns)
