"""Issue queries: recent issues (Q7), link edges (Q8), watermarks (AGG-1/2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.timefmt import as_of_lit, iso_z, minute_text, truncate_minute
from issuelens.operators.filters import updated_within
from issuelens.operators.normalize import extract_links
from issuelens.operators.upsert import upsert_links
from issuelens.plans.timeline import issue_attributes
from issuelens.schemas import empty_frame

DEFAULT_WATERMARK = "2000-01-01 00:00:00"


def recent_issues(issues: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """Q7: key and summary of issues updated in the last ``days`` days."""
    return updated_within(issues, days, as_of).select(
        "key", F.get_json_object("fields", "$.summary").alias("summary"))


def issue_links(issues: DataFrame, existing: DataFrame | None = None, as_of=None) -> DataFrame:
    """Q8: link edges of the issues, upserted with DO NOTHING into ``existing``."""
    edges = extract_links(issues).withColumn("created_at", as_of_lit(as_of))
    if existing is None:
        existing = empty_frame(edges.sparkSession, edges.schema)
    return upsert_links(existing, edges)


def high_watermark(df: DataFrame, ts_col: str = "updated_at",
                   default: str = DEFAULT_WATERMARK) -> DataFrame:
    """AGG-1: ``MAX(ts)`` or the default on an empty table, also as ``…Z`` text."""
    hw = F.coalesce(F.max(ts_col), F.lit(default).cast("timestamp_ntz"))
    return df.agg(hw.alias("high_watermark")).select(
        "high_watermark", iso_z("high_watermark").alias("high_watermark_iso"))


def issue_watermark(issues: DataFrame) -> DataFrame:
    """AGG-2: latest ``fields.updated`` (parsed), truncated to the minute, and as
    ``yyyy-MM-dd HH:mm`` text; NULL when there are no issues (full reload)."""
    upd = issue_attributes(issues).agg(F.max("updated").alias("u"))
    return upd.select(truncate_minute("u").alias("watermark"),
                      minute_text("u").alias("watermark_text"))
