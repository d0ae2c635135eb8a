"""Work-item history analytics on Spark.

Typed tables for pull requests, commits, issues, issue changelogs and issue
links; keyed upserts into Parquet tables (batch or ``availableNow``
Structured Streaming); and DataFrame queries over the tables: status
timelines, status transitions with durations, status chains, merged pull
requests tied to issue keys, and issue link edges.
"""

__version__ = "0.1.0"
