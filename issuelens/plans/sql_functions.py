"""The parametrised queries as SQL table functions (Q5, Q6, Q7, SNK-2).

They read the views that ``sources.tables.register_views`` makes (or any of the same
names), so SQL users pass values as arguments, or bind them with parameter markers:
``spark.sql("SELECT * FROM status_times(:issue, :statuses)", args={...})``.  A bound value
is never part of the SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Q5: first time an issue entered each of the statuses asked for.
STATUS_TIMES = """CREATE OR REPLACE TEMPORARY FUNCTION status_times(issue STRING, statuses ARRAY<STRING>)
RETURNS TABLE (key STRING, status STRING, first_seen TIMESTAMP_NTZ)
RETURN SELECT i.key, c.to_string, MIN(c.created)
  FROM jira_issues i JOIN jira_changelog c ON i.key = c.issue_key
  WHERE i.key = status_times.issue AND c.field = 'status' AND array_contains(status_times.statuses, c.to_string)
  GROUP BY i.key, c.to_string"""

# Q6: the commits of a pull request.
COMMITS_OF = """CREATE OR REPLACE TEMPORARY FUNCTION commits_of(pr_number INT)
RETURNS TABLE (sha STRING, author_name STRING, message STRING)
RETURN SELECT c.sha, c.author_name, c.message
  FROM pull_requests p JOIN pr_commits pc ON p.id = pc.pr_id JOIN commits c ON pc.commit_sha = c.sha
  WHERE p.number = commits_of.pr_number"""

# Q7: issues updated within some days.
UPDATED_WITHIN = """CREATE OR REPLACE TEMPORARY FUNCTION updated_within(days INT, as_of TIMESTAMP_NTZ)
RETURNS TABLE (key STRING, summary STRING)
RETURN SELECT key, get_json_object(fields, '$.summary') FROM jira_issues
  WHERE CAST(try_cast(get_json_object(fields, '$.updated') AS TIMESTAMP) AS TIMESTAMP_NTZ)
        >= timestampadd(DAY, -updated_within.days, updated_within.as_of)"""


def register_functions(spark: SparkSession) -> None:
    for text in (STATUS_TIMES, COMMITS_OF, UPDATED_WITHIN):
        spark.sql(text)


def status_times(spark: SparkSession, issue: str, statuses: list[str]) -> DataFrame:
    """Q5 in long form."""
    return spark.sql("SELECT * FROM status_times(:issue, :statuses)", args={"issue": issue, "statuses": statuses})


def commits_of(spark: SparkSession, number: int) -> DataFrame:
    """Q6."""
    return spark.sql("SELECT * FROM commits_of(:number)", args={"number": number})


def updated_within(spark: SparkSession, days: int, as_of: str) -> DataFrame:
    """Q7."""
    return spark.sql("SELECT * FROM updated_within(:days, CAST(:as_of AS TIMESTAMP_NTZ))", args={"days": days, "as_of": as_of})
