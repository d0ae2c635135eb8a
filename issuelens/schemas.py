"""Fixed schemas: the five tables, the lookup file and the landed payloads."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------- tables
PULL_REQUESTS = _struct(
    ("id", L), ("number", I), ("title", S), ("user_login", S), ("state", S),
    ("created_at", TS), ("updated_at", TS), ("closed_at", TS), ("merged_at", TS),
    ("html_url", S))

PULL_REQUEST_COMMITS = _struct(
    ("sha", S), ("pull_request_id", L), ("pull_request_number", I),
    ("author_name", S), ("author_email", S), ("author_date", TS),
    ("committer_name", S), ("committer_email", S), ("commit_date", TS),
    ("message", S), ("html_url", S))

JIRA_ISSUES = _struct(
    ("key", S), ("id", S), ("fields", S), ("created_at", TS), ("updated_at", TS))

JIRA_CHANGELOG = _struct(
    ("id", S), ("issue_key", S), ("created", TS), ("author_account_id", S),
    ("author_display_name", S), ("field", S), ("field_type", S), ("from_value", S),
    ("from_string", S), ("to_value", S), ("to_string", S))

JIRA_LINKS = _struct(
    ("source_issue_key", S), ("target_issue_key", S), ("link_type", S), ("created_at", TS))

STATUS_LOOKUP = _struct(("source", S), ("target", S), ("classification", S), ("type", S))

TABLES = {
    "pull_requests": PULL_REQUESTS,
    "pull_request_commits": PULL_REQUEST_COMMITS,
    "jira_issues": JIRA_ISSUES,
    "jira_changelog": JIRA_CHANGELOG,
    "jira_links": JIRA_LINKS,
}

# Primary keys, enforced by the upsert and audited by quality.key_duplicates.
KEYS = {
    "pull_requests": ["id"],
    "pull_request_commits": ["sha", "pull_request_id"],
    "jira_issues": ["key"],
    "jira_changelog": ["id", "field"],
    "jira_links": ["source_issue_key", "target_issue_key", "link_type"],
}

# ---------------------------------------------------------------- payloads
# Pull-request page: a top-level array of PR objects, times as ISO text.
PR_RAW = _struct(
    ("id", L), ("number", I), ("title", S), ("user", _struct(("login", S))), ("state", S),
    ("created_at", S), ("updated_at", S), ("closed_at", S), ("merged_at", S), ("html_url", S))

_PERSON = _struct(("name", S), ("email", S), ("date", S))

# Commit page element; landed records carry the PR id / number they belong to.
COMMIT_RAW = _struct(
    ("sha", S), ("html_url", S),
    ("commit", _struct(("message", S), ("author", _PERSON), ("committer", _PERSON))),
    ("pull_request_id", L), ("pull_request_number", I))

# Issue search page: {total, issues: [{key, id, fields}]}; ``fields`` kept as raw JSON text.
ISSUE_RAW = _struct(("key", S), ("id", S), ("fields", S))
ISSUE_PAGE = _struct(("total", L), ("issues", T.ArrayType(ISSUE_RAW)))

CHANGE_ITEM = _struct(("field", S), ("fieldtype", S), ("from", S), ("fromString", S),
                      ("to", S), ("toString", S))
HISTORY = _struct(("id", S), ("created", S),
                  ("author", _struct(("accountId", S), ("displayName", S))),
                  ("items", T.ArrayType(CHANGE_ITEM)))

# Changelog landing record: one issue key plus either the v2 shape
# ``changelog.histories`` or the v3 shape ``values`` (with ``total``).
CHANGELOG_RAW = _struct(
    ("issue_key", S), ("key", S),
    ("changelog", _struct(("histories", T.ArrayType(HISTORY)))),
    ("values", T.ArrayType(HISTORY)), ("total", L))

# Elements of ``fields.issuelinks``.
ISSUE_LINK = _struct(("type", _struct(("name", S))),
                     ("outwardIssue", _struct(("key", S))),
                     ("inwardIssue", _struct(("key", S))))
ISSUE_LINKS = T.ArrayType(ISSUE_LINK)


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame of ``schema`` as a local relation (no RDD job)."""
    from pyspark.sql import functions as F
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(0).select(*cols)


def empty_table(spark, name: str):
    """SNK-1: the typed, empty table (create-if-absent)."""
    return empty_frame(spark, TABLES[name])
