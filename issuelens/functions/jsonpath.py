"""JSON extraction (FN-1..FN-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Paths into an issue's ``fields`` JSON.  The raw payload spells the type and
# assignee attributes ``issuetype`` and ``displayName``.
ISSUE_PATHS = {
    "summary": "$.summary",
    "current_status": "$.status.name",
    "issue_type": "$.issuetype.name",
    "assignee": "$.assignee.displayName",
    "created": "$.created",
    "updated": "$.updated",
    "project": "$.project.key",
}


def json_text(col: str | Column, path: str) -> Column:
    """FN-1/2/3: the value at ``path`` as unquoted text; NULL for JSON null or missing."""
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, path)


# The attributes the queries read from an issue's ``fields``, as one schema so
# the JSON text is parsed once per row instead of once per path.
ISSUE_FIELDS_SCHEMA = (
    "summary string, status struct<name: string>, issuetype struct<name: string>, "
    "assignee struct<displayName: string>, created string, updated string, "
    "project struct<key: string>")

ISSUE_FIELD_COLUMNS = {
    "summary": "summary",
    "current_status": "status.name",
    "issue_type": "issuetype.name",
    "assignee": "assignee.displayName",
    "created": "created",
    "updated": "updated",
    "project": "project.key",
}


def parsed_issue_fields(fields: str | Column = "fields") -> Column:
    """``fields`` parsed once into a struct of the attributes above."""
    c = F.col(fields) if isinstance(fields, str) else fields
    return F.from_json(c, ISSUE_FIELDS_SCHEMA)
