"""Canonical tables built from the JSON fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import fixture_path
from issuelens.operators.normalize import first_item_per_key, flatten_changelog, normalize_issues
from issuelens.sources.landed import read_changelog_pages, read_issue_pages, read_transition_lookup

AS_OF = dt.datetime(2024, 2, 1)


def issues(spark):
    return normalize_issues(read_issue_pages(spark, fixture_path("issues_page.json")),
                            F.lit(AS_OF).cast("timestamp_ntz"))


def changelog(spark):
    return first_item_per_key(flatten_changelog(read_changelog_pages(spark, fixture_path("changelog.jsonl"))))


def lookup(spark):
    return read_transition_lookup(spark, fixture_path("status_transitions.csv"))
