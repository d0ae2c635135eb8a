"""The two ingest flows as ``availableNow`` streams (STR-1, STR-2).

* pull requests + commits: landed PR pages and commit pages → normalise →
  ``pull_requests`` (UPS-1) and ``pull_request_commits`` (UPS-2);
* issues + changelogs: landed issue pages (all, or one project's) → ``jira_issues``
  (UPS-3) and the link edges of their ``fields`` → ``jira_links`` (UPS-5, DO
  NOTHING), both from one parse; landed changelog records (either API shape) →
  flatten → ``jira_changelog`` (UPS-4).

Which files are new is the stream checkpoint's business alone; no row is left
out by a watermark, so a page that lands late, in any order, is never lost.  A
page that cannot be read is put aside with its text, and loaded when it lands
again whole.  Of a pull request's versions the latest by ``updated_at`` stays, then
the last landed.  Elsewhere the last landed version of a key wins within a batch
(landed files are named so that lexical order is landing order), and the later
batch wins across batches.  Several landing folders or providers may feed one
warehouse, each with a checkpoint folder of its own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from issuelens.functions.timefmt import as_of_lit
from issuelens.operators.filters import for_project
from issuelens.operators.normalize import (
    explode_issue_page, extract_links, flatten_changelog, item_order, normalize_issues)
from issuelens.operators.upsert import RULES
from issuelens.sources import providers
from issuelens.sources.landed import CHANGELOG_PAGES, ISSUE_PAGES
from issuelens.sources.tables import BUCKETS, Warehouse
from issuelens.streaming.incremental import LANDED, Load, load_pages


def ingest_pull_requests(spark: SparkSession, pr_landing: str, commit_landing: str,
                         warehouse: str, checkpoint_root: str, provider: str = "github",
                         multi_line: bool = True, buckets: int = BUCKETS) -> Warehouse:
    """STR-1."""
    p = providers.get(provider)
    store = Warehouse(spark, warehouse, buckets)
    prs = Load("pull_requests", lambda rows: p.normalize_pull_requests(rows, keep=LANDED), order=["updated_at", *LANDED],
               **RULES["pull_requests"])
    commits = Load("pull_request_commits", lambda rows: p.normalize_commits(rows, keep=LANDED), order=LANDED,
                   **RULES["pull_request_commits"])
    load_pages(store, pr_landing, p.pull_request_pages, [prs], f"{checkpoint_root}/pull_requests", multi_line)
    load_pages(store, commit_landing, p.commit_pages, [commits], f"{checkpoint_root}/pull_request_commits", multi_line)
    return store


def ingest_issues(spark: SparkSession, issue_landing: str, changelog_landing: str,
                  warehouse: str, checkpoint_root: str, as_of=None,
                  multi_line_issues: bool = True, project: str | None = None, buckets: int = BUCKETS) -> Warehouse:
    """STR-2: issues, their links, and changelogs; with ``project`` (FLT-4) only that
    project's issues and links."""
    store = Warehouse(spark, warehouse, buckets)
    now = as_of_lit(as_of)

    def issue_rows(pages):
        issues = explode_issue_page(pages, keep=LANDED)
        if project is not None:
            issues = for_project(issues, project)
        return normalize_issues(issues, now, keep=[*LANDED, "_ipos"])

    issues = Load("jira_issues", lambda rows: rows, order=[*LANDED, "_ipos"], **RULES["jira_issues"])
    links = Load("jira_links", lambda rows: extract_links(rows).withColumn("created_at", now), **RULES["jira_links"])
    # The load's own pick by this order is that of ``first_item_per_key``.
    changelog = Load("jira_changelog", lambda rows: flatten_changelog(rows, keep=LANDED), order=item_order(LANDED),
                     **RULES["jira_changelog"])
    load_pages(store, issue_landing, ISSUE_PAGES, [issues, links], f"{checkpoint_root}/jira_issues", multi_line_issues,
               prepare=issue_rows)
    load_pages(store, changelog_landing, CHANGELOG_PAGES, [changelog], f"{checkpoint_root}/jira_changelog")
    return store
