"""Pull requests and their commits (Q4, Q6, JN-3, JN-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.functions.text import issue_key_in
from issuelens.operators.filters import merged_only, one_pull_request, with_issue_key
from issuelens.operators.stage import materialize
from issuelens.operators.upsert import count_copies, dedupe_first


def pull_requests_with_commits(prs: DataFrame, commits: DataFrame,
                               pr_key: str = "id", commit_key: str = "pull_request_id") -> DataFrame:
    """JN-3: PRs LEFT JOIN commits (PRs without commits keep NULL commit columns).

    Written as inner join ∪ anti join: adaptive execution can split a PR with
    a huge number of commits in an inner join, but not on the outer side of a
    left join.  The anti join reads only the distinct PR ids of the commits
    (pre-aggregated map-side).
    """
    matched = prs.join(commits, prs[pr_key] == commits[commit_key], "inner")
    have = commits.select(F.col(commit_key).alias("_has_commits")).distinct()
    unmatched = prs.join(have, prs[pr_key] == have["_has_commits"], "left_anti")
    for f in commits.schema.fields:
        unmatched = unmatched.withColumn(f.name, F.lit(None).cast(f.dataType))
    return matched.unionByName(unmatched.select(*matched.columns))


Q4_COLUMNS = ["number", "title", "state", "created_at", "merged_at", "sha", "commit_date",
              "message", "jira_key"]


def merged_pr_issue_keys(prs: DataFrame, commits: DataFrame, project: str,
                         upper: bool = False) -> DataFrame:
    """Q4: commits of merged PRs whose title names an issue of ``project``
    (first key in the title, as written unless ``upper``)."""
    merged = merged_only(prs).select(
        "id", "number", "title", "state", "created_at", "merged_at",
        issue_key_in("title", project, upper).alias("jira_key"))
    merged = with_issue_key(merged)
    c = commits.select("pull_request_id", "sha", "commit_date", "message")
    return pull_requests_with_commits(merged, c).select(*Q4_COLUMNS)


def commit_views(pull_request_commits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``commits`` (one row per sha) and ``pr_commits`` (pr_id, commit_sha)
    derived from the denormalised table."""
    attrs = [c for c in pull_request_commits.columns
             if c not in ("sha", "pull_request_id", "pull_request_number")]
    rows = pull_request_commits.select("sha", "pull_request_id", *attrs)
    commits = dedupe_first(rows, ["sha"], ["pull_request_id"], count_copies(rows, ["sha"])).drop("pull_request_id")
    pr_commits = pull_request_commits.select(F.col("pull_request_id").alias("pr_id"),
                                             F.col("sha").alias("commit_sha"))
    return commits, pr_commits


def commits_of_pull_request(prs: DataFrame, pr_commits: DataFrame, commits: DataFrame,
                            number: int) -> DataFrame:
    """Q6 / JN-9 over separate ``commits`` / ``pr_commits`` tables: all
    commits of the PR with this number (PR → junction → commit)."""
    pr = one_pull_request(prs, number).select(F.col("id").alias("_pr_id")).alias("pr")
    pc = pr_commits.alias("pc")
    c = commits.alias("c")
    j = pr.join(pc, F.col("pr._pr_id") == F.col("pc.pr_id"), "inner")
    j = j.join(c, F.col("pc.commit_sha") == F.col("c.sha"), "inner")
    return j.select(*[F.col(f"c.{name}") for name in commits.columns])


def commits_of_pull_request_from_table(prs: DataFrame, pull_request_commits: DataFrame,
                                       number: int) -> DataFrame:
    """Q6 over the denormalised table.  The table is first narrowed to the rows
    whose sha belongs to that PR (a semi join against the PR's few shas), and
    only then split into the ``commits`` / ``pr_commits`` views: the per-sha
    representative is chosen among all rows of the sha either way, so the
    result is the same, but the de-duplication touches only the PR's commits
    instead of the whole table.  The PR's ids and shas are written first: Spark knows
    their size then, and only scans the table where they are few."""
    pr = materialize(one_pull_request(prs, number).select(F.col("id").alias("_pr_id")), "pr-ids")
    mine = pull_request_commits.join(pr, pull_request_commits["pull_request_id"] == pr["_pr_id"],
                                     "left_semi")
    shas = materialize(mine.select(F.col("sha").alias("_sha")).distinct(), "pr-shas")
    narrowed = pull_request_commits.join(shas, pull_request_commits["sha"] == shas["_sha"], "left_semi")
    commits, pr_commits = commit_views(narrowed)
    return commits_of_pull_request(prs, pr_commits, commits, number)
