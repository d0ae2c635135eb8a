from pyspark.sql import functions as F

from conftest import fixture_path
from issuelens.operators.normalize import normalize_commits, normalize_pull_requests
from issuelens.operators.upsert import upsert_pull_request_commits
from issuelens.plans import pull_requests as q
from issuelens.schemas import PULL_REQUEST_COMMITS
from issuelens.sources.landed import read_commit_pages, read_pull_request_pages


def _tables(spark):
    prs = normalize_pull_requests(read_pull_request_pages(spark, fixture_path("pull_requests_page.json")))
    landed = normalize_commits(read_commit_pages(spark, fixture_path("commits.jsonl"), multi_line=False))
    empty = spark.createDataFrame([], PULL_REQUEST_COMMITS)
    commits = upsert_pull_request_commits(empty, landed.withColumn("_pos", F.monotonically_increasing_id()),
                                          order=["_pos"], latest=True)
    return prs, commits


def test_merged_pr_issue_keys(spark):
    prs, commits = _tables(spark)
    rows = q.merged_pr_issue_keys(prs, commits, "PROJ").collect()
    keys = {(r["number"], r["sha"], r["jira_key"]) for r in rows}
    assert keys == {
        (1, "aaa", "PROJ-12"), (1, "bbb", "PROJ-12"),   # merged, two commits
        (2, "bbb", "proj-7"),                           # lower case kept; same sha in two PRs
        (3, "ccc", "PROJ-1"),                           # first of two keys
        (4, None, "PROJ-12345"),                        # six digits cut to five; no commits
        (9, None, "PROJ-11"),                           # merged PR without commits survives
    }
    assert q.merged_pr_issue_keys(prs, commits, "PROJ", upper=True) \
        .filter("number = 2").first()["jira_key"] == "PROJ-7"


def test_left_join_keeps_prs_without_commits(spark):
    prs, commits = _tables(spark)
    c = commits.select("pull_request_id", "sha")
    out = q.pull_requests_with_commits(prs.select("id", "number"), c)
    by = {}
    for r in out.collect():
        by.setdefault(r["number"], set()).add(r["sha"])
    assert by[1] == {"aaa", "bbb"} and by[8] == {None} and len(by) == 9


def test_commits_of_pull_request(spark):
    prs, commits = _tables(spark)
    cv, pc = q.commit_views(commits)
    rows = q.commits_of_pull_request(prs, pc, cv, 1).collect()
    assert sorted(r["sha"] for r in rows) == ["aaa", "bbb"]
    assert [r["message"] for r in rows if r["sha"] == "aaa"] == ["first, amended"]  # re-fetched wins
    narrow = q.commits_of_pull_request_from_table(prs, commits, 1).collect()
    assert sorted(tuple(r) for r in narrow) == sorted(tuple(r) for r in rows)
    assert sorted(r["sha"] for r in q.commits_of_pull_request_from_table(prs, commits, 2).collect()) == ["bbb"]
