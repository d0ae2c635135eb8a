import datetime as dt

from conftest import fixture_path
from issuelens.operators.normalize import (
    extract_links, first_item_per_key, flatten_changelog, normalize_commits, normalize_pull_requests)
from issuelens.sources.landed import (
    read_changelog_pages, read_commit_pages, read_issue_pages, read_pull_request_pages,
    read_transition_lookup)


def test_pull_request_page(spark):
    prs = normalize_pull_requests(read_pull_request_pages(spark, fixture_path("pull_requests_page.json")))
    rows = {r["id"]: r for r in prs.collect()}
    assert len(rows) == 9
    assert rows[1001]["user_login"] == "ann"
    assert rows[1001]["merged_at"] == dt.datetime(2024, 1, 3, 10, 0)
    assert rows[1008]["closed_at"] is None
    assert prs.schema["created_at"].dataType.simpleString() == "timestamp_ntz"


def test_commit_pages_coerce_and_offsets(spark):
    c = normalize_commits(read_commit_pages(spark, fixture_path("commits.jsonl"), multi_line=False))
    rows = c.collect()
    assert len(rows) == 6
    bad = [r for r in rows if r["sha"] == "ccc"][0]
    assert bad["author_date"] is None                       # d/m/Y does not parse → NULL
    assert bad["commit_date"] == dt.datetime(2024, 1, 3, 7, 5)  # +02:00 converted to UTC
    assert c.columns[:3] == ["sha", "pull_request_id", "pull_request_number"]


def test_issue_page_keeps_fields_as_json_text(spark):
    issues = read_issue_pages(spark, fixture_path("issues_page.json"))
    rows = {r["key"]: r for r in issues.collect()}
    assert set(rows) == {"PROJ-1", "PROJ-2", "PROJ-3", "PROJ-4"}
    assert '"assignee":null' in rows["PROJ-1"]["fields"].replace(" ", "")


def test_changelog_both_shapes_flatten(spark):
    raw = read_changelog_pages(spark, fixture_path("changelog.jsonl"))
    flat = flatten_changelog(raw)
    rows = flat.collect()
    keys = {r["issue_key"] for r in rows}
    assert keys == {"PROJ-1", "PROJ-2", "PROJ-99", "PROJ-4"}     # PROJ-3 has no history
    assert not [r for r in rows if r["id"] == "4"]                # entry without items → no rows
    r2 = [r for r in rows if r["id"] == "2"][0]
    assert (r2["author_account_id"], r2["author_display_name"]) == ("", "")   # missing author
    r3 = [r for r in rows if r["id"] == "3" and r["field"] == "status"][0]
    assert r3["author_display_name"] == ""
    r10 = [r for r in rows if r["id"] == "10"][0]
    assert r10["created"] == dt.datetime(2024, 1, 3, 7, 0)       # +0200 → UTC
    r12 = [r for r in rows if r["id"] == "12"][0]
    assert r12["to_string"] is None                               # explicit null kept
    r13 = [r for r in rows if r["id"] == "13"][0]
    assert r13["to_string"] is None and r13["field"] == "resolution"


def test_duplicate_field_in_entry_first_wins(spark):
    flat = first_item_per_key(flatten_changelog(read_changelog_pages(spark, fixture_path("changelog.jsonl"))))
    r11 = [r for r in flat.collect() if r["id"] == "11"]
    assert len(r11) == 1 and r11[0]["to_string"] == "Won't Do"
    assert "entry_pos" not in flat.columns


def test_extract_links(spark):
    issues = read_issue_pages(spark, fixture_path("issues_page.json"))
    edges = sorted(tuple(r) for r in extract_links(issues).collect())
    assert edges == sorted([
        ("PROJ-1", "PROJ-2", "Blocks"), ("PROJ-3", "PROJ-1", "Relates"),
        ("PROJ-1", "PROJ-2", "Blocks"), ("PROJ-2", "PROJ-4", ""), ("PROJ-5", "PROJ-2", "")])


def test_lookup_csv(spark):
    lk = read_transition_lookup(spark, fixture_path("status_transitions.csv"))
    assert lk.count() == 8 and lk.columns == ["source", "target", "classification", "type"]
