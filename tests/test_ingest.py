import datetime as dt
import json
import os
import shutil

from conftest import fixture_path
from issuelens.sources import providers
from issuelens.streaming.ingest import ingest_issues, ingest_pull_requests


def _copy(src, dst_dir, name):
    os.makedirs(dst_dir, exist_ok=True)
    shutil.copy(src, os.path.join(dst_dir, name))


def test_ingest_pull_requests(spark, tmp_dir):
    _copy(fixture_path("pull_requests_page.json"), f"{tmp_dir}/prs", "page-0001.json")
    os.makedirs(f"{tmp_dir}/commits", exist_ok=True)
    with open(fixture_path("commits.jsonl")) as f, open(f"{tmp_dir}/commits/page-0001.json", "w") as g:
        g.write("[" + ",".join(line.strip() for line in f if line.strip()) + "]")
    store = ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/commits", f"{tmp_dir}/wh", f"{tmp_dir}/ck")
    prs = store.read("pull_requests")
    commits = {(r["sha"], r["pull_request_id"]): r for r in store.read("pull_request_commits").collect()}
    assert prs.count() == 9 and len(commits) == 5
    assert commits[("aaa", 1001)]["message"] == "first, amended"     # later landed version wins
    assert commits[("ccc", 1003)]["author_date"] is None
    # second page: one PR updated, one older than its stored version
    with open(fixture_path("pull_requests_page.json")) as f:
        page = json.load(f)
    upd = dict(page[0], title="PROJ-12 again", updated_at="2024-03-01T00:00:00Z")
    stale = dict(page[1], title="stale", updated_at="2024-01-03T10:00:00Z")
    with open(f"{tmp_dir}/prs/page-0002.json", "w") as g:
        json.dump([upd, stale], g)
    store = ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/commits", f"{tmp_dir}/wh", f"{tmp_dir}/ck")
    titles = {r["id"]: r["title"] for r in store.read("pull_requests").collect()}
    assert titles[1001] == "PROJ-12 again" and titles[1002] == page[1]["title"]
    assert store.rows("pull_requests").where("load_batch = 1").select("id").collect() == [(1001,)]


def test_ingest_issues_links_changelog(spark, tmp_dir):
    _copy(fixture_path("issues_page.json"), f"{tmp_dir}/issues", "page-0001.json")
    _copy(fixture_path("changelog.jsonl"), f"{tmp_dir}/changelog", "part-0001.json")
    store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh",
                          f"{tmp_dir}/ck", as_of="2024-02-01 00:00:00")
    assert store.read("jira_issues").count() == 4
    links = sorted(tuple(r)[:3] for r in store.read("jira_links").collect())
    assert links == [("PROJ-1", "PROJ-2", "Blocks"), ("PROJ-2", "PROJ-4", ""),
                     ("PROJ-3", "PROJ-1", "Relates"), ("PROJ-5", "PROJ-2", "")]
    chg = store.read("jira_changelog")
    assert chg.filter("id = '11'").first()["to_string"] == "Won't Do"
    # re-landed issue page with an edited summary: updated, created_at kept
    with open(fixture_path("issues_page.json")) as f:
        page = json.load(f)
    page["issues"] = [dict(page["issues"][0], fields=dict(page["issues"][0]["fields"], summary="edited"))]
    with open(f"{tmp_dir}/issues/page-0002.json", "w") as g:
        json.dump(page, g)
    store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh",
                          f"{tmp_dir}/ck", as_of="2024-03-01 00:00:00")
    row = store.read("jira_issues").filter("key = 'PROJ-1'").first()
    assert json.loads(row["fields"])["summary"] == "edited"
    assert row["created_at"] == dt.datetime(2024, 2, 1) and row["updated_at"] == dt.datetime(2024, 3, 1)
    assert store.read("jira_links").count() == 4


def test_ingest_one_project(spark, tmp_dir):
    _copy(fixture_path("issues_page.json"), f"{tmp_dir}/issues", "page-0001.json")
    _copy(fixture_path("changelog.jsonl"), f"{tmp_dir}/changelog", "part-0001.json")
    with open(fixture_path("issues_page.json")) as f:
        page = json.load(f)
    projects = [(i["fields"].get("project") or {}).get("key") for i in page["issues"]]
    for name in ("NONE", "OTHER", "PROJ"):
        store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh-{name}", f"{tmp_dir}/ck-{name}",
                              as_of="2024-02-01 00:00:00", project=name)
        assert store.read("jira_issues").count() == projects.count(name)
    assert projects.count("OTHER") and projects.count("PROJ")


def test_provider_registry():
    assert "github" in providers.names()
    try:
        providers.get("nope")
    except KeyError:
        pass
    else:
        raise AssertionError


def test_second_provider(spark, tmp_dir):
    """Another host's pages, with names and keys of their own, in the same tables."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from issuelens import schemas
    from issuelens.sources.landed import Pages
    mr = T.StructType([T.StructField(n, t) for n, t in (("iid", T.LongType()), ("subject", T.StringType()), ("changed", T.StringType()))])
    ch = T.StructType([T.StructField("hash", T.StringType()), T.StructField("iid", T.LongType())])

    def table_rows(schema, known):
        return lambda raw, keep=(): raw.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], *keep)
    requests = table_rows(schemas.PULL_REQUESTS, {"id": F.col("iid"), "title": F.col("subject"), "updated_at": F.to_timestamp_ntz("changed")})
    commits = table_rows(schemas.PULL_REQUEST_COMMITS, {"sha": F.col("hash"), "pull_request_id": F.col("iid")})
    providers.register(providers.Provider(
        "other", Pages(mr, lambda e: e["iid"].isNotNull()), Pages(ch, lambda e: e["hash"].isNotNull()), requests, commits))
    for folder, text in (("mrs", '[{"iid": 5, "subject": "s", "changed": "2024-01-01T00:00:00"}]'), ("changes", '[{"hash": "f", "iid": 5}]')):
        os.makedirs(f"{tmp_dir}/{folder}")
        with open(f"{tmp_dir}/{folder}/p.json", "w") as f:
            f.write(text)
    _copy(fixture_path("pull_requests_page.json"), f"{tmp_dir}/prs", "page-0001.json")
    os.makedirs(f"{tmp_dir}/none")
    ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/none", f"{tmp_dir}/wh", f"{tmp_dir}/ck-a")
    store = ingest_pull_requests(spark, f"{tmp_dir}/mrs", f"{tmp_dir}/changes", f"{tmp_dir}/wh", f"{tmp_dir}/ck-b", provider="other")
    rows = {r["id"]: r["title"] for r in store.read("pull_requests").collect()}
    assert len(rows) == 10 and rows[5] == "s"
    assert [(r["sha"], r["pull_request_id"]) for r in store.read("pull_request_commits").collect()] == [("f", 5)]


def test_sql_over_registered_views(spark, tmp_dir):
    from issuelens.sources.tables import register_views
    _copy(fixture_path("pull_requests_page.json"), f"{tmp_dir}/prs", "page-0001.json")
    os.makedirs(f"{tmp_dir}/commits", exist_ok=True)
    with open(fixture_path("commits.jsonl")) as f, open(f"{tmp_dir}/commits/page-0001.json", "w") as g:
        g.write("[" + ",".join(line.strip() for line in f if line.strip()) + "]")
    store = ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/commits", f"{tmp_dir}/wh", f"{tmp_dir}/ck")
    _copy(fixture_path("issues_page.json"), f"{tmp_dir}/issues", "page-0001.json")
    _copy(fixture_path("changelog.jsonl"), f"{tmp_dir}/changelog", "part-0001.json")
    ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh", f"{tmp_dir}/ck2",
                  as_of="2024-02-01 00:00:00")
    register_views(store)
    rows = spark.sql("""SELECT sha FROM commits WHERE sha IN
        (SELECT commit_sha FROM pr_commits WHERE pr_id IN (SELECT id FROM pull_requests WHERE number = 1))""").collect()
    assert sorted(r["sha"] for r in rows) == ["aaa", "bbb"]
    keys = spark.sql("""SELECT key, JSON_EXTRACT_STRING(fields, '$.summary') AS summary FROM jira_issues
                        WHERE JSON_EXTRACT_STRING(fields, '$.status.name') = 'Done'""").collect()
    assert sorted(r["key"] for r in keys) == ["PROJ-1", "PROJ-4"]
