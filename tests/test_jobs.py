import os
import shutil

from conftest import fixture_path
from issuelens import jobs


def test_landing_to_sorted_csv(spark, tmp_dir):
    for folder, name in (("pull_requests", "pull_requests_page.json"), ("issues", "issues_page.json"),
                         ("changelog", "changelog.jsonl")):
        os.makedirs(f"{tmp_dir}/landing/{folder}")
        shutil.copy(fixture_path(name), f"{tmp_dir}/landing/{folder}/page-1.json")
    os.makedirs(f"{tmp_dir}/landing/commits")
    store = jobs.ingest(spark, f"{tmp_dir}/landing", f"{tmp_dir}/wh", f"{tmp_dir}/ck", as_of="2024-02-01 00:00:00")
    assert store.read("jira_issues").count() == 4
    jobs.timeline(spark, f"{tmp_dir}/wh", f"{tmp_dir}/timeline")
    rows = spark.read.option("header", True).csv(f"{tmp_dir}/timeline").collect()
    assert rows and [r["key"] for r in rows] == sorted(r["key"] for r in rows)
    jobs.chains(spark, f"{tmp_dir}/wh", fixture_path("status_transitions.csv"), f"{tmp_dir}/chains")
    rows = spark.read.option("header", True).csv(f"{tmp_dir}/chains").collect()
    assert rows and "chain_id" in rows[0].asDict()
    # SNK-4: every row of the chains, with the values they have as a frame
    from issuelens.plans.chains import status_chains
    from issuelens.sources.landed import read_transition_lookup
    frame = status_chains(store.read("jira_issues"), store.read("jira_changelog"),
                          read_transition_lookup(spark, fixture_path("status_transitions.csv"))).orderBy("issue_key", "step").collect()
    told = lambda r: tuple(str(r[c]) for c in ("issue_key", "step", "source", "target", "chain_length", "chain", "chain_id"))
    assert [told(r) for r in rows] == [told(r) for r in frame]
