"""Timeline maps, chain fingerprints and dictionary, VARIANT members, SQL functions."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

import tables
from issuelens.functions.variant import document, text_or
from issuelens.operators.normalize import changelog_members, flatten_changelog
from issuelens.plans import chains, proxies as X, sql_functions, timeline
from issuelens.plans.chain_store import ChainStore, chain_places, fingerprints
from issuelens.sources.landed import read_changelog_pages
from conftest import fixture_path

SF = "/root/testdata/sf0.001"


# -- map timeline --------------------------------------------------------------------------------------------------

def test_map_equals_pivot(spark):
    i, c = X.issues(spark, SF), X.changelog(spark, SF)
    pivot = {r["key"]: r.asDict() for r in timeline.status_timeline(i, c).collect()}
    maps = timeline.status_timeline_map(i, c).collect()
    assert {r["key"] for r in maps} == set(pivot)
    for r in maps:
        want = {k[:-4]: (v, pivot[r["key"]][k[:-4] + "_max"]) for k, v in pivot[r["key"]].items() if k.endswith("_min") and v}
        assert {k: (v["first"], v["last"]) for k, v in r["times"].items()} == want


def test_map_takes_any_number_of_statuses(spark):
    """20,000 statuses, some differing by case only, and a NULL one."""
    n = F.col("id")
    rows = spark.range(60_000).select(
        F.concat(F.lit("A-"), (n % 3).cast("string")).alias("issue_key"),
        F.when(n == 5, None).when(n % 2 == 0, F.concat(F.lit("s"), (n % 20_000).cast("string")))
        .otherwise(F.concat(F.lit("S"), ((n - 1) % 20_000).cast("string"))).alias("to_string"),
        F.timestamp_seconds(n).cast("timestamp_ntz").alias("created"), F.lit("status").alias("field"))
    out = timeline.status_times(rows).select("issue_key", F.size("times").alias("n"), F.element_at("times", "s2")["first"].alias("t")).collect()
    assert len(out) == 3 and sum(r.n for r in out) > 20_000
    assert min(r.t for r in out if r.t) == dt.datetime(1970, 1, 1, 0, 0, 2)


def test_map_path_collects_nothing(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    i, c = X.issues(spark, SF), X.changelog(spark, SF)
    for name in ("collect", "toPandas", "first", "take", "count"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **k: pytest.fail("a job on the driver's way"))
    timeline.status_timeline_map(i, c)


# -- chains --------------------------------------------------------------------------------------------------------

def _labels(spark, issues, changelog, lookup):
    rows = chains.status_chains(issues, changelog, lookup).select("issue_key", "chain", "chain_id").distinct()
    return {r["issue_key"]: (r["chain"], r["chain_id"]) for r in rows.collect()}


@pytest.mark.parametrize("strategy", ["window", "ranged"])
def test_first_load_gives_the_ids_of_the_labels(spark, tmp_dir, strategy):
    i, c, lk = X.issues(spark, SF), X.changelog(spark, SF), X.status_lookup(spark)
    store = ChainStore(spark, tmp_dir)
    ids = {r["issue_key"]: r["chain_id"] for r in store.extend(chain_places(i, c, lk, strategy), 1).collect()}
    texts = {r["chain_id"]: r["chain"] for r in store.texts().collect()}
    want = _labels(spark, i, c, lk)
    assert {k: (texts[n], n) for k, n in ids.items()} == want


def test_known_ids_stay_and_a_load_can_run_again(spark, tmp_dir):
    i, c, lk = X.issues(spark, SF), X.changelog(spark, SF), X.status_lookup(spark)
    store, days, seen = ChainStore(spark, tmp_dir), (8, 15, 40), {}
    for n, day in enumerate(days):
        part = c.where(F.col("created") < F.lit(f"2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr(f"INTERVAL {day} DAYS"))
        for _ in range(2):
            now = {r["issue_key"]: r["chain_id"] for r in store.extend(chain_places(i, part, lk), n).collect()}
        texts = {r["chain_id"]: r["chain"] for r in store.texts().collect()}
        assert all(texts[k] == v for k, v in seen.items())
        seen = texts
        want = _labels(spark, i, part, lk)
        assert {k: texts[v] for k, v in now.items()} == {k: v[0] for k, v in want.items()}
    ids = [r["chain_id"] for r in store.ids().collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_fingerprints_tell_chains_apart(spark):
    rnd = random.Random(1)
    seqs = [["a", "b", "c"], ["a", "c", "b"], ["a", "b"], ["a", "b", "c"], ["a", None, "c"], ["a", "", "c"], ["b", "a", "c"]]
    seqs += [[rnd.choice("abcd") for _ in range(rnd.randint(1, 6))] for _ in range(200)]
    rows = [(f"k{n}", p + 1, "new" if n % 2 else None, s) for n, seq in enumerate(seqs) for p, s in enumerate(seq)]
    df = spark.createDataFrame(rows, "issue_key string, place long, source string, target string")
    got = {r["issue_key"]: r["fingerprint"] for r in fingerprints(df).collect()}
    told = {f"k{n}": ("new" if n % 2 else None, *seq) for n, seq in enumerate(seqs)}
    assert len(set(zip(got.values(), (told[k] for k in got)))) == len(set(got.values())) == len(set(told.values()))


def test_a_hot_history_is_added_up_in_parts(spark):
    """The fingerprint's plan holds no array of a history, and adds up before it shuffles."""
    df = spark.range(200_000).select(F.lit("hot").alias("issue_key"), (F.col("id") + 1).alias("place"),
                                     F.lit("new").alias("source"), (F.col("id") % 7).cast("string").alias("target"))
    out = fingerprints(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_sum" in plan
    assert out.first()["n_steps"] == 200_000


# -- variant -------------------------------------------------------------------------------------------------------

def test_members_missing_null_and_present(spark):
    rows = [('{"a": "x"}', "x"), ('{"a": null}', None), ("{}", ""), ('{"a": 5}', "5"), ('{"a": {"b": 1}}', '{"b":1}'),
            ('{"a": ', None), (None, None), ('[1]', ""), ('{"a": true}', "true")]
    df = spark.createDataFrame([(n, t) for n, (t, _) in enumerate(rows)], "n int, t string")
    got = df.select("n", text_or(document("t"), "$.a", F.lit("")).alias("v"), document("t").isNull().alias("bad")).orderBy("n").collect()
    for (text, want), r in zip(rows, got):
        assert r.bad == (text is None or text == '{"a": ')
        if not r.bad:
            assert r.v == want, text


def test_changelog_members_on_both_shapes(spark):
    with open(fixture_path("changelog.jsonl")) as f:
        lines = [x for x in f.read().splitlines() if x]
    df = spark.createDataFrame([(x,) for x in lines] + [('{"key": "A", "val',)], "json string")
    got = {(r["id"], r["field"], r["item_pos"]): r for r in changelog_members(df, "json").collect()}
    flat = {(r["id"], r["field"], r["item_pos"]): r for r in flatten_changelog(read_changelog_pages(spark, fixture_path("changelog.jsonl"))).collect()}
    assert set(got) == set(flat)
    items = {}
    for x in map(json.loads, lines):
        for h in (x.get("changelog", {}).get("histories") or x.get("values") or []):
            for p, it in enumerate(h.get("items") or []):
                items[h["id"], it.get("field", ""), p] = it
    for k, r in got.items():
        for c in ("issue_key", "created", "author_account_id", "author_display_name", "field_type"):
            assert r[c] == flat[k][c], (k, c)
        assert (r["from_value"], r["from_string"], r["to_value"], r["to_string"]) == tuple(
            items[k].get(m, "") for m in ("from", "fromString", "to", "toString"))


# -- SQL functions -------------------------------------------------------------------------------------------------

def _views(spark):
    tables.issues(spark).createOrReplaceTempView("jira_issues")
    tables.changelog(spark).createOrReplaceTempView("jira_changelog")
    sql_functions.register_functions(spark)


def test_functions_equal_their_frames(spark):
    prs, c = X.pull_requests(spark, SF), X.pull_request_commits(spark, SF)
    from issuelens.plans import issues as issue_q, pull_requests as pr_q
    commits, pr_commits = pr_q.commit_views(c)
    for name, df in {"jira_issues": X.issues(spark, SF), "jira_changelog": X.changelog(spark, SF), "pull_requests": prs,
                     "commits": commits, "pr_commits": pr_commits}.items():
        df.createOrReplaceTempView(name)
    sql_functions.register_functions(spark)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sql_functions.commits_of(spark, 7)) == rows(
        pr_q.commits_of_pull_request(prs, pr_commits, commits, 7).select("sha", "author_name", "message"))
    assert rows(sql_functions.updated_within(spark, 7, "2023-12-20 00:00:00")) == rows(
        issue_q.recent_issues(X.issues(spark, SF), 7, "2023-12-20 00:00:00"))
    one = timeline.single_issue_status(X.issues(spark, SF), X.changelog(spark, SF), "PROJ-7").first().asDict()
    asked = ["view", "click", "no such"]
    assert {(r["status"], r["first_seen"]) for r in sql_functions.status_times(spark, "PROJ-7", asked).collect()} == {
        (s, one[s]) for s in asked if one.get(s)}


def test_bound_values_are_never_sql(spark):
    _views(spark)
    hostile = "PROJ-1' OR '1'='1"
    assert sql_functions.status_times(spark, hostile, ["Done"]).collect() == []
    got = sql_functions.status_times(spark, "PROJ-1", ["Done", "Won't Do', 'Review"]).collect()
    assert {r["status"] for r in got} <= {"Done"}
    won = sql_functions.status_times(spark, "PROJ-2", ["Won't Do"]).collect()
    assert [r["status"] for r in won] == ["Won't Do"]
