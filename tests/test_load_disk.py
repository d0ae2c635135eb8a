"""Loads move and write each row as seldom as they can (``load_counters``, ``commit_ingest``)."""
import json
import os

import pytest
from pyspark.sql import functions as F

from issuelens.operators import stage, upsert as U
from issuelens.plans import catalog, proxies as X
from issuelens.session import settings_held
from issuelens.sources import tables
from issuelens.sources.tables import Warehouse
from issuelens.streaming import incremental as inc
from issuelens.streaming.ingest import ingest_issues, ingest_pull_requests
from tests.test_scale import _frame, _lineitem, _plan, _rows


@pytest.mark.parametrize("hot_rows", [5, 10**9])
@pytest.mark.parametrize("many", [1, 4])
def test_rows_are_reduced_where_a_layout_puts_them(spark, monkeypatch, hot_rows, many):
    monkeypatch.setattr(U, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(U, "MANY_COPIES", many)
    df = _frame(spark).withColumn("task", F.pmod(F.xxhash64("k"), F.lit(6)).cast("int"))
    keys = ["k", "part"]
    want = _rows(U.dedupe_last(df, keys, ["o", "v"]).select(*df.columns))
    for layout in (U.Layout("task", 6, numbered=True), U.Layout("task", 3)):
        got = U.dedupe_last(df, keys, ["o", "v"], U.count_copies(df, keys), layout=layout)
        assert _rows(got.select(*df.columns)) == want
        tasks = got.select("task", F.spark_partition_id().alias("p")).distinct().collect()
        assert len({r["task"] for r in tasks}) == len(tasks)


@pytest.mark.parametrize("rule", [{}, {"keep_cols": ["v"], "version_col": "o"}, {"on_conflict": "nothing"}])
def test_a_large_load_is_shuffled_once(spark, tmp_dir, monkeypatch, rule):
    schema = spark.createDataFrame([], "k string, part long, o long, v string").schema
    load = inc.Load("t", lambda rows: rows, ["k"], ["o", "v"], schema=schema, **rule)
    monkeypatch.setattr(inc, "TASK_BYTES", 2_000)  # several parts of a bucket
    plans, real = [], inc.merge
    monkeypatch.setattr(inc, "merge", lambda *a: plans.append(real(*a)) or plans[-1])
    hints, hint = [], type(spark.range(1)).hint
    out = []
    for large in (False, True):
        monkeypatch.setattr(inc, "is_large", lambda copies, large=large: large)
        store, counts = Warehouse(spark, f"{tmp_dir}/{large}", 5), []
        for n, rows in enumerate((_frame(spark, 400, 2), _frame(spark, 900, 2))):
            path = f"{tmp_dir}/staged-{large}-{n}"
            counts.append(inc.stage_load(store, load, rows, "s", n, path))
            staged = spark.read.parquet(path)
            assert tables.lie_by_bucket(staged) == large
            with monkeypatch.context() as m:
                m.setattr(type(staged), "hint", lambda df, *a: hints.append(large) or hint(df, *a))
                store.replace_buckets("t", staged)
        out.append((_rows(store.rows("t", schema)), counts))
    assert out[0] == out[1] and hints == [False, False]
    with settings_held(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(plans[-1])
    assert plan.count("Exchange") == 2 == plan.count("shufflepartitionidpassthrough")  # the batch, and the table or its keys
    files = staged.select(F.input_file_name().alias("f"), "bucket", F.spark_partition_id()).groupBy("f").agg(
        F.countDistinct("bucket").alias("n"), F.first("bucket").alias("b")).collect()
    assert all(r["n"] == 1 for r in files) and len(files) > len({r["b"] for r in files}) == 5


def test_pages_are_made_of_lineitem_by_one_shuffle(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(U, "MANY_COPIES", 10**6)
    sf = _lineitem(spark, tmp_dir, 3000)
    where = F.col("l_orderkey") % 3 != 0
    got = X.commits_by_page(spark, sf, where, 7)
    want = X.build_pull_request_commits(spark, sf).where(F.col("pull_request_id") % 3 != 0).withColumn(
        "page", F.call_function("div", "pull_request_id", F.lit(7)))
    assert _rows(got.select(*want.columns)) == _rows(want)
    pages = catalog._commit_pages(got)
    assert _plan(pages).count("Exchange") == 1
    assert sum(len(json.loads(r["value"])) for r in pages.collect()) == want.count()


def test_what_a_batch_writes_between_is_deleted(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(stage, "scratch_path", lambda s, name: f"{tmp_dir}/between/{name}-{len(os.listdir(f'{tmp_dir}/between'))}")
    for folder in ("between", "prs", "commits", "issues", "changelog"):
        os.makedirs(f"{tmp_dir}/{folder}")
    lines = {"commits": {"sha": "a", "pull_request_id": 1}, "issues": {"issues": [{"key": "A-1", "fields": {"a": 1}}]},
             "changelog": {"key": "A-1", "values": [{"id": "1", "created": "2024-01-01T00:00:00.000+0000", "items": [{"field": "status"}]}]}}
    for folder, line in lines.items():
        with open(f"{tmp_dir}/{folder}/p.json", "w") as f:
            f.write(json.dumps(line) + "\n")
    made, real = [], inc.materialize
    monkeypatch.setattr(inc, "materialize", lambda df, name, *a: made.append(name) or real(df, name, *a))
    ingest_pull_requests(spark, f"{tmp_dir}/prs", f"{tmp_dir}/commits", f"{tmp_dir}/wh", f"{tmp_dir}/ck", multi_line=False)
    store = ingest_issues(spark, f"{tmp_dir}/issues", f"{tmp_dir}/changelog", f"{tmp_dir}/wh", f"{tmp_dir}/ck",
                          as_of="2024-02-01 00:00:00", multi_line_issues=False)
    assert set(made) == {"pages", "batch", "batch-rows"} and os.listdir(f"{tmp_dir}/between") == []
    assert [store.read(t).count() for t in ("pull_request_commits", "jira_issues", "jira_changelog")] == [1, 1, 1]


def test_settings_hold_within_only(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), settings_held(spark, {key: "true", "issuelens.none": "1"}):
        assert spark.conf.get(key) == "true" and spark.conf.get("issuelens.none") == "1"
        raise ValueError
    assert spark.conf.get(key) == before and spark.conf.get("issuelens.none", None) is None
