"""Plans of loads whose rows outgrow a task: what is shuffled, sorted and written."""

import os

import pytest
from pyspark.sql import functions as F

from issuelens import schemas
from issuelens.operators import upsert as U
from issuelens.operators.bulk import merge_bucketed, write_bucketed
from issuelens.plans import catalog, proxies as X, pull_requests as pr_q
from issuelens.sources.tables import Warehouse
from issuelens.streaming import incremental as inc

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


def _rows(df):
    return sorted(map(repr, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lineitem(spark, folder, n=400, nulls=True):
    i = F.col("id")
    null = lambda c, m: F.when((i % m != 0) | F.lit(not nulls), c)
    at = F.timestamp_add("DAY", (i % 3000).cast("int"), F.lit("1992-01-01").cast("timestamp_ntz"))
    rows = spark.range(n).select(
        null(i % 40, 11).alias("l_orderkey"), null(i % 7, 13).alias("l_partkey"), (i % 5).alias("l_suppkey"),
        null(i % 4, 17).cast("int").alias("l_linenumber"), (i % 9).cast("double").alias("l_quantity"),
        null(i * 1.5, 19).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.when(i % 2 == 0, "R").otherwise("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), at.alias("l_shipdate"))
    rows.union(rows.limit(50)).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def _frame(spark, n=3000, copies=2):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n * copies).select(
        F.when(hot, F.lit("hot")).otherwise((i % n).cast("string")).alias("k"), (i % 7).alias("part"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("o"), i.cast("string").alias("v"))


@pytest.mark.parametrize("hot_rows", [5, 10**9])
@pytest.mark.parametrize("largest", [False, True])
def test_dedupe_by_copies_is_the_same(spark, monkeypatch, hot_rows, largest):
    monkeypatch.setattr(U, "HOT_ROWS", hot_rows)
    df = _frame(spark).withColumn("k", F.when(F.col("k") != "5", F.col("k")))
    copies = U.count_copies(df, ["k", "part"])
    assert copies.few and copies.rows == 6000 and bool(copies.hot) == (hot_rows == 5)
    pick = U.dedupe_last if largest else U.dedupe_first
    want = _rows(pick(df, ["k", "part"], ["o", "v"]))
    assert _rows(pick(df, ["k", "part"], ["o", "v"], copies)) == want
    assert _rows(pick(df, ["k", "part"], ["o", "v"], copies, 3)) == want


def test_rows_of_few_copies_are_not_sorted_before_the_shuffle(spark):
    df = _frame(spark)
    plan = _plan(U.dedupe_first(df, ["k", "part"], ["o", "v"], U.count_copies(df, ["k", "part"])))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "Sort" not in below and plan.count("Exchange") == 1


def test_keys_with_many_copies_are_aggregated_first(spark):
    df = _frame(spark, n=20, copies=200)
    copies = U.count_copies(df, ["part"])
    assert not copies.few
    plan = _plan(U.dedupe_first(df, ["part"], ["o", "v"], copies))
    assert "SortAggregate" in plan[plan.index("Exchange hashpartitioning"):]


def test_commits_are_reduced_as_lineitem_rows(spark, tmp_dir):
    sf = _lineitem(spark, tmp_dir)
    got = X.build_pull_request_commits(spark, sf)
    keys = schemas.KEYS["pull_request_commits"]
    want = U.dedupe_first(X.commits_landed(spark, sf), keys, X.COMMIT_ORDER_COLS).drop(*X.COMMIT_ORDER_COLS)
    assert _rows(got.select(*want.columns)) == _rows(want)
    plan = _plan(got)
    assert "@example.org" not in plan[plan.index("Exchange hashpartitioning"):]


def test_a_large_batch_meets_the_table_where_it_was_reduced(spark):
    target, batch = _frame(spark, 500, 1).dropDuplicates(["k"]), _frame(spark)
    for rule in ({}, {"on_conflict": "nothing"}):
        out = U.upsert(target, batch, ["k"], order=["o", "v"], broadcast_batch_rows=10, **rule)
        assert _rows(out) == _rows(U.upsert(target, batch, ["k"], order=["o", "v"], **rule))
        assert "upsert-batch" not in _plan(out)


@pytest.mark.parametrize("rows", [10, 10**6])
def test_upsert_of_commits_shuffles_the_batch_as_lineitem_rows(spark, tmp_dir, monkeypatch, rows):
    li = spark.read.parquet(f"{_lineitem(spark, tmp_dir + '/one', 3000)}/lineitem.parquet")
    new = F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp_ntz")
    sf = tmp_dir + "/two"
    li.withColumn("l_orderkey", F.col("l_orderkey") + F.when(new, 20).otherwise(0)).write.parquet(f"{sf}/lineitem.parquet")
    monkeypatch.setattr(U.upsert, "__kwdefaults__", {**U.upsert.__kwdefaults__, "broadcast_batch_rows": rows})
    before, since = F.col("l_shipdate") < F.lit("1998-01-01"), F.col("l_shipdate") >= F.lit("1997-01-01")
    target = X.build_pull_request_commits(spark, sf, before)
    landed = X.commits_landed(spark, sf, since)
    for query, rule in ((catalog.q_upsert_update, {}), (catalog.q_upsert_do_nothing, {"on_conflict": "nothing"}),
                        (catalog.q_upsert_keep_columns, {"keep_cols": ["author_name", "author_date"]})):
        want = U.upsert(target, landed, schemas.KEYS["pull_request_commits"], order=X.COMMIT_ORDER_COLS, **rule)
        got = query(spark, sf)
        assert got.schema.names == want.schema.names and _rows(got) == _rows(want)
        assert got.count() > target.count()
        if rows == 10:
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            plan = plan[plan.index("Aggregate ["):]
            assert "@example.org" not in plan and "commit/" not in plan


def test_bulk_merge_shuffles_the_batch_once(spark):
    i = F.col("id")
    target = spark.range(300).select(i.alias("k"), F.lit("t").alias("v"))
    batch = spark.range(100, 600).select(i.alias("k"), F.lit("b").alias("v"))
    write_bucketed(target, "scale_bulk", ["k"], 4)
    merged = merge_bucketed(spark, "scale_bulk", batch, ["v"])
    assert _plan(merged).count("Exchange") == 1
    out = write_bucketed(merged, "scale_bulk_merged", ["k"], 4, laid_out=True)
    assert out.count() == 600 and out.where("v = 'b'").count() == 500
    assert len(out.inputFiles()) == 4


def test_one_pull_request_is_found_by_scans(spark):
    prs = spark.range(50).select("id", F.col("id").cast("int").alias("number"))
    commits = spark.range(400).select(
        F.concat(F.lit("s"), (F.col("id") % 90).cast("string")).alias("sha"), (F.col("id") % 50).alias("pull_request_id"),
        (F.col("id") % 50).cast("int").alias("pull_request_number"), F.col("id").cast("string").alias("message"))
    names = []
    real = pr_q.materialize
    try:
        pr_q.materialize = lambda df, name: names.append(name) or real(df, name)
        got = pr_q.commits_of_pull_request_from_table(prs, commits, 7)
    finally:
        pr_q.materialize = real
    assert names == ["pr-ids", "pr-shas"]
    assert sorted({r["sha"] for r in got.collect()}) == sorted({f"s{i % 90}" for i in range(400) if i % 50 == 7})


def test_a_large_load_is_not_written_between(spark, tmp_dir, monkeypatch):
    schema = "k string, part long, o long, v string"
    load = inc.Load("t", lambda rows: rows, ["k"], ["o", "v"], schema=spark.createDataFrame([], schema).schema)
    first, second = _frame(spark, 400, 2), _frame(spark, 900, 2)
    tables, names = [], []
    real = inc.materialize
    monkeypatch.setattr(inc, "materialize", lambda df, name, *a: names.append(name) or real(df, name, *a))
    for large in (False, True):
        monkeypatch.setattr(inc, "is_large", lambda copies, large=large: large)
        store, counts = Warehouse(spark, f"{tmp_dir}/{large}"), []
        for n, rows in enumerate((first, second)):
            path = f"{tmp_dir}/staged-{large}-{n}"
            counts.append(inc.stage_load(store, load, rows, "s", n, path))
            store.replace_buckets("t", spark.read.parquet(path))
        tables.append((_rows(store.read("t", load.schema)), counts))
    assert tables[0] == tables[1]
    assert names == ["batch-rows", "batch-rows"]


def test_profiles_parse_the_commits_once(spark, tmp_dir, monkeypatch):
    sf, names = _lineitem(spark, tmp_dir), []
    real = catalog.materialize
    monkeypatch.setattr(catalog, "materialize", lambda df, name, *a: names.append(name) or real(df, name, *a))
    out = catalog.q_load_profiles(spark, sf)
    assert names == ["profiled", "profiles", "key-counts"]
    assert "from_json" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_landed_texts_are_compressed(spark, tmp_dir, monkeypatch):
    sf = _lineitem(spark, tmp_dir, nulls=False)
    monkeypatch.setattr(catalog, "scratch_path", lambda s, name: f"{tmp_dir}/{name}")
    store = catalog._commit_store(spark, sf)
    landed = [f for f in os.listdir(f"{tmp_dir}/commit-ingest/commits") if f.startswith("part")]
    assert landed and all(f.endswith(".gz") for f in landed)
    assert store.read("pull_request_commits").count() == X.pull_request_commits(spark, sf).count() > 0
