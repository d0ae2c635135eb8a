"""Plan shape: pushdown, pruning, no Python evaluation, shuffle counts."""

import __spark_entry__ as E
from issuelens.plans import proxies as X
from issuelens.plans import timeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_registered_queries(spark):
    qs = E.queries()
    for name, fn in qs.items():
        p = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "PythonUDF" not in p and "MapInPandas" not in p, name


def test_status_filter_and_columns_reach_scan(spark):
    ch = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "CAST(event_id AS STRING) AS id", "CAST(user_id AS STRING) AS issue_key", "ts AS created",
        "'status' AS field", "event_type AS to_string")
    df = timeline.status_rows(ch.filter("to_string = 'view'"))
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in p \
        or "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_timeline_pivot_is_one_aggregate_shuffle(spark):
    ch = X.changelog(spark, SF)
    rows = timeline.status_rows(ch)
    piv = rows.groupBy("issue_key").pivot("status", ["click", "view"]).agg(F.min("created"))
    p = piv._jdf.queryExecution().executedPlan().toString()
    # the pivot itself adds exactly one hash exchange on the issue key
    assert p.count("Exchange hashpartitioning(issue_key") == 1


def test_changelog_status_filter_prunes_partitions(spark, tmp_dir):
    from issuelens.sources.tables import Warehouse
    import tables
    from issuelens import schemas
    store = Warehouse(spark, tmp_dir)
    store.write("jira_changelog", tables.changelog(spark).select(*schemas.JIRA_CHANGELOG.names))
    back = store.read("jira_changelog")
    assert back.columns == schemas.JIRA_CHANGELOG.names
    p = _plan(timeline.status_rows(back))
    assert "PartitionFilters: [(coalesce(field" in p
    p = _plan(timeline.status_rows(X.changelog(spark, SF)))
    assert "PartitionFilters: [isnotnull(field" in p
