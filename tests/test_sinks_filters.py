import csv
import datetime as dt
import glob

from pyspark.sql import functions as F

import tables
from issuelens.functions import issue_key_in, join_chain, strip_quotes
from issuelens.operators import filters
from issuelens.operators.normalize import strip_json_quotes
from issuelens.plans import issues as issue_q
from issuelens.sources.sinks import with_counters, write_csv


def test_write_csv_sorted_with_header(spark, tmp_dir):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "k string, v long")
    write_csv(df.repartition(1), f"{tmp_dir}/out", order_by=["k"])
    files = glob.glob(f"{tmp_dir}/out/part-*.csv")
    rows = [r for f in files for r in csv.reader(open(f))]
    assert rows[0] == ["k", "v"] and rows[1:] == [["a", "1"], ["b", "2"]]


def test_counters(spark, tmp_dir):
    df, obs = with_counters(spark.range(42), "rows_written")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 42


def test_filters(spark):
    iss = tables.issues(spark)
    assert [r["key"] for r in filters.for_project(iss, "OTHER").collect()] == ["PROJ-4"]
    assert filters.one_issue(iss, "PROJ-2").count() == 1
    recent = issue_q.recent_issues(iss, 2, "2024-01-12 12:00:00").collect()
    assert sorted(r["key"] for r in recent) == ["PROJ-2", "PROJ-4"]
    wm = issue_q.issue_watermark(iss).first()
    assert wm["watermark"] == dt.datetime(2024, 1, 12, 8) and wm["watermark_text"] == "2024-01-12 08:00"
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0, 30)), (2, dt.datetime(2024, 1, 1, 10, 1))],
                               "k long, updated timestamp_ntz")
    assert filters.since_minute(df, "2024-01-01 10:00:59").count() == 2
    assert filters.newer_than(df, "2024-01-01 10:00:30", "updated").count() == 1


def test_first_per_group(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o long, v string")
    got = sorted(tuple(r) for r in filters.first_per_group(df, ["k"], ["o"]).collect())
    assert got == [("a", 1, "y"), ("b", 5, "z")]


def test_scalar_functions(spark):
    df = spark.createDataFrame([('"quoted"', "fix proj-12 and PROJ-3")], "a string, t string")
    r = df.select(strip_quotes("a").alias("a"), issue_key_in("t", "PROJ").alias("k"),
                  issue_key_in("t", "PROJ", upper=True).alias("u"),
                  join_chain([F.lit("A"), F.lit("B")]).alias("c")).first()
    assert (r["a"], r["k"], r["u"], r["c"]) == ("quoted", "proj-12", "PROJ-12", "A > B")
    assert strip_json_quotes(df).first()["a"] == "quoted"


def test_cluster_settings():
    from issuelens.session import cluster_settings
    conf = cluster_settings(100 * 10**12)
    assert int(conf["spark.sql.shuffle.partitions"]) > 700_000
    assert cluster_settings(10)["spark.sql.shuffle.partitions"] == "200"
