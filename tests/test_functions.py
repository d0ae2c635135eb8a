import datetime as dt

from pyspark.sql import functions as F

from issuelens.functions import (
    as_of_lit, days_before, epoch_seconds_between, iso_z, minute_text, parse_iso_utc, parse_jira_ts,
    truncate_minute, try_parse_iso_utc)
from issuelens.functions.jsonpath import json_text


def test_timestamp_functions(spark):
    df = spark.createDataFrame([("2024-01-31T10:15:42.500+0200", "2024-01-31T10:15:42Z", "31/01/2024")],
                               "j string, z string, bad string")
    r = df.select(
        parse_jira_ts("j").alias("j"), parse_iso_utc("z").alias("z"), try_parse_iso_utc("bad").alias("bad"),
    ).first()
    assert r["j"] == dt.datetime(2024, 1, 31, 8, 15, 42, 500000)     # offset applied → UTC
    assert r["z"] == dt.datetime(2024, 1, 31, 10, 15, 42)
    assert r["bad"] is None
    t = spark.createDataFrame([(dt.datetime(2024, 1, 31, 10, 15, 42, 250000), dt.datetime(2024, 1, 30, 10, 15, 42))],
                              "a timestamp_ntz, b timestamp_ntz")
    r = t.select(iso_z("a").alias("iso"), minute_text("a").alias("m"), truncate_minute("a").alias("tm"),
                 epoch_seconds_between("a", "b").alias("secs"),
                 days_before(as_of_lit("2024-02-08 00:00:00"), 7).alias("week_ago")).first()
    assert r["iso"] == "2024-01-31T10:15:42Z" and r["m"] == "2024-01-31 10:15"
    assert r["tm"] == dt.datetime(2024, 1, 31, 10, 15)
    assert r["secs"] == 86400.25
    assert r["week_ago"] == dt.datetime(2024, 2, 1)


def test_json_text_nulls_and_nesting(spark):
    df = spark.createDataFrame([('{"a": {"b": "x"}, "n": null, "k": 69, "q": "say \\"hi\\""}',)], "j string")
    r = df.select(json_text("j", "$.a.b").alias("ab"), json_text("j", "$.n").alias("n"),
                  json_text("j", "$.missing").alias("m"), json_text("j", "$.k").alias("k"),
                  json_text("j", "$.q").alias("q")).first()
    assert (r["ab"], r["n"], r["m"], r["k"], r["q"]) == ("x", None, None, "69", 'say "hi"')
