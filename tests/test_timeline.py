import datetime as dt

import pytest
from pyspark.sql import functions as F

import tables
from issuelens.plans import timeline


def test_status_timeline_fixture(spark):
    out = timeline.status_timeline(tables.issues(spark), tables.changelog(spark))
    rows = {r["key"]: r.asDict() for r in out.collect()}
    # inner join: PROJ-3 (no history) and PROJ-99 (not loaded) are absent
    assert set(rows) == {"PROJ-1", "PROJ-2", "PROJ-4"}
    p1 = rows["PROJ-1"]
    assert p1["summary"] == 'Say "hello"'            # unescaped, no quotes left
    assert p1["assignee"] is None                      # JSON null → NULL
    assert p1["issue_type"] == "Bug" and p1["current_status"] == "Done"
    assert p1["In Progress_min"] == dt.datetime(2024, 1, 1, 9)
    assert p1["In Progress_max"] == dt.datetime(2024, 1, 5, 9)
    assert rows["PROJ-2"]["assignee"] == "Ann"
    # NULL status is not a column; columns interleave min/max in status order
    cols = [c for c in out.columns if c.endswith(("_min", "_max"))]
    assert cols == ["Done_min", "Done_max", "In Progress_min", "In Progress_max", "Review_min",
                    "Review_max", "Won't Do_min", "Won't Do_max"]


def test_first_last_seen_and_single_issue(spark):
    i, c = tables.issues(spark), tables.changelog(spark)
    first = {r["key"]: r for r in timeline.status_first_seen(i, c).collect()}
    last = {r["key"]: r for r in timeline.status_last_seen(i, c).collect()}
    assert first["PROJ-1"]["In Progress"] == dt.datetime(2024, 1, 1, 9)
    assert last["PROJ-1"]["In Progress"] == dt.datetime(2024, 1, 5, 9)
    one = timeline.single_issue_status(i, c, "PROJ-4").collect()
    assert len(one) == 1 and one[0]["Done"] == dt.datetime(2024, 1, 5, 8) and one[0]["Review"] is None


def test_status_values_sorted_nulls_last(spark):
    vals = timeline.status_values(tables.changelog(spark)).orderBy(F.col("status").asc_nulls_last())
    assert [r["status"] for r in vals.collect()] == ["Done", "In Progress", "Review", "Won't Do", None]


def test_no_statuses_gives_key_columns(spark):
    c = tables.changelog(spark).filter(F.lit(False))
    out = timeline.status_timeline(tables.issues(spark), c)
    assert out.columns == ["key", "summary", "current_status", "issue_type", "assignee"]
    assert out.count() == 0


def test_case_clash_rejected(spark):
    c = spark.createDataFrame([("1", "PROJ-1", dt.datetime(2024, 1, 1), "status", "a", "Done"),
                               ("2", "PROJ-1", dt.datetime(2024, 1, 2), "status", "Done", "done")],
                              "id string, issue_key string, created timestamp_ntz, field string, "
                              "from_string string, to_string string")
    with pytest.raises(ValueError):
        timeline.status_timeline(tables.issues(spark), c)


def test_explicit_statuses(spark):
    out = timeline.status_timeline(tables.issues(spark), tables.changelog(spark), statuses=["Done"])
    assert out.columns[-2:] == ["Done_min", "Done_max"]
