from pyspark.sql import functions as F

import tables
from conftest import fixture_path
from issuelens.functions.timefmt import try_parse_iso_utc
from issuelens.operators import quality
from issuelens.operators.filters import status_changes
from issuelens.sources.landed import read_commit_pages, read_pull_request_pages


def test_key_duplicates_and_orphans(spark):
    raw = read_commit_pages(spark, fixture_path("commits.jsonl"), multi_line=False)
    dups = {(r["sha"], r["pull_request_id"], r["n"]) for r in quality.key_duplicates(raw, ["sha", "pull_request_id"]).collect()}
    assert dups == {("aaa", 1001, 2)}
    prs = read_pull_request_pages(spark, fixture_path("pull_requests_page.json"))
    orph = quality.orphans(raw, prs, "pull_request_id", "id").collect()
    assert [r["sha"] for r in orph] == ["ddd"]


def test_unparsable_dates(spark):
    raw = read_commit_pages(spark, fixture_path("commits.jsonl"), multi_line=False) \
        .select("sha", F.col("commit.author.date").alias("d"))
    bad = quality.unparsable(raw, "d", try_parse_iso_utc("d")).collect()
    assert [(r["sha"], r["d"]) for r in bad] == [("ccc", "03/01/2024")]


def test_lookup_gaps(spark):
    hist = status_changes(tables.changelog(spark))
    gaps = {(r["source"], r["target"], r["n"]) for r in
            quality.lookup_gaps(hist, tables.lookup(spark), "from_string", "to_string").collect()}
    assert ("In Progress", "Won't Do", 1) in gaps and ("Open", "Done", 1) not in gaps


def _profiled(spark, rows):
    df = spark.createDataFrame(rows, "load string, a string, b long, text string")
    bad = F.col("text").isNotNull() & try_parse_iso_utc("text").isNull()
    return df, quality.profile(df, ["a", "b"], {"n_bad": bad}, ["load"])


def test_profiles_of_loads_add_up(spark):
    day = "2024-01-01T00:00:00Z"
    rows = [("x", f"k{i}", i % 3, day if i % 4 else "1/2/2024") for i in range(200)]
    rows += [("y", f"k{i}", i % 3, None) for i in range(100, 260)] + [("y", None, 1, "no date"), ("y", "k1", None, day)]
    df, each = _profiled(spark, rows)
    got = {r["load"]: (r["n_rows"], r["n_null_keys"], r["n_bad"]) for r in each.collect()}
    assert got == {"x": (200, 0, 50), "y": (162, 2, 1)}
    both = quality.merge_profiles(each).withColumn("near", F.hll_sketch_estimate("keys")).first()
    assert (both["n_rows"], both["n_null_keys"], both["n_bad"]) == (362, 2, 51)
    # Keys that both loads hold count once: the sketches are united, not added.
    assert abs(both["near"] - 260) <= 5
    assert quality.key_counts(df, ["a", "b"]).first().asDict() == {"n_keys": 260, "n_repeated": 100}


def test_profile_of_hot_key_and_of_nothing(spark):
    df, each = _profiled(spark, [("x", "hot", 1, None)] * 500 + [("x", "other", 1, None)])
    row = each.withColumn("near", F.hll_sketch_estimate("keys")).first()
    assert (row["n_rows"], row["near"]) == (501, 2)
    assert quality.key_counts(df, ["a", "b"]).first().asDict() == {"n_keys": 2, "n_repeated": 1}
    none = df.where("a = 'nobody'")
    empty = quality.profile(none, ["a", "b"], {}).withColumn("near", F.hll_sketch_estimate("keys")).first()
    assert (empty["n_rows"], empty["n_null_keys"], empty["near"]) == (0, 0, 0)
    assert quality.key_counts(none, ["a", "b"]).first().asDict() == {"n_keys": 0, "n_repeated": 0}
    nulls = quality.profile(df.withColumn("a", F.lit(None).cast("string")), ["a", "b"], {}).first()
    assert nulls["n_null_keys"] == 501


def test_profile_is_one_scan(spark, tmp_path):
    df, _ = _profiled(spark, [("x", "k", 1, None)])
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = quality.profile(stored, ["a", "b"], {"n_none": F.col("text").isNull()}, ["load"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
