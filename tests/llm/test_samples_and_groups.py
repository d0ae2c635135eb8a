"""Samples that do not depend on the order of rows, and groups that meet in no one task."""

import random

import numpy as np
from pyspark.sql import functions as F

from issuelens.llm import cotraining as C
from issuelens.llm import language_id as L
from issuelens.llm import quality_rules as Q
from issuelens.llm.common import split_by_keys, text_bytes
import pyarrow as pa

DOCS = "doc_id long, text string, lang string, source string"


def labelled_rows(seed=3, n=240):
    """Rows whose label shows in text and source; a third share their id with another text."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.5
        words = ["alpha", "beta", "gamma", "delta"] if good else ["xx!!", "zz??", "qq##", "vv$$"]
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 40)))
        rows.append((i, text, "en", "clean" if good else "spam"))
        if i % 3 == 0:
            rows.append((i, text[::-1] if i % 2 else None, None if i % 2 else "en", None))
        if i % 2 == 0:
            labels.append((i, int(good)))
    labels += [(0, 0), (0, 1), (2, 1), (2, 7), (10 ** 6, 1), (None, 1)]
    return rows + [(None, "no id", "en", "clean"), rows[5]], labels


def test_classifier_is_the_same_in_any_order(spark):
    rows, labels = labelled_rows()
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    results = []
    for order, parts in ((rows, 3), (rows[::-1], 5), (random.Random(1).sample(rows, len(rows)), 1)):
        df = spark.createDataFrame(order, DOCS).repartition(parts)
        results.append(sorted(map(tuple, C.classify(df, lab).collect()), key=str))
        assert len(results[-1]) == len(rows)
    assert results[0] == results[1] == results[2]


def test_classifier_equals_numpy(spark):
    """The sample by hand (all ids, one row and one label each), trained and scored without Spark."""
    rows, labels = labelled_rows(4)
    df = spark.createDataFrame(rows, DOCS)
    marks = C._marked(C._prepared(df)).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min_by(F.struct("text", "lang", "source", "size"), "mark").alias("r"))
    one = {}
    for i, v in labels:
        if i is not None and v in (0, 1):
            one[i] = min(v, one.get(i, v))
    order = marks.orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    raw, at = text_bytes(pa.array([r["r"]["text"] for r in order], pa.string()))
    view = lambda c: [r["r"][c] for r in order]
    model = C.co_train(C.content_features(raw, at), C.metadata_features(view("lang"), view("source"), view("size")),
                       np.array([one.get(r["doc_id"], -1) for r in order]))
    got = C.classify(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    raw, at = text_bytes(pa.array([r[1] for r in rows], pa.string()))
    want = model.score(C.content_features(raw, at), C.metadata_features([r[2] for r in rows], [r[3] for r in rows], [len(r[1] or "") for r in rows]))
    key = lambda r: (str(r[0]), *map(float, r[1:4]))
    assert np.allclose(np.array([key(r)[1:] for r in sorted(got, key=key)]),
                       np.array([key(r)[1:] for r in sorted(zip([r[0] for r in rows], *want), key=key)]), atol=1e-9)


def test_thousands_of_languages(spark):
    """Learned are those with most rows; a hot one does not crowd the others out."""
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("l"), (F.col("id") % 5000).cast("string"))).alias("lang"),
        F.concat(F.lit("text of "), F.col("id").cast("string")).alias("text"))
    model = L.learn(rows, "text", "lang", "doc_id", rows_per_language=5, excerpt_bytes=20, languages=50)
    assert len(model.langs) == 50 and "hot" in model.langs
    again = L.learn(rows.repartition(7), "text", "lang", "doc_id", rows_per_language=5, excerpt_bytes=20, languages=50)
    assert again.langs == model.langs and all((a == b).all() for a, b in zip(again.steps, model.steps))


def test_language_sample_is_what_its_parameters_say(spark):
    rows = [(i, "abcdefghij" * 30, "en") for i in range(40)] + [(i + 100, "xyz", "fr") for i in range(3)]
    df = spark.createDataFrame([(i, t + str(i), l) for i, t, l in rows], "doc_id long, text string, lang string")
    model = L.learn(df, "text", "lang", "doc_id", rows_per_language=10, excerpt_bytes=50)
    states = {k: len(t) // model.n_classes for k, t in zip(model.langs, model.steps)}
    assert model.langs == ["en", "fr"] and 10 * 50 <= states["en"] <= 2 * 10 * 51 + 2 and states["fr"] < 40


def _statistics_rows(spark, n=900):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    rows = [(i, " ".join(word() + ("##" if i % 50 == 0 else "") for _ in range(40)), "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_quality_groups_are_never_dealt_by_group_alone(spark, monkeypatch):
    """Broadcast where the count allows, else salted: the same verdicts, and no exchange of
    rows by the group alone."""
    import re
    df = _statistics_rows(spark)
    plans, real = [], Q.materialize

    def seen(frame, name):
        plans.append((name, frame._jdf.queryExecution().executedPlan().toString()))
        return real(frame, name)
    monkeypatch.setattr(Q, "materialize", seen)
    few = sorted(map(tuple, Q.score_rows(df).collect()))
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = sorted(map(tuple, Q.score_rows(df).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == many and {r[-1] for r in few} == {True, False}
    for name, plan in plans:
        for line in plan.split("\n"):
            if re.search(r"hashpartitioning\(g#\d+, \d+\)", line):
                below = plan[plan.index(line) + len(line):].lstrip("\n").split("\n")[0]
                assert "HashAggregate" in below or "Window" in below, (name, below)  # partial sums only


def test_split_by_keys(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    keys = rows.where("id % 11 = 0").select("h")
    others, perhaps = split_by_keys(rows, keys, "h")
    assert others.columns == perhaps.columns == ["id", "h"]
    a, b = {r.id for r in others.collect()}, {r.id for r in perhaps.collect()}
    assert a | b == set(range(5000)) and not a & b and {i for i in range(5000) if i % 11 == 0} <= b and len(b) < 600
    assert split_by_keys(rows, keys.limit(0), "h")[1].count() == 0


def test_quality_verdicts_do_not_depend_on_partitions(spark):
    df = _statistics_rows(spark, 300)
    assert sorted(map(tuple, Q.score_rows(df.repartition(7)).collect())) == sorted(map(tuple, Q.score_rows(df).collect()))
