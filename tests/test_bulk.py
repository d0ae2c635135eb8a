"""Merges into bucketed tables."""

import random

import pytest

from issuelens.operators.bulk import bucket_spec, merge_bucketed, write_bucketed
from issuelens.operators.upsert import upsert


def _frame(spark, seed, n):
    rnd = random.Random(seed)
    rows = {(rnd.randrange(60), rnd.choice("ab")): rnd.randrange(9) for _ in range(n)}
    return spark.createDataFrame([(*k, v, f"t{seed}") for k, v in rows.items()], "id long, part string, version long, note string")


@pytest.mark.parametrize("rule", [{}, {"keep_cols": ["note"]}, {"version_col": "version"}, {"on_conflict": "nothing"}])
def test_equals_upsert(spark, rule):
    keys = ["id", "part"]
    target, batch = _frame(spark, 1, 80), _frame(spark, 2, 80).union(_frame(spark, 3, 40))
    write_bucketed(target, "bulk_target", keys, 4)
    got = merge_bucketed(spark, "bulk_target", batch, ["version", "note"], **rule)
    want = upsert(target, batch, keys, order=["version", "note"], latest=True, **rule)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert bucket_spec(spark, "bulk_target") == (keys, 4)


def test_only_the_batch_is_shuffled(spark):
    target, batch = _frame(spark, 1, 80), _frame(spark, 2, 80)
    write_bucketed(target, "bulk_plan", ["id", "part"], 4)
    merged = merge_bucketed(spark, "bulk_plan", batch, ["version", "note"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):]
    table = join.index("Bucketed: true")
    assert "Exchange" not in join[:table]  # from the join down to the table's scan
    assert plan.count("Exchange hashpartitioning") <= 2  # the batch: one row per key, then the table's layout
