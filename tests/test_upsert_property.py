from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from issuelens.operators.upsert import upsert

SCHEMA = "k long, v string, first string"


def _model(batches, keep_first: bool):
    table = {}
    for b in batches:
        latest = {}
        for k, v in b:
            latest[k] = v                       # last row of a key in a batch wins
        for k, v in latest.items():
            if k in table:
                table[k] = (v, table[k][1] if keep_first else v)
            else:
                table[k] = (v, v)
    return sorted((k, v, f) for k, (v, f) in table.items())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", "c", None])),
                         max_size=12), min_size=1, max_size=4),
       st.booleans())
def test_batches_equal_model(spark, batches, keep_first):
    keep = ["first"] if keep_first else []
    table = spark.createDataFrame([], SCHEMA)
    for b in batches:
        rows = [(k, v, v, i) for i, (k, v) in enumerate(b)]
        src = spark.createDataFrame(rows, SCHEMA + ", pos long")
        table = upsert(table, src, ["k"], keep_cols=keep, order=["pos"], latest=True)
    got = sorted(tuple(r) for r in table.collect())
    assert got == _model(batches, keep_first)
    # one batch holding all rows, versioned by (batch, position), gives the same table
    # when no column is kept (later versions win everywhere)
    if not keep_first:
        rows = [(k, v, v, bi, i) for bi, b in enumerate(batches) for i, (k, v) in enumerate(b)]
        src = spark.createDataFrame(rows, SCHEMA + ", batch long, pos long") if rows else None
        if src is not None:
            one = upsert(spark.createDataFrame([], SCHEMA), src, ["k"], order=["batch", "pos"], latest=True)
            assert sorted(tuple(r) for r in one.collect()) == got
