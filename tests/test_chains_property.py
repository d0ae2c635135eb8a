import datetime as dt

from hypothesis import given, settings, strategies as st

import model
from issuelens.plans import chains

STATUSES = ["A", "B", "C"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from(STATUSES), st.sampled_from(STATUSES)),
                min_size=1, max_size=60))
def test_chain_labels_and_ids_equal_loop(spark, raw):
    rows, steps = [], {}
    for k, s, t in raw:
        steps[k] = steps.get(k, 0) + 1
        rows.append(dict(issue_key=f"K-{k}", step=steps[k], source=s, target=t))
    df = spark.createDataFrame([(r["issue_key"], r["step"], r["source"], r["target"]) for r in rows],
                               "issue_key string, step long, source string, target string")
    kept = chains.collapse_repeats(df, keep_pid=True)
    labels = chains.chain_labels(kept)
    ids = chains.chain_ids(labels)
    got = {r["issue_key"]: (r["chain"], r["chain_id"]) for r in labels.join(ids, "issue_key").collect()}
    assert got == model.chains(rows)


def test_hot_issue_chain(spark):
    # one issue holds most rows and spans several range partitions
    rows = [("K-0", i + 1, "A", "A" if i % 5 else "B") for i in range(400)] + [("K-1", 1, "A", "B")]
    df = spark.createDataFrame(rows, "issue_key string, step long, source string, target string")
    kept = chains.collapse_repeats(df, keep_pid=True, strategy="ranged")
    labels = {r["issue_key"]: r["chain"] for r in chains.chain_labels(kept).collect()}
    want = model.chains([dict(issue_key=k, step=s, source=a, target=b) for k, s, a, b in rows])
    assert labels == {k: v[0] for k, v in want.items()}
