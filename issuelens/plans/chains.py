"""Status chains (Q3): collapse immediate repeats, label each issue's chain,
number the distinct chains in order of first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.operators.sequence import global_rank, resolve_strategy, sequence_rows
from issuelens.operators.stage import materialize
from issuelens.plans.transitions import status_history, status_transitions


def collapse_repeats(transitions: DataFrame, keep_pid: bool = False,
                     strategy: str = "auto") -> DataFrame:
    """WIN-4: keep a transition when it is the issue's first or its target
    differs from the previous transition's target (the same as comparing with
    the last kept target, since a dropped row repeats that target)."""
    seq = sequence_rows(transitions.select("issue_key", "step", "source", "target"),
                        ["issue_key"], ["step"], lag_cols=["target"], step_col="_k",
                        keep_pid=keep_pid, strategy=strategy)
    kept = seq.filter((F.col("_k") == 1) | ~F.col("target").eqNullSafe(F.col("prev_target")))
    return kept.drop("_k", "prev_target")


def _ordered_join(items, order_field: str, text_field: str):
    return F.array_join(F.transform(F.array_sort(items), lambda x: x[text_field]), " > ")


def chain_labels(kept: DataFrame) -> DataFrame:
    """AGG-8: ``first source > target > target …`` in step order, one row per issue,
    with a 128-bit ``digest`` that stands for the chain.

    After a range split (``_pid`` present) two levels: parts per (range
    partition, issue), then the parts of an issue.  The label is one value, so
    the task that makes it holds all of it; the first level has by then reduced
    the rows to text.  Otherwise no issue is hot, and it is one aggregate.
    """
    if "_pid" not in kept.columns:
        labels = kept.groupBy("issue_key").agg(
            F.min_by("source", "step").alias("first_source"),
            _ordered_join(F.collect_list(F.struct("step", "target")), "step", "target").alias("targets"))
    else:
        parts = kept.groupBy("_pid", "issue_key").agg(
            F.min("step").alias("first_step"),
            F.min_by("source", "step").alias("first_source"),
            _ordered_join(F.collect_list(F.struct("step", "target")), "step", "target").alias("part"))
        labels = parts.groupBy("issue_key").agg(
            F.min_by("first_source", "first_step").alias("first_source"),
            _ordered_join(F.collect_list(F.struct("first_step", "part")), "first_step", "part")
            .alias("targets"))
    chain = F.concat_ws(" > ", "first_source", "targets")
    return labels.select("issue_key", chain.alias("chain"), F.md5(chain).alias("digest"))


def chain_ids(labels: DataFrame, strategy: str = "auto") -> DataFrame:
    """AGG-9: (issue_key, chain_id): 1, 2, 3 … per distinct chain, in the order chains
    first appear when issues are visited by ascending key — i.e. ordered by the
    smallest issue key carrying the chain.  Chains are told apart by their
    digest, and only (digest, smallest key) is ranked; no label is shuffled."""
    firsts = labels.groupBy("digest").agg(F.min("issue_key").alias("k0"))
    ranks = global_rank(firsts, ["k0"], name="chain_id", strategy=strategy).select("digest", "chain_id")
    return labels.select("issue_key", "digest").join(ranks, "digest").select("issue_key", "chain_id")


def status_chains(issues: DataFrame, changelog: DataFrame, lookup: DataFrame,
                  strategy: str = "auto", lookup_how: str = "inner") -> DataFrame:
    """Q3: Q2's rows plus ``chain`` and ``chain_id`` of the issue (JN-8).
    ``lookup_how="left"`` keeps transitions missing from the lookup (with NULL
    classification) instead of dropping them before the chains are built."""
    # Chains group the same issues over a subset of their history rows, so the
    # plan chosen for the history holds for every per-issue step below.
    strategy = resolve_strategy(status_history(changelog), ["issue_key"], strategy)
    tr = materialize(status_transitions(issues, changelog, lookup, strategy=strategy,
                                        lookup_how=lookup_how), "transitions")
    kept = collapse_repeats(tr, keep_pid=True, strategy=strategy)
    labels = materialize(chain_labels(kept), "chain-labels")
    per_issue = labels.select("issue_key", "chain").join(chain_ids(labels), "issue_key")
    if strategy == "ranged":
        # Written, so that the join below is between plain scans and a hot issue can be split.
        per_issue = materialize(per_issue, "chains")
    return tr.join(per_issue, "issue_key", "inner")
