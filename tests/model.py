"""Plain-Python statement of the query semantics, used as a brute-force check
on small fixtures (no Spark)."""

from __future__ import annotations

import datetime as dt
import itertools
from collections import defaultdict


def _num(x):
    try:
        return (0, int(x))
    except (TypeError, ValueError):
        return (1, 0)


def steps(history):
    """history: dicts with issue_key, id, created, from_string, to_string.
    Returns {issue_key: [rows sorted, with step]}."""
    by = defaultdict(list)
    for r in history:
        by[r["issue_key"]].append(r)
    out = {}
    for k, rows in by.items():
        rows = sorted(rows, key=lambda r: (r["created"] is None, r["created"] or dt.datetime.min,
                                           _num(r["id"]), r["id"]))
        out[k] = [dict(r, step=i + 1) for i, r in enumerate(rows)]
    return out


def transitions(issues, history, lookup):
    """issues: {key: {created, issue_type, current_status}}; lookup: list of
    (source, target, classification, type).  Each issue's history starts with a
    creation row (step 0); a row's previous time is that of the row before it."""
    classes = defaultdict(list)
    for s, t, c, ty in lookup:
        classes[s, t].append((c, ty))
    rows = []
    for k, seq in steps(history).items():
        if k not in issues:
            continue
        info = issues[k]
        full = [dict(step=0, created=info["created"])] + seq
        last = max(r["step"] for r in full)
        for before, r in zip(full, seq):
            known = before["created"] is not None and r["created"] is not None
            for c, ty in classes[r["from_string"], r["to_string"]]:
                rows.append(dict(
                    issue_key=k, step=r["step"], source=r["from_string"], target=r["to_string"],
                    previous_timestamp=before["created"], transition_timestamp=r["created"],
                    duration_seconds=(r["created"] - before["created"]).total_seconds() if known else None,
                    chain_length=last + 1, issue_type=info["issue_type"],
                    current_status=info["current_status"], classification=c, type=ty))
    return rows


def _label(rows):
    """First source, then the target of each run of equal targets."""
    rows = sorted(rows, key=lambda r: r["step"])
    runs = [target for target, _ in itertools.groupby(r["target"] for r in rows)]
    return " > ".join([rows[0]["source"], *runs])


def chains(transition_rows):
    """{issue_key: (chain, chain_id)}: all labels first, then each distinct label
    is numbered by the rank of the smallest issue key that has it."""
    issues = {r["issue_key"] for r in transition_rows}
    labels = {k: _label([r for r in transition_rows if r["issue_key"] == k]) for k in issues}
    smallest = {label: min(k for k in issues if labels[k] == label) for label in set(labels.values())}
    rank = {label: 1 + sum(other < first for other in smallest.values()) for label, first in smallest.items()}
    return {k: (labels[k], rank[labels[k]]) for k in issues}
