"""Keyed upsert without MERGE (UPS-1..UPS-5).

Built-in Parquet tables have no ``MERGE INTO``, so the upsert is a
full-outer join of the current table with the de-duplicated batch on the key:
both sides hold one row per key, so no key can be hot in the join.  What is
done with the result, and how much of a table is merged, is the caller's
business (``streaming.incremental`` merges and writes the touched buckets).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.operators.sizing import has_at_most
from issuelens.operators.stage import materialize


#: Rows per key, on average, from which a partial aggregate before the shuffle pays.
MANY_COPIES = 4
#: Rows of one key that are too many to sort in one task, and how many such keys are told apart.
HOT_ROWS, HOT_KEYS, TRACKED = 500_000, 100, 10_000


@dataclass(frozen=True)
class Copies:
    """How a table's rows spread over its keys: number of rows, about how many keys, the
    hashes of the keys that very many rows hold, and what else was asked for."""
    rows: int
    keys: int
    hot: tuple[int, ...]
    also: tuple = ()

    @property
    def few(self) -> bool:
        return self.rows < MANY_COPIES * self.keys


@dataclass(frozen=True)
class Layout:
    """Which task a key's rows go to: by ``column``, which the rows hold and their key gives.
    With ``tasks`` to so many; ``numbered``: the column is the task's number."""
    column: str
    tasks: int | None = None
    numbered: bool = False

    def __call__(self, rows: DataFrame) -> DataFrame:
        if self.numbered:
            return rows.repartitionById(self.tasks, F.col(self.column))
        return rows.repartition(*([self.tasks] if self.tasks else []), self.column)


def count_copies(df: DataFrame, keys: Sequence[str], also: Sequence[Column] = ()) -> Copies:
    """One scan of the key columns; a sketch per task is all that is shuffled.  The figures
    only choose a plan.  ``also``: aggregates over ``df`` that the same scan is to give."""
    cols = ", ".join(f"`{k}`" for k in keys)
    row = df.withColumn("_h", F.expr(f"xxhash64({cols})")).agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_h").alias("keys"),
        F.expr(f"approx_top_k(_h, {HOT_KEYS}, {TRACKED})").alias("top"),
        *[c.alias(f"_also{i}") for i, c in enumerate(also)]).first()
    return Copies(row["n"], row["keys"], tuple(t["item"] for t in row["top"] or () if t["count"] > HOT_ROWS), tuple(row[3:]))


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], largest: bool,
          copies: Copies | None = None, partitions: int | None = None, layout: Layout | None = None) -> DataFrame:
    of_key, keys = list(keys), list(keys) if layout is None else [layout.column, *keys]
    order_names = sorted({o for o in order if isinstance(o, str)})
    rest = [c for c in df.columns if c not in keys and c not in order_names]
    if not keys or not (order or rest):
        return df.select(*keys).distinct()
    # One struct (order first, then the other columns): min/max of it is the row with the
    # smallest/largest order.
    if df.isStreaming:  # streams that run have this layout in their state
        order_cols = [F.col(o) if isinstance(o, str) else o for o in order] or [F.col(c) for c in rest]
        both = F.struct(F.struct(*order_cols).alias("o"), F.struct(*[F.col(c) for c in rest + order_names]).alias("v"))
        newest = df.groupBy(*keys).agg((F.max if largest else F.min)(both).alias("_row"))
        return newest.select(*keys, *[F.col("_row.v")[c].alias(c) for c in rest + order_names])
    fields = [(o, F.col(o) if isinstance(o, str) else o) for o in order] + [(c, F.col(c)) for c in rest]
    at = {name: f"_{i}" for i, (name, _) in reversed(list(enumerate(fields))) if isinstance(name, str)}
    whole = F.struct(*[c.alias(f"_{i}") for i, (_, c) in enumerate(fields)])

    def picked(rows: DataFrame) -> DataFrame:
        out = rows.groupBy(*keys).agg((F.max if largest else F.min)(whole).alias("_row"))
        return out.select(*keys, *[F.col("_row")[at[c]].alias(c) for c in rest + order_names])

    def together(rows: DataFrame) -> DataFrame:
        return layout(rows) if layout else rows.repartition(*([partitions] if partitions else []), *keys)

    if copies is None or not copies.few:
        return together(picked(df)) if partitions or layout else picked(df)
    if not copies.hot:
        return picked(together(df))
    hot = F.xxhash64(*of_key).isin(*copies.hot)
    if layout:
        return picked(together(df.where(~hot).unionByName(picked(df.where(hot)))))
    both = picked(together(df.where(~hot))).union(picked(df.where(hot)))
    return together(both) if partitions else both


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), copies: Copies | None = None,
                 partitions: int | None = None, layout: Layout | None = None) -> DataFrame:
    """One row per key: the smallest in ``order`` (default: all other columns).

    An aggregate, not a window: partial aggregation collapses a hot key
    map-side before the shuffle.  That sorts every row before the shuffle and again
    after it, so where ``copies`` (``count_copies``) tells that a key has few rows, rows go
    to their key's task as they are and are sorted there once; only those of hot keys
    are collapsed first.  ``partitions``: the number of tasks the result is spread over by key;
    ``layout``: what it is laid out by instead.
    """
    return _pick(df, keys, order, False, copies, partitions, layout)


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), copies: Copies | None = None,
                partitions: int | None = None, layout: Layout | None = None) -> DataFrame:
    """One row per key: the largest in ``order`` (the latest version)."""
    return _pick(df, keys, order, True, copies, partitions, layout)


BROADCAST_BATCH_ROWS = 100_000  # ~5 MB of key hash table: within the usual broadcast sizes


def _merge_rows(target: DataFrame, src: DataFrame, keys: list[str], keep: set[str],
                version_col: str | None = None) -> DataFrame:
    cols = target.columns
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = src.withColumn("_in_s", F.lit(True)).alias("s")
    j = t.join(s, keys, "full_outer")
    takes = F.col("s._in_s")
    if version_col:  # an older version never overwrites a newer one
        older = F.col(f"s.{version_col}") < F.col(f"t.{version_col}")
        takes = takes & ~F.coalesce(older, F.col(f"s.{version_col}").isNull() & F.col(f"t.{version_col}").isNotNull())
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in keep:
            out.append(F.when(F.col("t._in_t"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
        else:
            out.append(F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*out)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
           keep_cols: Sequence[str] = (), on_conflict: str = "update",
           order: Sequence[str | Column] = (), latest: bool = False, version_col: str | None = None,
           broadcast_batch_rows: int = BROADCAST_BATCH_ROWS, late: Mapping[str, Column] | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT (keys) DO UPDATE / DO NOTHING``.

    * ``source`` is de-duplicated first: the first row per key in ``order``
      (``latest=True``: the last; order columns may be extra source columns),
      so the result is deterministic;
    * ``on_conflict="update"``: matched rows take every non-key column from
      the source — a NULL in the source overwrites — except ``keep_cols``,
      which keep the target's value;
    * ``version_col``: a matched row is updated only when the source's version is
      not older than the target's (a NULL version is older than any other);
    * ``on_conflict="nothing"``: matched rows keep the target row;
    * unmatched target rows stay, unmatched source rows are inserted.
    Columns come out in the target's order; the source must have them all, or ``late``
    gives those it lacks: expressions over the source's columns, evaluated for the rows that
    the de-duplication keeps, so that it moves only what they are made of.  Rows of one
    key that are alike in the source's columns must be alike in these too.

    Plan: with at most ``broadcast_batch_rows`` rows the de-duplicated batch is
    written once, so that its source is parsed once, its keys are broadcast and the
    table is only scanned — untouched rows pass through an anti join, touched rows
    (no more than the batch) are merged with it — so the table is never shuffled.
    Larger batches use one full outer join on the key (both sides unique per
    key), which finds the batch's rows where their de-duplication put them.
    """
    late = late or {}
    missing = [c for c in target.columns if c not in source.columns and c not in late]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    copies = count_copies(source, keys)
    src = newest_per_key(source, keys, order, latest, copies)
    src = src.select(*[late[c].alias(c) if c in late else F.col(c) for c in target.columns])
    if is_large(copies, broadcast_batch_rows):
        return merge(target, src, keys, keep_cols, on_conflict, version_col, -1)
    return merge(target, materialize(src, "upsert-batch"), keys, keep_cols, on_conflict, version_col, broadcast_batch_rows)


def is_large(copies: Copies, broadcast_batch_rows: int = BROADCAST_BATCH_ROWS) -> bool:
    """Are there surely more keys than are broadcast (beyond the estimate's error)?"""
    return copies.keys > max(broadcast_batch_rows, 0) * 1.25


def newest_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = (), latest: bool = True,
                   copies: Copies | None = None, partitions: int | None = None, layout: Layout | None = None) -> DataFrame:
    """One row per key: the last in ``order``, or the first."""
    return (dedupe_last if latest else dedupe_first)(source, keys, order, copies, partitions, layout)


def merge(target: DataFrame, src: DataFrame, keys: Sequence[str], keep_cols: Sequence[str] = (), on_conflict: str = "update",
          version_col: str | None = None, broadcast_batch_rows: int = BROADCAST_BATCH_ROWS,
          layout: Layout | None = None) -> DataFrame:
    """The merge of ``upsert``, for a batch that has one row per key: a written one, or
    (``broadcast_batch_rows`` -1) one that is computed as it is joined; that may be laid out
    by a ``layout``, whose column both sides hold, and the merged rows are too."""
    keys, keep = list(keys) if layout is None else [layout.column, *keys], set(keep_cols)
    if on_conflict not in ("update", "nothing"):
        raise ValueError(f"unknown on_conflict {on_conflict!r}")
    small = broadcast_batch_rows >= 0 and has_at_most(src, broadcast_batch_rows)
    if on_conflict == "nothing":
        if small:
            batch_keys = F.broadcast(src.select(*keys))
            existing = target.select(*keys).join(batch_keys, keys, "left_semi")
            return target.unionByName(src.join(existing, keys, "left_anti"))
        held = target.select(*keys)
        return target.unionByName(src.join(layout(held) if layout else held, keys, "left_anti"))
    if not small:
        return _merge_rows(layout(target) if layout else target, src, keys, keep, version_col)
    batch_keys = F.broadcast(src.select(*keys))
    untouched = target.join(batch_keys, keys, "left_anti")
    touched = target.join(batch_keys, keys, "left_semi")
    return untouched.unionByName(_merge_rows(touched, src, keys, keep, version_col))


# The rules of the five tables.
RULES: dict[str, dict] = {
    # UPS-1: every non-key column is updated, by a version not older.
    "pull_requests": {"keys": ["id"], "version_col": "updated_at"},
    # UPS-2.
    "pull_request_commits": {"keys": ["sha", "pull_request_id"]},
    # UPS-3: ``created_at`` keeps its first value; ``updated_at`` comes from the batch.
    "jira_issues": {"keys": ["key"], "keep_cols": ["created_at"]},
    # UPS-4: ``issue_key`` and ``field_type`` keep their first value.
    "jira_changelog": {"keys": ["id", "field"], "keep_cols": ["issue_key", "field_type"]},
    # UPS-5: DO NOTHING, an existing edge keeps its first ``created_at``.
    "jira_links": {"keys": ["source_issue_key", "target_issue_key", "link_type"], "on_conflict": "nothing"},
}


def upsert_pull_requests(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    """UPS-1."""
    return upsert(target, source, **{**RULES["pull_requests"], **kw})


def upsert_pull_request_commits(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    """UPS-2."""
    return upsert(target, source, **{**RULES["pull_request_commits"], **kw})


def upsert_issues(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    """UPS-3."""
    return upsert(target, source, **{**RULES["jira_issues"], **kw})


def upsert_changelog(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    """UPS-4."""
    return upsert(target, source, **{**RULES["jira_changelog"], **kw})


def upsert_links(target: DataFrame, source: DataFrame, **kw) -> DataFrame:
    """UPS-5."""
    return upsert(target, source, **{**RULES["jira_links"], **kw})
