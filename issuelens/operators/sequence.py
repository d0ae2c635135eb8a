"""Row numbering and ``lag`` inside ordered groups, safe for hot groups.

``Window.partitionBy(key)`` sends every row of one key to one task; a key
holding a third of all rows would then be one task.  ``sequence_rows``
first measures the groups (``resolve_strategy``: one count, then one partially
aggregated size job).  When no group has more rows than a task may hold
(``HOT_ROWS``, whatever the size of the input), it uses a plain window (one
shuffle).  Otherwise it splits the hot groups:

1. range-partition on (group, order) so a hot group spans many partitions
   (without an explicit count AQE may coalesce adjacent ranges);
2. number and count rows and take ``lag`` inside (partition, group) — every
   window holds at most one range partition — and write that stage to the
   checkpoint folder, so the partition assignment (range bounds come from
   sampling) is fixed for everything read from it, also after executor loss;
3. per partition keep a one-row summary of its first and its last group; only
   those can reach over a partition's edge.  Windows over these ``n`` rows
   (``n`` = number of partitions) give the rows carried in, the last row before
   and the whole size of the groups that do;
4. join the summaries of the partitions where a group crosses an edge on the
   partition id.  The rows are never joined on their group again.

The result equals ``row_number()`` / ``lag()`` / ``count()`` over
``Window.partitionBy(group).orderBy(order)`` when the order is total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.operators.sizing import has_at_most
from issuelens.operators.stage import materialize
from issuelens.session import ensure_checkpoint_dir

_CONST_GROUP = "_seq_group"


def _order_exprs(order_cols) -> list[Column]:
    out = []
    for o in order_cols:
        out.append(o if isinstance(o, Column) else F.col(o).asc_nulls_last())
    return out


#: Rows of one group that one task may hold: at some 100 bytes a row about 100 MB.
HOT_ROWS = 1_000_000


def hot_groups(df: DataFrame, group_cols: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """True when some group has more than ``hot_rows`` rows.  One aggregate job;
    partial aggregation keeps it cheap even when a group is huge."""
    sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))
    return (sizes.agg(F.max("n")).first()[0] or 0) > hot_rows


def resolve_strategy(df: DataFrame, group_cols: Sequence[str], strategy: str = "auto",
                     hot_rows: int = HOT_ROWS) -> str:
    """``"window"`` or ``"ranged"``; ``"auto"`` measures the groups of ``df``.
    Resolve once and pass the result on when later steps group the same keys
    over a subset of these rows."""
    if strategy != "auto":
        return strategy
    # Cheap first: no group can be hot when the whole input is within the bound.
    if has_at_most(df, hot_rows):
        return "window"
    if not group_cols:
        return "ranged"
    return "ranged" if hot_groups(df, group_cols, hot_rows) else "window"


def sequence_rows(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                  lag_cols: Sequence[str] = (), step_col: str = "step",
                  prev_prefix: str = "prev_", num_partitions: int | None = None,
                  keep_pid: bool = False, strategy: str = "auto",
                  hot_rows: int = HOT_ROWS, size_col: str | None = None) -> DataFrame:
    """Add ``step_col`` (1, 2, … per group, long) and ``prev_<c>`` for ``lag_cols``;
    with ``size_col`` also the number of rows of the group (long).

    ``strategy``: ``"window"`` is the plain one-shuffle window; ``"ranged"``
    the skew-safe plan above; ``"auto"`` (default) measures group sizes first
    and takes ``"ranged"`` only when a group is hot (``hot_groups``).  All
    three give the same rows.
    """
    gcols = list(group_cols)
    orders = _order_exprs(order_cols)
    strategy = resolve_strategy(df, gcols, strategy, hot_rows)
    if strategy == "window":
        w = Window.partitionBy(*gcols).orderBy(*orders) if gcols else Window.orderBy(*orders)
        new_cols = {step_col: F.row_number().over(w).cast("long")}
        new_cols.update({prev_prefix + c: F.lag(c).over(w) for c in lag_cols})
        if size_col:
            whole = Window.partitionBy(*gcols) if gcols else Window.partitionBy()
            new_cols[size_col] = F.count(F.lit(1)).over(whole).cast("long")
        return df.withColumns(new_cols)
    if strategy != "ranged":
        raise ValueError(f"unknown strategy {strategy!r}")

    ensure_checkpoint_dir(df.sparkSession)
    const = not gcols
    if const:
        df = df.withColumn(_CONST_GROUP, F.lit(0))
        gcols = [_CONST_GROUP]
    group_sort = [F.col(c).asc_nulls_first() for c in gcols]

    # Without an explicit count the range shuffle is sized by
    # spark.sql.shuffle.partitions and AQE may coalesce adjacent ranges into
    # partitions of the advisory size; coalescing keeps range order, so the
    # partition ids below stay ordered.
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *group_sort, *orders)
    else:
        ranged = df.repartitionByRange(*group_sort, *orders)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())

    w_local = Window.partitionBy("_pid", *gcols).orderBy(*orders)
    local_cols = {"_lrn": F.row_number().over(w_local).cast("long")}
    local_cols.update({"_lag_" + c: F.lag(c).over(w_local) for c in lag_cols})
    local_cols["_lcnt"] = F.count(F.lit(1)).over(Window.partitionBy("_pid", *gcols))
    local = ranged.withColumns(local_cols)
    # Freeze partition assignment and local numbering (range bounds come from
    # sampling): summary and final rows then read the same written stage.
    local = materialize(local, "sequence")

    gk = F.struct(*[F.col(c) for c in gcols])
    last_vals = F.struct(*[F.col(c).alias(c) for c in lag_cols]) if lag_cols else F.lit(0)
    summary = (local.groupBy("_pid").agg(
        F.min(F.struct(gk.alias("g"), F.col("_lcnt").alias("n"))).alias("_first"),
        F.max(F.struct(gk.alias("g"), F.col("_lrn").alias("n"))).alias("_last"),
        F.max_by(last_vals, F.struct(gk, F.col("_lrn"))).alias("_lastv")))
    summary = materialize(summary, "sequence-parts")
    # n rows: one per non-empty partition, ordered windows over them are cheap.
    w_all = Window.orderBy("_pid")
    w_grp = (Window.partitionBy(F.col("_last.g")).orderBy("_pid")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.lag(F.col("_last.g")).over(w_all).eqNullSafe(F.col("_first.g"))
    goes_on = F.lead(F.col("_first.g")).over(w_all).eqNullSafe(F.col("_last.g"))
    ends = summary.select("_pid", F.explode(F.when(
        F.col("_first.g").eqNullSafe(F.col("_last.g")), F.array("_first")).otherwise(
        F.array("_first", "_last"))).alias("e")).groupBy(F.col("e.g").alias("g")).agg(F.sum("e.n").alias("size"))
    edge = (summary
            .withColumns({"_cum": F.sum(F.col("_last.n")).over(w_grp), "_same": same, "_on": goes_on})
            .withColumns({"_carry": F.when(F.col("_same"), F.lag("_cum").over(w_all)).otherwise(F.lit(0)),
                          "_carryv": F.when(F.col("_same"), F.lag("_lastv").over(w_all))})
            .where(F.col("_same") | F.col("_on")))
    one, two = ends.select(F.col("g").alias("g1"), F.col("size").alias("_size1")), ends.select(
        F.col("g").alias("g2"), F.col("size").alias("_size2"))
    edge = (edge.join(one, F.col("_first.g").eqNullSafe(F.col("g1"))).join(two, F.col("_last.g").eqNullSafe(F.col("g2")))
            .select("_pid", F.col("_first.g").alias("_fk"), F.col("_last.g").alias("_lk"),
                    F.col("_carry").cast("long").alias("_carry"), "_carryv", "_size1", "_size2"))
    edge = materialize(edge, "sequence-edges")

    first_group = gk.eqNullSafe(F.col("_fk"))
    out = local.join(edge, "_pid", "left")
    fixed = {step_col: (F.col("_lrn") + F.when(first_group, F.col("_carry"))
                        .otherwise(F.lit(0))).cast("long")}
    fixed.update({prev_prefix + c: F.when(first_group & (F.col("_lrn") == 1), F.col("_carryv")[c])
                  .otherwise(F.col("_lag_" + c)) for c in lag_cols})
    if size_col:
        fixed[size_col] = (F.when(first_group, F.col("_size1")).when(gk.eqNullSafe(F.col("_lk")), F.col("_size2"))
                           .otherwise(F.col("_lcnt"))).cast("long")
    out = out.withColumns(fixed)
    drop = ["_lrn", "_lcnt", "_fk", "_lk", "_carry", "_carryv", "_size1", "_size2"] + ["_lag_" + c for c in lag_cols]
    if const:
        drop.append(_CONST_GROUP)
    if not keep_pid:
        drop.append("_pid")
    return out.drop(*drop)


def global_rank(df: DataFrame, order_cols: Sequence, name: str = "rank",
                num_partitions: int | None = None, strategy: str = "auto",
                hot_rows: int = HOT_ROWS) -> DataFrame:
    """1, 2, 3 … over the whole frame in ``order_cols`` order.  A one-task
    window only when the frame is counted and small (at most ``hot_rows``),
    otherwise the range-split plan.  Keep the frame narrow."""
    return sequence_rows(df, [], order_cols, step_col=name, num_partitions=num_partitions,
                         strategy=strategy, hot_rows=hot_rows)
