"""Status values and status pivots (AGG-3..AGG-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_values(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """AGG-3/SET-2: distinct values, NULL last when sorted."""
    return df.select(F.col(col).alias(alias or col)).distinct()


def pivot_values(df: DataFrame, col: str) -> list[str]:
    """The sorted, non-NULL distinct values that become pivot columns.

    A small job whose result is bounded by ``spark.sql.pivotMaxValues``
    (checked by reading at most that many + 1 values).  Values differing only
    by case would clash as Spark column names and are rejected.
    """
    spark = df.sparkSession
    limit = int(spark.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = (df.select(F.col(col).alias("v")).filter(F.col("v").isNotNull()).distinct()
              .orderBy("v").limit(limit + 1).collect())
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct values in {col}; pass them explicitly")
    values = [r["v"] for r in rows]
    seen: dict[str, str] = {}
    for v in values:
        low = v.lower()
        if low in seen:
            raise ValueError(f"values {seen[low]!r} and {v!r} differ only by case")
        seen[low] = v
    return values


def pivot_by_value(df: DataFrame, group_cols: Sequence[str], pivot_col: str,
                   values: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """``groupBy(group).pivot(col, values).agg(...)``.

    With one aggregate the new columns are named by the value; with several,
    ``<value>_<alias>`` in value order.  For string and timestamp values this
    is one hash aggregate with map-side partial aggregation (one shuffle).
    """
    return df.groupBy(*group_cols).pivot(pivot_col, list(values)).agg(*aggs)
