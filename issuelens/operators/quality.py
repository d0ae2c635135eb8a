"""Data-quality checks (DQ-1..DQ-4, AGG-10), row by row or as profiles of a table.

A profile holds the counts of all checks of a table and a sketch of its keys, from one
scan.  Profiles of several loads add up to that of all their rows, so a table that grows
load by load is never read again for its counts.  The sketch only estimates how many keys
there are; whether keys repeat is told by ``key_counts``, which is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-1/AGG-10: keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """DQ-2/JN-10: child rows whose reference has no parent row.  The parent
    side is reduced to its distinct keys (map-side) before the anti join."""
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(keys, child[child_key] == keys["_pk"], "left_anti")


def unparsable(df: DataFrame, text_col: str, parsed: Column) -> DataFrame:
    """DQ-3: rows whose text is present but does not parse."""
    return df.filter(F.col(text_col).isNotNull() & parsed.isNull())


def lookup_gaps(transitions: DataFrame, lookup: DataFrame,
                source: str = "source", target: str = "target") -> DataFrame:
    """DQ-4: (source, target) pairs the inner lookup join would drop, with counts.
    Pairs are counted first (map-side), so only distinct pairs meet the lookup."""
    pairs = transitions.groupBy(F.col(source).alias("source"), F.col(target).alias("target")) \
        .agg(F.count(F.lit(1)).alias("n"))
    lk = lookup.select("source", "target").distinct()
    return pairs.join(lk, ["source", "target"], "left_anti")


#: Registers of a key sketch, as a power of two: an error of about 0.8 percent.
SKETCH_LG = 14


def profile(df: DataFrame, keys: Sequence[str], checks: dict[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by``): ``n_rows``, ``n_null_keys`` (rows with a null in a key), for each
    check the number of rows where its condition is true, and ``keys``, a sketch of the whole
    keys.  All are partial aggregates of one scan; a table without rows gives zeros."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~whole, 1)).alias("n_null_keys"),
        *[F.count(F.when(failed, 1)).alias(name) for name, failed in checks.items()],
        F.hll_sketch_agg(F.when(whole, F.xxhash64(*keys)), F.lit(SKETCH_LG)).alias("keys"))


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of all rows (per ``by``) that ``profiles`` describe."""
    counts = [c for c, kind in profiles.dtypes if kind == "bigint" and c not in by]
    return profiles.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
                                     F.hll_union_agg("keys").alias("keys"))


def key_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by``): ``n_keys``, the distinct keys without a null, and ``n_repeated``,
    those that occur more than once.  A key that many rows hold is a partial aggregate."""
    each = df.dropna(subset=list(keys)).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"))
    return each.groupBy(*by).agg(F.count(F.lit(1)).alias("n_keys"),
                                 F.count(F.when(F.col("_n") > 1, 1)).alias("n_repeated"))
