"""Merges of large batches into bucketed tables (UPS-1..UPS-4): the table is read bucket by
bucket and never shuffled; only the batch is.

For loads that touch most of a table (a first load in parts, a backfill), where
``sources.tables`` would read and write nearly every folder anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from issuelens.operators.upsert import count_copies, merge, newest_per_key
from issuelens.session import scratch_path


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None,
                   laid_out: bool = False) -> DataFrame:
    """Save ``df`` as table ``name``, one file per bucket of its key, sorted by the key
    (Spark sorts a bucket again for a merge join, which costs little on sorted rows).
    ``laid_out``: its tasks hold a bucket each, as those of ``merge_bucketed`` do."""
    spark = df.sparkSession
    rows = df if laid_out else df.repartition(buckets, *keys)
    (rows.write.mode("overwrite").option("path", path or scratch_path(spark, f"bucketed-{name}"))
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Bucket columns and number of buckets of a saved table."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    columns = [c.strip("`] [") for c in info["Bucket Columns"].split(",")]
    return columns, int(info["Num Buckets"])


def merge_bucketed(spark: SparkSession, name: str, batch: DataFrame, order: Sequence = (), latest: bool = True,
                   keep_cols: Sequence[str] = (), on_conflict: str = "update", version_col: str | None = None) -> DataFrame:
    """The table with the batch merged into it, as ``upsert`` would, by a merge join that
    shuffles only the batch, once.  Write it with ``write_bucketed`` under a new
    name: the result is laid out like the table (``laid_out``)."""
    keys, buckets = bucket_spec(spark, name)
    target = spark.table(name)
    src = newest_per_key(batch, keys, order, latest, count_copies(batch, keys), buckets).select(*target.columns)
    return merge(target.hint("merge"), src, keys, keep_cols, on_conflict, version_col, broadcast_batch_rows=-1)
