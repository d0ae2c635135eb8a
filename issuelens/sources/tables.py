"""Persisted tables as partitioned Parquet (SRC-5, SRC-7, SNK-1).

A table's rows lie in folders by ``bucket``, a hash of their key, so a load reads
and replaces only the buckets that its keys fall into: Spark's dynamic partition
overwrite stages the new files and then swaps the touched folders, all others
keep their files.  Every row carries the stream and the batch that wrote it
(``LOADED_BY``).  The number of buckets is fixed when a table is first written
(its folder says ``of=<n>``); at about 1 GB a bucket, a table of 10 TB takes
10,000.  A table has one writer at a time, and readers come between loads.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.session import list_dirs, settings_held

BUCKETS = 16
LOADED_BY = T.StructType([T.StructField("load_stream", T.StringType()), T.StructField("load_batch", T.LongType())])

#: Codec of the tables' files: they are written once per load and hold mostly text.
COMPRESSION = "zstd"

# Further partitioning per table: the changelog by ``field``, so the
# ``field = 'status'`` filter of every status query prunes whole folders.
PARTITION_BY = {"jira_changelog": ["field"]}


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


#: Folders that a task writes to side by side; with more, its rows are sorted by folder first.
OPEN_FOLDERS = 32


def folders_side_by_side(spark: SparkSession):
    """Within, a task whose rows lie in few folders writes them as they come, unsorted."""
    return settings_held(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS)})


def lie_by_bucket(rows: DataFrame) -> bool:
    """Are the rows read from files that hold a bucket each?"""
    files = rows.inputFiles()
    return bool(files) and all("/bucket=" in f for f in files)


class Warehouse:
    """The tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.new_buckets = buckets

    def _written(self, name: str) -> list[int]:
        return [int(d[3:]) for d in list_dirs(self.spark, f"{self.root}/{name}") if d.startswith("of=")]

    def exists(self, name: str) -> bool:
        """SRC-7: has anything ever been written to the table?"""
        return bool(self._written(name))

    def buckets(self, name: str) -> int:
        return next(iter(self._written(name)), self.new_buckets)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/of={self.buckets(name)}"

    def rows(self, name: str, schema: T.StructType | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The table with its ``bucket`` and ``LOADED_BY`` columns; with ``buckets`` only
        theirs (other folders are not listed as input).  Typed and empty before the
        first load."""
        schema = schema or schemas.TABLES[name]
        full = T.StructType([*schema.fields, *LOADED_BY.fields, T.StructField("bucket", T.IntegerType())])
        if not self.exists(name):
            return schemas.empty_frame(self.spark, full)
        df = self.spark.read.schema(full).option("basePath", self.path(name)).parquet(self.path(name))
        if buckets is not None:
            df = df.where(F.col("bucket").isin(*buckets))
        # An empty text is no folder name: Spark files it under its default partition.
        empty = {c: F.coalesce(F.col(c), F.lit("")) for c in PARTITION_BY.get(name, []) if c in schema.names}
        return df.select(*[empty.get(c, F.col(c)).alias(c) for c in full.names])

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """SRC-5: the table's own columns (pruning and pushdown apply)."""
        schema = schema or schemas.TABLES[name]
        return self.rows(name, schema).select(*schema.names)

    def replace_buckets(self, name: str, rows: DataFrame) -> None:
        """Write ``rows`` (as ``rows`` gives them) in place of what the folders they belong to
        held.  The folders' files are of about the advisory partition size; rows that lie by
        bucket already are not shuffled, and their files are those they come in."""
        parts = [c for c in PARTITION_BY.get(name, []) if c in rows.columns] + ["bucket"]
        laid_out = lie_by_bucket(rows)
        rows = rows if laid_out else rows.hint("rebalance", *parts)
        with folders_side_by_side(rows.sparkSession) if laid_out else nullcontext():
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*parts).parquet(self.path(name), compression=COMPRESSION))

    def write(self, name: str, df: DataFrame, keys: Sequence[str] | None = None) -> None:
        """Write a whole table at once, outside of any stream."""
        keys = keys or schemas.KEYS[name]
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in LOADED_BY.fields]
        self.replace_buckets(name, df.select("*", *none, bucket_of(keys, self.buckets(name)).alias("bucket")))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """SRC-5."""
    return Warehouse(spark, root).read(name)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """SRC-7."""
    return Warehouse(spark, root).exists(name)


def register_views(store: Warehouse) -> list[str]:
    """SNK-2: the tables as temporary views, so SQL written against them runs as is:
    the five tables, the derived ``commits`` / ``pr_commits`` views, and
    ``json_extract_string(json, path)`` as a SQL function (inlined to
    ``get_json_object``; no Python)."""
    from issuelens.plans.pull_requests import commit_views
    spark = store.spark
    names = []
    for name in schemas.TABLES:
        store.read(name).createOrReplaceTempView(name)
        names.append(name)
    commits, pr_commits = commit_views(store.read("pull_request_commits"))
    commits.createOrReplaceTempView("commits")
    pr_commits.createOrReplaceTempView("pr_commits")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION json_extract_string(j STRING, p STRING) "
              "RETURNS STRING RETURN get_json_object(j, p)")
    return names + ["commits", "pr_commits"]
