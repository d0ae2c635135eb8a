"""Pages that cannot be loaded, and the log of what each batch loaded (SNK-5).

Both are Parquet below the warehouse, in a folder per stream and batch, so that a
batch that is replayed writes its own again and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.session import path_exists

_BY = [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())]
QUARANTINE = T.StructType([
    T.StructField("landing", T.StringType()), T.StructField("file", T.StringType()), T.StructField("reason", T.StringType()),
    T.StructField("text", T.StringType()), *_BY])
LOADS = T.StructType([
    T.StructField("landing", T.StringType()), T.StructField("table", T.StringType()),
    *[T.StructField(c, T.LongType()) for c in ("pages", "quarantined", "elements", "inserted", "updated")], *_BY])


def _write(store, name: str, df: DataFrame, stream: str, batch_id: int) -> None:
    (df.withColumns({"stream": F.lit(stream), "batch": F.lit(batch_id).cast("long")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stream", "batch")
     .parquet(f"{store.root}/{name}"))


def _read(store, name: str, schema: T.StructType) -> DataFrame:
    path = f"{store.root}/{name}"
    if not path_exists(store.spark, path):
        return schemas.empty_frame(store.spark, schema)
    return store.spark.read.schema(schema).parquet(path)


def put_aside(store, parsed: DataFrame, landing: str, stream: str, batch_id: int) -> dict:
    """Write the pages that have a ``reason``; the batch's counts of pages and elements."""
    bad = F.col("reason").isNotNull()
    counts = parsed.agg(F.count(F.lit(1)).alias("pages"), F.count(F.when(bad, 1)).alias("quarantined"),
                        F.coalesce(F.sum(F.when(~bad, F.size("page"))), F.lit(0)).alias("elements")).first().asDict()
    if counts["quarantined"]:
        _write(store, "quarantine", parsed.where(bad).select(
            F.lit(landing).alias("landing"), F.col("_file").alias("file"), "reason", F.col("value").alias("text")), stream, batch_id)
    return counts


def log_load(store, counts: list[dict], landing: str, stream: str, batch_id: int) -> None:
    """One row per table that a batch went to (a few numbers, made on the driver)."""
    names = LOADS.names[2:-2]
    rows = F.array(*[F.struct(F.lit(landing).alias("landing"), F.lit(c["table"]).alias("table"),
                              *[F.lit(c.get(n)).cast("long").alias(n) for n in names]) for c in counts])
    _write(store, "loads", store.spark.range(1).select(F.inline(rows)), stream, batch_id)


def read_quarantine(store) -> DataFrame:
    """All pages put aside so far; one that was repaired and landed again stays listed."""
    return _read(store, "quarantine", QUARANTINE)


def read_loads(store) -> DataFrame:
    """SNK-5: what each batch read, put aside, inserted and updated."""
    return _read(store, "loads", LOADS)
