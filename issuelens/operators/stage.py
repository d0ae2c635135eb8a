"""Cut lineage by writing a stage to the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from issuelens.session import delete_path, scratch_path


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    One job computes the stage once; later reads are columnar (pruning and
    pushdown apply) and a lost executor re-reads files instead of recomputing
    upstream shuffles, so anything derived from a non-deterministic step (range
    sampling, partition ids) stays fixed.  ``compression``: the files' codec, if not the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Delete what ``materialize`` has written, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in written.inputFiles()}:
        delete_path(written.sparkSession, folder)


def spread(df: DataFrame) -> DataFrame:
    """Spread an input that arrives in fewer splits than the cluster has task
    slots (e.g. one small file with a single row group) over all slots, so the
    narrow work before the first shuffle is not single-threaded.  Large inputs
    already have many splits and pass through unchanged."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df
