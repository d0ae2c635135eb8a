"""Expressions and Arrow helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.operators.stage import materialize
from issuelens.session import delete_path, scratch_path

# The white space that separates words, and the ASCII letters.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RE = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
MIN_LONG = -(1 << 63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the runs of characters other than white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE_RE), lambda w: w != "")


def strip_white(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def doc_key(id_col: str) -> Column:
    """The id as a long without nulls: a null id counts as one id below all others."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(MIN_LONG))


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string column and the ``n + 1`` offsets of its rows
    (no copy of the text; a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if offsets is not None and len(column) else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def release_memory() -> None:
    """Give back to the system what a task's batches took: a Python worker outlives its task,
    and idle ones would hold their largest batches besides the executor's own memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most ``BATCH_ROWS`` rows (a session's lower limit stays).  An
    executor holds a batch of each task in its own memory and again in the Python worker, and
    Spark's 10,000 whole texts are tens of MB each time.  The results do not depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name))
    if rows <= 0 or rows > BATCH_ROWS:  # 0 or less: no limit
        spark.conf.set(name, str(BATCH_ROWS))


FILTER_BITS = 25


def split_by_keys(rows: DataFrame, keys: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(others, perhaps): the rows whose ``col`` (a 64-bit hash) is certainly none of ``keys``,
    and the rest, which has all that are and few more.  The keys become a bitmap of
    ``2 ** FILTER_BITS`` bits, as rows of 64 bits: some 20 MB at most, so it may be
    broadcast, and only the second part has to be shuffled to meet the keys.  It only
    spares work; when it fills up, all rows are in the second part."""
    at = F.shiftright(F.col(col).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)), 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast({col} & 63 as int))")
    words = keys.select(at.alias("__kf_w"), bit.alias("__kf_b")).groupBy("__kf_w").agg(F.bit_or("__kf_b").alias("__kf_b"))
    marked = rows.withColumn("__kf_w", at).join(F.broadcast(materialize(words, "key-filter")), "__kf_w", "left")
    hit = F.coalesce(F.col("__kf_b").bitwiseAND(bit) != 0, F.lit(False))
    return tuple(marked.where(x).drop("__kf_w", "__kf_b") for x in (~hit, hit))


class Stages:
    """Written stages of one operator (below ``spark.checkpoint.dir``).  A stage that
    later ones no longer read is dropped, so a long operator's disk is that of its
    largest step: its files are deleted, and a collection on the driver lets
    Spark remove the shuffle files of finished jobs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = self.paths[name] = scratch_path(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            delete_path(self.spark, self.paths.pop(name))
        self.spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers (once per application),
    as ``--py-files`` does, so that tasks find them wherever the driver was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    if os.path.isdir(package):  # else it came as a zip already
        bundle = os.path.join(tempfile.mkdtemp(prefix="issuelens-code-"), "issuelens-code.zip")
        with zipfile.ZipFile(bundle, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(bundle)
    _SHIPPED.add(sc.applicationId)
