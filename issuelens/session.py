"""Session settings and the shared scratch / checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every query relies on: UTC wall clock for timestamp_ntz columns,
# ANSI casts, adaptive execution with skew-join splitting.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "issuelens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_settings(input_bytes: int, target_partition_bytes: int = 128 << 20,
                     min_partitions: int = 200) -> dict[str, str]:
    """Settings sized for ``input_bytes`` of (compressed) input.

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    (AQE coalesces small ones at run time and splits skewed join partitions);
    scans read splits of the same size.  The sequencing operator's range
    partitions use the same count, so a split hot group also lands in
    partitions of this size.  Example: 100 TB → about 800k shuffle partitions.
    """
    parts = max(min_partitions, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_session_defaults(spark: SparkSession) -> None:
    """Set the SQL settings the queries need on an existing session; a session
    that does not take the ones the results rest on is refused."""
    for k, v in SESSION_DEFAULTS.items():
        if not k.startswith("spark.ui") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(k) != SESSION_DEFAULTS[k]:
            raise RuntimeError(f"{k} must be {SESSION_DEFAULTS[k]}, is {spark.conf.get(k)}")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only in a single-process session (local tests) with nothing
    configured a private folder is created; elsewhere executors would not see it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="issuelens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


@contextmanager
def settings_held(spark: SparkSession, settings: dict[str, str]):
    """SQL settings that hold within, and then are what they were."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """Within, the shuffle files of a query go when it ends, not when the driver happens to
    collect its garbage."""
    return settings_held(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the checkpoint folder (shared on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def path_state(spark: SparkSession, path: str) -> str:
    """Bytes, files and last change of what is under ``path``: tells rewritten data apart."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return "missing"
    size, newest, files = 0, 0, fs.listFiles(p, True)
    n = 0
    while files.hasNext():
        f = files.next()
        size, newest, n = size + f.getLen(), max(newest, f.getModificationTime()), n + 1
    return f"{size}-{n}-{newest}"


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small marker file through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str) -> str | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
