"""Incremental upsert of landed files: ``readStream`` → ``availableNow`` →
``foreachBatch`` → merge into the tables' buckets.

The stream checkpoint decides which landed files are new (replacing the
reference's "fetch only records newer than the last run").  Every micro-batch
is reduced to one row per key, merged with the buckets its keys fall into, and
those buckets are written; the rest of the table is neither read nor written.

A batch that is replayed after a failure gives the same table: the merged
buckets are first written next to the checkpoint (``staged``), then put in place;
a replay that finds them complete puts the same files in place again, and one
that does not has left the table as it was.  Landing folders, streams and fresh
checkpoints on one table are merged by the table's own rule.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens import schemas
from issuelens.operators.stage import discard, materialize
from issuelens.operators.upsert import Layout, count_copies, is_large, merge, newest_per_key
from issuelens.session import delete_path, path_exists, read_text_file, shuffles_freed
from issuelens.sources.landed import NTZ_MICROS, Pages, page_rows, page_texts, parse_pages
from issuelens.sources.tables import COMPRESSION, Warehouse, bucket_of, folders_side_by_side
from issuelens.streaming.quarantine import log_load, put_aside

#: Columns that say when a landed row came: file, page in the file, place in the page.
LANDED = ["_file", "_pos", "_el"]

#: Bytes of rows, before compression, that a task reduces and merges; the column of the task's number.
TASK_BYTES = 256 << 20
PART = "_part"


@dataclass(frozen=True)
class Load:
    """How a batch's rows go into one table: ``rows`` makes table rows of them (order
    columns may follow), of which the last per key in ``order`` counts."""
    table: str
    rows: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    order: Sequence = ()
    keep_cols: Sequence[str] = ()
    on_conflict: str = "update"
    version_col: str | None = None
    schema: T.StructType | None = None
    latest: bool = field(default=True)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint folder belongs to."""
    text = read_text_file(spark, f"{checkpoint}/metadata")
    if not text:
        raise RuntimeError(f"{checkpoint} holds no stream")
    return json.loads(text)["id"]


def _staged(checkpoint: str, load: Load, batch_id: int) -> str:
    return f"{checkpoint}/staged/{load.table}/{batch_id}"


def _bytes(rows: DataFrame) -> Column:
    """About how many bytes ``rows`` are, before compression."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    return F.sum(reduce(lambda x, y: x + y, texts, F.lit(16 * len(rows.columns))).cast("long"))


def stage_load(store: Warehouse, load: Load, batch: DataFrame, stream: str, batch_id: int, path: str) -> dict | None:
    """Write the touched buckets as they will be; the counts of what changes, or None when
    the batch has no row for the table.  A batch of few keys is written first, as one row per
    key; that of many goes to its keys' tasks once, where it is reduced and merged.  These
    tasks hold a bucket or a part of one each, so the staged files lie by bucket and are put in
    place without another shuffle."""
    schema, keys = load.schema or schemas.TABLES[load.table], list(load.keys)
    buckets = store.buckets(load.table)
    keyed = load.rows(batch).dropna(subset=keys)
    bucket = bucket_of(keys, buckets).alias("bucket")
    # At most as many values as the table has buckets.
    copies = count_copies(keyed, keys, [F.collect_set(bucket), _bytes(keyed)])
    touched, size = sorted(copies.also[0]), copies.also[1]
    if not touched:
        return None
    current = store.rows(load.table, schema, touched)
    held = current.count()  # the files' own row counts
    written_by = [F.lit(stream).alias("load_stream"), F.lit(batch_id).cast("long").alias("load_batch")]
    rule = (load.keep_cols, load.on_conflict, load.version_col)
    large, src = is_large(copies), None
    if large:
        whole = size * (copies.rows + held) // copies.rows
        parts = -(-whole // (TASK_BYTES * len(touched)))  # of a bucket: part p is of bucket p % buckets
        layout = Layout(PART, parts * buckets, numbered=True)
        part = bucket_of(keys, layout.tasks).alias(PART)
        newest = newest_per_key(keyed.select("*", part), keys, load.order, load.latest, copies, layout=layout)
        newest = newest.select(*schema.names, *written_by, bucket, PART)
        merged = merge(current.select("*", part), newest, keys, *rule, -1, layout).drop(PART)
    else:
        src = newest_per_key(keyed, keys, load.order, load.latest, copies).select(*schema.names)
        src = materialize(src.select("*", *written_by, bucket), "batch-rows", COMPRESSION)
        merged = merge(current, src, keys, *rule)
    ours = (F.col("load_stream") == stream) & (F.col("load_batch") == batch_id)
    seen = Observation(f"{load.table}-{batch_id}")
    merged = merged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(ours, 1)).alias("written"))
    writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with folders_side_by_side(merged.sparkSession):
        (writer.partitionBy("bucket") if large else writer).parquet(path, compression=COMPRESSION)
    if src is not None:
        discard(src)
    inserted = seen.get["rows"] - held
    return {"inserted": inserted, "updated": seen.get["written"] - inserted}


def batch_writer(store: Warehouse, checkpoint: str, loads: Sequence[Load],
                 prepare: Callable[[DataFrame], DataFrame] | None = None, pages: Pages | None = None, landing: str = "",
                 stateful: bool = False):
    """The ``foreachBatch`` function.  The batch is parsed (and ``prepare``d) once and
    written, and all tables are merged from that; parsed pages that need no preparing are
    taken as they were written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, stream = store.spark, stream_id(store.spark, checkpoint)
        todo = [x for x in loads if not path_exists(spark, f"{_staged(checkpoint, x, batch_id)}/_SUCCESS")]
        if not todo and stateful:
            batch.write.format("noop").mode("overwrite").save()  # the state's version of this batch is made by running it
        if todo:
            rows, read, between = batch, {}, []
            if pages is not None:
                parsed = parse_pages(batch.withColumn("_pos", F.monotonically_increasing_id()), pages)
                value = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
                parsed = materialize(parsed.select("_file", "_pos", value, "page", "reason"), "pages", COMPRESSION)
                between.append(parsed)
                read = put_aside(store, parsed, landing, stream, batch_id)
                rows = page_rows(parsed, ["_file", "_pos"])
            if prepare or pages is None:
                rows = materialize(prepare(rows) if prepare else rows, "batch", COMPRESSION)
                between.append(rows)
            counts = []
            for load in todo:
                changed = stage_load(store, load, rows, stream, batch_id, _staged(checkpoint, load, batch_id))
                if changed is not None:
                    counts.append({"table": load.table, **read, **changed})
            if read.get("pages") and not counts:
                counts = [{"table": loads[0].table, **read, "inserted": 0, "updated": 0}]
            if counts:
                log_load(store, counts, landing, stream, batch_id)
            for written in between:
                discard(written)
        for load in loads:
            path = _staged(checkpoint, load, batch_id)
            if path_exists(spark, f"{path}/_SUCCESS"):
                store.replace_buckets(load.table, spark.read.parquet(path))
            # Only the last batch of a stream can come again.
            delete_path(spark, _staged(checkpoint, load, batch_id - 1))
    return write


def _run(stream: DataFrame, write, checkpoint: str, mode: str = "append") -> None:
    q = (stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def load_pages(store: Warehouse, landing: str, pages: Pages, loads: Sequence[Load], checkpoint: str,
               multi_line: bool = False, prepare: Callable[[DataFrame], DataFrame] | None = None,
               max_files_per_trigger: int | None = None) -> None:
    """Load every landed page not yet seen by ``checkpoint`` and stop; pages that cannot be
    loaded go to the quarantine."""
    reader = store.spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    with shuffles_freed(store.spark):
        _run(page_texts(reader, landing, multi_line), batch_writer(store, checkpoint, loads, prepare, pages, landing), checkpoint)


def run_incremental(spark: SparkSession, landing: str, store: Warehouse, raw_schema: T.StructType, load: Load,
                    checkpoint: str, max_files_per_trigger: int | None = None, fmt: str = "json") -> None:
    """Load landed rows of a fixed schema (JSON lines, Parquet, ...) into one table."""
    _run(_row_stream(spark, landing, raw_schema, fmt, max_files_per_trigger), batch_writer(store, checkpoint, [load]), checkpoint)


def run_latest(spark: SparkSession, landing: str, store: Warehouse, raw_schema: T.StructType, load: Load, checkpoint: str,
               max_files_per_trigger: int | None = None, fmt: str = "json") -> None:
    """Like ``run_incremental``, with each key's latest version kept in the stream's state:
    the state store holds one row per key, a batch changes those of its own keys,
    and only they go on to the table.  Landings that come again, late or out of
    order, within a batch or across, so cost no read of the table's history and
    give the latest by ``load.order`` (which has to be total, as a stream has no
    order of its own)."""
    rows = load.rows(_row_stream(spark, landing, raw_schema, fmt, max_files_per_trigger))
    newest = newest_per_key(rows.dropna(subset=list(load.keys)), load.keys, load.order)
    keyed = replace(load, rows=lambda batch: batch)
    with _state_on_disk(spark):
        _run(newest, batch_writer(store, checkpoint, [keyed], stateful=True), checkpoint, "update")


@contextmanager
def _state_on_disk(spark: SparkSession):
    """Keep state in RocksDB, which need not fit in memory, unless the session names a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    chosen = any(k == key for k in spark.conf.getAll)
    if not chosen:
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if not chosen:
            spark.conf.unset(key)


def _row_stream(spark, landing, raw_schema, fmt, max_files_per_trigger):
    reader = spark.readStream.schema(raw_schema).option("timestampNTZFormat", NTZ_MICROS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.format(fmt).load(landing)
