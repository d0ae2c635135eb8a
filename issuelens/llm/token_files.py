"""Token-id files: ids of all documents in id order, range coded in independent blocks.

Format: a folder of Parquet files with one row per frame.  A frame holds whole
documents, at least ``FRAME`` ids but for a part's last: ``part`` and ``frame`` give its place (parts
ascend with the document id, frames within a part), ``ids_before`` the ids of
the part before it, ``docs`` and ``lengths`` its documents in order with their
numbers of ids, and ``blocks`` the coded blocks, each with its own checksum.
A reader needs only the frames it wants.

Writing range-partitions the texts by id (ties by content, so that one id with
many rows is split), tokenises each task's rows in order and writes the frames;
where a task is lost, its files are written again by Spark's commit.  No task
needs the counts of another: the ids before a part are summed when reading,
from one row per frame.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from issuelens.llm import range_coder
from issuelens.llm.common import release_memory, ship_package, small_batches, text_bytes
from issuelens.llm.piece_bpe import slices

FRAME = range_coder.BLOCK * range_coder.LANES
#: Entries of a worker's table of known stretches (of two generations), the bytes of the
#: longest one kept, and the number that the library tokenizes as one text.
STRETCHES, LONGEST, AT_ONCE = 500_000, 48, 16
SLICE = 4 << 20        # bytes of text that a worker tokenizes at a time
# Classes of bytes: characters beyond U+023F, controls and the signs of multiplication and
# division are _ODD, and text is not cut beside them.
_ODD, _LETTER, _DIGIT, _SIGN, _APOSTROPHE, _WHITE, _LINE, _MORE = range(8)


def _byte_classes() -> np.ndarray:
    out = np.full(256, _ODD, np.uint8)
    out[33:127] = _SIGN
    out[[*range(65, 91), *range(97, 123)]] = _LETTER
    out[48:58], out[39] = _DIGIT, _APOSTROPHE
    out[[9, 11, 12, 13, 32]], out[10] = _WHITE, _LINE
    out[0x80:0xC0], out[0xC3:0xC9] = _MORE, _LETTER
    return out


def _cut_after() -> np.ndarray:
    """Whether text is cut between a byte of class ``a`` and one of class ``b``, at ``8 * a + b``:
    where byte-level pre-tokenization always starts a new token."""
    out = np.zeros((8, 8), bool)
    out[_LETTER:_WHITE, _WHITE:_MORE] = True
    out[_LETTER, [_DIGIT, _SIGN, _APOSTROPHE]] = True
    out[_DIGIT, [_LETTER, _SIGN, _APOSTROPHE]] = True
    out[_SIGN, [_LETTER, _DIGIT]] = True  # (not after an apostrophe, which may belong to what follows)
    return out.reshape(-1)


_CLASSES, _CUTS = _byte_classes(), _cut_after()


def _cut(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a stretch may start at each byte, and whether the byte is of a known character
    other than white space."""
    kind = _CLASSES.take(raw)
    high = np.flatnonzero(raw >= 0x80)
    if high.size:
        odd = high[(raw[high] == 0xC3) & np.isin(raw[np.minimum(high + 1, raw.size - 1)], (0x97, 0xB7))]
        kind[odd] = _ODD
        more = high[kind[high] == _MORE]
        for _ in range(3):  # a byte within a character has the class of its first one
            kind[more] = kind[more - 1]
    out = np.zeros(raw.size, bool)
    out[1:] = _CUTS.take((kind[:-1] << 3) | kind[1:])
    # A line feed alone between two other characters is a token.
    solid = (kind > _ODD) & (kind < _WHITE)
    line = np.flatnonzero(kind[1:-1] == _LINE) + 1
    out[line[solid[line - 1] & solid[line + 1]] + 1] = True
    return out, solid


class StretchTokenizer:
    """The library's tokenizer behind a table of known stretches.

    Text is cut where byte-level pre-tokenisation always cuts too (before white
    space, between letters, digits and signs, around a line feed), so the ids of
    the stretches in a row are the ids of the text.  Texts with an added token
    of the vocabulary are not cut.  Stretches met for the first time go to the
    library; words led by a space several at once, told apart again by the
    bytes that their ids stand for.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(range_coder.MAX_ID, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a byte-level token has one character a byte
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _library(self, texts: list[bytes]) -> list[bytes]:
        found = self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [array("H", e.ids).tobytes() for e in found]  # a larger id raises

    def _learn(self, words: list[bytes], alone: list[bytes]) -> None:
        """``words``: stretches that may follow each other in one text."""
        flat = b"".join(self._library([b"".join(words[a:a + AT_ONCE]) for a in range(0, len(words), AT_ONCE)]))
        ends = np.cumsum(self.bytes_of[np.frombuffer(flat, np.uint16)])
        want = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        last = np.searchsorted(ends, want)
        if words and ends[-1] == want[-1] and (ends[last] == want).all():
            stop = (2 * (last + 1)).tolist()
            self.known.update(zip(words, [flat[a:b] for a, b in zip([0, *stop], stop)]))
        else:
            alone = words + alone
        self.known.update(zip(alone, self._library(alone)))

    def encode(self, texts: Sequence[str], end_id: int) -> list[np.ndarray]:
        """Ids of each text, with ``end_id`` appended, as unsigned 16-bit numbers."""
        flat, counts = self.encode_column(pa.array(texts, pa.string()), end_id)
        return np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []

    def encode_column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other with ``end_id`` after each (a null
        text has only that), and their numbers."""
        raw, at = text_bytes(texts)
        begins, solid = _cut(raw)
        whole = raw.tobytes()
        for token in self.added:
            found = whole.find(token)
            while found >= 0:
                row = int(np.searchsorted(at, found, "right")) - 1
                begins[at[row]:at[row + 1]] = False
                found = whole.find(token, int(at[row + 1]))
        begins[at[:-1][at[:-1] < raw.size]] = True
        starts = np.flatnonzero(begins)
        stops = np.append(starts, raw.size)
        stretches = pa.Array.from_buffers(pa.large_binary(), starts.size, [
            None, pa.py_buffer(stops), pa.py_buffer(whole)]).dictionary_encode()
        distinct = stretches.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = stretches.indices.to_numpy()
        if len(self.known) + len(distinct) > STRETCHES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        coded, new = list(map(known.get, distinct)), []
        for k, s in enumerate(distinct):
            if coded[k] is None:
                if s in older:
                    coded[k] = known[s] = older[s]
                else:
                    new.append(k)
        if new:
            # Led by a space, with known characters after it and at the end: a token starts at its both ends.
            at_first = np.empty(len(distinct), np.int64)
            at_first[which[::-1]] = np.arange(which.size)[::-1]
            a, b = starts[at_first[new]], stops[at_first[new] + 1]
            word = (raw[a] == 32) & (b - a > 1) & solid[np.minimum(a + 1, raw.size - 1)] & solid[b - 1]
            self._learn([distinct[k] for k, w in zip(new, word.tolist()) if w],
                        [distinct[k] for k, w in zip(new, word.tolist()) if not w])
        for k in new:
            coded[k] = known[distinct[k]] if len(distinct[k]) <= LONGEST else known.pop(distinct[k])
        coded.append(np.array([end_id], np.uint16).tobytes())
        ids = np.frombuffer(b"".join(coded), np.uint16)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) >> 1
        # The stretches of each text, and its end.
        per_text = np.searchsorted(starts, at)
        order = np.insert(which, per_text[1:], len(distinct))
        n = size[order]
        ends = np.cumsum(n)
        places = np.repeat((np.cumsum(size) - size)[order] - (ends - n), n)
        places += np.arange(places.size)
        flat = ids.take(places)
        done = ends[per_text[1:] + np.arange(len(texts))]
        return flat, np.diff(done, prepend=0)


_TOKENIZERS: dict[str, StretchTokenizer] = {}


def tokenizer(path: str) -> StretchTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = StretchTokenizer(path)
    return _TOKENIZERS[path]


FRAME_SCHEMA = ("part int, frame int, ids_before bigint, n_ids bigint, docs array<bigint>, "
                "lengths array<int>, blocks array<binary>")


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, text_col: str = "text",
                      id_col: str = "doc_id") -> None:
    """Write the ids of all rows of ``docs`` under ``path`` (a folder that all
    executors share), in ascending id order, null ids first.

    A null or empty text is only its end id.  Rows of one id follow each other,
    ordered by their text.  An empty table writes a folder without frames.  The
    vocabulary must fit unsigned 16-bit ids.  Other columns are not read.  The
    session's Arrow batches get small (``small_batches``).
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("tie"))
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")

    def frame_row(part, frame, before, ids, lens, parts):
        ids, lens, flat = pa.concat_arrays(ids), np.concatenate(lens), np.concatenate(parts)
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([frame], pa.int32()), pa.array([before], pa.int64()),
            pa.array([flat.size], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids),
            pa.ListArray.from_arrays([0, len(ids)], pa.array(lens, pa.int32())),
            pa.array([range_coder.encode(flat)], pa.list_(pa.binary()))],
            ["part", "frame", "ids_before", "n_ids", "docs", "lengths", "blocks"]), flat.size

    def run(batches):
        part, frame, before = TaskContext.get().partitionId(), 0, 0
        tok = tokenizer(tokenizer_file)
        ids, lens, parts, held = [], [], [], 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                flat, n = tok.encode_column(batch.column("text"), end_id)
                ids.append(batch.column("id"))
                lens.append(n)
                parts.append(flat)
                held += flat.size
                if held >= FRAME:
                    row, n = frame_row(part, frame, before, ids, lens, parts)
                    yield row
                    frame, before, ids, lens, parts, held = frame + 1, before + n, [], [], [], 0
        if ids:
            yield frame_row(part, frame, before, ids, lens, parts)[0]
        release_memory()

    ordered.mapInArrow(run, FRAME_SCHEMA).write.mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` (of the ids as little-endian 32-bit
    numbers); every block's checksum is checked."""
    ship_package(spark)
    frames = spark.read.schema(FRAME_SCHEMA).parquet(path)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per written part: the number of tasks of the writing job.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("part_start"))
    placed = frames.join(F.broadcast(begins), "part").select(
        (F.col("part_start") + F.col("ids_before")).alias("start"), "n_ids", "docs", "lengths", "blocks")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = np.ascontiguousarray(range_coder.decode(row["blocks"], row["n_ids"]), "<u4")
                lens = np.asarray(row["lengths"], np.int64)
                ends = np.cumsum(lens)
                raw = memoryview(ids).cast("B")
                crcs = [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(ends.tolist(), lens.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["docs"], pa.int64()), pa.array(row["start"] + ends - lens, pa.int64()),
                    pa.array(lens, pa.int64()), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])
        release_memory()

    return placed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
