"""SentencePiece (BPE) encoding by prefix tables, and decoding.

For merge-built vocabularies every prefix of a text has one last token, and a
piece that ends at a position is that token exactly if it is compatible with
the last token of the prefix before it: merging the two pieces' characters from
scratch gives the two pieces again.  An automaton of all pieces yields the
pieces ending at each position; the table of last tokens is filled from left to
right, and the ids are read off backwards.

Where no piece holds a word mark after another character, a mark that follows
another character always starts a new token, so the table is filled per such
stretch and repeated stretches are looked up.  The normalisation and the
decoding are the library's own.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from issuelens.llm.common import release_memory, ship_package, small_batches, text_bytes

MARK = "▁"
#: Entries of the lookup tables of a worker.  Of the stretches two generations are
#: kept, so that what is met often stays; the pairs start anew.  A worker at work takes some
#: 80 MB more than an idle one (140 MB with 300,000 stretches and slices of 2 MB).
STRETCHES, PAIRS, LONGEST = 100_000, 600_000, 48
_NO_PIECE = 1 << 24  # with the character's number: a character without a piece
SLICE_BYTES = 2 << 20
ENCODE_BYTES = 512 << 10  # a slice whose ids become Python numbers to be decoded
_NEVER = float("inf")


def merge_all(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """Merge neighbours, the best-scored result first, the leftmost of equals."""
    symbols = list(symbols)
    while len(symbols) > 1:
        best = None
        for i in range(len(symbols) - 1):
            c = cost.get(symbols[i] + symbols[i + 1])
            if c is not None and (best is None or c < best[0]):
                best = (c, i)
        if best is None:
            break
        i = best[1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
    return symbols


class PrefixEncoder:
    """Encoder of one model file; built once per worker."""

    def __init__(self, model_file: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.library = sp
        n = sp.vocab_size()
        special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
        pieces = {sp.id_to_piece(i): i for i in range(n) if not special(i)}
        self.cost = {p: -sp.get_score(i) for p, i in pieces.items()}
        self.end_id = sp.eos_id()
        self.unknown = sp.unk_id()
        self.bytes = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.automaton = ahocorasick.Automaton()
        for p, i in pieces.items():
            if len(p) == 1 or merge_all(list(p), self.cost) == [p]:  # a piece that merging yields
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        inner = any(MARK in p.lstrip(MARK) for p in pieces)
        self.split = (lambda s: [s]) if inner else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def compatible(self, left: str, right: str) -> bool:
        """True if merging the characters of both ends with these two tokens: no
        merge ever takes characters from both."""
        cost, symbols, border = self.cost, [*left, *right], len(left)
        costs = [cost.get(symbols[i] + symbols[i + 1], _NEVER) for i in range(len(symbols) - 1)]
        while costs:
            least = min(costs)
            if least == _NEVER:
                break
            i = costs.index(least)
            if i == border - 1:
                return False
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del costs[i]
            if i < border:
                border -= 1
            if i < len(costs):
                costs[i] = cost.get(symbols[i] + symbols[i + 1], _NEVER)
            if i:
                costs[i - 1] = cost.get(symbols[i - 1] + symbols[i], _NEVER)
        return len(symbols) == 2

    def last_tokens(self, s: str) -> list[int]:
        """The id of the last token of each prefix of ``s``; -1 where that is a
        character without a piece."""
        last = [-1] * (len(s) + 1)
        pairs = self.pairs
        for end, (size, token) in self.automaton.iter(s):
            end += 1
            if last[end] < 0:
                start = end - size
                if start:
                    left = last[start]
                    if left < 0:
                        left = _NO_PIECE + ord(s[start - 1])
                    ok = pairs.get(left << 32 | token)
                    if ok is None:
                        if len(pairs) >= PAIRS:
                            pairs.clear()
                        known = self.pieces[left] if left < _NO_PIECE else s[start - 1]
                        ok = pairs[left << 32 | token] = self.compatible(known, self.pieces[token])
                    if ok:
                        last[end] = token
                else:
                    last[end] = token
        return last

    def _char_ids(self, c: str) -> list[int]:
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[f"<0x{b:02X}>"] for b in c.encode("utf-8")]

    def stretch(self, s: str) -> bytes:
        last, out, i = self.last_tokens(s), [], len(s)
        while i:
            token = last[i]
            if token < 0:
                out.extend(reversed(self._char_ids(s[i - 1])))
                i -= 1
            else:
                out.append(token)
                i -= len(self.pieces[token])
        out.reverse()
        return array("i", out).tobytes()

    def encode(self, text: str, end: bool = True) -> np.ndarray:
        known, parts = self.known, []
        for s in self.split(self.library.normalize(text)) if text else ():
            ids = known.get(s)
            if ids is None:
                ids = self.older.get(s) or self.stretch(s)
                if len(s) <= LONGEST:
                    if len(known) >= STRETCHES:
                        self.older, self.known = known, {}
                        known = self.known
                    known[s] = ids
            parts.append(ids)
        if end:
            parts.append(array("i", [self.end_id]).tobytes())
        return np.frombuffer(b"".join(parts), dtype=np.int32)

    def rest(self) -> None:
        """Between tasks only the newer generation of stretches is kept."""
        self.older = {}
        release_memory()

    def decode(self, ids: Sequence[np.ndarray]) -> list[str]:
        """The texts of the ids, by one thread: a task has one core, and each thread its own heap."""
        return self.library.decode([x.tolist() for x in ids], num_threads=1) if ids else []


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(model_file: str) -> PrefixEncoder:
    if model_file not in _ENCODERS:
        _ENCODERS[model_file] = PrefixEncoder(model_file)
    return _ENCODERS[model_file]


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of at most about ``limit`` text bytes (one row at least)."""
    _, at = text_bytes(batch.column(text_col))
    start, n = 0, batch.num_rows
    while start < n:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def encode_texts(docs: DataFrame, model_file: str, carry: Sequence[str] = ("doc_id",), text_col: str = "text",
                 decode: bool = True) -> DataFrame:
    """``carry`` columns with ``ids`` (array of int, end id last) and, with ``decode``,
    ``decoded`` (the text that the library makes of those ids).

    A null text is encoded as an empty one (only the end id).  Rows are
    independent, so repeats and ties are nothing special; an empty table gives
    an empty table.  ``ids`` and ``decoded`` replace carried columns of these
    names.  ``model_file`` must be readable at that path on every executor.
    The session's Arrow batches get small (``small_batches``).
    """
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    names = [c for c in carry if c not in ("ids", "decoded")]
    rows = docs.select(*names, *[] if text_col in names else [text_col])
    fields = [rows.schema[c] for c in names] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
    fields += [T.StructField("decoded", T.StringType(), False)] if decode else []

    def run(batches):
        enc = encoder(model_file)
        for whole in batches:
            for batch in slices(whole, text_col, ENCODE_BYTES):
                texts = batch.column(text_col).to_pylist()
                ids = [enc.encode(t or "") for t in texts]
                at = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=at[1:])
                cols = [batch.column(c) for c in names]
                cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids))))
                if decode:
                    cols.append(pa.array(enc.decode(ids), pa.string()))
                yield pa.RecordBatch.from_arrays(cols, [*names, "ids", "decoded"][:len(cols)])
        whole = batch = texts = ids = cols = None
        enc.rest()

    return rows.mapInArrow(run, T.StructType(fields))
