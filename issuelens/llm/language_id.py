"""Language identification by cross-parsing against labelled text.

For each language a bounded sample of labelled text becomes a suffix automaton
over bytes.  A text is cut greedily into the longest phrases that occur in that
sample; the language whose sample needs the fewest phrases per byte wins.

The sample is fixed in size whatever the corpus: of each learned language the
same number of rows (``ROWS_PER_LANGUAGE``) gives the same number of bytes
(``EXCERPT_BYTES``), and at most ``LANGUAGES`` are learned.  So the automata are
small tables of known size that are broadcast; every text is parsed whole.  In a task the texts
are cut into runs of ``RUN`` bytes, and all runs walk the automata together as
numpy lanes, so one very long text is many lanes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from issuelens.llm.common import ship_package, text_bytes
from issuelens.llm.piece_bpe import slices
from issuelens.operators.stage import materialize

RUN = 1024
ROWS_PER_LANGUAGE = 200
EXCERPT_BYTES = 150      # of each row; 30 kB a language keep its automaton below 2 ** 16 states
LANGUAGES = 100          # learned ones: those with most rows, ties by name
SALTS = 32               # parts of a language whose smallest marks are found apart
UNKNOWN = "und"


@dataclass
class Automata:
    """Next states of all languages: ``steps[language][state * classes + class]``,
    0 where no suffix of the sample goes on; state 1 is the root.  Class 1 is
    any ASCII character but a letter; class 0 a byte that no sample holds."""
    langs: list[str]
    classes: np.ndarray      # byte -> class
    steps: list[np.ndarray]
    n_classes: int


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``data``; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def _folded(raw: np.ndarray) -> np.ndarray:
    """ASCII letters lower-cased, each run of other ASCII characters one space."""
    low = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
    low = np.where((low < 128) & ~((low >= 97) & (low <= 122)), np.uint8(32), low)
    again = np.zeros(low.size, bool)
    again[1:] = (low[1:] == 32) & (low[:-1] == 32)
    return low[~again]


def build_automata(samples: dict[str, bytes]) -> Automata:
    langs = sorted(samples)
    folded = {k: _folded(np.frombuffer(samples[k], np.uint8)) for k in langs}
    seen = np.unique(np.concatenate([*folded.values(), np.zeros(0, np.uint8)]))
    seen = seen[seen != 32]
    classes = np.zeros(256, np.uint16)
    classes[:128] = 1
    classes[97:123] = 0
    classes[seen] = np.arange(2, len(seen) + 2)
    classes[65:91] = classes[97:123]
    n = len(seen) + 2
    steps = []
    for k in langs:
        nxt = suffix_automaton(classes[folded[k]].tolist())
        table = np.zeros((len(nxt) + 1, n), np.uint16 if len(nxt) < 65535 else np.uint32)
        for state, edges in enumerate(nxt):
            for c, to in edges.items():
                table[state + 1, c] = to + 1
        steps.append(table.reshape(-1))
    return Automata(langs, classes, steps, n)


def count_phrases(model: Automata, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Phrases of each text (rows) under each language (columns)."""
    n = len(at) - 1
    out = np.zeros((n, len(model.langs)), np.int64)
    lens = np.diff(at)
    runs = -(-lens // RUN)
    owner = np.repeat(np.arange(n), runs)
    nth = np.arange(owner.size) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = at[owner] + nth * RUN
    size = np.minimum(at[owner + 1] - begin, RUN)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    if not owner.size:
        return out
    coded = model.classes[raw].astype(np.int32)
    active = np.searchsorted(-size, -np.arange(1, RUN + 1), side="right")  # lanes with more than t bytes
    for col, table in enumerate(model.steps):
        root = table[model.n_classes:2 * model.n_classes]
        state = np.ones(owner.size, np.int32)
        phrases = np.zeros(owner.size, np.int32)
        for t in range(int(size[0])):
            k = active[t]
            c = coded[begin[:k] + t]
            to = table[state[:k] * model.n_classes + c]
            miss = to == 0
            # A phrase begins with a letter, after a mismatch or at the root; what is
            # between words costs nothing.  A byte of no sample is a phrase of its own.
            phrases[:k] += (c != 1) & (miss | (state[:k] == 1))
            state[:k] = np.where(miss, np.maximum(root[c], 1), to)
        out[:, col] = np.bincount(owner, weights=phrases, minlength=n)
    return out


def learning_row(id_col: str) -> Column:
    """True for rows to learn from: crc32 of the id as text, modulo 3, is not 1 (a null id: empty text)."""
    return fold(id_col) != 1


def fold(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def learn(rows: DataFrame, text_col: str, lang_col: str, id_col: str, rows_per_language: int = ROWS_PER_LANGUAGE,
          excerpt_bytes: int = EXCERPT_BYTES, languages: int = LANGUAGES) -> Automata:
    """Automata from a bounded sample of ``rows`` with text and language.

    Learned are the ``languages`` values that most distinct rows have (ties by name; the
    others are never predicted).  Of each, the ``rows_per_language`` rows with the
    smallest hashes give an excerpt of ``excerpt_bytes`` from their middle (all of a
    shorter text), however many languages there are.  Rows without text or language
    are not learned from, repeated rows count once, an empty table gives a model without
    languages.
    """
    known = rows.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.xxhash64(text_col).cast("string"))).alias("mark"))
    # Repeated rows count once; a first cut by hash leaves some hundred marks of each
    # language, so the ranking is small.
    marks = materialize(known.select("lang", "mark").distinct(), "language-marks")
    counts = materialize(marks.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages),
                         "language-counts")
    share = F.least(F.lit(1.0), F.lit(3.0 * rows_per_language) / F.col("n"))
    part = F.conv(F.substring("mark", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    # At most ``languages`` rows: broadcast, so that the cut comes before any exchange.
    few = marks.join(F.broadcast(counts), "lang").where(part < share)
    # The smallest marks of each part of a language, then of these: no task sees all of a language.
    salt = F.pmod(F.xxhash64("mark"), F.lit(SALTS)).alias("salt")
    first = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("mark"))
    few = few.select("lang", "mark", salt).withColumn("nth", first).where(F.col("nth") <= rows_per_language)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    chosen = few.select("lang", "mark", nth.alias("nth")).where(F.col("nth") <= rows_per_language)
    # At most ``languages * rows_per_language`` rows.
    chosen = F.broadcast(materialize(chosen, "language-chosen"))
    # An excerpt from the middle of each row, where headers and shared lines are rare; a
    # character has a byte at least.
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - excerpt_bytes) / 2).cast("int"))
    excerpt = F.substring(F.col("text"), middle, F.lit(excerpt_bytes)).alias("text")
    picked = known.join(chosen, ["lang", "mark"]).select("lang", "mark", "nth", excerpt).dropDuplicates(["lang", "mark"])
    samples: dict[str, bytes] = {}
    for r in materialize(picked, "language-sample").orderBy("lang", "nth").collect():
        samples[r["lang"]] = samples.get(r["lang"], b"") + r["text"].encode("utf-8")[:excerpt_bytes] + b"\n"
    return build_automata(samples)


def predict(docs: DataFrame, model: Automata, text_col: str = "text",
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and a score from 0 (a tie with the next
    language) to 1; only the text is read for it.

    A null text, a text without a letter, or a model without languages gives
    ``und`` and 0.  Of languages that need equally few phrases the first by
    name wins.  The two columns replace input columns of these names.
    """
    ship_package(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(model)
    letters = "__li_letters"
    rows = docs.drop(*out).withColumn(letters, F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    fields = [f for f in rows.schema.fields if f.name != letters]
    schema = T.StructType([*fields, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.DoubleType())])

    def run(batches):
        automata = share.value
        langs = np.array([*automata.langs, UNKNOWN], object)
        for whole in batches:
            for batch in slices(whole, text_col, 8 << 20):
                raw, at = text_bytes(batch.column(text_col))
                has = batch.column(letters).to_numpy(zero_copy_only=False).astype(bool)
                best = np.full(batch.num_rows, len(automata.langs))
                score = np.zeros(batch.num_rows)
                if automata.langs:
                    counts = count_phrases(automata, raw, at)
                    best = np.where(has, counts.argmin(axis=1), best)
                    if len(automata.langs) > 1:
                        two = np.partition(counts, 1, axis=1)[:, :2]
                        score = np.where(has & (two[:, 1] > 0), 1 - two[:, 0] / np.maximum(two[:, 1], 1), 0.0)
                    else:
                        score = has.astype(float)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(f.name) for f in fields], pa.array(langs[best], pa.string()), pa.array(score)],
                    [*[f.name for f in fields], *out])

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """Learn from two of three folds of ``docs`` and predict all of it."""
    model = learn(docs.where(learning_row(id_col)), text_col, lang_col, id_col)
    return predict(docs, model, text_col)
