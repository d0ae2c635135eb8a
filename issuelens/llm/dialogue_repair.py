"""Repair of conversations whose roles do not alternate, with the cheapest edits.

A conversation should have role initials ``(s?(ua)+)?``.  Rows are kept, deleted or
given another role, and empty rows are inserted.  Seen from a row, what counts is
the state before it (start, after s, after u, after a), and the cost of the rest
from each state: a vector of four numbers, which a row changes by sums and
minima.  The costs of a conversation are found as a rank-convergence parallel
Viterbi does it:

1. A conversation is cut into chunks of ``CHUNK`` rows, a byte a row.  Every chunk
   is run backwards from a speculative vector, that of the conversation's end;
   for the last chunk, and so for any conversation of one, this is the true one.
2. Fix-up passes: a chunk whose right neighbour came out with another vector than
   the one it began with is run again from that, until its vector and that of the
   run before differ only by a constant; then the rest of the run before holds.
   Only chunks right of which something changed take part in the next pass.
3. Costs forget what is right of them after few rows, unless a chunk's rows leave
   no choice (say, only repeats).  If chunks still change after ``PASSES`` passes,
   they are run from the four unit vectors instead, which gives their effect on
   any vector, and the effects are combined in a tree of ``FAN`` chunks a node.
4. The backward costs of a chunk, now those of the whole conversation but for a
   constant, say which edits are cheapest.  From every state the chunk's least
   audit is traced; the same tree then tells with which state each chunk begins.

Vectors that differ by a constant choose the same edits, so all are kept with least
member 0.  There are few of those, and a row's step on one is looked up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import Stages, ship_package
from issuelens.operators.sequence import sequence_rows

CHUNK = 128
PASSES = 4
FAN = 1024
BLANK = "[^\\x20\\x09-\\x0D]"
# Costs of the edits, and of a truncated row that stays.
RENAME, DELETE, INSERT, CUT = 3, 4, 3, 3
# States: 0 start, 1 after s, 2 after u, 3 after a.  The state after one more user or assistant row:
NEXT = (2, 2, 3, 2)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "": {}}
END = (0, 6, 3, 0)
FAR = 1 << 50
# A row's byte: 0 must be deleted, else 1 + place of its initial in ROLES, 4 more if truncated.
ROLES = ("s", "u", "a", "")
UNITS = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))

Vector = tuple[int, ...]


def _choices(code: int) -> tuple[dict, int] | None:
    """States after keeping the row, and what it costs to leave it in; None if it must go."""
    return (KEPT[ROLES[(code - 1) % 4]], CUT if code > 4 else 0) if code else None


@lru_cache(maxsize=None)
def costs(after: Vector, code: int) -> Vector:
    """Cost vector before a row, from that after it."""
    out = [DELETE + c for c in after]
    if way := _choices(code):
        kept, cut = way
        for q in range(4):
            out[q] = min(out[q], RENAME + cut + after[NEXT[q]], cut + after[kept[q]] if q in kept else FAR)
    for _ in range(2):
        out = [min(out[q], INSERT + out[NEXT[q]]) for q in range(4)]
    return tuple(min(c, FAR) for c in out)


def level(v: Vector) -> Vector:
    """The vector less its least member; what is out of reach stays so."""
    least = min(v)
    return tuple(c if c >= FAR else c - least for c in v)


@lru_cache(maxsize=None)
def back(after: Vector, code: int) -> Vector:
    return level(costs(after, code))


@lru_cache(maxsize=None)
def edit(after: Vector, code: int, q: int) -> tuple[str, int, int]:
    """The least edits of one row from state ``q``: letters, the state after, their cost.
    I and R stand for user rows; J and S are I and R for assistant rows."""
    before, out, cost = costs(after, code), "", 0
    way = _choices(code)
    while True:
        n = NEXT[q]
        if before[q] == DELETE + after[q]:
            return out + "D", q, cost + DELETE
        if before[q] == INSERT + before[n]:
            out, q, cost = out + ("I" if n == 2 else "J"), n, cost + INSERT
            continue
        kept, cut = way
        if q in kept and before[q] == cut + after[kept[q]]:
            return out + "K", kept[q], cost + cut
        return out + ("R" if n == 2 else "S"), n, cost + RENAME + cut


def run_back(codes: bytes, after: Vector, known: Vector | None = None, stop: Vector | None = None) -> Vector:
    """The vector before a chunk.  ``known`` began the run before, which gave ``stop``:
    where the two runs meet, that is the result."""
    for code in reversed(codes):
        after = back(after, code - 48)
        if known is not None:
            known = back(known, code - 48)
            if known == after:
                return stop
    return after


def effect(codes: bytes) -> list[int]:
    """Vectors before a chunk for the four unit vectors after it, one after the other."""
    out = []
    for v in UNITS:
        paid = 0
        for code in reversed(codes):
            paid += min(costs(v, code - 48))
            v = back(v, code - 48)
        out.extend(c if c >= FAR else c + paid for c in v)
    return out


def after_effect(e: list[int], v: list[int]) -> list[int]:
    return list(level(tuple(min(FAR, *(e[4 * j + q] + v[j] for j in range(4))) for q in range(4))))


def joined_effects(first: list[int], then: list[int]) -> list[int]:
    return [min(FAR, *(then[4 * j + q] + first[4 * i + j] for j in range(4))) for i in range(4) for q in range(4)]


def trace(codes: bytes, after: Vector, q: int, last: bool) -> tuple[list[str], int, int]:
    """Edits of each row of a chunk from state ``q`` (and those behind the last row), the
    state after it, and the edits' cost."""
    vectors = [after]
    for code in reversed(codes):
        vectors.append(back(vectors[-1], code - 48))
    out, cost = [], 0
    for code, v in zip(codes, reversed(vectors[:-1])):
        letters, q, paid = edit(v, code - 48, q)
        out.append(letters)
        cost += paid
    tail = ""
    while last and END[q]:
        q = NEXT[q]
        tail, cost = tail + ("I" if q == 2 else "J"), cost + INSERT
    return out + [tail], q, cost


def _each(rows: DataFrame, columns: str, make: Callable[[pd.Series], tuple]) -> DataFrame:
    """``make`` gives the named columns of a row beside its key and chunk."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [make(r) for r in frame.itertuples(index=False)]
            out = pd.DataFrame(made, columns=names, index=frame.index)
            out.insert(0, "key", frame["key"])
            out.insert(1, "chunk", frame["chunk"])
            yield out
    return rows.mapInPandas(run, f"key string, chunk long, {columns}")


def scan(rows: DataFrame, start: list[int], apply: Callable, combine: Callable, stages: Stages, depth: int = 0) -> DataFrame:
    """(key, at, value): what reaches place ``at`` (0, 1, ...) of a key when ``start`` goes
    through the ``op``s of the places before it.  ``rows`` has (key, at, op).

    Places are put into nodes of ``FAN`` neighbours, whose ops are combined to one; the
    nodes' values come from the same scan over the nodes.
    """
    node = F.call_function("div", F.col("at"), F.lit(FAN)).alias("chunk")
    listed = rows.groupBy("key", node).agg(F.array_sort(F.collect_list(F.struct("at", "op"))).alias("of"))
    nodes = stages.write(f"nodes-{depth}", listed.select("key", "chunk", F.col("of.at").alias("places"), F.col("of.op").alias("ops")))
    if nodes.agg(F.max("chunk")).first()[0]:
        sums = _each(nodes, "op array<long>", lambda r: (list(reduce(combine, r.ops)),))
        reach = scan(sums.select("key", F.col("chunk").alias("at"), "op"), start, apply, combine, stages, depth + 1)
        nodes = nodes.join(reach.withColumnRenamed("at", "chunk"), ["key", "chunk"])
    else:
        nodes = nodes.withColumn("value", F.array(*[F.lit(x).cast("long") for x in start]))

    def spread(r):
        reached = list(accumulate(r.ops, lambda v, op: apply(op, v), initial=list(r.value)))
        return r.places, reached[:-1]
    found = _each(nodes, "places array<long>, reached array<array<long>>", spread)
    found = found.select("key", F.explode(F.arrays_zip("places", "reached")).alias("p"))
    return found.select("key", F.col("p.places").alias("at"), F.col("p.reached").alias("value"))


def _cost_vectors(chunks: DataFrame, stages: Stages) -> DataFrame:
    """(key, chunk, after): the true vector, less a constant, behind each chunk of the
    conversations that have several."""
    first = _each(chunks, "guess array<long>, left array<long>",
                  lambda r: (list(END), list(run_back(r.codes.encode(), END))))
    runs = [stages.write("run-0", first)]
    moved = runs[0]
    for k in range(1, PASSES + 1):
        new = moved.select("key", (F.col("chunk") - 1).alias("chunk"), F.col("left").alias("new"))
        states = runs[0]
        for r in runs[1:]:
            later = r.select("key", "chunk", F.col("guess").alias("guess_"), F.col("left").alias("left_"))
            states = states.join(later, ["key", "chunk"], "left").select(
                "key", "chunk", F.coalesce("guess_", "guess").alias("guess"), F.coalesce("left_", "left").alias("left"))
        work = states.join(new, ["key", "chunk"]).where("new <> guess").join(chunks.select("key", "chunk", "codes"), ["key", "chunk"])

        def again(r):
            new_, old, left = tuple(r.new), tuple(r.guess), tuple(r.left)
            out = run_back(r.codes.encode(), new_, old, left)
            return list(new_), list(out), out != left
        run = stages.write(f"run-{k}", _each(work, "guess array<long>, left array<long>, moved boolean", again))
        runs.append(run.select("key", "chunk", "guess", "left"))
        moved = run.where("moved").select("key", "chunk", "guess", "left")
        if moved.isEmpty():
            break
    else:
        open_ = moved.select("key").distinct()
        effects = _each(chunks.join(open_, "key"), "at long, op array<long>",
                        lambda r: (r.last - r.chunk, effect(r.codes.encode()))).select("key", "at", "op")
        exact = scan(effects, list(END), after_effect, joined_effects, stages)
        lasts = chunks.select("key", "chunk", (F.col("last") - F.col("chunk")).alias("at"))
        runs.append(exact.join(lasts, ["key", "at"]).select("key", "chunk", F.col("value").alias("guess"), F.col("value").alias("left")))
    out = None
    for k, r in enumerate(runs):
        r = r.select("key", "chunk", F.struct(F.lit(k).alias("k"), "guess").alias("g"))
        out = r if out is None else out.union(r)
    return stages.write("cost-vectors", out.groupBy("key", "chunk").agg(F.max("g").alias("g")).select(
        "key", "chunk", F.col("g.guess").alias("after")))


def _edits(chunks: DataFrame, stages: Stages) -> DataFrame:
    """(key, chunk, edits, cost) of every chunk (key, chunk, last, codes)."""
    chunk = "edits array<string>, cost long"
    alone = _each(chunks.where("last = 0"), chunk, lambda r: trace(r.codes.encode(), END, 0, True)[::2])
    several = chunks.where("last > 0")
    if several.isEmpty():
        return alone
    several = stages.write("chunks-of-several", several.join(_cost_vectors(several, stages), ["key", "chunk"]))
    ways = _each(several, "op array<long>", lambda r: (
        [trace(r.codes.encode(), tuple(r.after), q, False)[1] for q in range(4)],)).select("key", F.col("chunk").alias("at"), "op")
    begins = scan(ways, [0], lambda op, v: [int(op[v[0]])], lambda a, b: [int(b[int(q)]) for q in a], stages)
    begins = begins.select("key", F.col("at").alias("chunk"), F.col("value")[0].alias("start"))
    rest = _each(several.join(begins, ["key", "chunk"]), chunk, lambda r: trace(
        r.codes.encode(), tuple(r.after), int(r.start), r.chunk == r.last)[::2])
    return alone.union(rest)


def conversation_key(conv_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit(""))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, edits) of the rows of ``turns``.

    ``conversations`` has a row for each conversation: ``key`` (``conversation_key``),
    ``gaps`` (missing turn numbers), the rows whose first fault is ``blank``,
    ``duplicate`` or ``truncated``, ``illegal`` (neighbours whose role initials are
    not su, ua or au) and ``cost`` of the cheapest repair.  ``edits`` has the repair
    itself: ``key``, ``pos`` (row in the conversation, from 1; inserted rows have that
    of the row they precede), ``nth`` (order within), ``edit`` (D, I, K or R), and
    ``role`` and ``text`` of what comes out (null for D).  Of the cheapest repairs
    it is the one whose letters are least.

    Rows go by turn (nulls first), ties by role and text; rows that are equal are
    duplicates of the first.  A null role or text is one space, so such a text is
    blank; a null conversation is one of its own.  Other roles go by their first
    character and are no state of the pattern, so they are renamed or deleted.
    Extra columns are not read.  An empty table gives empty tables.  A long
    conversation is many chunks; no step holds its rows together.
    """
    spark = turns.sparkSession
    ship_package(spark)
    stages = Stages(spark)
    space = F.lit(" ")
    rows = turns.select(conversation_key(conv_col).alias("key"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), space).alias("role"), F.coalesce(F.col(text_col), space).alias("text"))
    rows = stages.write("turns", rows.withColumn("initial", F.substring("role", 1, 1)))
    placed = sequence_rows(rows, ["key"], [F.col("turn").asc_nulls_first(), "role", "text"], ["initial"], step_col="pos",
                           size_col="rows")
    placed = stages.write("placed-turns", placed)
    told = F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))
    stripped = F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    state = placed.select("key", "pos", "rows", "turn", "initial", "prev_initial", told.alias("told"),
                          (stripped == "").alias("blank"),
                          (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("cut"))
    firsts = state.groupBy("key", "told").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("is_first"))
    state = state.join(firsts, ["key", "pos"], "left")
    again = ~F.col("blank") & F.col("is_first").isNull()
    cut = ~F.col("blank") & F.col("is_first").isNotNull() & F.col("cut")
    role = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES[:3])), F.col("initial")), F.lit(0))
    role = F.when(role > 0, role).otherwise(F.lit(4))
    state = state.select("key", "pos", "rows", "turn", F.col("blank"), again.alias("again"), cut.alias("cut"),
                         (F.concat("prev_initial", "initial").isin("su", "ua", "au")).alias("legal"),
                         F.when(F.col("blank") | again, 0).when(cut, role + 4).otherwise(role).cast("int").alias("code"))
    state = stages.write("turn-states", state)

    number = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")
    counts = state.groupBy("key").agg(gaps.alias("gaps"), number(F.col("blank")).alias("blank"), number(F.col("again")).alias("duplicate"),
                                      number(F.col("cut")).alias("truncated"), number(~F.col("legal")).alias("illegal"))
    of = lambda c: F.call_function("div", F.col(c) - 1, F.lit(CHUNK)).alias
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"].cast("string"))
    chunks = state.groupBy("key", of("pos")("chunk"), of("rows")("last")).agg(F.array_join(listed, "").alias("codes"))
    chunks = stages.write("chunks", chunks)
    done = stages.write("chunk-edits", _edits(chunks, stages))
    conversations = counts.join(done.groupBy("key").agg(F.sum("cost").alias("cost")), "key")

    each = done.select("key", "chunk", F.posexplode("edits").alias("row", "letters"))
    each = each.select("key", (F.col("chunk") * CHUNK + F.col("row") + 1).alias("pos"),
                       F.posexplode(F.split(F.col("letters"), "")).alias("nth", "letter")).where("letter <> ''")
    stays = placed.select("key", "pos", "role", "text")
    joined = each.where("letter in ('K', 'R', 'S')").join(stays, ["key", "pos"]).select(
        "key", "pos", "nth", "letter", F.when(F.col("letter") == "R", "user").when(F.col("letter") == "S", "assistant")
        .otherwise(F.col("role")).alias("role"), "text")
    other = each.where("letter in ('D', 'I', 'J')").select(
        "key", "pos", "nth", "letter", F.when(F.col("letter") == "I", "user").when(F.col("letter") == "J", "assistant").alias("role"),
        F.when(F.col("letter") != "D", "").alias("text"))
    edits = joined.union(other).withColumn("letter", F.translate("letter", "JS", "IR")).withColumnRenamed("letter", "edit")
    return conversations, edits


def digests(edits: DataFrame) -> DataFrame:
    """(key, audit, repaired_sha256): the edits' letters, and the digest of the repaired
    rows as ``role:text`` lines.  A digest goes through a text from its beginning,
    so one task reads a conversation's rows in order, and holds none but its audit."""
    rows = edits.repartition("key").sortWithinPartitions("key", "pos", "nth").select("key", "edit", "role", "text")

    names = ["key", "audit", "repaired_sha256"]

    def batch(done):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (zip(*done) if done else ([], [], []))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, sha, lines = None, [], None, 0
        for rows_ in batches:
            out = []
            for k, letter, role, text in zip(*(rows_.column(c).to_pylist() for c in ("key", "edit", "role", "text"))):
                if k != key:
                    if key is not None:
                        out.append((key, "".join(audit), sha.hexdigest()))
                    key, audit, sha, lines = k, [], hashlib.sha256(), 0
                audit.append(letter)
                if letter != "D":
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            yield batch(out)
        if key is not None:
            yield batch([(key, "".join(audit), sha.hexdigest())])
    return rows.mapInArrow(run, "key string, audit string, repaired_sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with the faults that the hash of ``conv_id:turn`` tells, nulls as one
    space (a null turn stays null): 0 drops the row, 1 empties its text, 2 takes
    the sentence ends out, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    text = lambda c: F.coalesce(F.col(c).cast("string"), space)
    fate = (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("fate")
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fate).where("fate <> 0")
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", ""))
                       .otherwise(F.col("text")).alias("text"), times.alias("nth")).drop("nth")
