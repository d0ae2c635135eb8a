"""How far the sources of a language differ in their words.

1. A text's bytes go through one translate table that lower-cases A-Z and blanks
   everything else below 0x80; the runs that are left are its terms, and a Counter
   of them gives the text's frequencies.  A task adds these up by language,
   source and term before it sends them (texts that hold the term, occurrences).
2. Partial sums by (language, source, term).  Terms in enough texts of their
   language are kept.  All later work is on counts above zero only.
3. Smoothed shares in billionths, as long numbers: a share is divided out three
   digits at a time, so nothing is rounded or overflows.
4. A language's sources are numbered and cut into blocks of ``BLOCK``.  A task holds
   some terms of a language and two blocks of its sources at a time as a small
   table, and adds up the divergences of all pairs of sources column by column:
   it sends a number for each pair, never rows for a term's pairs.  Terms that
   neither block has have the same divergence for a pair and are added at the end.

The result has a row for each ordered pair of sources of a language, so it grows
with their square by definition; what is done for it grows with the sources' terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from issuelens.llm.common import LOWER, UPPER, Stages, ship_package
from issuelens.llm.piece_bpe import slices
from issuelens.operators.sequence import sequence_rows

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
BLOCK = 64             # sources whose counts meet in one table
TERMS = 1 << 14        # terms that a task's table holds at once
HELD = 1 << 18         # terms that a task adds up before it sends them
ONE = 1 << 40          # one text, beside its occurrences
_TABLE = bytes(b if b >= 0x80 or chr(b) in LOWER else ord(chr(b).lower()) if chr(b) in UPPER else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, repeats included: runs of ASCII letters and bytes from 0x80."""
    return text.translate(_TABLE).split()


def _labels(lang_col: str, source_col: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, docs, n): added up within tasks."""
    empty = F.lit("")
    rows = docs.select(*_labels(lang_col, source_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    names = ["lang", "source", "term", "docs", "n"]

    def run(batches):
        held, size = defaultdict(dict), 0  # values: texts and occurrences in one number

        def send():
            for (lang, source), sums in held.items():
                found = list(sums.items())
                for at in range(0, len(found), 1 << 16):
                    some = found[at:at + (1 << 16)]
                    n = np.array([v for _, v in some], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang), len(some)), pa.repeat(pa.scalar(source), len(some)),
                         pa.array([t for t, _ in some], pa.binary()).cast(pa.string()),
                         pa.array(n >> 40), pa.array(n & (ONE - 1))], names)
            held.clear()

        for whole in batches:
            for batch in slices(whole, "text"):
                for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                    sums = held[lang, source]
                    size -= len(sums)
                    for term, n in Counter(terms(text)).items():
                        sums[term] = sums.get(term, 0) + n + ONE
                    size += len(sums)
                    if size > HELD:
                        yield from send()
                        size = 0
        yield from send()
    return rows.mapInArrow(run, "lang string, source string, term string, docs bigint, n bigint")


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * count / total) for ``count <= total``, exact for totals below 2 ** 53."""
    whole, rest = F.expr("0L"), count
    for _ in range(3):
        whole = whole * 1000 + F.call_function("div", rest * 1000, total)
        rest = (rest * 1000) % total
    return whole + 1


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(entries: DataFrame) -> DataFrame:
    """(lang, a, b, f, seen): divergence of sources a < b over the terms of a slice that one
    of the two blocks has, and the number of those terms.  ``entries`` has the rows
    (term, source number i, share p) of a (lang, slice, x, y), and one without
    term for each source of the blocks x and y, with the share of a count of 0."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        entry = rows["term"].notna().to_numpy()
        every, shares = rows["i"].to_numpy(), rows["p"].to_numpy()
        own, first = np.unique(every[~entry], return_index=True)
        blank, at, p = shares[~entry][first], np.searchsorted(own, every[entry]), shares[entry]
        found, term = np.unique(rows["term"].to_numpy()[entry].astype(np.int64), return_inverse=True)
        left, right = np.flatnonzero(own // BLOCK == rows["x"].iloc[0]), np.flatnonzero(own // BLOCK == rows["y"].iloc[0])
        sums = np.zeros((len(own), len(own)), np.int64)
        for start in range(0, len(found), TERMS):
            mine = (term >= start) & (term < start + TERMS)
            table = np.repeat(blank[:, None], min(TERMS, len(found) - start), axis=1)
            table[at[mine], term[mine] - start] = p[mine]
            for i in left:
                for j in right[right > i]:
                    apart = table[j] - table[i]
                    sums[i, j] += (apart * apart // (table[j] + table[i])).sum()
        pairs = [(i, j) for i in left for j in right[right > i]]
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": [own[i] for i, _ in pairs], "b": [own[j] for _, j in pairs],
                             "f": [sums[x] for x in pairs], "seen": len(found)})
    return entries.groupBy("lang", "slice", "x", "y").applyInPandas(run, "lang string, a long, b long, f long, seen long")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, text_col: str = "text",
               lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has the divergence from each
    other source of the language, part ``term`` the ``top`` kept terms that are
    commoner in the source than in its language, by their part of it.

    A term is kept where ``min_docs`` rows of its language hold it.  Values are exact
    sums of whole numbers: shares in billionths of counts plus 2, and
    ``(p - q) ** 2 // (p + q)``.  Ranks go by value, ties by the item's UTF-8 bytes.
    A null text, language or source is an empty one.  Every (language, source) of a
    row counts, also without terms; without kept terms all divergences are 0.
    Repeated rows count each.  Whole texts are read; what a task holds is bounded
    by ``HELD`` terms and one text's.  Only the three columns are read.  An empty
    table gives an empty table.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stages = Stages(spark)
    counts = stages.write("term-counts", term_counts(docs, text_col, lang_col, source_col).groupBy("lang", "source", "term")
                          .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))
    kept = stages.write("kept-terms", counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                        .where(F.col("docs") >= min_docs).select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("id")))
    entries = stages.write("kept-counts", counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "id", "n", "lang_n"))
    stages.drop("term-counts")

    # Sums by source and by language: a row for each group.
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_all"))
    groups = docs.select(*_labels(lang_col, source_col)).distinct()
    sums = entries.groupBy("lang", "source").agg(F.sum("n").alias("all"))
    groups = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
        (F.coalesce("all", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total"),
        (F.coalesce("lang_all", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("lang_total"))
    groups = sequence_rows(groups, ["lang"], ["source"], step_col="i").withColumn("i", F.col("i") - 1)
    two = F.expr("2L")
    groups = stages.write("groups", groups.withColumn("blank", F.when(F.col("v") > 0, share(two, F.col("total"))).otherwise(two)))

    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "id", "i", share(F.col("n") + 2, F.col("total")).alias("p"),
        share(F.col("lang_n") + 2, F.col("lang_total")).alias("q"))
    shares = stages.write("shares", shares)
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    said = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                        gap(F.col("p"), F.col("q")).alias("value"))
    said = said.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    cuts = -(-kept.count() // TERMS) or 1
    own = F.call_function("div", F.col("i"), F.lit(BLOCK))
    blocks = groups.groupBy("lang").agg(F.max(own).alias("last"))
    meets = F.explode(F.transform(F.sequence(F.expr("0L"), F.col("last")), lambda o: F.struct(
        F.least(o, own).alias("x"), F.greatest(o, own).alias("y"))))
    marks = groups.select("lang", F.explode(F.sequence(F.expr("0L"), F.lit(cuts - 1).cast("long"))).alias("slice"),
                          F.lit(None).cast("long").alias("id"), "i", F.col("blank").alias("p"))
    rows = shares.select("lang", (F.col("id") % cuts).alias("slice"), "id", "i", "p").union(marks)
    rows = rows.join(blocks, "lang").withColumn("__meets", meets).select(
        "lang", "slice", F.col("__meets.x").alias("x"), F.col("__meets.y").alias("y"), F.col("id").alias("term"), "i", "p")
    apart = stages.write("pair-sums", _pair_sums(rows).groupBy("lang", "a", "b").agg(
        F.sum("f").alias("f"), F.sum("seen").alias("seen")))
    one = groups.select("lang", F.col("i").alias("a"), F.col("source").alias("s1"), F.col("blank").alias("p1"), "v")
    other = groups.select("lang", F.col("i").alias("b"), F.col("source").alias("s2"), F.col("blank").alias("p2"))
    pairs = apart.join(one, ["lang", "a"]).join(other, ["lang", "b"]).withColumn(
        "value", F.col("f") + (F.col("v") - F.col("seen")) * gap(F.col("p1"), F.col("p2")))
    both = pairs.select("lang", F.explode(F.array(F.struct(F.col("s1").alias("source"), F.col("s2").alias("item")), F.struct(
        F.col("s2").alias("source"), F.col("s1").alias("item")))).alias("x"), "value")
    both = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    both = both.withColumn("rank", F.row_number().over(by_value))
    return both.union(said)
