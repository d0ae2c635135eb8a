"""Mixing sources to target weights by hash thresholds.

Each source gets a target number of words (weights, a total budget, and a cap
on repetition; what a capped source cannot take is shared again by weight).
A target is met without sorting any document: words are summed by source and
hash bucket, the bucket in which the budget ends is found from at most 1,024
sums per source, and only the documents of that bucket are summed again by the
next ten hash bits.  After four levels a source's rule is one 40-bit threshold,
and the documents are picked by a filter.

Documents are never gathered by source: every sum is a partial aggregate, and
the per-source rules are a small written table that Spark broadcasts or joins
by its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from issuelens.llm.common import words
from issuelens.operators.sequence import global_rank
from issuelens.operators.stage import materialize

LEVEL_BITS, LEVELS, HASH_BITS = 10, 4, 60
SRC, SIZE, HASH, CUT, BASE, LEFT, SUM, CUM, WEIGHT, RANK = (
    "__mx_" + n for n in ("src", "size", "hash", "cut", "base", "left", "sum", "cum", "weight", "rank"))


def source_targets(sizes: DataFrame, weights: Sequence[int], budget: float, max_repeat: float) -> DataFrame:
    """One row per source: its size, weight and target.

    ``sizes``: (source key, name, words).  Sources in code point order (null
    last) take ``weights`` in turn.  The target is ``min(cap, level * weight)``
    where the level shares the budget that capped sources leave.  Each pass
    reads one row of two sums, so the number of sources is not bounded.
    """
    ranked = global_rank(sizes, [F.col("source").asc_nulls_last()], name=RANK)
    turn = F.pmod(F.col(RANK) - 1, F.lit(len(weights))).cast("int")
    ranked = materialize(ranked.withColumn(WEIGHT, F.get(F.array(*map(F.lit, weights)), turn)), "source-weights")
    cap = F.col(SIZE) * F.lit(float(max_repeat))
    total = ranked.agg(F.sum(SIZE)).first()[0] or 0
    level = 0.0
    while total:
        capped = cap < F.lit(level) * F.col(WEIGHT)
        row = ranked.agg(F.sum(F.when(capped, cap).otherwise(0.0)).alias("c"),
                         F.sum(F.when(~capped, F.col(WEIGHT)).otherwise(0)).alias("w")).first()
        if not row["w"]:
            break
        new = (budget * total - row["c"]) / row["w"]
        if new <= level:
            break
        level = new
    return ranked.withColumn("target", F.least(cap, F.lit(level) * F.col(WEIGHT)))


def _cut(sums: DataFrame, prefix: str, rules: DataFrame, last: bool) -> DataFrame:
    """Per source the bucket in which its remaining budget ends, and what is left
    for that bucket."""
    order = Window.partitionBy(SRC).orderBy(prefix)
    upto = sums.withColumn(CUM, F.sum(SUM).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = (upto.join(rules.select(SRC, LEFT), SRC).where(F.col(CUM) > F.col(LEFT))
            .groupBy(SRC).agg(F.min(F.struct(prefix, CUM, SUM, LEFT)).alias("e")))
    before = F.col("e")[CUM] - F.col("e")[SUM]
    left = F.col("e")[LEFT] - before
    cut = F.col("e")[prefix]
    if last:  # take the last bucket too where that comes nearer to the target
        cut = cut + F.when(F.col("e")[SUM] - left < left, 1).otherwise(0)
    return ends.select(SRC, cut.alias(CUT), left.alias(LEFT))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5,
                max_repeat: float = 2.0, text_col: str = "text", id_col: str = "doc_id",
                source_col: str = "source", out: Sequence[str] = ("size", "source_size", "target", "copies")) -> DataFrame:
    """``docs`` with four columns: the document's words, its source's words, the
    source's target and how often the mix takes the document (0 to ``max_repeat``,
    rounded up).

    The columns replace input columns of the same names.  Null or empty texts
    have size 0; a null source is a source of its own; the pick depends on id
    and text alone, so identical rows share their fate and reruns agree.  An
    empty table gives an empty table, a corpus without words has targets of 0.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n"))
    mark = F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text)))
    hash60 = F.conv(F.substring(mark, 1, HASH_BITS // 4), 16, 10).cast("long")
    base = docs.withColumns({SRC: key, SIZE: F.size(words(F.col(text_col))).cast("long"), HASH: hash60})
    narrow = materialize(base.select(SRC, F.col(source_col).alias("source"), SIZE, HASH), "mix-sizes")

    sizes = narrow.groupBy(SRC, "source").agg(F.sum(SIZE).alias(SIZE))
    targets = source_targets(sizes, weights, budget, max_repeat)
    whole = F.when(F.col(SIZE) > 0, F.floor(F.col("target") / F.col(SIZE))).otherwise(0).cast("int")
    rules = materialize(targets.select(
        SRC, F.col(SIZE).alias(SUM), "target", whole.alias(BASE),
        (F.col("target") - whole * F.col(SIZE)).alias(LEFT)), "mix-targets")

    left, prefix = rules, "__mx_p"
    for level in range(1, LEVELS + 1):
        rows = narrow.withColumn(prefix, F.shiftright(HASH, HASH_BITS - LEVEL_BITS * level))
        if level > 1:
            outer = F.shiftright(HASH, HASH_BITS - LEVEL_BITS * (level - 1))
            rows = rows.withColumn(CUT, outer).join(left.select(SRC, CUT), [SRC, CUT], "left_semi")
        sums = rows.groupBy(SRC, prefix).agg(F.sum(SIZE).alias(SUM))
        left = materialize(_cut(sums, prefix, left, level == LEVELS), "mix-cut")

    # No cut: the budget beyond the whole copies holds no word.  Where nothing is left
    # beyond them, documents without words before the cut get no further copy either.
    cut = F.when(F.col(LEFT) > 0, F.col(CUT))
    picks = materialize(rules.join(left.select(SRC, CUT), SRC, "left")
                        .select(SRC, F.col(SUM), "target", BASE, F.coalesce(cut, F.lit(0)).alias(CUT)), "mix-rules")
    names = dict(zip(("size", "source_size", "target", "copies"), out))
    picks = picks.select(SRC, F.col(SUM), F.col("target").alias("__mx_target"), BASE, CUT)
    extra = (F.shiftright(HASH, HASH_BITS - LEVEL_BITS * LEVELS) < F.col(CUT)).cast("int")
    joined = base.join(picks, SRC)
    joined = joined.withColumns({
        "__mx_copies": F.col(BASE) + extra})
    cols = [c for c in docs.columns if c not in out]
    return joined.select(*cols, F.col(SIZE).alias(names["size"]), F.col(SUM).alias(names["source_size"]),
                         F.col("__mx_target").alias(names["target"]), F.col("__mx_copies").alias(names["copies"]))
