"""Line deduplication over a corpus.

Lines are exploded with their position, normalised (stripped, A-Z lower-cased)
and hashed to 128 bits; the distinct documents of each hash are counted; lines
whose key is in too many documents go, except in the largest document id that
holds it; the rest are put together again by position.

Only narrow rows (document, position, hash) are exploded and shuffled for the
counts.  Texts of documents that lose a line are shuffled once, to meet the
positions they lose; the others stay where they are.
A line held by a third of all documents is counted by partial aggregates, and
the join back to its holders is a plain equi-join that adaptive execution
splits (both sides are written tables).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import Stages, ascii_lower, doc_key, split_by_keys, strip_white

DOC, ROW, KEY, LINES, POS, LINE, H1, H2, KEEPER, LOST, KEEP = (
    "__ld_" + n for n in ("doc", "row", "key", "lines", "pos", "line", "h1", "h2", "keeper", "lost", "keep"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text_col: str = "text",
               id_col: str = "doc_id", n_lines_col: str = "n_lines",
               n_dropped_col: str = "n_dropped") -> DataFrame:
    """``docs`` with repeated lines removed from ``text_col``, and two long columns
    (lines before, lines dropped) that replace input columns of these names.

    A null or empty text is one empty line and comes back empty.  A null id
    counts as one document below all ids.  Rows that share an id count as one
    document; each keeps or loses its own lines.  A very long text is one array of
    lines in one row.  An empty table gives an empty table.  Other columns pass through, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    stages = Stages(docs.sparkSession)
    base = docs.withColumns({DOC: doc_key(id_col), ROW: F.xxhash64(text), LINES: F.split(text, "\n")})
    key = ascii_lower(strip_white(F.col(LINE)))
    lines = (base.select(DOC, ROW, F.posexplode(LINES).alias(POS, LINE))
             .select(DOC, ROW, POS, key.alias(LINE))
             .where(F.length(LINE) >= min_chars)
             .select(DOC, ROW, POS, F.xxhash64(LINE).alias(H1), F.xxhash64(F.lit(1), F.col(LINE)).alias(H2)))
    lines = stages.write("lines", lines)
    repeated = (lines.select(H1, H2, DOC).distinct()
                .groupBy(H1, H2).agg(F.count(F.lit(1)).alias(POS), F.max(DOC).alias(KEEPER))
                .where(F.col(POS) >= min_docs).drop(POS))
    repeated = stages.write("repeated-lines", repeated)
    lost = (lines.join(repeated, [H1, H2]).where(F.col(DOC) < F.col(KEEPER))
            .groupBy(DOC, ROW).agg(F.collect_set(POS).alias(LOST)).withColumn(KEY, F.xxhash64(DOC, ROW)))
    lost = stages.write("lost-lines", lost)
    stages.drop("lines", "repeated-lines")
    # Only documents that may lose a line are shuffled, to meet their positions.
    whole, perhaps = split_by_keys(base.withColumn(KEY, F.xxhash64(DOC, ROW)), lost, KEY)
    none = F.lit(None).cast(lost.schema[LOST].dataType).alias(LOST)
    joined = whole.select("*", none).drop(KEY).unionByName(perhaps.drop(KEY).join(lost.drop(KEY), [DOC, ROW], "left"))
    every = F.sequence(F.lit(0), F.size(LINES) - 1)
    joined = joined.withColumn(KEEP, F.when(F.col(LOST).isNotNull(), F.array_except(every, F.col(LOST))))
    kept_text = F.array_join(F.transform(KEEP, lambda i: F.get(F.col(LINES), i)), "\n")
    n_kept = F.when(F.col(KEEP).isNull(), F.size(LINES)).otherwise(F.size(KEEP))
    out = joined.withColumns({
        text_col: F.when(F.col(KEEP).isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(kept_text),
        n_lines_col: F.size(LINES).cast("long"),
        n_dropped_col: (F.size(LINES) - n_kept).cast("long")})
    return out.drop(DOC, ROW, LINES, LOST, KEEP)
