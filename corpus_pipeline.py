"""Cleaning pipeline over ``documents``: each stage works on what the one before kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  ``run`` applies them to the documents table.

1. quality_rules: documents that fail the limits or are robust outliers go.
2. line_dedup: lines that many documents hold stay only in the largest id.
3. near_duplicates: of each group of documents linked by 5-word shingles with a
   Jaccard similarity of 0.8 or more the smallest id stays, as one row.
4. source_mix: documents are taken as often as their source's target asks; one
   that is taken twice is two rows.
5. sentencepiece: the texts' token ids and the decoded texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm import line_dedup, mixing, ngram_join, piece_bpe, quality_rules
from issuelens.llm.common import doc_key, split_by_keys
from issuelens.llm.queries import tokenizer_path
from issuelens.operators.stage import materialize


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that pass the limits and are no outliers of their language and source.
    Nulls, repeated and very long rows: see ``quality_rules.score_rows``."""
    return quality_rules.quality_rules(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text without its repeated lines; ``n_chars`` is that of the new text."""
    out = line_dedup.line_dedup(docs, n_lines_col="__lines", n_dropped_col="__dropped")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows linked by their texts: the smallest id's, where a
    null id is below all others, and of equal ids the smallest hash's.  Rows are
    linked by texts alone: those that share an id, or have none, stay apart unless
    their texts are near.  Of rows that share the id and the text one stays."""
    rows = docs.withColumn("__nd_row", F.xxhash64(doc_key("doc_id"), "text"))
    groups = materialize(ngram_join.jaccard_components(rows, words=5, percent=80, id_col="__nd_row").select(
        doc_key("doc_id").alias("__nd_row"), doc_key("component_id").alias("__nd_group")), "near-groups")
    linked = groups.where("__nd_row <> __nd_group").select("__nd_group").distinct()
    members = groups.join(linked, "__nd_group").distinct()
    ids = rows.groupBy("__nd_row").agg(F.min(doc_key("doc_id")).alias("__nd_key"), F.count(F.lit(1)).alias("__nd_n"))
    ids = materialize(ids, "near-rows")
    first = F.struct("__nd_key", "__nd_row")
    members = materialize(members.join(ids, "__nd_row").select("__nd_group", "__nd_row", first.alias("__nd_first")),
                          "near-members")
    stays = members.groupBy("__nd_group").agg(F.min("__nd_first").alias("__nd_stays"))
    gone = materialize(members.join(stays, "__nd_group").where("__nd_first <> __nd_stays").select("__nd_row"),
                       "near-duplicates")
    again = materialize(ids.where("__nd_n > 1").select("__nd_row"), "repeated-rows")
    # Only rows that may go or be repeated are shuffled with their texts.
    others, perhaps = split_by_keys(rows, gone.union(again), "__nd_row")
    kept = materialize(perhaps, "near-rows-met").join(gone, "__nd_row", "left_anti")
    once = kept.join(again, "__nd_row", "left_anti")
    one = kept.join(again, "__nd_row", "left_semi").dropDuplicates(["__nd_row"])
    return others.select(*docs.columns).union(once.select(*docs.columns)).union(one.select(*docs.columns))


def source_mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row none, once or twice, as its source's target asks.  A null source is one of its
    own, texts without words are taken at most twice too; no row is shuffled with its text."""
    names = [f"__mix_{n}" for n in ("size", "source_size", "target", "copies")]
    mixed = mixing.mix_sources(docs, out=names)
    times = F.explode(F.sequence(F.lit(1), F.col(names[3]).cast("int")))
    return mixed.where(F.col(names[3]) > 0).withColumn("__mix_nth", times).select(*docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Id, language, source, token ids and decoded text of each row, from its whole text; a
    null text is an empty one."""
    return piece_bpe.encode_texts(docs, tokenizer_path("piece_bpe_32k.model"), carry=("doc_id", "lang", "source"))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates_stage),
    ("source_mix", source_mix_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: The robust estimates, the similarity components and the encoding are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
