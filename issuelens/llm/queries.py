"""Registered queries of the corpus operators: ``opN_<name>`` and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelens.llm import (collision_ann, cotraining, dialogue_repair, divergence, language_id, line_dedup, mixing,
                           ngram_join, piece_bpe, quality_rules, simhash, token_files, url_filters)
from issuelens.llm.common import read
from issuelens.session import scratch_path


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers (same path on all executors)."""
    import public_tokenizers
    return public_tokenizers.path(name)

# The rules of the URL query, in the order given.
SITE_RULES = (
    url_filters.SiteRule("allow", "com/"),
    url_filters.SiteRule("block", "example.com/en/"),
    url_filters.SiteRule("allow", "www.example.com/en/"),
    url_filters.SiteRule("block", "net/es/"),
    url_filters.SiteRule("block", "net/fr/"),
)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.line_dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_components(docs, words=3, percent=90)


def op2_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return collision_ann.nearest(vectors, F.col("vec_id") % 50 == 0)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = piece_bpe.encode_texts(docs, tokenizer_path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.learn(docs.where(language_id.learning_row("doc_id")), "text", "lang", "doc_id")
    texts = docs.select("doc_id", "text", (language_id.fold("doc_id") == 1).alias("held_out"))
    return language_id.predict(texts, model).select("doc_id", "held_out", "lang_pred", "score")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_rules.score_rows(docs).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mix_sources(docs)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.url_filter(pages, SITE_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    found, edits = dialogue_repair.repair(dialogue_repair.damage(turns))
    every = turns.select("conv_id").distinct().withColumn("key", dialogue_repair.conversation_key("conv_id"))
    out = every.join(found, "key", "left").join(dialogue_repair.digests(edits), "key", "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_collision_ann": op2_collision_ann,
    "op3_line_dedup": op3_line_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_language_id": op5_language_id,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_source_mixing": op8_source_mixing,
    "op9_token_files": op9_token_files,
    "op10_url_filters": op10_url_filters,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_source_divergence": op12_source_divergence,
    "op13_simhash": op13_simhash,
}
