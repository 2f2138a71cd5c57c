"""Registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (chat_format, cover_search, exact_dedup, icws_dedup, license_scan, lm_mix,
                          ngram_join, piece_codec, quality_mil, source_mix, spelling_variants, toxicity,
                          turn_repair)
from tidemark.llm.common import id_fold, load


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    net = toxicity.fit(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))
    return _judged(toxicity.score(docs, net), 0.5)


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", (id_fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"))
    return chat_format.digests(chat_format.formatted(turns.unionByName(extra)))


def op3_lm_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mix.score(load(spark, sf_dir, "documents", "doc_id", "text"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup.DigestIndex(spark).dedupe(docs)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(load(spark, sf_dir, "documents", "doc_id", "text"))


def op6_cover_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_search.search(load(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text", "source")
    return source_mix.mix(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_mil.fit(docs, load(spark, sf_dir, "labels", "doc_id", "quality"))
    return _judged(quality_mil.score(docs, model), 0.3)


def op9_icws_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return icws_dedup.near_classes(load(spark, sf_dir, "documents", "doc_id", "text"))


def op10_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    v = piece_codec.Vocabulary.load(piece_codec.default_path(spark))
    both = piece_codec.decode(piece_codec.encode(docs, v), v)
    return both.select(
        "doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(load(spark, sf_dir, "documents", "doc_id", "text"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return turn_repair.digests(turn_repair.damaged(turns), turns.select("conv_id"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return spelling_variants.variants(spelling_variants.vocabulary(docs, damage=97))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_chat_format": op2_chat_format,
    "op3_lm_mix": op3_lm_mix,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_cover_search": op6_cover_search,
    "op7_source_mix": op7_source_mix,
    "op8_quality_mil": op8_quality_mil,
    "op9_icws_dedup": op9_icws_dedup,
    "op10_piece_codec": op10_piece_codec,
    "op11_ngram_join": op11_ngram_join,
    "op12_turn_repair": op12_turn_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
