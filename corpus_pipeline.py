"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing, piece encoding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its predecessor
kept; its result is written as Parquet in the shared folder and read back as the next
one's ``docs``.  All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, icws_dedup, piece_codec, source_mix, toxicity
from tidemark.llm.common import load, prepare, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more; learns from ``labels`` of ``docs``."""
    prepare(spark)
    net = toxicity.fit(docs, load(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.clean(docs, net)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    prepare(spark)
    return exact_dedup.keep_first(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    prepare(spark)
    return icws_dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    prepare(spark)
    return source_mix.taken(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, and whether they decode to the text."""
    prepare(spark)
    v = piece_codec.Vocabulary.load(piece_codec.default_path(spark))
    both = piece_codec.decode(piece_codec.encode(docs.select("doc_id", "text"), v), v)
    return both.select(
        "doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("piece_codec", encode_pieces),
]

#: The trained network, the near-duplicate classes and the piece paths are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
