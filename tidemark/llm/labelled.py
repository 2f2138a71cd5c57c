"""A bounded sample of labelled texts for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_fold, text_of


def training_texts(docs: DataFrame, labels: DataFrame, label: str, ones: int, zeros: int,
                   seed: str) -> tuple[list[str], list[int]]:
    """At most ``ones`` and ``zeros`` texts of the labels, by a hash of the id, without fold 0.

    Null labels and ids take no part; of an id's repeated labels the largest counts, of
    repeated rows one text.  The bound is ids, so the join's broadcast side and what the
    driver gets are bounded; texts come whole.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()
                          & (id_fold() != 0))
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
             .withColumn("order", F.xxhash64(F.lit(seed), F.col("doc_id"))))
    ids = known.where("y = 1").orderBy("order", "doc_id").limit(ones).unionByName(
        known.where("y = 0").orderBy("order", "doc_id").limit(zeros))
    rows = (docs.select("doc_id", text_of().alias("text"))
            .join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
            .select("doc_id", "y", "text").collect())
    rows = sorted(rows, key=lambda r: r["doc_id"])
    return [r["text"] for r in rows], [r["y"] for r in rows]
