"""Exact dedup against a persistent digest index, bucketed and sorted by digest.

The index is a Spark table (digest, keep_id) clustered into buckets by the digest and
sorted within them.  A new batch is reduced to one row per digest, anti-joined with the
index (a sort-merge join that reads the buckets as they lie, without a shuffle of the
index) and what is left is appended.  DataFrame operations only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, fresh_name, shared_path, written
from tidemark.sources.files import names_in, read_json, write_json


def normalised(text: Column) -> Column:
    """Null is empty; every run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


class DigestIndex:
    """Digests seen so far, each with the id of the row that was kept.

    ``path`` is the index's folder (shared storage); reopening the same path in another
    session registers the files again.  ``buckets`` (by default as many as shuffle
    partitions) and ``id_type`` are fixed at creation and kept beside the files: a later
    opening takes them from there and raises if it names others.
    """

    def __init__(self, spark: SparkSession, path: str | None = None,
                 buckets: int | None = None, id_type: str | None = None):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        asked = {"buckets": buckets, "id_type": id_type}
        facts = f"{self.path.rstrip('/')}/_index.json"
        if "_index.json" in names_in(spark, self.path):
            known = read_json(spark, facts)
            other = {k: v for k, v in asked.items() if v is not None and v != known[k]}
            if other:
                raise ValueError(f"the index at {self.path} has {known}, not {other}")
        else:
            known = {"buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
                     "id_type": id_type or "bigint"}
            write_json(spark, facts, known)
        self.buckets, id_type = known["buckets"], known["id_type"]
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, new: DataFrame) -> None:
        """Add digests the index lacks: one file per bucket and batch, sorted."""
        (new.select("digest", "keep_id").repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest")
            .sortBy("digest").saveAsTable(self.table))

    def dedupe(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               carry: bool = False) -> DataFrame:
        """Decide every row of ``docs`` and append its new digests to the index.

        Returns ``id_col``, keep_id, group_size, kept, text_sha256; with ``carry`` also
        every other column of ``docs`` (names that clash get trailing underscores).
        Rules: null text equals the empty text.  Of equal texts in the batch the smallest
        id stays, null ids last; of repeated rows with one id exactly one stays.  A text
        the index already holds is dropped, keep_id then names the earlier row.
        group_size counts the batch's rows with that text.  An empty batch gives no rows.
        """
        others = [c for c in docs.columns if c != id_col] if carry else []
        row, digest = fresh_name("row_", docs.columns), fresh_name("digest_", docs.columns)
        # Written once: a row number that stays the same, and each text hashed once.
        batch = written(docs.select(
            F.col(id_col), *[F.col(c) for c in others],
            text_digest(F.col(text_col)).alias(digest),
            F.monotonically_increasing_id().alias(row)), "digests")
        first = F.min(F.struct(F.col(id_col).isNull().alias("no_id"),
                               F.col(id_col).alias("id"), F.col(row).alias("row")))
        groups = written(
            batch.groupBy(F.col(digest).alias("digest"))
            .agg(first.alias("first"), F.count(F.lit(1)).alias("size"))
            .select("digest", F.col("first.id").alias("keep_id"),
                    F.col("first.row").alias("keep_row"), "size"), "digest-groups")
        new = written(groups.hint("merge").join(self.rows().select("digest"), "digest",
                                                "left_anti"), "digest-new")
        earlier = (groups.join(new.select("digest"), "digest", "left_anti")
                   .join(self.rows().withColumnRenamed("keep_id", "old_id"), "digest"))
        # Read from files on both sides, so that adaptive execution can split a digest
        # that holds a large share of the rows.
        known = written(
            new.select("digest", "keep_id", "keep_row", "size").unionByName(
                earlier.select("digest", F.col("old_id").alias("keep_id"),
                               F.lit(None).cast("bigint").alias("keep_row"), "size")),
            "digest-known")
        self.append(new)
        known = known.select(F.col("digest").alias(digest), F.col("keep_id").alias("k_"),
                             F.col("keep_row").alias("r_"), F.col("size").alias("s_"))
        out = batch.alias("b").join(known.alias("k"), digest)
        names = {n: fresh_name(n, others) for n in ("keep_id", "group_size", "kept",
                                                    "text_sha256")}
        return out.select(
            F.col(f"b.{id_col}"), *[F.col(f"b.`{c}`") for c in others],
            F.col("k.k_").alias(names["keep_id"]), F.col("k.s_").alias(names["group_size"]),
            F.coalesce(F.col(f"b.{row}") == F.col("k.r_"), F.lit(False))
            .alias(names["kept"]),
            F.col(digest).alias(names["text_sha256"]))


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they had."""
    index = DigestIndex(spark, id_type=dict(docs.dtypes)["doc_id"])
    kept = fresh_name("kept", [c for c in docs.columns if c != "doc_id"])
    return index.dedupe(docs, carry=True).where(F.col(kept)).select(*docs.columns)
