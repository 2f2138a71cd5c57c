"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import apply_core_conf, ensure_checkpoint_dir
from tidemark.sources.tables import read_table

#: The white space of every contract: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows a Python worker holds at a time; operators cut long texts further.
ROWS_PER_BATCH = 256
BYTES_PER_BATCH = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on; small Arrow batches bound a worker's memory."""
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return spark


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, name, columns or None)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the cluster's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_fold(name: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null ids hash as the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % folds


def fresh_name(base: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` has (case-insensitively)."""
    low, name = {t.lower() for t in taken}, base
    while name.lower() in low:
        name += "_"
    return name


def word_hashes(text: Column, lower: bool = True) -> Column:
    """The words' 64-bit hashes in order (empty for null and blank texts)."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    t = F.lower(t) if lower else t
    return F.when(t == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(t, " "), lambda w: F.xxhash64(w)))


def list_parts(column) -> tuple:
    """An Arrow list column as numpy: flat values and offsets (null lists are empty)."""
    import numpy as np

    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
