"""Readers for the raw driver tables with projection and predicate pushdown.

Every reader selects only the columns the caller asks for, so the Parquet
scan's ``ReadSchema`` is pruned and filters reach ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Iterable[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns is not None:
        df = df.select(*columns)
    return df


def register_views(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """Register the raw tables as temp views (for ``spark.sql`` users)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
