"""Parametrised scans and sinks (#1-8).

Sinks write under a folder the cluster shares: the session's checkpoint
folder (``spark.checkpoint.dir``) unless the caller names one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files


def shared_dir(spark: SparkSession, sub: str) -> str:
    from tidemark.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{sub}/{uuid.uuid4().hex}"


def filter_between(df: DataFrame, col: str, start: str | None = None,
                   end: str | None = None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end).cast("date"))
    return df


def overlapping(df: DataFrame, start: str, end: str, from_col: str = "eff_from",
                to_col: str = "eff_to") -> DataFrame:
    """Intervals that overlap [start, end] (#2)."""
    return df.filter((F.col(to_col) >= F.lit(start).cast("date"))
                     & (F.col(from_col) <= F.lit(end).cast("date")))


def in_ids(df: DataFrame, ids: DataFrame, col: str, ids_col: str | None = None) -> DataFrame:
    """Rows whose ``col`` is in a (possibly large) id table: left semi-join (#2, #3, #9)."""
    ids = ids.select(F.col(ids_col or col).alias(col)).distinct()
    return df.join(ids, col, "left_semi")


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite") -> str:
    """Parquet under ``col=value/`` folders so later reads prune partitions (#6).

    Overwriting replaces only the partitions that ``df`` has; siblings stay.
    """
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


class EmptyResult(ValueError):
    """A write that must have rows had none."""


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with its rows counted by whatever job writes it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_checked(df: DataFrame, path: str, partition_cols: Sequence[str],
                  what: str = "input") -> str:
    """:func:`write_partitioned`, raising if nothing was written (#10); no job of its own.

    Dynamic partition overwrite replaces no partition when there are no rows, so an empty
    result leaves what was there.
    """
    counted, seen = observed(df)
    write_partitioned(counted, path, partition_cols)
    if not seen.get["rows"]:
        raise EmptyResult(f"{what} is empty")
    return path


def save_table(df: DataFrame, name: str, location: str | None = None,
               require_rows: bool = True) -> int:
    """Truncate-and-load into a catalog table (#8): staged, then swapped; returns its rows.

    The new rows go to a folder of their own and the table's location is then set to it, in
    one change of the catalog.  Readers see all old rows or all new ones, a query that
    began before the swap reads on in the old folder, and a load that fails (or, with
    ``require_rows``, is empty) leaves the old rows.  ``location`` is the table's home (the
    shared folder by default); :func:`drop_old_loads` clears what earlier loads left there.
    """
    spark = df.sparkSession
    home = location or table_home(spark, name) or shared_dir(spark, f"tables/{name}")
    stage = f"{home.rstrip('/')}/load-{uuid.uuid4().hex}"
    counted, seen = observed(df)
    counted.write.parquet(stage)
    if require_rows and not seen.get["rows"]:
        raise EmptyResult(f"the load of {name} is empty")
    if spark.catalog.tableExists(name):
        now = spark.table(name).schema
        if [(f.name, f.dataType) for f in now] != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"{name} has other columns: {now.simpleString()}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{stage}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=stage, source="parquet", schema=df.schema)
    return seen.get["rows"]


def _location(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(
        F.col("col_name") == "Location").collect()
    return rows[0]["data_type"] if rows else None


def table_home(spark: SparkSession, name: str) -> str | None:
    """The folder that holds a table's loads."""
    now = _location(spark, name)
    return now.rstrip("/").rpartition("/")[0] if now else None


def drop_old_loads(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Delete all but the ``keep`` loads before the current one; not while they are read."""
    home, now = table_home(spark, name), _location(spark, name).rpartition("/")[2]
    if home is None:
        return []
    loads = [n for n in files.names_in(spark, home) if n.startswith("load-") and n != now]
    loads.sort(key=lambda n: files.tree_stamp(spark, f"{home}/{n}")[2])
    gone = loads[:max(len(loads) - keep, 0)]
    for n in gone:
        files.delete_tree(spark, f"{home}/{n}")
    return gone
