"""What Parquet footers say of a table, without reading its rows (#86)."""

from __future__ import annotations

import contextlib
import datetime as dt
import re

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PER_DAY = {"MICROS": 86_400_000_000, "MILLIS": 86_400_000, "NANOS": 86_400_000_000_000}


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict):
    """Session settings for a while; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _unit(spark: SparkSession, file: str, column: str) -> str | None:
    """The unit in which a file keeps a timestamp column as INT64."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(file), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        text = reader.getFileMetaData().getSchema().toString()
    finally:
        reader.close()
    found = re.search(rf"int64 {re.escape(column)} \(TIMESTAMP\((\w+)", text)
    return found[1] if found else None


def date_span(spark: SparkSession, path: str, column: str) -> tuple[dt.date, dt.date] | None:
    """First and last day of a date or timestamp column, from the files' footers.

    The minimum and maximum are pushed into the Parquet scan, which then reads statistics
    only; that works on integers and dates, so a timestamp is read as the integer it is
    kept as.  None where the footers can't tell (no rows, no statistics, another encoding);
    the caller then looks at the rows.  All files have the columns in one order, as every
    writer leaves them.
    """
    schema = spark.read.parquet(path).schema
    kind, files = schema[column].dataType, spark.read.parquet(path).inputFiles()
    if not files:
        return None
    per_day = 1
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        unit = _unit(spark, files[0], column)
        if unit not in _PER_DAY:
            return None
        per_day, kind = _PER_DAY[unit], T.LongType()
    elif not isinstance(kind, T.DateType):
        return None
    asked = T.StructType([T.StructField(f.name, kind if f.name == column else f.dataType)
                          for f in schema])
    with _settings(spark, {"spark.sql.sources.useV1SourceList": "",
                           "spark.sql.parquet.aggregatePushdown": "true"}):
        span = spark.read.schema(asked).parquet(path).agg(
            F.min(column).alias("a"), F.max(column).alias("b"))
        if "PushedAggregation: [MIN" not in span._jdf.queryExecution().executedPlan().toString():
            return None
        try:
            row = span.first()
        except Exception:  # noqa: BLE001 - files without statistics make the scan raise
            return None
    if row is None or row["a"] is None:
        return None
    if isinstance(row["a"], dt.date):
        return row["a"], row["b"]
    day = lambda x: dt.date(1970, 1, 1) + dt.timedelta(days=x // per_day)
    return day(row["a"]), day(row["b"])
