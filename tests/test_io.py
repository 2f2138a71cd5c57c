"""Sources and sinks: CSV round trip, partitioned Parquet, staged tables, guards, spans (#6-#10)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.profile import require_rows
from tidemark.sources import io as IO
from tidemark.sources import stats
from tidemark.sources.tables import table_path
from tests.conftest import SF_ORACLE, SF_SMALL


def test_csv_roundtrip(spark):
    import __spark_entry__ as E
    fc = E.queries()["forecast_wide"](spark, SF_SMALL)
    path = IO.write_csv(fc, IO.shared_dir(spark, "csv"))
    back = IO.read_csv(spark, path, ",".join(f"{c} {t}" for c, t in fc.dtypes))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fc.collect()))


def test_partitioned_write_prunes(spark):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("p"), "id")
    path = IO.write_partitioned(df, IO.shared_dir(spark, "part"), ["p"])
    back = spark.read.parquet(path).filter(F.col("p") == "1")
    files = [r[0] for r in back.select(F.input_file_name()).distinct().collect()]
    assert files and all("p=1" in f for f in files) and back.count() == 33


def test_table_is_swapped_whole(spark):
    name = "tidemark_sink_test"
    spark.sql(f"drop table if exists {name}")
    assert IO.save_table(spark.range(5).toDF("x"), name) == 5
    reading = spark.table(name)
    assert IO.save_table(spark.range(3).toDF("x"), name) == 3
    # A reader from before the swap still has all old rows, a new one all new rows.
    assert reading.count() == 5 and spark.table(name).count() == 3
    fails = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken")))
                                  .otherwise(F.col("id")).cast("bigint").alias("x"))
    for bad, error in ((fails, Exception), (spark.range(0).toDF("x"), IO.EmptyResult),
                       (spark.range(2).toDF("y"), ValueError)):
        with pytest.raises(error):
            IO.save_table(bad, name)
        assert sorted(r["x"] for r in spark.table(name).collect()) == [0, 1, 2]
    assert IO.save_table(spark.range(0).toDF("x"), name, require_rows=False) == 0
    assert spark.table(name).count() == 0
    gone = IO.drop_old_loads(spark, name, keep=0)
    assert len(gone) >= 2 and spark.table(name).count() == 0
    spark.sql(f"drop table {name}")


def test_empty_guard(spark):
    with pytest.raises(ValueError):
        require_rows(spark.range(0), "forecasts")
    assert require_rows(spark.range(1)).count() == 1


def test_guarded_write_counts_in_its_own_job(spark):
    df = spark.range(10).withColumn("p", F.lit("a"))
    path = IO.write_checked(df, IO.shared_dir(spark, "guard"), ["p"])
    jobs = spark.sparkContext.statusTracker()
    group = "guarded"
    spark.sparkContext.setJobGroup(group, group)
    try:
        IO.write_checked(df, path, ["p"])
        checked = len(jobs.getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup(group + "2", group)
        IO.write_partitioned(df, path, ["p"])
        plain = len(jobs.getJobIdsForGroup(group + "2"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert checked == plain > 0
    with pytest.raises(IO.EmptyResult):
        IO.write_checked(df.limit(0), path, ["p"], "forecasts")
    assert spark.read.parquet(path).count() == 10


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
def test_span_from_footers(spark, kind):
    df = spark.range(1000).select(
        F.lit("z").alias("before"),
        F.expr(f"cast(date'1999-03-01' + cast(id as int) as {kind})").alias("at"),
        F.col("id").alias("after"))
    path, old = IO.shared_dir(spark, "span"), IO.shared_dir(spark, "span")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    df.repartition(4).write.parquet(path)
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    df.write.parquet(old)
    # Timestamps of 96 bits have no statistics: the caller looks at the rows.
    assert (stats.date_span(spark, old, "at") is None) == (kind == "timestamp")
    before = spark.conf.get("spark.sql.sources.useV1SourceList", None)
    assert stats.date_span(spark, path, "at") == (dt.date(1999, 3, 1), dt.date(2001, 11, 24))
    assert spark.conf.get("spark.sql.sources.useV1SourceList", None) == before
    assert stats.date_span(spark, path, "before") is None
    empty = IO.shared_dir(spark, "span")
    df.limit(0).write.parquet(empty)
    assert stats.date_span(spark, empty, "at") is None


def test_calendar_reads_no_row_of_the_fact(spark):
    import __spark_entry__ as E
    path = table_path(SF_ORACLE, "lineitem")
    rows = spark.read.parquet(path).agg(F.to_date(F.min("l_shipdate")),
                                        F.to_date(F.max("l_shipdate"))).first()
    assert stats.date_span(spark, path, "l_shipdate") == tuple(rows)
    E.queries()["active_stores"](spark, SF_ORACLE).count()  # the panel is there
    plan = E.queries()["calendar_daily"](spark, SF_ORACLE)._jdf.queryExecution().toString()
    assert "lineitem" not in plan
