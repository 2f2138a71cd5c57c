"""Marketing spend: region extraction, brand/region filter, monthly KPIs, source pivot (#23, #45-47, #104)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.safe import sdiv


def campaign_region(df: DataFrame, regions: Sequence[str], campaign_col: str = "campaign_name",
                    out: str = "region") -> DataFrame:
    """First region code found in the campaign name (case-insensitive), upper-cased; else NULL."""
    pattern = "(?i)(" + "|".join(regions) + ")"
    hit = F.regexp_extract(F.col(campaign_col), pattern, 1)
    return df.withColumn(out, F.when(hit == "", F.lit(None)).otherwise(F.upper(hit)))


def pairs_table(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Small literal (brand, region) table; its size is the length of ``pairs``."""
    return spark.createDataFrame(list(pairs), "brand string, region string")


def filter_pairs(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows whose (brand, region) is one of the pairs (left semi-join on a tiny table)."""
    return df.join(F.broadcast(pairs), ["brand", "region"], "left_semi")


def _metric_aggs():
    return [F.sum("total_cost_usd").cast("decimal(38,2)").alias("total_cost_usd"),
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.avg("ctr").alias("ctr_l"), F.avg("cpm").alias("cpm_l"), F.avg("cpc").alias("cpc_l")]


def _kpis(g: DataFrame) -> DataFrame:
    return g.withColumns({
        "CPM": sdiv("total_cost_usd", "impressions") * 1000,
        "CPC": sdiv("total_cost_usd", "clicks"),
        "CTR": sdiv("clicks", "impressions") * 100,
    })


def _source_aggs(sources: Sequence[str], prefix: str):
    return [F.coalesce(F.sum(F.when(F.col("source") == s, F.col("total_cost_usd"))),
                       F.lit(0)).cast("decimal(38,2)").alias(prefix + s) for s in sources]


def monthly_metrics(df: DataFrame) -> DataFrame:
    """Monthly sums, means of row KPIs (``*_l``) and KPIs from sums (#45, #47, S18)."""
    g = df.groupBy(F.trunc("date", "MM").alias("month"), "brand", "region").agg(*_metric_aggs())
    return _kpis(g)


def cost_by_source(df: DataFrame, sources: Sequence[str], prefix: str = "total_cost_usd_") -> DataFrame:
    """Pivot of summed cost by source, explicit values, 0 fill (#46).

    Written as one conditional sum per value (what ``pivot`` with explicit
    values computes), so it can share the pass with other aggregates.
    """
    return (df.groupBy(F.trunc("date", "MM").alias("month"), "brand", "region")
            .agg(*_source_aggs(sources, prefix)))


def monthly_with_sources(df: DataFrame, sources: Sequence[str],
                         prefix: str = "total_cost_usd_") -> DataFrame:
    """Monthly metrics and the source pivot in a single aggregate pass."""
    g = (df.groupBy(F.trunc("date", "MM").alias("month"), "brand", "region")
         .agg(*_metric_aggs(), *_source_aggs(sources, prefix)))
    return _kpis(g)
