"""Monthly rollup of line-grain sales and the active-store semi-join (#14, #24, #25, #39, #87)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.safe import sdiv


def month_start(c) -> Column:
    """First day of the month as DATE (pandas ``Period('M')`` / ``datetime64[M]``)."""
    return F.trunc(F.col(c) if isinstance(c, str) else c, "MM")


def monthly_rollup(sales: DataFrame, keys: Sequence[str] = ("key", "business_type"),
                   date_col: str = "date", txn_col: str = "tran_seq_no",
                   amount_col: str = "amount", qty_col: str = "quantity",
                   approx_distinct: bool = False) -> DataFrame:
    """One row per (keys, month): distinct transactions, summed amount and units, ppu.

    Amount and quantity are truncated toward zero *per line* before summing
    (the reference casts each line to int), so the sums are exact integers.
    Plan: partial aggregation on (keys, month, txn) map-side, then one shuffle
    on (keys, month); no Expand, because only one column is distinct-counted.
    ``approx_distinct`` swaps in HyperLogLog++ for a single-stage aggregate.
    """
    distinct = (F.approx_count_distinct(txn_col) if approx_distinct
                else F.countDistinct(txn_col)).cast("bigint")
    return (sales.groupBy(*keys, month_start(date_col).alias("date"))
            .agg(distinct.alias("num_transactions"),
                 F.sum(F.col(amount_col).cast("bigint")).alias("sales_amount"),
                 F.sum(F.col(qty_col).cast("bigint")).alias("units"))
            .withColumn("ppu", sdiv("sales_amount", "units")))


def active_keys(panel: DataFrame, key: str = "key", date_col: str = "date",
                cutoff_month: str | None = None) -> DataFrame:
    """Distinct keys with a row in the cutoff month (default: the panel's last month)."""
    if cutoff_month is None:
        cutoff = panel.select(F.max(month_start(date_col))).scalar()
    else:
        cutoff = month_start(F.lit(cutoff_month).cast("date"))
    return (panel.filter(month_start(date_col) == cutoff).select(key).distinct())


def keep_active(panel: DataFrame, key: str = "key", date_col: str = "date",
                cutoff_month: str | None = None) -> DataFrame:
    """Keep every row of keys active in the cutoff month (left semi-join, #25)."""
    return panel.join(active_keys(panel, key, date_col, cutoff_month), key, "left_semi")
