"""Bind the driver's TPC-H-like tables to the logical inputs of the pipeline.

Logical table  <- driver tables (see FIXTURES.md part B)
  sales        <- lineitem (+ supplier/nation/region for geography, part for brand)
  promotions   <- lineitem (one promo rule per line; length = quantity days)
  stores       <- supplier ⋈ nation ⋈ region
  marketing    <- orders ⋈ customer ⋈ nation ⋈ region (campaign-day grain)
  month_series <- orders (monthly order counts as dirty text)
  event_ranges / event_days / holidays <- small calendar configuration tables

Scale notes: ``nation`` and ``region`` are fixed-size by the TPC-H schema (25
and 5 rows) and are the only dims broadcast by hint here; ``supplier``,
``part`` and ``customer`` grow with the scale factor, so their joins are left
to the planner (AQE converts them to broadcast only when the runtime size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation ⋈ region, 25 rows by schema definition -> safe to broadcast."""
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return F.broadcast(geo.select("n_nationkey", "n_name", "r_name"))


def store_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store id -> (country, business_type). One row per supplier."""
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    return (sup.join(geography(spark, sf_dir), sup.s_nationkey == F.col("n_nationkey"))
            .select("s_suppkey",
                    F.col("s_suppkey").cast("string").alias("key"),
                    F.col("n_name").alias("country"),
                    F.col("r_name").alias("business_type")))


def sales_lines(spark: SparkSession, sf_dir: str, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Line-grain sales without geography (keyed by the numeric store id).

    Date predicates are applied on the raw ship timestamp so they reach the
    Parquet scan as pushed filters.
    """
    li = read_table(spark, sf_dir, "lineitem")
    if start is not None:
        li = li.filter(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        li = li.filter(F.col("l_shipdate") < F.date_add(F.lit(end).cast("date"), 1)
                       .cast("timestamp_ntz"))
    return li.select(
        F.col("l_suppkey").alias("s_suppkey"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_orderkey").alias("tran_seq_no"),
        F.col("l_partkey").alias("item"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").alias("quantity"))


def of_brand(spark: SparkSession, sf_dir: str, lines: DataFrame, brand: str) -> DataFrame:
    """Lines of one brand: the product table is filtered first and only its ids are joined."""
    items = (read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
             .filter(F.col("p_brand") == brand).select(F.col("p_partkey").alias("item")))
    return lines.join(items, "item", "left_semi")


def sales(spark: SparkSession, sf_dir: str, brands: Sequence[str] | None = None,
          countries: Sequence[str] | None = None, start: str | None = None,
          end: str | None = None) -> DataFrame:
    """Logical ``sales`` (A1): line grain with key, date, brand, country, business_type.

    The product join is made only when a brand predicate is requested (it is
    the reference's way of filtering by brand); the brand filter is applied to
    ``part`` before the join, so only matching parts are shuffled/broadcast.
    """
    lines = sales_lines(spark, sf_dir, start, end)
    geo = store_geo(spark, sf_dir)
    if countries:
        geo = geo.filter(F.col("country").isin(list(countries)))
    df = lines.join(geo, "s_suppkey")
    if brands:
        part = (read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
                .filter(F.col("p_brand").isin(list(brands))))
        df = (df.join(part, df.item == part.p_partkey)
              .withColumnRenamed("p_brand", "brand").drop("p_partkey"))
    return df.drop("s_suppkey")


# Promotion strategy encoded by the line's return flag.
STRATEGY_BY_FLAG = {"R": "RELATIVE", "A": "ABSOLUTE"}


def promotions(spark: SparkSession, sf_dir: str,
               strategies: Sequence[str] | None = None) -> DataFrame:
    """Logical ``promotions`` (A3): closed intervals [eff_from, eff_to].

    ``strategies`` is pushed to the Parquet scan as a predicate on the raw
    flag column (a filter on the derived ``strategy`` would fold into a CASE
    expression that the scan cannot evaluate).
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_suppkey", "l_partkey", "l_returnflag", "l_discount",
                     "l_shipdate", "l_quantity"])
    if strategies is not None:
        flags = [f for f, name in STRATEGY_BY_FLAG.items() if name in strategies]
        cond = F.col("l_returnflag").isin(flags) if flags else F.lit(False)
        if "NONE" in strategies:
            cond = cond | ~F.col("l_returnflag").isin(list(STRATEGY_BY_FLAG))
        li = li.filter(cond)
    eff_from = F.to_date("l_shipdate")
    return li.select(
        F.col("l_suppkey").cast("string").alias("locationId"),
        F.col("l_partkey").alias("itemId"),
        F.when(F.col("l_returnflag") == "R", "RELATIVE")
         .when(F.col("l_returnflag") == "A", "ABSOLUTE")
         .otherwise("NONE").alias("strategy"),
        F.round(F.col("l_discount") * 100).cast("int").alias("amountOfDiscount"),
        eff_from.alias("eff_from"),
        F.date_add(eff_from, F.col("l_quantity").cast("int") - 1).alias("eff_to"))


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical ``stores`` dim (A4)."""
    sup = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    df = sup.join(geography(spark, sf_dir), sup.s_nationkey == F.col("n_nationkey"))
    ecom = (F.col("s_suppkey") % 5) == 0
    return df.select(
        F.col("s_suppkey").cast("string").alias("store"),
        F.col("n_name").alias("city"),
        F.when(ecom, 1).otherwise(0).alias("is_ecom_fullfillment_loc"),
        F.when(ecom, "ecommerce").otherwise("retail").alias("channel"),
        F.col("s_acctbal").alias("total_square_ft"),
        F.when((F.col("s_suppkey") % 7) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("s_acctbal") / 2).alias("selling_square_ft"),
        F.col("r_name").alias("store_format"))


def marketing(spark: SparkSession, sf_dir: str, start: str | None = None,
              end: str | None = None, brand: str | None = None,
              limit: int | None = None) -> DataFrame:
    """Logical ``marketing`` (A5), campaign-day grain, with null-safe row KPIs (#4).

    ``start``/``end`` are pushed to the orders scan, ``brand`` to the
    customer scan; ``limit`` (optional, as in the reference's query builder)
    caps the rows returned in a deterministic (date, campaign) order.
    """
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    if start is not None:
        o = o.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        o = o.filter(F.col("o_orderdate") < F.date_add(F.lit(end).cast("date"), 1)
                     .cast("timestamp_ntz"))
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    if brand is not None:
        c = c.filter(F.col("c_mktsegment") == brand)
    df = (o.join(c, o.o_custkey == c.c_custkey)
          .join(geography(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))
    cost = F.col("o_totalprice").cast("decimal(18,2)")
    out = df.select(
        F.to_date("o_orderdate").alias("date"),
        F.col("c_mktsegment").alias("brand"),
        F.concat(F.lower("r_name"), F.lit("_"), F.col("o_orderkey").cast("string"))
         .alias("campaign_name"),
        F.lower(F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2))).alias("source"),
        cost.alias("total_cost_usd"),
        F.col("o_totalprice").cast("bigint").alias("impressions"),
        (F.col("o_custkey") % 50).cast("bigint").alias("clicks"),
    ).withColumns({
        "ctr": F.try_divide(F.col("clicks").cast("double"), F.col("impressions").cast("double")),
        "cpm": F.try_divide(F.col("total_cost_usd").cast("double") * 1000,
                            F.col("impressions").cast("double")),
        "cpc": F.try_divide(F.col("total_cost_usd").cast("double"),
                            F.col("clicks").cast("double")),
    })
    if limit is not None:
        out = out.orderBy("date", "campaign_name").limit(limit)
    return out


def month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical ``month_series`` (A6): monthly order counts as dirty text.

    ``month`` is the full English month name; ``tourists`` carries a thousands
    comma and a trailing no-break space, as a spreadsheet export would.
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderdate"])
    m = F.trunc(F.to_date("o_orderdate"), "MM")
    return (o.groupBy(m.alias("m")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.year("m").alias("year"),
                    F.date_format("m", "MMMM").alias("month"),
                    F.concat(F.format_number("n", 0), F.lit("\u00a0")).alias("tourists")))


# The moving-festival calendar used with the driver data.
# One 30-day range per year, starting at 1 June of 1995 and 11 days earlier
# each year after; the three days after each range are feast days.
EVENT_FIRST_YEAR = 1995
EVENT_RANGE_DAYS = 30
EVENT_DRIFT_DAYS = 11
FEAST_DAYS = 3
# A second feast of three days starts 70 days after each range ends.
FEAST2_OFFSET_DAYS = 70
# Fixed-date national holidays (month-day), one per year each.
NATIONAL_HOLIDAYS_MMDD = ("02-22", "09-23")


def event_years(months: DataFrame, horizon: int) -> DataFrame:
    """``event_years(y)``: the years of ``months.date`` and ``horizon`` months on, one more each side."""
    span = months.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return span.select(F.explode(F.sequence(
        F.year("a") - 1, F.year(F.add_months("b", horizon)) + 1)).alias("y"))


def event_ranges(years: DataFrame) -> DataFrame:
    """``event_ranges(event, start, end)``: one festival range per year (tiny, bounded by years)."""
    y = F.col("y")
    start = F.date_sub(F.make_date(y, F.lit(6), F.lit(1)), (y - EVENT_FIRST_YEAR) * EVENT_DRIFT_DAYS)
    return years.select(F.lit("festival").alias("event"), start.alias("start"),
                        F.date_add(start, EVENT_RANGE_DAYS - 1).alias("end"))


def event_days(years: DataFrame) -> DataFrame:
    """``event_days(event, date)``: ``feast`` right after each festival range, ``feast2`` later."""
    rng = event_ranges(years)
    first = rng.select(F.lit("feast").alias("event"),
                       F.explode(F.sequence(F.date_add("end", 1),
                                            F.date_add("end", FEAST_DAYS))).alias("date"))
    second = rng.select(F.lit("feast2").alias("event"),
                        F.explode(F.sequence(F.date_add("end", FEAST2_OFFSET_DAYS),
                                             F.date_add("end", FEAST2_OFFSET_DAYS + FEAST_DAYS - 1)))
                        .alias("date"))
    return first.unionByName(second)


def holidays(years: DataFrame) -> DataFrame:
    """``holidays(date)``: feast days plus fixed-date national holidays."""
    fixed = years.select(F.explode(F.array(*[
        F.make_date("y", F.lit(int(md[:2])), F.lit(int(md[3:]))) for md in NATIONAL_HOLIDAYS_MMDD
    ])).alias("date"))
    feasts = event_days(years).select("date")
    return feasts.unionByName(fixed).distinct()
