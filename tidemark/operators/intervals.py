"""Promotion intervals: lengths, month and day expansion, monthly features (#15, #40-44, #77-81).

Scale: a promotion is a closed date interval. Counting distinct promo days
per (location, month) never expands days: each interval is cut at month
boundaries (one piece per month it touches), each piece becomes a 31-bit
mask of its days, and the masks are OR-ed per (location, month) with
``bit_or`` — an aggregate with map-side partial aggregation — and counted
with ``bit_count``. Overlaps are counted once by construction, the work is
O(promos × months touched), and a location holding a third of all promos
still spreads over every task (no per-location window or sort).
``explode_days`` keeps the literal day expansion for callers that need days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.safe import r, sdiv

LOC, ITEM, FROM, TO, DISC = "locationId", "itemId", "eff_from", "eff_to", "amountOfDiscount"


def relative_only(promos: DataFrame, strategy: str = "RELATIVE") -> DataFrame:
    return promos.filter(F.col("strategy") == strategy)


def with_length(promos: DataFrame) -> DataFrame:
    """``promo_length`` (inclusive days) and ``discount_efficiency`` per promo (#77)."""
    length = F.datediff(TO, FROM) + 1
    return promos.withColumns({"promo_length": length,
                               "discount_efficiency": sdiv(F.col(DISC), length)})


def month_starts_inside(start: Column, end: Column) -> Column:
    """Array of month starts inside [start, end]; empty when none (S9).

    Never calls ``sequence`` with stop < start (it throws under ANSI).
    """
    first = F.when(F.dayofmonth(start) == 1, start).otherwise(F.add_months(F.trunc(start, "MM"), 1))
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month"))) \
            .otherwise(F.array().cast("array<date>"))


def explode_months(promos: DataFrame) -> DataFrame:
    """One row per promo and month start contained in it (#78)."""
    return promos.withColumn("date", F.explode(month_starts_inside(F.col(FROM), F.col(TO))))


def explode_days(promos: DataFrame) -> DataFrame:
    """One row per (location, day) covered by any promo (#79), dedup before expansion."""
    iv = promos.filter(F.col(FROM) <= F.col(TO)).select(LOC, FROM, TO).distinct()
    return (iv.select(LOC, F.explode(F.sequence(F.col(FROM), F.col(TO))).alias("day"))
            .distinct())


def promo_span(promos: DataFrame) -> DataFrame:
    """First start and last end per location (#40)."""
    return promos.groupBy(LOC).agg(F.min(FROM).alias("min_eff_from_date"),
                                   F.max(TO).alias("max_eff_up_to_date"))


def month_pieces(promos: DataFrame) -> DataFrame:
    """Cut each interval at month boundaries: (location, month, day mask)."""
    iv = promos.filter(F.col(FROM) <= F.col(TO))
    m = F.explode(F.sequence(F.trunc(FROM, "MM"), F.trunc(TO, "MM"), F.expr("interval 1 month")))
    pieces = iv.select(LOC, FROM, TO, m.alias("date"))
    start = F.greatest(F.col(FROM), F.col("date"))
    end = F.least(F.col(TO), F.last_day("date"))
    length = F.datediff(end, start) + 1
    one = F.lit(1).cast("bigint")
    ones = F.call_function("shiftleft", one, length) - 1
    mask = F.call_function("shiftleft", ones, F.dayofmonth(start) - 1)
    return pieces.select(LOC, "date", mask.alias("_mask"))


def promo_days(promos: DataFrame) -> DataFrame:
    """Distinct promo days per (location, month) (#41), via OR-ed day masks."""
    return (month_pieces(promos).groupBy(LOC, "date")
            .agg(F.bit_count(F.bit_or("_mask")).cast("int").alias("promo_days_in_month")))


#: Words of 64 bits for the discount levels: 0 to 127 percent.
LEVEL_WORDS = 2


def _level_bits(word: int):
    """The level's bit if it lies in this word; a level that no word has is an error."""
    x = F.col(DISC)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (x - 64 * word).cast("int"))
    return (F.when(x.between(64 * word, 64 * word + 63), bit)
            .when((x < 0) | (x >= 64 * LEVEL_WORDS),
                  F.raise_error(F.lit("discount is no percentage")).cast("bigint"))
            .otherwise(F.lit(0).cast("bigint")))


def promo_monthly(promos: DataFrame) -> DataFrame:
    """Monthly promo statistics and share of items on promo (#42, #43)."""
    p = with_length(promos)
    monthly = (explode_months(p).groupBy(LOC, "date").agg(
        F.countDistinct(ITEM).alias("_items"),
        # Discounts are integer percents: a bit each keeps this a hash aggregate on
        # fixed-size buffers (a second countDistinct would make Spark Expand every
        # exploded row three times, a collected set would fall back to sorting).
        *[F.bit_or(_level_bits(k)).alias(f"_levels{k}") for k in range(LEVEL_WORDS)],
        F.avg(DISC).alias("avg_discount"),
        F.max(DISC).cast("double").alias("max_discount"),
        F.min(DISC).cast("double").alias("min_discount"),
        F.avg("promo_length").alias("avg_promo_duration")))
    total = p.groupBy(LOC).agg(F.countDistinct(ITEM).alias("_total"))
    return (monthly.join(total, LOC, "left")
            .withColumns({
                "percentage_products_on_promo": r(sdiv("_items", "_total") * 100, 2),
                "distinct_discount_levels": sum(
                    (F.bit_count(f"_levels{k}") for k in range(1, LEVEL_WORDS)),
                    F.bit_count("_levels0")).cast("bigint")})
            .drop("_items", "_total", *[f"_levels{k}" for k in range(LEVEL_WORDS)])
            .select(LOC, "date", "distinct_discount_levels", "avg_discount", "max_discount",
                    "min_discount", "avg_promo_duration", "percentage_products_on_promo"))


def promo_features(promos: DataFrame) -> DataFrame:
    """End-to-end monthly promo features (#80): stats ⋈ day counts, rounded."""
    monthly = promo_monthly(promos)
    days = promo_days(promos)
    out = monthly.join(days, [LOC, "date"], "left").withColumn(
        "promo_days_in_month", F.coalesce("promo_days_in_month", F.lit(0)))
    return out.withColumns({c: r(F.coalesce(F.col(c), F.lit(0.0)), 2)
                            for c in ("avg_discount", "max_discount", "min_discount",
                                      "avg_promo_duration")})


def available_months(monthly: DataFrame, key: str = LOC, date_col: str = "date") -> DataFrame:
    """Sorted distinct months per location (#44); bounded by months per location."""
    return monthly.groupBy(key).agg(F.sort_array(F.collect_set(date_col)).alias("available_months"))
