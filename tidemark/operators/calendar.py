"""Daily retail calendar, event flags and monthly summaries (#36-38, #48-49, #86, #93-103).

Calendars are bounded by the number of days in the data span (a few thousand
rows per decade), never by data volume, so broadcasting them is safe. Event
ranges and feast days are turned into a day-level flag table (equi-join on
``date``) instead of a non-equi range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates as D

# National holidays by month-day, notebook variant.
NATIONAL_MMDD_A = ("01-01", "06-05", "06-26", "11-30", "12-02", "12-03")
# National holidays by month-day, pipeline variant
# (founding day and national day).
NATIONAL_MMDD_B = ("02-22", "09-23")
PRE_RANGE_DAYS = 14
POST_RANGE_DAYS = 7
PRE_FEAST_DAYS = 7


def day_spine(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One row per day from a one-row (start, end) frame."""
    return bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("date"))


def event_day_flags(ranges: DataFrame, days: DataFrame) -> DataFrame:
    """Day-level flags from festival ranges and feast days.

    ranges(event, start, end): in-range, 14 days before, 7 days after (same year).
    days(event, date): ``feast`` / ``feast2`` day flags and 7-day pre-feast window.
    """
    r = ranges.select(
        F.explode(F.sequence(F.date_sub("start", PRE_RANGE_DAYS),
                             F.date_add("end", POST_RANGE_DAYS))).alias("date"),
        "start", "end")
    r = r.filter(F.year("date") == F.year("start")).select(
        "date",
        F.col("date").between(F.col("start"), F.col("end")).cast("int").alias("is_range"),
        (F.col("date") < F.col("start")).cast("int").alias("pre_range"),
        (F.col("date") > F.col("end")).cast("int").alias("post_range"),
        F.lit(0).alias("is_feast"), F.lit(0).alias("is_feast2"), F.lit(0).alias("pre_feast"))
    fe = days.select(
        F.explode(F.sequence(F.date_sub("date", PRE_FEAST_DAYS), F.col("date"))).alias("d"),
        F.col("date").alias("feast_day"), "event")
    fe = fe.filter(F.year("d") == F.year("feast_day")).select(
        F.col("d").alias("date"), F.lit(0).alias("is_range"), F.lit(0).alias("pre_range"),
        F.lit(0).alias("post_range"),
        ((F.col("d") == F.col("feast_day")) & (F.col("event") == "feast")).cast("int").alias("is_feast"),
        ((F.col("d") == F.col("feast_day")) & (F.col("event") == "feast2")).cast("int").alias("is_feast2"),
        ((F.col("d") < F.col("feast_day")) & (F.col("event") == "feast")).cast("int").alias("pre_feast"))
    flags = ["is_range", "pre_range", "post_range", "is_feast", "is_feast2", "pre_feast"]
    return r.unionByName(fe).groupBy("date").agg(*[F.max(f).alias(f) for f in flags])


def with_event_flags(spine: DataFrame, ranges: DataFrame, days: DataFrame) -> DataFrame:
    ev = event_day_flags(ranges, days)
    flags = [c for c in ev.columns if c != "date"]
    return (spine.join(F.broadcast(ev), "date", "left")
            .fillna(0, subset=flags))


def holiday_calendar(spine: DataFrame, ranges: DataFrame, days: DataFrame,
                     variant: str = "A") -> DataFrame:
    """Daily holiday and retail-event flags.

    variant "A" (notebook): festival/summer/season/year-end/black-friday events,
    high-intent periods, fashion weeks in Feb and Sep.
    variant "B" (pipeline): national-day/season/summer sale months, high intent
    only in festival days of Mar/Apr, luxury season flags.
    """
    d = F.col("date")
    m, day = F.month(d), F.dayofmonth(d)
    cal = with_event_flags(spine, ranges, days)
    ramadan = F.greatest("is_range", "pre_range", "post_range")
    if variant == "A":
        national = D.month_day_in(d, NATIONAL_MMDD_A)
    else:
        national = D.month_day_in(d, NATIONAL_MMDD_B)
    cal = cal.withColumns({
        "national_holiday_flag": national,
        "ramadan_period": ramadan,
        "is_eid_fitr": F.col("is_feast"),
        "is_eid_adha": F.col("is_feast2"),
        "pre_eid_shopping": F.col("pre_feast"),
    }).withColumn("public_holidays",
                  F.greatest("is_eid_fitr", "is_eid_adha", "national_holiday_flag"))
    # The months and days of shopping events and seasons.
    if variant == "A":
        ev = {
            "dubai_shopping_festival": ((m == 12) | ((m == 1) & (day <= 15))).cast("int"),
            "dubai_summer_surprises": m.isin(6, 7, 8).cast("int"),
            "end_of_season_sales": m.isin(2, 7, 11).cast("int"),
            "year_end_sales": ((m == 12) & (day >= 15)).cast("int"),
            "black_friday_week": D.black_friday_week(d),
        }
        cal = cal.withColumns(ev).withColumns({
            "is_high_sales_intent_flag": F.greatest(
                "is_eid_adha", "pre_eid_shopping", "dubai_summer_surprises", "black_friday_week"),
            "shopping_event_code": F.greatest(*ev.keys(), F.col("pre_eid_shopping")),
            "fashion_week_season": m.isin(2, 9).cast("int"),
        })
    else:
        ev = {
            "saudi_national_day_sales": (m == 9).cast("int"),
            "end_of_season_sales": m.isin(3, 8).cast("int"),
            "saudi_summer_sales": m.isin(6, 7).cast("int"),
        }
        lux = {
            "fashion_week_season": m.isin(2, 3, 9).cast("int"),
            "riyadh_fashion_week": (m == 3).cast("int"),
            "jeddah_fashion_week": (m == 10).cast("int"),
            "luxury_ramadan_eid_season": m.isin(2, 3, 4).cast("int"),
            "saudi_national_day_season": (m == 9).cast("int"),
        }
        cal = cal.withColumns(ev).withColumns({
            "ramadan_shopping": F.col("ramadan_period"),
            "is_high_sales_intent_flag": ((F.col("ramadan_period") == 1) & m.isin(3, 4)).cast("int"),
            "shopping_event_code": F.greatest(*ev.keys(), F.col("pre_eid_shopping")),
            **lux,
        }).withColumn("luxury_season", F.greatest(*lux.keys()))
    return cal.drop("is_range", "pre_range", "post_range", "is_feast", "is_feast2", "pre_feast")


def calendar_monthly(cal: DataFrame, variant: str = "A") -> DataFrame:
    """Month sums of daily flags, days in month, season code (#48, #92, #103)."""
    ym = D.month_start("date").alias("date")
    if variant == "A":
        cols = ["ramadan_period", "public_holidays", "is_high_sales_intent_flag",
                "shopping_event_code", "fashion_week_season"]
        g = cal.groupBy(ym).agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])
        return g.withColumns({"count_of_days": D.days_in_month("date"),
                              "uae_seasons": D.season_code(F.month("date"))})
    g = cal.groupBy(ym).agg(
        F.sum("ramadan_period").cast("bigint").alias("ramadan_days"),
        F.sum("public_holidays").cast("bigint").alias("public_holiday_days"),
        F.sum(F.greatest("fashion_week_season", "luxury_season")).cast("bigint")
         .alias("fashion_luxury_days"))
    return g.withColumn("count_of_days", D.days_in_month("date"))


def peak_calendar(spine: DataFrame, ranges: DataFrame, days: DataFrame) -> DataFrame:
    """Daily ``peak_flag`` and ``festive_peak_flag`` (#102, S12)."""
    d = F.col("date")
    m, day = F.month(d), F.dayofmonth(d)
    cal = with_event_flags(spine, ranges, days)
    festive = F.greatest("is_range", "is_feast", "is_feast2")
    # Peak months and date ranges.
    peak = (m.isin(1, 7, 12) | (festive == 1) | ((m == 9) & (day == 23))
            | ((m == 11) & day.between(20, 30)) | ((m == 2) & day.between(10, 16))
            | ((m == 3) & day.between(15, 25)))
    return cal.select("date", peak.cast("int").alias("peak_flag"),
                      festive.alias("festive_peak_flag"))


def peak_ratio(peak: DataFrame) -> DataFrame:
    """Share of peak days among the spine days of each month (#49)."""
    return (peak.groupBy(D.month_start("date").alias("date"))
            .agg(F.sum("peak_flag").cast("bigint").alias("peak_days"),
                 F.count(F.lit(1)).alias("days_in_month"))
            .withColumn("ksa_shopping_peak_ratio",
                        F.col("peak_days") / F.col("days_in_month")))


def join_peak_calendar(panel: DataFrame, peak: DataFrame, date_col: str = "date") -> DataFrame:
    """Ratio by month and festive flag of the month-start date (#28, S12)."""
    ratio = peak_ratio(peak).select(F.col("date").alias("_ym"), "ksa_shopping_peak_ratio")
    fest = peak.select(F.col("date").alias("_d"), "festive_peak_flag")
    return (panel.join(F.broadcast(ratio), D.month_start(date_col) == F.col("_ym"), "left")
            .join(F.broadcast(fest), F.col(date_col) == F.col("_d"), "left")
            .drop("_ym", "_d"))


def holiday_count(panel: DataFrame, holidays: DataFrame, date_col: str = "date") -> DataFrame:
    """Holidays per (year, month) joined to the panel, 0 when none (#26, #94)."""
    counts = (holidays.groupBy(F.year("date").alias("_y"), F.month("date").alias("_m"))
              .agg(F.count(F.lit(1)).cast("int").alias("holiday_count")))
    out = panel.join(F.broadcast(counts),
                     (F.year(date_col) == F.col("_y")) & (F.month(date_col) == F.col("_m")), "left")
    return out.withColumn("holiday_count", F.coalesce("holiday_count", F.lit(0))).drop("_y", "_m")


def pre_post_event_flag(panel: DataFrame, monthly_flags: DataFrame, flag_col: str,
                        date_col: str = "date", out_col: str = "pre_post_event") -> DataFrame:
    """1 when the month before or after a flagged month is flagged (#38).

    ``monthly_flags`` has one row per month start with ``flag_col`` > 0 where
    the event happens; the flagged month starts are shifted ±1 month.
    """
    flagged = monthly_flags.filter(F.col(flag_col) > 0).select(F.col("date").alias("_f"))
    near = (flagged.select(F.explode(F.array(F.add_months("_f", -1), F.add_months("_f", 1)))
                           .alias("_d")).distinct().withColumn(out_col, F.lit(1)))
    return (panel.join(F.broadcast(near), F.col(date_col) == F.col("_d"), "left")
            .withColumn(out_col, F.coalesce(out_col, F.lit(0))).drop("_d"))


def date_features(df: DataFrame, date_col: str = "date", fourier_places: int | None = 6) -> DataFrame:
    parts = D.date_parts(date_col)
    if fourier_places is not None:
        for k in ("fourier_year_sin", "fourier_year_cos", "quarter_sin", "quarter_cos"):
            parts[k] = F.bround(parts[k], fourier_places) + F.lit(0.0)  # no -0.0
    return df.withColumns(parts)
