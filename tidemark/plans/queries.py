"""Registered queries: one per operator of the survey inventory.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables (or data Spark derives from them).
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import key_month_label, last_friday_of_november, season_code, slug
from tidemark.operators import calendar as CA
from tidemark.operators import encode as EN
from tidemark.operators import evaluate as EV
from tidemark.operators import extend as EX
from tidemark.operators import feature_store as FS
from tidemark.operators import intervals as IV
from tidemark.operators import marketing as MK
from tidemark.operators import ml as ML
from tidemark.operators import profile as PR
from tidemark.operators import recursive as RC
from tidemark.operators import rollup as RU
from tidemark.operators import series as SE
from tidemark.operators import windows as WN
from tidemark.operators.contract import FeatureContract
from tidemark.plans import models as M
from tidemark.plans.common import Run, compute_panel, panel, rnd, stage_table, target_panel
from tidemark.plans.flagship import flagship
from tidemark.plans.fragments import (CORR_GROUPS, FEATURES, FROM_TARGET, MASTER_ENCODED,
                                      MODEL_INPUTS, PROMO_FEATURES, SEASONAL, active_ids,
                                      applied, cal, event_years, feature_store, forecasts,
                                      last_month, marketing_by_month, master_table, mkt,
                                      ml_frames, model_frames, panel_stores, peak, rel, scored,
                                      spine, sply_promo, sply_spend, stores_binned, train_mean)
from tidemark.plans.params import (CUTOFF_LABEL, HORIZON_MONTHS, LAGS, REGIONS, SOURCES,
                                   TRAIN_END, WINDOWS)
from tidemark.session import apply_core_conf
from tidemark.sources import bindings as B
from tidemark.sources import io as IO
from tidemark.sources import registry
from tidemark.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; it runs under the package's session settings (UTC, AQE)."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, d: str) -> DataFrame:
            return fn(apply_core_conf(spark), d)

        QUERIES[name] = run
        return run
    return deco


# ---------------------------------------------------------------- panel
@query("monthly_rollup")
def q_monthly_rollup(spark, d):
    return compute_panel(spark, d)


@query("active_stores")
def q_active_stores(spark, d):
    return RU.keep_active(panel(spark, d))


@query("lag_features")
def q_lag_features(spark, d):
    df = WN.lag_features(target_panel(spark, d), LAGS, train_end=TRAIN_END)
    return rnd(df, [f"Lag{k}_y" for k in LAGS])


@query("moving_stats")
def q_moving_stats(spark, d):
    df = WN.moving_stats(target_panel(spark, d), WINDOWS)
    return rnd(df, [f"{p}{w}_y" for w in WINDOWS for p in ("MA", "STD", "EMA")])


@query("ema")
def q_ema(spark, d):
    df = WN.moving_stats(target_panel(spark, d), (3, 12), ema=True)
    df = df.drop(*[c for c in df.columns if c.startswith(("MA", "STD"))])
    return rnd(df, ["EMA3_y", "EMA12_y"])


@query("seasonality_index")
def q_seasonality_index(spark, d):
    return WN.seasonality_index(target_panel(spark, d))


@query("seasonal_means")
def q_seasonal_means(spark, d):
    return rnd(WN.seasonal_means(target_panel(spark, d)),
               ["target_seasonal_monthly", "target_seasonal_quarterly"])


@query("rate_of_sale")
def q_rate_of_sale(spark, d):
    return rnd(WN.rate_of_sale(target_panel(spark, d)), ["rate_of_sale"])


@query("derivatives")
def q_derivatives(spark, d):
    return WN.derivatives(target_panel(spark, d))


# ---------------------------------------------------------------- calendar
@query("calendar_daily")
def q_calendar_daily(spark, d):
    return cal(spark, d, "A")


@query("holiday_flags")
def q_holiday_flags(spark, d):
    return cal(spark, d, "A").select("date", "national_holiday_flag", "is_eid_fitr",
                                      "is_eid_adha", "public_holidays")


@query("ramadan_flags")
def q_ramadan_flags(spark, d):
    years = event_years(spark, d)
    ev = CA.with_event_flags(spine(spark, d), B.event_ranges(years), B.event_days(years))
    return ev.select("date", F.col("is_range").alias("is_ramadan"),
                     F.col("pre_range").alias("pre_ramadan"),
                     F.col("post_range").alias("post_ramadan"),
                     F.greatest("is_range", "pre_range", "post_range").alias("ramadan_period"))


@query("eid_flags")
def q_eid_flags(spark, d):
    return cal(spark, d, "A").select("date", "is_eid_fitr", "is_eid_adha", "pre_eid_shopping")


@query("shopping_events")
def q_shopping_events(spark, d):
    return cal(spark, d, "A").select(
        "date", "dubai_shopping_festival", "dubai_summer_surprises", "end_of_season_sales",
        "year_end_sales", "black_friday_week", "is_high_sales_intent_flag", "shopping_event_code")


@query("black_friday")
def q_black_friday(spark, d):
    return (spine(spark, d).withColumn("black_friday_week",
                                        CA.D.black_friday_week("date"))
            .filter("black_friday_week = 1")
            .select("date", last_friday_of_november(F.year("date")).alias("black_friday")))


@query("luxury_season")
def q_luxury_season(spark, d):
    return cal(spark, d, "B").select(
        "date", "fashion_week_season", "riyadh_fashion_week", "jeddah_fashion_week",
        "luxury_ramadan_eid_season", "saudi_national_day_season", "luxury_season",
        "is_high_sales_intent_flag", "shopping_event_code", "public_holidays")


@query("calendar_monthly")
def q_calendar_monthly(spark, d):
    return CA.calendar_monthly(cal(spark, d, "A"), "A")


@query("calendar_monthly_b")
def q_calendar_monthly_b(spark, d):
    return CA.calendar_monthly(cal(spark, d, "B"), "B")


@query("season_code")
def q_season_code(spark, d):
    return target_panel(spark, d).select("key", "date", season_code(F.month("date"))
                                         .alias("uae_seasons"))


@query("peak_calendar")
def q_peak_calendar(spark, d):
    return peak(spark, d)


@query("peak_ratio")
def q_peak_ratio(spark, d):
    return rnd(CA.peak_ratio(peak(spark, d)), ["ksa_shopping_peak_ratio"])


@query("peak_calendar_join")
def q_peak_calendar_join(spark, d):
    return rnd(CA.join_peak_calendar(target_panel(spark, d), peak(spark, d)),
               ["ksa_shopping_peak_ratio"])


@query("holiday_count")
def q_holiday_count(spark, d):
    return CA.holiday_count(target_panel(spark, d), B.holidays(event_years(spark, d)))


@query("pre_post_event_flag")
def q_pre_post_event_flag(spark, d):
    p = CA.join_peak_calendar(target_panel(spark, d), peak(spark, d)).drop(
        "ksa_shopping_peak_ratio")
    months = p.filter("festive_peak_flag = 1").select("date").distinct() \
              .withColumn("flag", F.lit(1))
    return CA.pre_post_event_flag(p, months, "flag", out_col="pre_post_rm_flg")


@query("date_features")
def q_date_features(spark, d):
    return CA.date_features(target_panel(spark, d))


# ---------------------------------------------------------------- promotions
@query("promo_length")
def q_promo_length(spark, d):
    return rnd(IV.with_length(rel(spark, d)), ["discount_efficiency"])


@query("promo_span")
def q_promo_span(spark, d):
    return IV.promo_span(rel(spark, d))


@query("promo_days")
def q_promo_days(spark, d):
    return IV.promo_days(rel(spark, d))


@query("promo_monthly")
def q_promo_monthly(spark, d):
    return rnd(IV.promo_monthly(rel(spark, d)), ["avg_discount", "avg_promo_duration"])


@query("promo_features")
def q_promo_features(spark, d):
    return IV.promo_features(rel(spark, d)).select(*PROMO_FEATURES)


@query("sply_promo")
def q_sply_promo(spark, d):
    return sply_promo(spark, d)


@query("available_months")
def q_available_months(spark, d):
    am = IV.available_months(sply_promo(spark, d))
    return am.select("locationId", F.size("available_months").alias("n_months"),
                     F.array_join(F.transform("available_months",
                                              lambda x: F.date_format(x, "yyyy-MM")), ",")
                     .alias("available_months"))


# ---------------------------------------------------------------- marketing
MKT_DOUBLES = ["ctr_l", "cpm_l", "cpc_l", "CPM", "CPC", "CTR"]


@query("campaign_region")
def q_campaign_region(spark, d):
    return MK.campaign_region(B.marketing(spark, d), REGIONS).select(
        "date", "brand", "campaign_name", "region")


@query("marketing_monthly")
def q_marketing_monthly(spark, d):
    return rnd(MK.monthly_metrics(mkt(spark, d)), MKT_DOUBLES)


@query("marketing_pivot")
def q_marketing_pivot(spark, d):
    return rnd(MK.monthly_with_sources(mkt(spark, d), SOURCES), MKT_DOUBLES)


@query("sply_marketing")
def q_sply_marketing(spark, d):
    out = sply_spend(spark, d, actual_flag="is_actual")
    return rnd(out.withColumn("is_actual", F.col("is_actual") == 1), MKT_DOUBLES)


# ---------------------------------------------------------------- stores & encoders
@query("quartile_bins")
def q_quartile_bins(spark, d):
    return stores_binned(spark, d)


@query("target_encode")
def q_target_encode(spark, d):
    df = EN.target_encode(panel_stores(spark, d), ["channel", "store_format", "key"],
                          F.col("date") <= F.lit(TRAIN_END).cast("date"),
                          small=("channel", "store_format"))
    return rnd(df, ["channel_encode", "store_format_encode", "key_encode"])


@query("target_share_encode")
def q_target_share_encode(spark, d):
    df = EN.target_share_encode(panel_stores(spark, d), ["channel", "store_format", "key"],
                                small=("channel", "store_format"))
    return rnd(df, ["channel_target_pct", "store_format_target_pct", "key_target_pct"], 6)


@query("one_hot")
def q_one_hot(spark, d):
    return EN.one_hot(B.stores(spark, d), "channel", ["ecommerce", "retail"])


@query("binary_encode")
def q_binary_encode(spark, d):
    s = B.stores(spark, d)
    s = EN.binary_map(s, "city", "NATION_3", "NATION_13", out="city_code")
    return EN.binary_map(s, "channel", "ecommerce", out="channel_code")


@query("binary_encode_sets")
def q_binary_encode_sets(spark, d):
    """Membership of a set, without regard to case (#114)."""
    s = B.stores(spark, d)
    s = EN.binary_map(s, "city", ["nation_3", "NATION_13", "Nation_8"], out="primary_city",
                      fold=True)
    return EN.binary_map(s, "store_format", ["asia", "europe"], ["AFRICA"], out="format_code",
                         fold=True)


# ---------------------------------------------------------------- evaluation
APE_COLS = [f"{m}_row_mape" for m in EV.MODELS]


@query("forecast_wide")
def q_forecast_wide(spark, d):
    return forecasts(spark, d)


@query("forecast_long")
def q_forecast_long(spark, d):
    models, _ = model_frames(spark, d)
    parts = [df.select("key", "date", F.lit(m).alias("model"),
                       F.col(f"forecast_{m}").alias("forecast")) for m, df in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("label", key_month_label("key", "date"))


@query("row_mape")
def q_row_mape(spark, d):
    return rnd(EV.row_ape(forecasts(spark, d)), APE_COLS)


@query("forecast_clean")
def q_forecast_clean(spark, d):
    return rnd(scored(spark, d), APE_COLS)


@query("metrics")
def q_metrics(spark, d):
    return rnd(EV.metrics(scored(spark, d)),
               ["mape", "wmape", "mae", "rmse", "std_actual", "r2", "rmse_over_std"])


@query("champion_row")
def q_champion_row(spark, d):
    return rnd(EV.champion_row(scored(spark, d)), APE_COLS + ["best_row_mape"])


STORE_DBL = ["xgboost_mape", "lgbm_mape", "random_forest_mape", "best_mape"]


@query("champion_store")
def q_champion_store(spark, d):
    return rnd(EV.champion_store(scored(spark, d)), STORE_DBL)


@query("champion_store4")
def q_champion_store4(spark, d):
    return rnd(EV.champion_store(scored(spark, d), with_row_champion=True),
               STORE_DBL + ["best_forecast_monthly_mape"])


@query("champion_filtered")
def q_champion_filtered(spark, d):
    s = scored(spark, d).filter(F.month("date").isin(5, 6, 7))
    return rnd(EV.champion_store(s), STORE_DBL)


@query("champion_applied")
def q_champion_applied(spark, d):
    return rnd(applied(spark, d), APE_COLS + ["mape_best_model"])


@query("mape_by_month")
def q_mape_by_month(spark, d):
    return rnd(EV.mape_by_month(applied(spark, d)), ["mape"])


@query("mape_overall")
def q_mape_overall(spark, d):
    out = EV.mape_overall(EV.champion_store(scored(spark, d)))
    return rnd(out, out.columns)


@query("champion_compare")
def q_champion_compare(spark, d):
    s = scored(spark, d)
    rw = EV.champion_row(s).agg(F.avg("best_row_mape").alias("row_wise_mape"))
    champs = EV.champion_store(s)
    sw = EV.apply_store_champion(s, champs).agg(F.avg("mape_best_model").alias("store_wise_mape"))
    mean_best = champs.agg(F.avg("best_mape").alias("mean_store_best_mape"))
    out = rw.select("row_wise_mape", sw.scalar().alias("store_wise_mape"),
                    mean_best.scalar().alias("mean_store_best_mape"))
    return rnd(out, out.columns)


@query("model_wins")
def q_model_wins(spark, d):
    return EV.model_wins(EV.champion_row(scored(spark, d)), "best_model_monthly")


@query("model_summary")
def q_model_summary(spark, d):
    champs = EV.champion_store(scored(spark, d))
    brands = B.stores(spark, d).select(F.col("store").alias("key"),
                                       F.col("store_format").alias("brand"))
    return rnd(EV.model_summary(champs.join(brands, "key", "left"), ["brand"]), ["avg_mape"])


@query("worst_stores")
def q_worst_stores(spark, d):
    champs = EV.champion_store(scored(spark, d))
    return rnd(EV.worst(champs, 10)
               .select("key", "target", "best_model_store", "best_mape"), ["best_mape"])


@query("exclude_keys")
def q_exclude_keys(spark, d):
    excluded = B.stores(spark, d).filter(F.col("channel") == "ecommerce").select(
        F.col("store").alias("key"))
    return forecasts(spark, d).join(excluded, "key", "left_anti")


@query("report_table")
def q_report_table(spark, d):
    s = EV.row_ape(forecasts(spark, d), ["xgboost"])
    promo = IV.promo_features(rel(spark, d)).select(
        F.col("locationId").alias("key"), "date", F.col("avg_discount").alias("promo_depth"))
    spend = (mkt(spark, d).groupBy(F.trunc("date", "MM").alias("date"))
             .agg(F.sum("total_cost_usd").cast("double").alias("marketing_spend")))
    # ``spend`` has one row per month (bounded): broadcast, never a date-keyed shuffle.
    t = s.join(promo, ["key", "date"], "left").join(F.broadcast(spend), "date", "left")
    return t.select(
        "date", F.col("key").cast("bigint").alias("store"), F.lit("ALL").alias("brand"),
        F.col("target").cast("bigint").alias("actual_units"),
        F.bround("forecast_xgboost", 0).cast("bigint").alias("forecasted_units"),
        F.coalesce(F.bround("xgboost_row_mape", 0), F.lit(0.0)).cast("bigint").alias("MAPE"),
        F.lit("Monthly").alias("frequency"),
        F.coalesce("promo_depth", F.lit(0.0)).alias("promo_depth"),
        F.coalesce("marketing_spend", F.lit(0.0)).alias("marketing_spend"))


# ---------------------------------------------------------------- profiling & hygiene
FEATURE_COLS = ["target", "ppu", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y"]


@query("profile")
def q_profile(spark, d):
    return PR.profile(flagship(spark, d))


@query("value_counts")
def q_value_counts(spark, d):
    return PR.value_counts(B.stores(spark, d),
                           ["channel", "store_format", "city", "is_ecom_fullfillment_loc"])


@query("corr_pairs")
def q_corr_pairs(spark, d):
    return rnd(PR.corr_pairs(flagship(spark, d), FEATURE_COLS), ["corr"])


@query("corr_matrix")
def q_corr_matrix(spark, d):
    """Correlations of the whole master table's numbers and of three groups of them (#60)."""
    from tidemark.session import checkpoint
    master = q_master_table(spark, d)
    numbers = [c for c, t in master.dtypes if t in ("int", "bigint", "double")]
    groups = {"all": numbers, **CORR_GROUPS}
    wanted = dict.fromkeys(c for cols in groups.values() for c in cols)
    out = PR.corr_groups(checkpoint(master.select(*[F.col(f"`{c}`") for c in wanted])), groups)
    return rnd(out, ["corr"], 3).withColumn("corr", F.col("corr") + 0.0)  # no minus zero


@query("dup_report")
def q_dup_report(spark, d):
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    return PR.duplicates(li.select(F.col("l_orderkey").alias("tran_seq_no"),
                                   F.col("l_linenumber").alias("line")))


@query("dedup_first")
def q_dedup_first(spark, d):
    return PR.keep_first(rel(spark, d), ["locationId", "eff_from"],
                         ["itemId", "eff_to", "amountOfDiscount"])


# ---------------------------------------------------------------- scans & sinks
SCAN_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
SCAN_COUNTRIES = ("NATION_3", "NATION_13", "NATION_8")


@query("scan_sales")
def q_scan_sales(spark, d):
    return B.sales(spark, d, brands=SCAN_BRANDS, countries=SCAN_COUNTRIES,
                   start="1997-01-01", end="1998-12-31")


@query("scan_promos")
def q_scan_promos(spark, d):
    p = IO.overlapping(B.promotions(spark, d), "1998-01-01", "1998-03-31")
    return IO.in_ids(p, active_ids(spark, d), "locationId", "key")


@query("scan_stores")
def q_scan_stores(spark, d):
    return IO.in_ids(B.stores(spark, d), active_ids(spark, d), "store", "key")


@query("scan_marketing")
def q_scan_marketing(spark, d):
    return B.marketing(spark, d, start="1998-01-01", end="1998-12-31", brand="BUILDING")


@query("sink_roundtrip")
def q_sink_roundtrip(spark, d):
    f = IV.promo_features(rel(spark, d)).select(*PROMO_FEATURES)
    path = IO.shared_dir(spark, "sink_roundtrip")
    # One write per combination: a later one must leave the earlier ones alone.
    for brand, end in (("all", TRAIN_END), ("other", TRAIN_END), ("all", "1999-12-31")):
        IO.write_partitioned(f.withColumns({
            "target": F.lit("units"), "brand": F.lit(brand),
            "cutoff_month": F.lit(CUTOFF_LABEL), "train_end": F.lit(end)}),
            path, ["target", "brand", "cutoff_month", "train_end"])
    back = spark.read.parquet(path).filter((F.col("target") == "units")
                                           & (F.col("cutoff_month") == CUTOFF_LABEL))
    return back.select("brand", F.col("train_end").cast("string").alias("train_end"),
                       *PROMO_FEATURES)


@query("csv_roundtrip")
def q_csv_roundtrip(spark, d):
    """Forecasts written as CSV and read back with their schema (#7)."""
    fc = rnd(forecasts(spark, d), ["target", *(f"forecast_{m}" for m in EV.MODELS)])
    path = IO.write_csv(fc, IO.shared_dir(spark, "csv"))
    return IO.read_csv(spark, path, ",".join(f"{c} {t}" for c, t in fc.dtypes))


@query("truncate_and_load")
def q_truncate_and_load(spark, d):
    """A table loaded twice, read during and after the second load; an empty third load
    leaves it alone (#8, #10)."""
    rows = B.stores(spark, d).select("store", "channel", "store_format")
    name = f"tidemark_load_{uuid.uuid4().hex[:12]}"
    IO.save_table(rows.filter(F.col("channel") == "retail"), name)
    during = spark.table(name)
    IO.save_table(rows, name)
    try:
        IO.save_table(rows.limit(0), name)
    except IO.EmptyResult:
        left_alone = True
    else:
        left_alone = False
    return (during.withColumn("seen", F.lit("during"))
            .unionByName(spark.table(name).withColumn("seen", F.lit("after")))
            .withColumn("empty_load_refused", F.lit(left_alone)))


@query("blanket_fill")
def q_blanket_fill(spark, d):
    """Every numeric column's NULL becomes 0 (#20)."""
    return FS.blanket_fill(B.stores(spark, d))


@query("promo_day_rows")
def q_promo_day_rows(spark, d):
    """One row per location and day on promotion (#79)."""
    return IV.explode_days(rel(spark, d))


@query("brand_panel")
def q_brand_panel(spark, d):
    """The panel of one brand's sales amounts, its own active stores (#24)."""
    return target_panel(spark, Run(d, "Brand#1", "sales")).select("key", "business_type", "date",
                                                                  "target")


# ---------------------------------------------------------------- grids, series, feature store
@query("horizon_dates")
def q_horizon_dates(spark, d):
    p = panel(spark, d)
    return (p.agg(F.max("date").alias("origin"))
            .select(F.explode(F.sequence(F.lit(1), F.lit(HORIZON_MONTHS))).alias("h"), "origin")
            .select("h", F.add_months("origin", F.col("h")).alias("date"))
            .withColumn("month_end", F.last_day("date")))


@query("future_grid")
def q_future_grid(spark, d):
    return EX.future_grid(active_ids(spark, d), last_month(spark, d), HORIZON_MONTHS)


@query("align_start")
def q_align_start(spark, d):
    promo_start = IV.promo_features(rel(spark, d)).select(F.min("date")).scalar()
    mkt_start = marketing_by_month(spark, d).select(F.min("date")).scalar()
    tp = target_panel(spark, d)
    return EX.align_start(tp, [tp.select(F.min("date")).scalar(), promo_start, mkt_start])


@query("clean_month_series")
def q_clean_month_series(spark, d):
    return SE.clean_month_series(B.month_series(spark, d))


@query("sply_series")
def q_sply_series(spark, d):
    s = SE.clean_month_series(B.month_series(spark, d)).select("date", "tourists")
    last = s.select(F.max("date")).scalar()
    out = EX.sply_extend_grouped(s, [], F.add_months(last, 17))
    return out.withColumns({"year": F.year("date"), "month": F.month("date")})


@query("slug")
def q_slug(spark, d):
    return (B.marketing(spark, d).select("brand", "campaign_name")
            .select("brand", slug(F.concat_ws(" ", "brand", "campaign_name")).alias("slug")))


@query("detect_date_format")
def q_detect_date_format(spark, d):
    s = panel(spark, d).select("key", F.date_format("date", "M-d-yyyy").alias("date_str"))
    return SE.detect_date_format(s, "date_str")


@query("train_test_split")
def q_train_test_split(spark, d):
    return FS.split_flag(target_panel(spark, d), TRAIN_END)


@query("recency_weight")
def q_recency_weight(spark, d):
    tr = target_panel(spark, d).filter(F.col("date") <= F.lit(TRAIN_END).cast("date"))
    return rnd(FS.recency_weight(tr, TRAIN_END), ["weight"], 6)


@query("feature_store")
def q_feature_store(spark, d):
    return feature_store(spark, d)


# ---------------------------------------------------------------- recursion
@query("recursive_features")
def q_recursive_features(spark, d):
    """All step features of the month after the panel's last, for every store (#124).

    Seasonality over all stores, as the panel has it, and over the store's own rows.
    """
    tp = target_panel(spark, d)
    origin = last_month(spark, d)
    month = F.add_months("_origin", 1)
    everyone = RC.GlobalSeason(tp, origin, "key", "date", "target")
    st = RC.initial_state(tp, origin).withColumn("_mean", train_mean(tp))
    feats = RC.step_features(month, F.col("_mean"), everyone.column())
    feats["Seasonality_Index_key"] = RC.seasonality_of(F.col("_season"), F.month(month))
    out = st.select("key", month.alias("date"), *[v.alias(k) for k, v in feats.items()])
    return rnd(out, ["Lag12_y", "MA6_y", "STD6_y", "EMA6_y", "rate_of_sale"])


@query("recursive_forecast_naive")
def q_recursive_forecast_naive(spark, d):
    """A fixed rule with one covariate (days on promotion), from the train end, for all
    stores and the same months (#125)."""
    tp = target_panel(spark, d)
    origin = F.trunc(F.lit(TRAIN_END).cast("date"), "MM")
    promo = sply_promo(spark, d).select(F.col("locationId").alias("key"), "date",
                                        "promo_days_in_month")
    grid = EX.future_grid(tp.select("key").distinct(), origin, HORIZON_MONTHS)
    known = FS.left_join_by(grid, promo, ["key", "date"], {"promo_days_in_month": 0})

    def score(h, now):
        f = RC.next_features(h, F.col("_mean"))
        return (0.5 * f["Lag12_y"] + 0.5 * F.coalesce(f["MA6_y"], F.col("_mean"))
                + 0.1 * now["promo_days_in_month"])

    out = RC.recursive_forecast_expr(
        tp, HORIZON_MONTHS, score, constants={"_mean": train_mean(tp)}, origin=origin,
        covariates=RC.covariates_by_step(known, ["promo_days_in_month"], origin, HORIZON_MONTHS))
    return rnd(out, ["forecast"])


@query("feature_contract")
def q_feature_contract(spark, d):
    """A feature list enforced on rows that lack a column, have one too many and one as text
    (#22)."""
    good = flagship(spark, d)
    contract = FeatureContract.of(good, ["EMA6_y", "Lag12_y", "STD6_y", "MA6_y", "ppu"],
                                  fills={"STD6_y": -1.0})
    bad = (good.drop("STD6_y").withColumn("extra", F.lit("x"))
           .withColumn("Lag12_y", F.when(F.month("date") == 1, "n/a")
                       .otherwise(F.col("Lag12_y").cast("decimal(18,4)").cast("string"))))
    found = contract.problems(bad.drop("key", "date", "business_type", "target"))
    return contract.enforce(bad, keep=["key", "date"]).withColumn(
        "problems", F.lit("; ".join(f"{k}: {','.join(v)}" for k, v in sorted(found.items()))))


# ---------------------------------------------------------------- modelling
def _holdout(spark, d, name):
    _, test = ml_frames(spark, d)
    return M.predictions(M.published(spark, d, name), name, test)


def _finite_rows(pred):
    """What SQL can say of predictions: their rows, and that all are finite numbers."""
    p = F.col("prediction")
    return pred.select("key", "date", "target", (p.isNotNull() & ~F.isnan(p) & (
        F.abs(p) < F.lit(float("inf")))).alias("finite"))


def _within_training(spark, d, pred):
    """A forest averages training targets: no prediction leaves their range."""
    train, _ = ml_frames(spark, d)
    low = train.select(F.min("target")).scalar()
    high = train.select(F.max("target")).scalar()
    return _finite_rows(pred.withColumn("prediction", F.when(
        F.col("prediction").between(low - 1e-6, high + 1e-6), F.col("prediction"))))


@query("train_rf")
def q_train_rf(spark, d):
    return _holdout(spark, d, "random_forest")


@query("train_rf_facts")
def q_train_rf_facts(spark, d):
    return _within_training(spark, d, _holdout(spark, d, "random_forest"))


@query("train_gbt")
def q_train_gbt(spark, d):
    return _holdout(spark, d, "xgboost")


@query("train_gbt_facts")
def q_train_gbt_facts(spark, d):
    return _finite_rows(_holdout(spark, d, "xgboost"))


@query("train_gbt_fine")
def q_train_gbt_fine(spark, d):
    return _holdout(spark, d, "lgbm")


@query("train_gbt_fine_facts")
def q_train_gbt_fine_facts(spark, d):
    return _finite_rows(_holdout(spark, d, "lgbm"))


_SEARCHES: dict = {}


def _search(spark, d):
    """The forest's search over the target-derived features, once per application and folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _SEARCHES:
        train, _ = ml_frames(spark, d)
        _SEARCHES[key] = ML.tuned(["random_forest"], train, draws=10, folds=3,
                                  features=FROM_TARGET)[1]
    return spark.createDataFrame(
        _SEARCHES[key], "model string, draw int, params string, cv_rmse double, chosen boolean")


@query("tune_model")
def q_tune_model(spark, d):
    return _search(spark, d).select("draw", "params", "cv_rmse")


@query("tune_model_facts")
def q_tune_model_facts(spark, d):
    """Ten draws with different parameters and a positive error each; the best is chosen."""
    rows = _search(spark, d)
    return rows.groupBy("model").agg(
        F.count(F.lit(1)).alias("draws"), F.countDistinct("params").alias("different"),
        F.count_if(F.col("cv_rmse") > 0).alias("positive"),
        F.count_if("chosen").alias("chosen"))


@query("train_all")
def q_train_all(spark, d):
    _, test = ml_frames(spark, d)
    rows = []
    for name, v in M.all_published(spark, d).items():
        scored = M.predictions(v, name, test)
        error = scored.select(F.sqrt(F.avg((F.col("target") - F.col("prediction")) ** 2)))
        rows.append((name, f"{v.folder}/models/{name}", error.first()[0]))
    return spark.createDataFrame(rows, "model string, path string, holdout_rmse double")


@query("train_all_facts")
def q_train_all_facts(spark, d):
    """Every candidate is saved, reloads with its feature list and predicts the hold-out."""
    rows = [(r["model"], len(M.published(spark, d, r["model"]).contract(r["model"]).names),
             r["holdout_rmse"] > 0) for r in q_train_all(spark, d).collect()]
    return spark.createDataFrame(rows, "model string, features int, has_error boolean")


@query("feature_importance")
def q_feature_importance(spark, d):
    return ML.importances(spark, M.published(spark, d, "xgboost").model("xgboost"), FEATURES)


@query("feature_importance_facts")
def q_feature_importance_facts(spark, d):
    """One row per feature; shares are not negative and add up to one."""
    total = F.sum("importance").over(Window.partitionBy())
    return q_feature_importance(spark, d).select(
        "feature", (F.col("importance") >= 0).alias("not_negative"),
        F.bround(total, 6).alias("total"))


def _model_forecasts(spark, d):
    versions = M.all_published(spark, d)

    def build():
        return M.wide_forecasts(spark, d, versions, M.train_origin())

    return stage_table(spark, d, "model_forecasts", MODEL_INPUTS, build)


@query("recursive_forecast")
def q_recursive_forecast(spark, d):
    """Every model forecasts H months ahead for all stores; wide table (#125-126)."""
    return _model_forecasts(spark, d)


@query("recursive_forecast_facts")
def q_recursive_forecast_facts(spark, d):
    """Every active store has every month after the train end, from every model."""
    ok = [F.col(f"forecast_{n}").isNotNull() & ~F.isnan(f"forecast_{n}") for n in EV.MODELS]
    return _model_forecasts(spark, d).select(
        "key", "date", "target", (ok[0] & ok[1] & ok[2]).alias("forecast_by_all"))


@query("trend_label_encode")
def q_trend_label_encode(spark, d):
    """Trend label encoded on train rows, saved as a mapping, applied from disk (#9, #111, #115)."""
    tp = target_panel(spark, d)
    dv = WN.derivatives(tp).select("key", F.col("year_month").alias("date"), "deriv_2_trend_flag")
    rows = tp.join(dv, ["key", "date"], "left")
    train = rows.filter(F.col("date") <= F.lit(TRAIN_END).cast("date"))
    root = IO.shared_dir(spark, "registry")
    draft = registry.Draft(spark, M.scope_of(spark, d), root)
    draft.mapping("trend", EN.target_encoding_table(train, "deriv_2_trend_flag"),
                  "deriv_2_trend_flag", "deriv_2_trend_flag_encode")
    draft.commit()
    mapping = registry.latest(spark, root, M.scope_of(spark, d)).mapping("trend")
    return rnd(EN.apply_mapping(rows, mapping, "deriv_2_trend_flag", small=True),
               ["deriv_2_trend_flag_encode"])


@query("train_recency_weighted")
def q_train_recency_weighted(spark, d):
    """Random forest fit with recency sample weights (#128) — hold-out predictions."""
    return _holdout(spark, d, "weighted_forest")


@query("train_recency_weighted_facts")
def q_train_recency_weighted_facts(spark, d):
    return _within_training(spark, d, _holdout(spark, d, "weighted_forest"))


def _permuted(spark, d):
    def build():
        _, test = ml_frames(spark, d)
        return ML.permutation_importance(
            spark, M.published(spark, d, "xgboost").model("xgboost"), test, FEATURES)

    return stage_table(spark, d, "permutation_importance", MODEL_INPUTS, build)


@query("permutation_importance")
def q_permutation_importance(spark, d):
    """Hold-out RMSE increase per permuted feature for the depth-wise booster (#127)."""
    return _permuted(spark, d).orderBy(F.desc("rmse_increase"), "feature")


@query("permutation_importance_facts")
def q_permutation_importance_facts(spark, d):
    return _permuted(spark, d).select("feature", F.col("rmse_increase").isNotNull()
                                      .alias("measured"))


@query("master_table")
def q_master_table(spark, d):
    return rnd(master_table(spark, d), [f"{c}_encode" for c in MASTER_ENCODED]
               + ["ksa_shopping_peak_ratio", *SEASONAL])
