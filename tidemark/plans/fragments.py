"""Shared plan fragments: the feature tables that several queries and the pipeline reuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import calendar as CA
from tidemark.operators import encode as EN
from tidemark.operators import evaluate as EV
from tidemark.operators import extend as EX
from tidemark.operators import feature_store as FS
from tidemark.operators import intervals as IV
from tidemark.operators import marketing as MK
from tidemark.operators import recursive as RC
from tidemark.operators import rollup as RU
from tidemark.operators import windows as WN
from tidemark.plans.common import panel, stage_table, target_panel
from tidemark.plans.flagship import flagship
from tidemark.plans.params import (BRAND_REGION_PAIRS, HORIZON_MONTHS, REGIONS, SOURCES,
                                   TRAIN_END)
from tidemark.sources import bindings as B
from tidemark.sources.stats import date_span
from tidemark.sources.tables import table_path

PROMO_FEATURES = ["locationId", "date", "distinct_discount_levels", "avg_discount", "max_discount",
                  "min_discount", "avg_promo_duration", "percentage_products_on_promo",
                  "promo_days_in_month"]


def slug_name(column: str) -> str:
    """A column's name without blanks."""
    return column.replace(" ", "_")


FC_COLS = ["forecast_xgboost", "forecast_lgbm", "forecast_random_forest"]


MKT_SRC_COLS = [f"total_cost_usd_{s}" for s in SOURCES]
PROMO_FILL = [c for c in PROMO_FEATURES if c not in ("locationId", "date")]


def spine(spark, d, horizon: bool = False):
    """Day spine over the sales span; with ``horizon`` extended to the forecast horizon end.

    The span comes from the footers of the fact's files (#86), else from its rows.
    """
    span = date_span(spark, table_path(d, "lineitem"), "l_shipdate")
    if span is None:
        bounds = B.sales_lines(spark, d).agg(F.min("date").alias("start"),
                                             F.max("date").alias("end"))
    else:
        bounds = spark.range(1).select(F.lit(span[0]).alias("start"), F.lit(span[1]).alias("end"))
    if horizon:
        bounds = bounds.select("start", F.last_day(F.add_months("end", HORIZON_MONTHS))
                               .alias("end"))
    return CA.day_spine(bounds)


def event_years(spark, d):
    """Years that events are listed for: all of the panel and of the forecast horizon."""
    return B.event_years(panel(spark, d), HORIZON_MONTHS)


def cal(spark, d, variant="A", horizon: bool = False):
    years = event_years(spark, d)
    return CA.holiday_calendar(spine(spark, d, horizon), B.event_ranges(years),
                               B.event_days(years), variant)


def peak(spark, d, horizon: bool = False):
    years = event_years(spark, d)
    return CA.peak_calendar(spine(spark, d, horizon), B.event_ranges(years), B.event_days(years))


def rel(spark, d):
    return IV.relative_only(B.promotions(spark, d, strategies=["RELATIVE"]))


def sply_promo(spark, d):
    f = EX.truncate_at(IV.promo_features(rel(spark, d)).select(*PROMO_FEATURES),
                       last_month(spark, d))
    return EX.sply_extend(f, ["locationId"], horizon_end(spark, d))


def mkt(spark, d):
    m = MK.campaign_region(B.marketing(spark, d), REGIONS)
    return MK.filter_pairs(m, MK.pairs_table(spark, BRAND_REGION_PAIRS))


def stores_binned(spark, d):
    s = B.stores(spark, d).fillna(0.0, subset=["selling_square_ft"])
    return EN.quartile_bin(EN.quartile_bin(s, "total_square_ft"), "selling_square_ft", of=s)


def panel_stores(spark, d):
    s = B.stores(spark, d).select(F.col("store").alias("key"), "channel", "store_format", "city")
    return target_panel(spark, d).join(s, "key", "left")


def features_for_stub(spark, d):
    p = target_panel(spark, d)
    f = WN.moving_stats(WN.lag_features(p, (12,), train_end=TRAIN_END), (6,), ema=False)
    return p, f.filter(F.col("date") > F.lit(TRAIN_END).cast("date"))


def model_frames(spark, d):
    """Per-model forecast frames (stub scorers on all hold-out months) and actuals."""
    p, f = features_for_stub(spark, d)
    ma, lag = F.col("MA6_y"), F.col("Lag12_y")
    models = {
        "xgboost": f.select("key", "date", F.bround(ma, 0).alias("forecast_xgboost")),
        "lgbm": f.select("key", "date", F.bround(lag, 0).alias("forecast_lgbm")),
        "random_forest": f.select("key", "date",
                                  F.bround((ma + lag) / 2, 0).alias("forecast_random_forest")),
    }
    actuals = p.select("key", "date", F.col("target").cast("double").alias("target"))
    return models, actuals


def forecasts(spark, d):
    """Wide table (#33, #34, #126): inner join of model frames, left join of actuals."""
    models, actuals = model_frames(spark, d)
    wide = models["xgboost"].join(models["lgbm"], ["key", "date"]).join(
        models["random_forest"], ["key", "date"])
    return wide.join(actuals, ["key", "date"], "left")


def scored(spark, d):
    return EV.scored(EV.row_ape(forecasts(spark, d)))


def applied(spark, d):
    s = scored(spark, d)
    return EV.apply_store_champion(s, EV.champion_store(s))


def active_ids(spark, d):
    return RU.active_keys(panel(spark, d))


def last_month(spark, d):
    return panel(spark, d).select(F.max("date")).scalar()


def horizon_end(spark, d):
    """Last month of the forecast horizon."""
    return F.add_months(last_month(spark, d), HORIZON_MONTHS)


def sply_spend(spark, d, actual_flag=None):
    """Monthly spend up to the panel's last month, extended to the horizon's end."""
    m = EX.truncate_at(MK.monthly_with_sources(mkt(spark, d), SOURCES), last_month(spark, d),
                       "month")
    return EX.sply_extend(m, ["brand", "region"], horizon_end(spark, d), "month",
                          actual_flag=actual_flag)


def marketing_by_month(spark, d):
    return mkt(spark, d).select(F.trunc("date", "MM").alias("date"))


def common_start(spark, d, rows):
    """Rows from the latest of the first months of sales, promotions and spend on (#141)."""
    promo = rel(spark, d).select(F.trunc(F.min("eff_from"), "MM")).scalar()
    spend = marketing_by_month(spark, d).select(F.min("date")).scalar()
    return EX.align_start(rows, [target_panel(spark, d).select(F.min("date")).scalar(), promo,
                                 spend])


def with_covariates(spark, d, rows):
    """Store-month rows with all that is known of the month: calendar, marketing, stores,
    promotions (#20-31, #75)."""
    # Future rows need calendar features too: the spine runs to the horizon end.
    cal_m = CA.calendar_monthly(cal(spark, d, "A", horizon=True), "A")
    spend = (sply_spend(spark, d).groupBy(F.col("month").alias("date"))
             .agg(*[F.sum(c).cast("double").alias(c) for c in MKT_SRC_COLS]))
    stores = stores_binned(spark, d).withColumnRenamed("store", "key").drop("city")
    promo = sply_promo(spark, d).withColumnRenamed("locationId", "key")
    # Month-keyed tables (one row per month of the span/horizon: a proven
    # bound) are broadcast; a shuffle join on ``date`` would send all stores
    # of a month to one task.
    out = FS.left_join_by(rows, F.broadcast(cal_m), ["date"])
    out = FS.left_join_by(out, F.broadcast(spend), ["date"], {c: 0.0 for c in MKT_SRC_COLS})
    out = FS.left_join_by(out, stores, ["key"])
    out = FS.left_join_by(out, promo, ["key", "date"],
                          {c: 0 for c in PROMO_FILL})
    return FS.split_flag(out, TRAIN_END)


def feature_store(spark, d):
    """Panel + future rows + calendar + marketing + stores + promotions (#20-31, #75, #141)."""
    hist = common_start(spark, d, flagship(spark, d))
    # Keys and last month come from the (bucketed) panel, not from the
    # feature plan, so the window features are computed once.
    tp = target_panel(spark, d)
    rows = FS.add_future_rows(hist, tp, tp.select(F.max("date")).scalar(), HORIZON_MONTHS)
    return with_covariates(spark, d, rows)


def train_mean(tp):
    return tp.filter(F.col("date") <= F.lit(TRAIN_END).cast("date")).select(
        F.avg(F.col("target").cast("double"))).scalar()


MASTER_ENCODED = ("channel", "store_format", "key", "festive_peak_flag", "deriv_2_trend_flag")
# Those whose domain is fixed: 2 channels, 4 formats at most, a 0/1 flag, 3 trend labels.
MASTER_SMALL = ("channel", "store_format", "festive_peak_flag", "deriv_2_trend_flag")


def tourism(spark, d):
    """Cleaned monthly series extended 17 months by same-month-last-year (#84, #106)."""
    from tidemark.operators import series as SE
    s = SE.clean_month_series(B.month_series(spark, d)).select("date", "tourists")
    return EX.sply_extend_grouped(s, [], F.add_months(s.select(F.max("date")).scalar(), 17))


def whole_history(spark, d):
    """Per key and month what the reference takes from the whole history (#50, #65-66)."""
    tp = target_panel(spark, d)
    out = WN.seasonal_means(WN.rate_of_sale(WN.seasonality_index(tp)))
    return out.select("key", "date", *SEASONAL)


SEASONAL = ("Seasonality_Index", "rate_of_sale", "target_seasonal_monthly",
            "target_seasonal_quarterly")


def with_encodings(spark, d, rows, seasonal):
    """Calendar peaks, derivatives, date parts, encoders, tourism (FS stage) on store rows."""
    out = CA.join_peak_calendar(rows, peak(spark, d, horizon=True))
    dv = WN.derivatives(target_panel(spark, d)).withColumnRenamed("year_month", "date")
    out = out.join(dv, ["key", "date"], "left").join(seasonal, ["key", "date"], "left")
    out = CA.holiday_count(CA.date_features(out), B.holidays(event_years(spark, d)))
    # The encoder stage reads this frame about a dozen times (statistics,
    # priors, size checks, flags, the final rows): materialise it once in the
    # shared checkpoint folder instead of re-deriving the feature store.
    from tidemark.session import checkpoint
    out = checkpoint(out)
    train = (F.col("date") <= F.lit(TRAIN_END).cast("date")) & F.col("target").isNotNull()
    out = EN.target_encode(out, list(MASTER_ENCODED), train, small=MASTER_SMALL)
    out = EN.one_hot(out, "channel", ["ecommerce", "retail"])
    flagged = (out.filter(F.col("festive_peak_flag") == 1).select("date").distinct()
               .withColumn("_flag", F.lit(1)))
    out = CA.pre_post_event_flag(out, flagged, "_flag", out_col="pre_post_rm_flg")
    # One row per month (bounded): broadcast.
    return out.join(F.broadcast(tourism(spark, d)), "date", "left")


def master_table(spark, d):
    """Feature store + whole-history features, calendar peaks, derivatives, encoders, tourism."""
    return with_encodings(spark, d, feature_store(spark, d), whole_history(spark, d))


# What a model sees.  Known for any month in advance:
COVARIATES = (
    "ramadan_period", "public_holidays", "is_high_sales_intent_flag", "shopping_event_code",
    "fashion_week_season", "count_of_days", "uae_seasons", *MKT_SRC_COLS,
    "is_ecom_fullfillment_loc", "total_square_ft", "selling_square_ft", "total_square_ft_cat",
    "selling_square_ft_cat", *PROMO_FILL, "ksa_shopping_peak_ratio", "is_month_start",
    "is_month_end", "days_in_month", "fourier_year_sin", "fourier_year_cos", "quarter_sin",
    "quarter_cos", "holiday_count", "channel_encode", "store_format_encode", "key_encode",
    "festive_peak_flag_encode", "channel_retail", "pre_post_rm_flg", "tourists")
#: Groups of columns whose correlations are looked at together (#60).
CORR_GROUPS = {
    "seasonal": (*SEASONAL, *MKT_SRC_COLS),
    "store": ("is_ecom_fullfillment_loc", "total_square_ft", "selling_square_ft",
              "total_square_ft_cat", "selling_square_ft_cat"),
    "history": ("rate_of_sale", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y",
                "target_seasonal_monthly", "target_seasonal_quarterly", "key_encode",
                "store_format_encode", "channel_encode", "festive_peak_flag_encode"),
}


# From the targets before it; computed again at every step of a recursion:
FROM_TARGET = tuple(c for c in RC.STEP_FEATURES if c != "deriv_2_trend_flag") + (
    "deriv_2_trend_flag_encode",)
FEATURES = tuple(slug_name(c) for c in (*FROM_TARGET, *COVARIATES))
MODEL_INPUTS = ("lineitem", "supplier", "nation", "region", "part", "orders", "customer")


def model_table(spark, d):
    """One row per active store and month to the horizon's end, with ``FEATURES`` (#116).

    The master table's features, but those of the whole history only from earlier months
    (``rate_of_sale``, the seasonality index), as a forecast step sees them.  After the
    train end every store has every month, with a null target where it sold nothing or
    the month is still to come, so that a recursion finds the covariates of all months.
    Column names have no blanks.  Written once (see ``stage_table``).
    """
    def build():
        tp = target_panel(spark, d)
        last = tp.select(F.max("date")).scalar()
        months = F.months_between(last, F.trunc(F.lit(TRAIN_END).cast("date"), "MM")).cast(
            "int") + HORIZON_MONTHS
        grid = EX.future_grid(tp.select("key").distinct(), F.lit(TRAIN_END).cast("date"), months)
        hist = flagship(spark, d)
        empty = grid.join(hist.select("key", "date"), ["key", "date"], "left_anti")
        rows = with_covariates(spark, d, hist.unionByName(empty, allowMissingColumns=True))
        seasonal = (WN.seasonality_index_as_of(WN.rate_of_sale(tp, as_of=True))
                    .select("key", "date", "Seasonality_Index", "rate_of_sale"))
        out = with_encodings(spark, d, rows, seasonal)
        wanted = [c for c in out.columns if c in {*FROM_TARGET, *COVARIATES}]
        return out.select("key", "date", F.col("target").cast("double").alias("target"),
                          "deriv_2_trend_flag",
                          *[F.col(f"`{c}`").cast("double").alias(slug_name(c)) for c in wanted])

    return stage_table(spark, d, "model_table", MODEL_INPUTS, build)


def ml_frames(spark, d):
    """Train rows and hold-out rows of the model table that have a target."""
    f = model_table(spark, d).filter(F.col("target").isNotNull())
    cut = F.lit(TRAIN_END).cast("date")
    return f.filter(F.col("date") <= cut), f.filter(F.col("date") > cut)


def trend_mapping(spark, d):
    """The trend labels and the codes that training gave them (#115)."""
    return (model_table(spark, d).filter(F.col("deriv_2_trend_flag").isNotNull())
            .groupBy("deriv_2_trend_flag")
            .agg(F.max("deriv_2_trend_flag_encode").alias("deriv_2_trend_flag_encode")))
