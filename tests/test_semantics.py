"""Hand-made goldens for the semantics notes (FIXTURES.md part C)."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import last_friday_of_november
from tidemark.operators import calendar as CA
from tidemark.operators import encode as EN
from tidemark.operators import evaluate as EV
from tidemark.operators import extend as EX
from tidemark.operators import intervals as IV
from tidemark.operators import marketing as MK
from tidemark.operators import rollup as RU
from tidemark.operators import series as SE
from tidemark.operators import windows as WN

D = dt.date


def panel_df(spark, values, key="a", start=D(2023, 1, 1)):
    rows = [(key, pd.Timestamp(start) + pd.DateOffset(months=i), float(v))
            for i, v in enumerate(values)]
    rows = [(k, d.date(), v) for k, d, v in rows]
    return spark.createDataFrame(rows, "key string, date date, target double")


def col(df, c, order="date"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_ema_golden(spark):
    df = WN.moving_stats(panel_df(spark, [5, 7, 1, 9, 3, 8, 0]), (6,))
    got = col(df, "EMA6_y")[1:]
    assert got == pytest.approx([5, 5.571429, 4.265306, 5.618076, 4.870054, 5.764324], abs=1e-6)


def test_ema_equals_pandas(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0]
    df = WN.moving_stats(panel_df(spark, vals), (4,), fill_zero=False)
    exp = pd.Series(vals).shift(1).ewm(span=4, adjust=False).mean().tolist()
    got = col(df, "EMA4_y")
    assert got[0] is None
    assert got[1:] == pytest.approx(exp[1:])


def test_one_row_key(spark):
    df = WN.moving_stats(WN.lag_features(panel_df(spark, [7]), (12,)), (6,))
    r = df.collect()[0]
    assert r["Lag12_y"] == 7.0 and r["MA6_y"] == 0 and r["STD6_y"] == 0 and r["EMA6_y"] == 0
    dv = WN.derivatives(panel_df(spark, [7])).collect()[0]
    assert dv["deriv_1_pct"] == 0 and dv["deriv_2_pct"] == 0


def test_zero_targets_no_exception(spark):
    df = WN.derivatives(panel_df(spark, [0, 0, 5, 0, 3, 0, 0, 0]))
    assert all(v is not None for v in col(df, "deriv_1_pct", "year_month"))
    fc = spark.createDataFrame([("a", D(2023, 1, 1), 1.0, 1.0, 1.0, 0.0)],
                               "key string, date date, forecast_xgboost double, "
                               "forecast_lgbm double, forecast_random_forest double, target double")
    assert EV.row_ape(fc).collect()[0]["xgboost_row_mape"] is None


def test_rounding_half_even(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (33.335,)], "x double")
    got = [r[0] for r in df.select(F.bround("x", 2)).collect()]
    assert got[0] == 0.12 and got[1] in (2.67, 2.68) and got[2] in (1.0, 1.01)


def test_truncation_toward_zero(spark):
    s = spark.createDataFrame([("k", "b", D(2023, 1, 5), 1, 2.7, 2.7),
                               ("k", "b", D(2023, 1, 6), 2, -2.7, -2.7)],
                              "key string, business_type string, date date, tran_seq_no bigint, "
                              "amount double, quantity double")
    r = RU.monthly_rollup(s).collect()[0]
    assert r["sales_amount"] == 0 and r["units"] == 0 and r["num_transactions"] == 2


def promos(spark, rows):
    return spark.createDataFrame(
        [("L", i, "RELATIVE", 10, a, b) for i, (a, b) in enumerate(rows)],
        "locationId string, itemId bigint, strategy string, amountOfDiscount int, "
        "eff_from date, eff_to date")


def test_promo_inside_one_month(spark):
    p = promos(spark, [(D(2023, 3, 2), D(2023, 3, 30))])
    assert IV.promo_monthly(p).count() == 0
    assert IV.promo_days(p).collect()[0]["promo_days_in_month"] == 29


def test_promo_two_month_starts(spark):
    p = promos(spark, [(D(2023, 3, 2), D(2023, 5, 1))])
    assert sorted(r["date"] for r in IV.explode_months(p).collect()) == [D(2023, 4, 1), D(2023, 5, 1)]


def test_promo_reversed_interval(spark):
    p = promos(spark, [(D(2023, 3, 5), D(2023, 3, 1))])
    assert IV.explode_months(p).count() == 0 and IV.promo_days(p).count() == 0


def test_overlapping_promos_days_once(spark):
    p = promos(spark, [(D(2023, 3, 1), D(2023, 3, 10)), (D(2023, 3, 5), D(2023, 3, 15))])
    assert IV.promo_days(p).collect()[0]["promo_days_in_month"] == 15


def sply_loop(months: dict, horizon):
    """The reference's chunked loop, written out for a single group."""
    data = dict(months)
    last = max(data)
    add = lambda d, k: (pd.Timestamp(d) + pd.DateOffset(months=k)).date()
    while last < horizon:
        fs, fe = add(last, 1), min(add(last, 15), horizon)
        src = {d: v for d, v in data.items() if add(fs, -12) <= d <= add(fe, -12)}
        if not src:
            break
        for d, v in src.items():
            data.setdefault(add(d, 12), v)
        last = max(data)
    return data


@pytest.mark.parametrize("gap", [None, 6])
def test_sply_closed_form_equals_loop(spark, gap):
    months = {(pd.Timestamp("2022-01-01") + pd.DateOffset(months=i)).date(): float(i)
              for i in range(20) if i != gap and i != (gap or -1) + 8}
    horizon = D(2024, 11, 1)
    df = spark.createDataFrame([("g", d, v) for d, v in months.items()], "g string, date date, v double")
    got = {r["date"]: r["v"] for r in EX.sply_extend(df, ["g"], horizon.isoformat()).collect()}
    assert got == sply_loop(months, horizon)


def test_sply_short_history(spark):
    months = {D(2023, 1, 1): 1.0, D(2023, 2, 1): 2.0, D(2023, 3, 1): 3.0}
    df = spark.createDataFrame([("g", d, v) for d, v in months.items()], "g string, date date, v double")
    got = {r["date"] for r in EX.sply_extend(df, ["g"], "2024-06-01").collect()}
    assert got == set(months) | {D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)}


def test_date_format_detection(spark):
    for vals, label in ((["2024-01-02"], "%Y-%m-%d"), (["1-2-2024"], "%m-%d-%Y"),
                        (["2024-01-02", "1/2/2024"], None)):
        df = spark.createDataFrame([(v,) for v in vals], "s string")
        out = SE.detect_date_format(df, "s").collect()
        assert out[0]["date_format_used"] == label
    one = SE.detect_date_format(spark.createDataFrame([("1-2-2024",)], "s string"), "s").collect()
    assert one[0]["parsed_date"] == D(2024, 1, 2)


def test_black_friday(spark):
    df = spark.createDataFrame([(2024,)], "y int")
    assert df.select(last_friday_of_november(F.col("y"))).collect()[0][0] == D(2024, 11, 29)
    days = spark.createDataFrame([(D(2024, 11, d),) for d in range(20, 31)] +
                                 [(D(2024, 12, d),) for d in (1, 2, 3)], "date date")
    flagged = {r["date"] for r in days.filter(CA.D.black_friday_week("date") == 1).collect()}
    assert flagged == {D(2024, 11, 26), D(2024, 11, 27), D(2024, 11, 28), D(2024, 11, 29),
                       D(2024, 11, 30), D(2024, 12, 1), D(2024, 12, 2)}


def test_festive_flag_on_month_start(spark):
    spine = CA.day_spine(spark.createDataFrame([(D(2023, 2, 1), D(2023, 5, 31))], "start date, `end` date"))
    ranges = spark.createDataFrame([("f", D(2023, 3, 23), D(2023, 4, 20))], "event string, start date, `end` date")
    days = spark.createDataFrame([], "event string, date date")
    peak = CA.peak_calendar(spine, ranges, days)
    panel = spark.createDataFrame([("a", D(2023, 3, 1)), ("a", D(2023, 4, 1))], "key string, date date")
    got = col(CA.join_peak_calendar(panel, peak), "festive_peak_flag")
    assert got == [0, 1]


def test_quartile_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 7, 10, 20)], "x double")
    cuts = df.select(EN.quartile_cuts(df, "x")).collect()[0][0]
    assert cuts == [2.5, 4.0, 8.5]
    assert col(EN.quartile_bin(df, "x"), "x_cat", "x") == [1, 1, 2, 2, 3, 4, 4]


def test_quartile_cuts_are_exact_over_many_bins_and_ties(spark):
    for x in ([float(i * 7919 % 5003) for i in range(5003)], [float(i % 3) for i in range(900)],
              [4.0]):
        df = spark.createDataFrame([(v,) for v in x] + [(None,)], "x double")
        want = df.select(F.percentile("x", F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)])))
        assert df.select(EN.quartile_cuts(df, "x")).first()[0] == want.first()[0]


def test_panel_follows_changed_inputs(spark, tmp_path):
    import shutil

    from tidemark.plans.common import panel
    for name in ("lineitem", "orders", "supplier", "nation", "region"):
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1000).toPandas()
    units = panel(spark, str(tmp_path)).agg(F.sum("units")).first()[0]
    lines.to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    spark.catalog.refreshByPath(str(tmp_path))
    fewer = panel(spark, str(tmp_path)).agg(F.sum("units")).first()[0]
    assert 0 < fewer < units


def fc_rows(spark, rows):
    return spark.createDataFrame(rows, "key string, date date, forecast_xgboost double, "
                                 "forecast_lgbm double, forecast_random_forest double, "
                                 "target double")


def test_champion_tie_goes_to_first_model(spark):
    df = EV.row_ape(fc_rows(spark, [("a", D(2023, 1, 1), 8.0, 12.0, 8.0, 10.0)]))
    assert EV.champion_row(df).collect()[0]["best_model_monthly"] == "xgboost"
    assert EV.champion_store(df).collect()[0]["best_model_store"] == "xgboost"


def test_null_forecast_row_excluded(spark):
    df = EV.scored(EV.row_ape(fc_rows(spark, [("a", D(2023, 1, 1), None, 1.0, 1.0, 2.0),
                                              ("a", D(2023, 2, 1), 1.0, 1.0, 1.0, 2.0)])))
    assert df.count() == 1


def test_unseen_category_is_null(spark):
    df = spark.createDataFrame([("x", 1.0, True), ("x", 3.0, True), ("y", 5.0, False)],
                               "c string, target double, tr boolean")
    out = {r["c"]: r["c_encode"] for r in EN.target_encode(df, ["c"], F.col("tr")).collect()}
    assert out["y"] is None and out["x"] is not None


def test_campaign_region(spark):
    df = spark.createDataFrame([("X_uae_y",), ("KSA-UAE",), ("none",), (None,)], "campaign_name string")
    got = [r["region"] for r in MK.campaign_region(df, ["UAE", "KSA"]).collect()]
    assert got == ["UAE", "KSA", None, None]


def test_ema_prefixes_equal_the_fold_and_pandas(spark):
    """Blocks make no difference; a first row has no history; other columns come through."""
    rng = random.Random(8)
    rows = []
    for k, n in (("a", 1), ("b", 63), ("c", 64), ("d", 65), ("e", 400)):
        d = pd.Timestamp("1990-01-01")
        rows += [(k, (d + pd.DateOffset(months=i)).date(), rng.randint(0, 50), f"x{i}")
                 for i in range(n)]
    df = spark.createDataFrame(rows, "key string, date date, target int, `other col` string")
    out = WN.ema_features(df, (3, 12)).toPandas().sort_values(["key", "date"])
    assert list(out["other col"]) == [r[3] for r in rows]
    for span in (3, 12):
        for k, g in out.groupby("key"):
            want = g["target"].astype(float).ewm(span=span, adjust=False).mean().shift(1)
            assert np.allclose(g[f"EMA{span}_y"].astype(float), want, equal_nan=True)
