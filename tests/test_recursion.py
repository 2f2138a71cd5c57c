"""Recursion against recomputation: every step's features from the whole series so far."""

import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import recursive as RC

START = pd.Timestamp("2019-01-01")


def month(i):
    return (START + pd.DateOffset(months=i)).date()


def series(rng):
    """Keys with gaps, one without a row in the last months, one that starts last, one short."""
    rows = {}
    for k in range(6):
        rows[f"k{k}"] = {i: float(rng.randint(0, 40)) for i in range(30) if rng.random() < 0.85}
    rows["k0"].pop(29, None)
    rows["k0"].pop(28, None)
    rows["late"] = {29: 5.0}
    rows["none"] = {}
    return rows


def round_even(x, n=2):
    return float(pd.Series([x]).round(n)[0])


def pct(cur, prev):
    return None if cur is None or prev is None or prev == 0 else round_even(
        (cur - prev) / prev * 100)


def season(points, m):
    """Index of calendar month m, its own next value unknown: points are (month, value)."""
    means = {}
    for c in range(1, 13):
        v = [x for q, x in points if q == c]
        v = v if c == m else v[:-1]
        if v:
            means[c] = sum(v) / len(v)
    whole = sum(means.values()) / len(means) if means else 0
    return round_even(means[m] / whole) if m in means and whole else 1.0


def expected(history, i, mean, everyone=None):
    """All step features of month i after ``history`` (month -> value), from scratch."""
    ms = sorted(history)
    h = [history[m] for m in ms]
    back = lambda j: h[-j] if len(h) >= j else None
    last = h[-6:]
    ma = sum(last) / len(last) if last else None
    ema = None
    for v in h:
        ema = v if ema is None else ema * (1 - 2 / 7) + v * 2 / 7
    year = month(i).year
    prevs = [h[j - 1] for j in range(1, len(h)) if month(ms[j]).year == year]
    prevs += [back(1)] if h else []
    d1 = pct(back(1), back(2))
    d2 = pct(d1, pct(back(2), back(3))) or 0.0
    own = [(month(m).month, history[m]) for m in ms]
    return {
        "Lag12_y": h[-12] if len(h) >= 12 else mean, "MA6_y": ma,
        "STD6_y": math.sqrt(sum((x - ma) ** 2 for x in last) / (len(last) - 1))
        if len(last) > 1 else None,
        "EMA6_y": ema,
        "Seasonality_Index": season(own if everyone is None else everyone, month(i).month),
        "rate_of_sale": sum(prevs) / len(prevs) if prevs else None,
        "deriv_1_pct": d1 or 0.0, "deriv_2_pct": d2,
        "deriv_3_pct": pct(back(1), back(4)) or 0.0, "deriv_6_pct": pct(back(1), back(7)) or 0.0,
        "deriv_1_flag": int(abs(d2) > 50),
        "deriv_2_trend_flag": "increasing" if d2 > 0 else "decreasing" if d2 < 0
        else "fluctuating"}


@pytest.mark.parametrize("scope", ["key", "all"])
def test_every_step_equals_recomputation(spark, scope):
    rows = series(random.Random(4))
    mean, steps = 9.5, 8                                  # over the turn of the year
    df = spark.createDataFrame([(k, month(m), v) for k, s in rows.items() for m, v in s.items()],
                               "key string, date date, target double")
    keys = spark.createDataFrame([(k,) for k in rows], "key string")
    codes = {"increasing": 7.0, "decreasing": 3.0}       # no code for "fluctuating"
    cov = spark.createDataFrame(
        [(k, month(29 + s), s + 0.5, None) for k in rows for s in range(1, steps + 1)
         if k != "k1"], "key string, date date, promo double, other double")
    origin = RC.last_date(df)
    wanted = [*RC.STEP_FEATURES, "deriv_2_trend_flag_encode", "promo", "month", "quarter"]
    seen = []

    def score(x):
        seen.append(x.select("key", *wanted).collect())
        return x.withColumn("prediction", F.round(
            F.coalesce("MA6_y", F.lit(1.0)) + 0.25 * F.coalesce("Lag12_y", F.lit(0.0))
            + F.coalesce("promo", F.lit(0.0)) + F.coalesce("deriv_2_trend_flag_encode",
                                                           F.lit(0.0)), 1))

    out = RC.recursive_forecast_scorer(
        df, steps, score, wanted, F.lit(mean), keys=keys, origin=origin, season=scope,
        covariates=RC.covariates_by_step(cov, ["promo", "other"], origin, steps),
        covariate_cols=["promo"], codes={"deriv_2_trend_flag": codes})
    got = {(r["key"], r["date"]): r["forecast"] for r in out.collect()}
    # The same months for all keys, a silent one, a late one and one without rows included.
    assert set(got) == {(k, month(29 + s)) for k in rows for s in range(1, steps + 1)}

    now = {k: dict(s) for k, s in rows.items()}
    for s in range(1, steps + 1):
        i = 29 + s
        points = sorted((m, k, v) for k, x in now.items() for m, v in x.items())
        everyone = [(month(m).month, v) for m, _, v in points] if scope == "all" else None
        for r in seen[s - 1]:
            want = expected(now[r["key"]], i, mean, everyone)
            for c, v in want.items():
                assert r[c] == (v if v is None or isinstance(v, str)
                                else pytest.approx(v, rel=1e-9, abs=1e-9)), (c, r["key"], i)
            assert r["deriv_2_trend_flag_encode"] == codes.get(want["deriv_2_trend_flag"])
            assert r["promo"] == (None if r["key"] == "k1" else s + 0.5)
            assert r["month"] == month(i).month
        for k in now:
            now[k][i] = got[k, month(i)]


def test_expression_recursion_with_a_covariate(spark):
    rows = series(random.Random(5))
    df = spark.createDataFrame([(k, month(m), v) for k, s in rows.items() for m, v in s.items()],
                               "key string, date date, target double")
    cov = spark.createDataFrame([(k, month(29 + s), float(s)) for k in rows for s in range(1, 4)],
                                "key string, date date, x double")
    origin = RC.last_date(df)

    def score(h, c):
        return F.coalesce(F.get(h, F.size(h) - 1), F.lit(0.0)) + c["x"]

    out = RC.recursive_forecast_expr(df, 3, score,
                                     covariates=RC.covariates_by_step(cov, ["x"], origin, 3))
    for r in out.collect():
        s = (r["date"].year - 2021) * 12 + r["date"].month - 6
        h = rows[r["key"]]
        assert r["forecast"] == h[max(h)] + sum(range(1, s + 1))
    assert out.count() == 3 * 7
