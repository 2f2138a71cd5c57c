"""Error analytics and champion/challenger selection (#33-35, #53-57, #71, #129-140).

Forecast tables are wide: ``key, date, forecast_<model>..., target``.
Every step is a grouped aggregate or a row expression; store- and
month-level tables are one row per key / per month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.safe import r, sdiv

MODELS = ("xgboost", "lgbm", "random_forest")


def fc(m: str) -> str:
    return f"forecast_{m}"


def ape(actual, forecast) -> Column:
    """|actual − forecast| / actual × 100; NULL when actual is 0 or NULL (#129)."""
    a = F.col(actual) if isinstance(actual, str) else actual
    f = F.col(forecast) if isinstance(forecast, str) else forecast
    return sdiv(F.abs(a - f), a) * 100


def row_ape(df: DataFrame, models: Sequence[str] = MODELS, target: str = "target") -> DataFrame:
    return df.withColumns({f"{m}_row_mape": ape(target, fc(m)) for m in models})


def scored(df: DataFrame, models: Sequence[str] = MODELS, target: str = "target") -> DataFrame:
    """Rows with an actual and every forecast, finite APE (S17: inf → NaN → dropped)."""
    cond = F.col(target).isNotNull()
    for m in models:
        cond = cond & F.col(f"{m}_row_mape").isNotNull()
    return df.filter(cond)


def pick_min(cands: Sequence[tuple[str, Column, Column]]) -> Column:
    """Struct (err, ord, name, value) with the lowest error; ties → earlier candidate.

    NULL errors never win (their structs are NULL elements, skipped by array_min).
    """
    structs = [F.when(err.isNull(), F.lit(None)).otherwise(
        F.struct(err.alias("err"), F.lit(i).alias("ord"), F.lit(name).alias("name"),
                 val.cast("double").alias("value")))
        for i, (name, err, val) in enumerate(cands)]
    return F.array_min(F.array(*structs))


def champion_row(df: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    """Per-row champion: lowest APE, ties to model order (#133)."""
    best = pick_min([(m, F.col(f"{m}_row_mape"), F.col(fc(m))) for m in models])
    return df.withColumn("_b", best).withColumns({
        "best_model_monthly": F.col("_b.name"),
        "best_forecast_monthly": F.col("_b.value"),
        "best_row_mape": F.col("_b.err")}).drop("_b")


def store_totals(df: DataFrame, models: Sequence[str] = MODELS, target: str = "target",
                 key: str = "key", extra: Sequence[str] = ()) -> DataFrame:
    """Sum forecasts and actuals over months per store (#53)."""
    cols = [fc(m) for m in models] + list(extra) + [target]
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in cols])


def champion_store(df: DataFrame, models: Sequence[str] = MODELS, target: str = "target",
                   key: str = "key", with_row_champion: bool = False) -> DataFrame:
    """Store champion on summed forecasts (#134, #135, #136, #71).

    With ``with_row_champion`` the sum of per-row champions is a fourth candidate.
    """
    extra = ["best_forecast_monthly"] if with_row_champion else []
    src = champion_row(df, models) if with_row_champion else df
    g = store_totals(src, models, target, key, extra)
    if with_row_champion:
        g = g.withColumnRenamed("best_forecast_monthly", "best_forecast_monthly_sum")
    g = g.withColumns({f"{m}_mape": ape(target, fc(m)) for m in models})
    cands = [(m, F.col(f"{m}_mape"), F.col(fc(m))) for m in models]
    if with_row_champion:
        g = g.withColumn("best_forecast_monthly_mape", ape(target, "best_forecast_monthly_sum"))
        cands.append(("best_monthly", F.col("best_forecast_monthly_mape"),
                      F.col("best_forecast_monthly_sum")))
    total = g.select(F.sum(target)).scalar()
    return (g.withColumn("_b", pick_min(cands)).withColumns({
        "best_model_store": F.col("_b.name"),
        "best_forecast_store": F.col("_b.value"),
        "best_mape": F.col("_b.err"),
        "pct_demand": r(sdiv(F.col(target), total) * 100, 2)}).drop("_b"))


def apply_store_champion(df: DataFrame, champions: DataFrame, models: Sequence[str] = MODELS,
                         target: str = "target", key: str = "key") -> DataFrame:
    """Each row takes its store champion's forecast; row APE of that mix (#35, #138)."""
    pick = F.lit(None).cast("double")
    for m in reversed(models):
        pick = F.when(F.col("best_model_store") == m, F.col(fc(m))).otherwise(pick)
    return (df.join(champions.select(key, "best_model_store"), key, "left")
            .withColumn("best_forecast_by_store_model", pick)
            .withColumn("mape_best_model", ape(target, "best_forecast_by_store_model")))


def mape_by_month(applied: DataFrame, target: str = "target", date_col: str = "date") -> DataFrame:
    """Month totals of actual and champion-mix forecast, then APE (#54, #137)."""
    return (applied.groupBy(date_col)
            .agg(F.sum(target).alias(target),
                 F.sum("best_forecast_by_store_model").alias("best_forecast_by_store_model"))
            .withColumn("mape", ape(target, "best_forecast_by_store_model")))


def mape_overall(champions: DataFrame, models: Sequence[str] = MODELS,
                 target: str = "target") -> DataFrame:
    """Error of all-store totals per model and for the store-champion mix (#55)."""
    tot = champions.agg(F.sum(target).alias("_t"),
                        *[F.sum(fc(m)).alias(fc(m)) for m in models],
                        F.sum("best_forecast_store").alias("_best"))
    return tot.select(*[ape("_t", fc(m)).alias(f"overall_mape_{m}") for m in models],
                      ape("_t", "_best").alias("overall_mape_best"))


def metrics(df: DataFrame, models: Sequence[str] = MODELS, target: str = "target") -> DataFrame:
    """MAPE, WMAPE, MAE, RMSE, R², std of actuals, RMSE/std per model, long form (#130-132).

    One aggregate pass; models are stacked afterwards (a few rows).
    """
    t = F.col(target)
    aggs = [F.stddev_samp(t).alias("std_actual"),
            (F.var_pop(t) * F.count(t)).alias("_sst")]
    for m in models:
        f, e = F.col(fc(m)), t - F.col(fc(m))
        aggs += [F.avg(ape(t, f)).alias(f"{m}__mape"),
                 (sdiv(F.sum(F.abs(e)), F.sum(t)) * 100).alias(f"{m}__wmape"),
                 F.avg(F.abs(e)).alias(f"{m}__mae"),
                 F.sqrt(F.avg(e * e)).alias(f"{m}__rmse"),
                 F.sum(e * e).alias(f"{m}__sse")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(m).alias("model"),
                     *[F.col(f"{m}__{k}").alias(k) for k in ("mape", "wmape", "mae", "rmse", "sse")])
            for m in models]
    long = wide.select("std_actual", "_sst", F.inline(F.array(*rows)))
    return (long.withColumns({"r2": 1 - sdiv("sse", "_sst"),
                              "rmse_over_std": sdiv("rmse", "std_actual")})
            .drop("_sst", "sse"))


def model_wins(df: DataFrame, model_col: str) -> DataFrame:
    """How often each model is the champion (#56)."""
    return df.groupBy(F.col(model_col).alias("model")).agg(F.count(F.lit(1)).alias("wins"))


def model_summary(champions: DataFrame, group_cols: Sequence[str], key: str = "key") -> DataFrame:
    """Distinct stores and mean best error per group and champion model (#57)."""
    return (champions.groupBy(*group_cols, "best_model_store")
            .agg(F.countDistinct(key).alias("stores"), F.avg("best_mape").alias("avg_mape")))


def worst(champions: DataFrame, k: int = 10, by: str = "best_mape",
          key: str = "key") -> DataFrame:
    """The ``k`` keys with the largest error, ties by key (#73)."""
    return champions.orderBy(F.desc(by), key).limit(k)
