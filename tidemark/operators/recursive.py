"""Recursive multi-step forecasting for all keys at once (#124-125, survey §3.4).

All keys are forecast for the same months, those after one common origin; a key without a
row in the origin month, or with its first row after it, gets the same months as the rest.
State is one row per key.  Target-derived features of the next month are expressions on
it, and what is known of a future month in advance (calendar, promotions, spend, store
attributes) comes as a map from step to covariates, so a step never re-reads or
re-shuffles the panel.

* Expression scorers (e.g. a fixed linear rule) keep the history as an array and run the
  whole recursion as one ``aggregate(sequence(1, H), history, step)`` expression: no
  driver loop and no plan growth with H.
* Spark ML models run a driver loop of H narrow steps (assemble → transform → append)
  over a *bounded* state per key: last 12 values, count, running EMA, the year's sum for
  the rate of sale, and sum, count and last value of each calendar month.  The seasonality
  index over all keys needs a second, 12-row state; one aggregate a step updates it.
  Lineage is cut with reliable ``checkpoint()`` into the cluster's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.safe import pct_change, r, sdiv
from tidemark.operators.windows import ema_fold

#: Features of a month that follow from the targets before it.
STEP_FEATURES = ("Lag12_y", "MA6_y", "STD6_y", "EMA6_y", "Seasonality_Index", "rate_of_sale",
                 "deriv_1_pct", "deriv_2_pct", "deriv_3_pct", "deriv_6_pct", "deriv_1_flag",
                 "deriv_2_trend_flag")


def history(df: DataFrame, key: str = "key", date_col: str = "date",
            target: str = "target") -> DataFrame:
    """One row per key: ``h`` = targets ordered by date, ``last_date``."""
    return (df.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(date_col).alias("d"),
                                                      F.col(target).cast("double").alias("v"))))
                 .alias("_s"))
            .select(key, F.transform("_s", lambda s: s["v"]).alias("h"),
                    F.element_at("_s", -1)["d"].alias("last_date")))


def _mean(arr: Column) -> Column:
    return F.try_divide(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), F.size(arr).cast("double"))


def next_features(h: Column, mean_fill: Column, lag: int = 12, window: int = 6,
                  span: int = 6) -> dict[str, Column]:
    """Features of the month after the history ``h`` (same definitions as the panel).

    Lag falls back to ``mean_fill``; MA/STD use the last ``window`` values
    (STD is NULL with fewer than two; not zero-filled in recursion, S5); EMA
    folds the whole history.
    """
    n = F.size(h)
    lagv = F.when(n >= lag, F.get(h, n - lag)).otherwise(mean_fill)
    k = F.least(n, F.lit(window))
    last = F.slice(h, F.greatest(n - window + 1, F.lit(1)), k)
    ma = _mean(last)
    ss = F.aggregate(last, F.lit(0.0), lambda a, x: a + (x - ma) * (x - ma))
    std = F.when(k >= 2, F.sqrt(ss / (k - 1)))
    return {f"Lag{lag}_y": lagv.cast("double"), f"MA{window}_y": ma, f"STD{window}_y": std,
            f"EMA{span}_y": ema_fold(h, span)}


def last_date(df: DataFrame, date_col: str = "date") -> Column:
    """The common origin: the latest month of ``df`` (a scalar subquery)."""
    return df.select(F.max(date_col)).scalar()


def _up_to(df: DataFrame, origin: Column, key: str, date_col: str, target: str,
           keys: DataFrame | None) -> DataFrame:
    """One row per key: ``_s``, its (d, v) up to the origin by date, and ``_origin``."""
    rows = df.filter((F.col(date_col) <= origin) & F.col(target).isNotNull())
    point = F.struct(F.col(date_col).alias("d"), F.col(target).cast("double").alias("v"))
    series = rows.groupBy(key).agg(F.sort_array(F.collect_list(point)).alias("_s"))
    known = (df if keys is None else keys).select(key).distinct()
    empty = F.array().cast("array<struct<d: date, v: double>>")
    return known.join(series, key, "left").select(
        key, F.coalesce("_s", empty).alias("_s"), origin.alias("_origin"))


def covariates_by_step(rows: DataFrame, cols: Sequence[str], origin: Column, steps: int,
                       key: str = "key", date_col: str = "date") -> DataFrame:
    """One row per key: ``_covs``, a map from step (1 is the month after the origin) to the
    covariates known for that month.  One row per key and month; at most ``steps`` entries.
    """
    step = F.months_between(F.trunc(date_col, "MM"), F.trunc("_origin", "MM")).cast("int")
    future = (rows.withColumn("_origin", origin).withColumn("_step", step)
              .filter(F.col("_step").between(1, steps)))
    entry = F.struct("_step", F.struct(*[F.col(f"`{c}`").alias(c) for c in cols]))
    return future.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("_covs"))


def recurse_expression(h0: Column, steps: int, score: Callable[..., Column],
                       covs: Column | None = None) -> Column:
    """History extended by ``steps`` predictions, each scored from the history so far (and,
    with ``covs``, from the step's covariates)."""
    def step(acc, i):
        p = score(acc) if covs is None else score(acc, F.try_element_at(covs, i))
        return F.concat(acc, F.array(p.cast("double")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), h0, step)


def recursive_forecast_expr(df: DataFrame, steps: int, score: Callable[..., Column],
                            key: str = "key", date_col: str = "date", target: str = "target",
                            constants: dict[str, Column] | None = None,
                            origin: Column | None = None, keys: DataFrame | None = None,
                            covariates: DataFrame | None = None) -> DataFrame:
    """Whole recursion as one expression per key (expression scorers): key, date, forecast.

    ``constants`` (e.g. scalar-subquery fills) are materialised as columns first, because
    lambdas cannot hold subqueries; ``score`` refers to them by column name.  With
    ``covariates`` (of :func:`covariates_by_step`) the scorer takes (history, struct).
    """
    origin = last_date(df, date_col) if origin is None else origin
    st = _up_to(df, origin, key, date_col, target, keys).withColumn(
        "h", F.transform("_s", lambda s: s["v"]))
    if covariates is not None:
        st = st.join(covariates, key, "left")
    if constants:
        st = st.withColumns(constants)
    st = st.withColumns({"_n0": F.size("h"), "h": recurse_expression(
        F.col("h"), steps, score, None if covariates is None else F.col("_covs"))})
    return forecasts_from(st, steps, key)


def forecasts_from(df: DataFrame, steps: int, key: str = "key", h_col: str = "h",
                   n0_col: str = "_n0", out: str = "forecast") -> DataFrame:
    """Explode the last ``steps`` history values into (key, date, forecast)."""
    tail = F.slice(F.col(h_col), F.col(n0_col) + 1, F.lit(steps))
    return (df.select(key, "_origin", F.posexplode(tail).alias("_i", out))
            .select(key, F.add_months("_origin", F.col("_i") + 1).alias("date"), out))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _month_stats(values: Column) -> Column:
    """Sum, count and last of a month's values in order."""
    return F.struct(_total(values).alias("s"), F.size(values).alias("n"),
                    F.get(values, F.size(values) - 1).alias("last"))


def initial_state(df: DataFrame, origin: Column | None = None, keys: DataFrame | None = None,
                  key: str = "key", date_col: str = "date", target: str = "target",
                  keep: int = 12, span: int = 6) -> DataFrame:
    """The bounded recursion state of every key after the origin.

    ``tail``: last ``keep`` values; ``_n``: months so far; ``_ema``; ``_ros``: year of the
    last row, sum and count of the previous-month values of that year's rows; ``_season``:
    per calendar month sum, count and last value; ``preds``: predictions so far.
    """
    origin = last_date(df, date_col) if origin is None else origin
    st = _up_to(df, origin, key, date_col, target, keys)
    s, n = F.col("_s"), F.size("_s")
    h = F.transform(s, lambda x: x["v"])
    year = F.year(F.get(s, n - 1)["d"])
    prev = F.filter(F.transform(s, lambda x, i: F.when(
        F.year(x["d"]) == year, F.get(s, i - 1)["v"])), lambda v: v.isNotNull())
    by_month = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda m: _month_stats(
        F.transform(F.filter(s, lambda x: F.month(x["d"]) == m), lambda x: x["v"])))
    return st.select(
        key, "_origin", n.alias("_n"),
        F.slice(h, F.greatest(n - keep + 1, F.lit(1)), F.least(n, F.lit(keep))).alias("tail"),
        ema_fold(h, span).alias("_ema"),
        F.struct(year.alias("year"), _total(prev).alias("s"), F.size(prev).alias("n"))
        .alias("_ros"),
        by_month.alias("_season"), F.array().cast("array<double>").alias("preds"))


def seasonality_of(season: Column, month: Column) -> Column:
    """Index of ``month`` whose own target isn't known yet (#65).

    Month means leave out each month's last value; in the month itself that is the row to
    forecast, so all known values count.  Rounded to 2 places, 1.0 where undefined.
    """
    own = lambda i: i + 1 == month
    means = F.transform(season, lambda x, i: F.try_divide(
        F.when(own(i), x["s"]).otherwise(x["s"] - x["last"]),
        F.when(own(i), x["n"]).otherwise(x["n"] - 1).cast("double")))
    known = F.filter(means, lambda v: v.isNotNull())
    return F.coalesce(r(sdiv(F.get(means, month - 1), _mean(known)), 2), F.lit(1.0))


def step_features(date: Column, mean_fill: Column, season: Column | None = None, lag: int = 12,
                  window: int = 6, span: int = 6) -> dict[str, Column]:
    """All of ``STEP_FEATURES`` for the month ``date`` from the state's columns.

    ``season`` replaces the key's own month statistics (e.g. by those of all keys).
    STD is NULL with fewer than two values and not zero-filled in recursion (S5).
    """
    tail, n = F.col("tail"), F.col("_n")
    k = F.size(tail)
    back = lambda j: F.get(tail, k - j)
    w = F.least(k, F.lit(window))
    last = F.slice(tail, F.greatest(k - window + 1, F.lit(1)), w)
    ma = _mean(last)
    ss = F.aggregate(last, F.lit(0.0), lambda a, x: a + (x - ma) * (x - ma))
    same = F.col("_ros.year").eqNullSafe(F.year(date))
    d1, d1_before = pct_change(back(1), back(2)), pct_change(back(2), back(3))
    d2 = F.coalesce(pct_change(d1, d1_before), F.lit(0.0))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return {
        f"Lag{lag}_y": F.when(n >= lag, back(lag)).otherwise(mean_fill).cast("double"),
        f"MA{window}_y": ma,
        f"STD{window}_y": F.when(w >= 2, F.sqrt(ss / (w - 1))),
        f"EMA{span}_y": F.col("_ema"),
        "Seasonality_Index": seasonality_of(F.col("_season") if season is None else season,
                                            F.month(date)),
        "rate_of_sale": sdiv(F.when(same, F.col("_ros.s")).otherwise(0.0) + back(1),
                             F.when(same, F.col("_ros.n")).otherwise(0) + 1),
        "deriv_1_pct": zero(d1), "deriv_2_pct": d2,
        "deriv_3_pct": zero(pct_change(back(1), back(4))),
        "deriv_6_pct": zero(pct_change(back(1), back(7))),
        "deriv_1_flag": F.when(F.abs(d2) > 50, 1).otherwise(0),
        "deriv_2_trend_flag": F.when(d2 > 0, "increasing").when(d2 < 0, "decreasing")
                               .otherwise("fluctuating"),
    }


def advanced(date: Column, p: Column, keep: int = 12, span: int = 6) -> dict[str, Column]:
    """The state's columns after the target of month ``date`` turned out to be ``p``."""
    alpha = 2.0 / (span + 1.0)
    tail = F.concat("tail", F.array(p))
    prev = F.get("tail", F.size("tail") - 1)
    same = F.col("_ros.year").eqNullSafe(F.year(date))
    seen = F.when(prev.isNotNull(), 1).otherwise(0)
    month = F.month(date)
    return {
        "_n": F.col("_n") + 1,
        "tail": F.slice(tail, F.greatest(F.size(tail) - keep + 1, F.lit(1)),
                        F.least(F.size(tail), F.lit(keep))),
        "_ema": F.coalesce(F.col("_ema") * (1.0 - alpha) + p * alpha, p),
        "_ros": F.struct(
            F.year(date).alias("year"),
            (F.when(same, F.col("_ros.s")).otherwise(0.0) + F.coalesce(prev, F.lit(0.0)))
            .alias("s"),
            (F.when(same, F.col("_ros.n")).otherwise(0) + seen).alias("n")),
        "_season": F.transform("_season", lambda x, i: F.when(i + 1 == month, F.struct(
            (x["s"] + p).alias("s"), (x["n"] + 1).alias("n"), p.alias("last"))).otherwise(x)),
        "preds": F.concat("preds", F.array(p)),
    }


class GlobalSeason:
    """Sum, count and last value (by date, then key) of each calendar month over all keys."""

    def __init__(self, df: DataFrame, origin: Column, key: str, date_col: str, target: str):
        t = F.col(target).cast("double")
        rows = (df.filter((F.col(date_col) <= origin) & F.col(target).isNotNull())
                .groupBy(F.month(date_col).alias("m"))
                .agg(F.sum(t).alias("s"), F.count(t).alias("n"),
                     F.max_by(t, F.struct(F.col(date_col), F.col(key))).alias("last"))
                .collect())  # 12 rows at most
        self.months = {m: (0.0, 0, None) for m in range(1, 13)} | {
            x["m"]: (x["s"], x["n"], x["last"]) for x in rows}

    def column(self) -> Column:
        return F.array(*[F.struct(F.lit(s).cast("double").alias("s"), F.lit(n).alias("n"),
                                  F.lit(last).cast("double").alias("last"))
                         for s, n, last in (self.months[m] for m in range(1, 13))])

    def add(self, month: int, predictions: DataFrame, p: Column, key: str) -> None:
        """Take in a month's predictions: one aggregate, one row to the driver."""
        x = predictions.agg(F.sum(p).alias("s"), F.count(p).alias("n"),
                            F.max_by(p, F.col(key)).alias("last")).first()
        s, n, last = self.months[month]
        self.months[month] = (s + (x["s"] or 0.0), n + x["n"],
                              last if x["last"] is None else x["last"])


def recursive_forecast_scorer(df: DataFrame, steps: int,
                              score: Callable[[DataFrame], DataFrame],
                              feature_cols: Sequence[str], mean_fill: Column,
                              key: str = "key", date_col: str = "date", target: str = "target",
                              prediction_col: str = "prediction", checkpoint_every: int = 1,
                              keep: int = 12, span: int = 6, origin: Column | None = None,
                              keys: DataFrame | None = None,
                              covariates: DataFrame | None = None,
                              covariate_cols: Sequence[str] = (),
                              codes: dict[str, dict] | None = None,
                              season: str = "key") -> DataFrame:
    """H narrow steps over bounded per-key state; ``score`` adds ``prediction_col``.

    The scorer sees ``feature_cols``: step features, the covariates of the step's month
    (``covariates`` of :func:`covariates_by_step`; null where unknown), month and quarter,
    and for every column of ``codes`` ({label: code}) its ``_encode`` (null for a label
    that has none).  ``season`` is ``key`` (each key's own seasonality index, as the
    reference's loop over single keys has it) or ``all`` (over all keys, as the training
    panel has it; one aggregate and one checkpoint a step).  Plans of steps that are not
    checkpointed nest in each other and grow by a factor a step, so ``checkpoint_every``
    is small.
    """
    from tidemark.session import checkpoint

    origin = last_date(df, date_col) if origin is None else origin
    st = initial_state(df, origin, keys, key, date_col, target, keep, span).withColumn(
        "_mean", mean_fill)
    if covariates is not None:
        st = st.join(covariates, key, "left")
    carried = [key, "_origin", "_mean", *(["_covs"] if covariates is not None else [])]
    everyone, month = None, None
    if season == "all":
        st = checkpoint(st)
        everyone = GlobalSeason(df, origin, key, date_col, target)
        first = st.select(F.min("_origin")).first()[0]
        month = first.month if first is not None else None
    for i in range(1, steps + 1):
        d = F.add_months("_origin", i)
        feats = step_features(d, F.col("_mean"), everyone.column() if everyone else None,
                              span=span)
        feats.update({"month": F.month(d), "quarter": F.quarter(d)})
        if covariates is not None:
            now = F.try_element_at("_covs", F.lit(i))
            feats.update({c: now[c] for c in covariate_cols})
        for c, table in (codes or {}).items():
            entries = [F.lit(x).cast("string" if k % 2 == 0 else "double")
                       for k, x in enumerate(v for kv in table.items() for v in kv)]
            known = F.create_map(*entries) if entries else F.lit(None).cast("map<string,double>")
            feats[f"{c}_encode"] = F.try_element_at(known, feats[c])
        scored = score(st.withColumns({c: feats[c] for c in feature_cols}))
        p = F.col(prediction_col).cast("double")
        st = scored.select(*carried, *[v.alias(c) for c, v in
                                       advanced(d, p, keep, span).items()])
        if everyone:
            st = checkpoint(st)
            if month is not None and i < steps:
                everyone.add((month + i - 1) % 12 + 1, st, F.element_at("preds", -1), key)
        elif checkpoint_every and i % checkpoint_every == 0 and i < steps:
            st = checkpoint(st)
    return (st.select(key, "_origin", F.posexplode("preds").alias("_i", "forecast"))
            .select(key, F.add_months("_origin", F.col("_i") + 1).alias("date"), "forecast"))


def recursive_forecast_model(df: DataFrame, steps: int, model, feature_cols: Sequence[str],
                             mean_fill: Column, **kw) -> DataFrame:
    """Recursion with a fitted Spark ML ``PipelineModel`` (assembler inside)."""
    return recursive_forecast_scorer(df, steps, model.transform, feature_cols, mean_fill, **kw)
