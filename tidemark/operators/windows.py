"""Per-key temporal features over the monthly panel (#50-52, #61-68).

All windows share one partitioning (``key``) and one order (``date``), so the
panel is shuffled once and every feature is computed in the same sorted pass.
A key holds one row per month, so window partitions are bounded by the number
of months no matter how skewed the raw sales are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.safe import pct_change, r, sdiv


def _w(key, date_col):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(date_col)


def target_mean(df: DataFrame, target: str = "target", date_col: str = "date",
                train_end: str | None = None) -> Column:
    """Scalar-subquery mean of the target (all rows, or rows up to ``train_end``)."""
    src = df if train_end is None else df.filter(F.col(date_col) <= F.lit(train_end).cast("date"))
    return src.select(F.avg(target)).scalar()


def lag_features(df: DataFrame, lags: Sequence[int] = (12,), key: str = "key",
                 date_col: str = "date", target: str = "target",
                 train_end: str | None = None) -> DataFrame:
    """``Lag{k}_y``: row-based lag within key; gaps are not filled (S4).

    Missing lags take the target mean: of the train rows when ``train_end`` is
    given (pipeline, no leakage) else of all rows (notebook).
    """
    w = _w(key, date_col)
    mean = target_mean(df, target, date_col, train_end)
    return df.withColumns({f"Lag{k}_y": F.coalesce(F.lag(target, k).over(w).cast("double"), mean)
                           for k in lags})


def moving_stats(df: DataFrame, windows: Sequence[int] = (6,), key: str = "key",
                 date_col: str = "date", target: str = "target",
                 fill_zero: bool = True, ema: bool = True) -> DataFrame:
    """``MA{w}_y``, ``STD{w}_y`` (ddof 1) and ``EMA{w}_y`` over the previous w rows.

    ``min_periods=1``: one previous row gives an MA and a NULL std; the first
    row of a key has no history. The reference fills all three with 0.
    """
    w = _w(key, date_col)
    cols = {}
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        cols[f"MA{n}_y"] = F.avg(F.col(target).cast("double")).over(frame)
        cols[f"STD{n}_y"] = F.stddev_samp(F.col(target).cast("double")).over(frame)
    names = [c for n in windows for c in (f"MA{n}_y", f"STD{n}_y", *([f"EMA{n}_y"] * ema))]
    order = [*df.columns, *names]
    out = df.withColumns(cols)
    if ema:
        out = ema_features(out, windows, key, date_col, target)
    if fill_zero:
        out = out.fillna(0.0, subset=names)
    return out.select(*order)


def ema_fold(values: Column, span: int) -> Column:
    """Exponential average of an array, pandas ``ewm(span, adjust=False)`` (S6)."""
    a = 2.0 / (span + 1.0)
    return F.aggregate(values, F.lit(None).cast("double"),
                       lambda acc, v: F.when(acc.isNull(), v.cast("double"))
                       .otherwise(acc * (1.0 - a) + v.cast("double") * a))


#: Values folded at a time; appending to a list copies it, so lists stay this short.
EMA_BLOCK = 64


def ema_prefixes(values: Column, span: int) -> Column:
    """The averages after each value of an array of doubles, in one pass (same recurrence
    as :func:`ema_fold`, so the same numbers)."""
    a = 2.0 / (span + 1.0)

    def state(e, out):
        return F.struct(e.alias("e"), out.alias("out"))

    def one(acc, v):
        e = F.when(acc["e"].isNull(), v).otherwise(acc["e"] * (1.0 - a) + v * a)
        return state(e, F.concat(acc["out"], F.array(e)))

    def block(acc, part):
        done = F.aggregate(part, state(acc["e"], F.array().cast("array<double>")), one)
        return state(done["e"], F.concat(acc["out"], F.array(done["out"])))

    count = F.ceil(F.size(values) / EMA_BLOCK).cast("int")
    parts = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                        lambda i: F.slice(values, (i - 1) * EMA_BLOCK + 1, F.lit(EMA_BLOCK)))
    start = state(F.lit(None).cast("double"), F.array().cast("array<array<double>>"))
    return F.flatten(F.aggregate(parts, start, block)["out"])


def ema_features(df: DataFrame, spans: Sequence[int], key: str = "key", date_col: str = "date",
                 target: str = "target") -> DataFrame:
    """``EMA{span}_y``: the average of a key's rows strictly before each row (#64).

    A key's rows are collected once in order and folded once, all prefixes coming out
    together, so a key with n months costs n steps.  NULL on a key's first row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in (*keys, date_col)]
    rows = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(
        F.col(date_col), *[F.col(f"`{c}`") for c in rest]))).alias("_rows"))
    values = F.transform("_rows", lambda x: x[target].cast("double"))
    none = F.array(F.lit(None).cast("double"))
    # Zipped rather than looked up by place: a lambda would fold again for every row.
    zipped = rows.select(*keys, F.explode(F.arrays_zip(
        F.col("_rows").alias("r"), *[
            F.concat(none, F.slice(ema_prefixes(values, n), F.lit(1), F.size("_rows") - 1))
            .alias(f"e{n}") for n in spans])).alias("z"))
    return zipped.select(*keys, "z.r.*", *[F.col(f"z.e{n}").alias(f"EMA{n}_y") for n in spans])


def seasonality_index_as_of(df: DataFrame, date_col: str = "date",
                            target: str = "target") -> DataFrame:
    """Leak-free seasonality index: only rows dated strictly before the current date.

    Per date D and calendar month m: mean target of month m over dates < D,
    divided by the mean of those 12 means, rounded 2, default 1.0. Daily/monthly
    totals are expanded to (D, m) rows by a generate (12 per date, no join),
    running sums per m give the "before D" means, and the result (one row per
    date, bounded by the number of dates) is broadcast back.
    """
    per_date = df.groupBy(F.col(date_col).alias("_d")).agg(
        F.sum(F.col(target).cast("double")).alias("_s"), F.count(target).alias("_n"))
    grid = per_date.select("_d", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("_m"), "_s", "_n")
    own = F.month("_d") == F.col("_m")
    grid = grid.withColumns({"_s": F.when(own, F.col("_s")).otherwise(0.0),
                             "_n": F.when(own, F.col("_n")).otherwise(0)})
    before = Window.partitionBy("_m").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    means = grid.withColumn("_a", sdiv(F.sum("_s").over(before), F.sum("_n").over(before)))
    norm = means.withColumn("_mean", F.avg("_a").over(Window.partitionBy("_d")))
    idx = (norm.filter(F.month("_d") == F.col("_m"))
           .select("_d", F.coalesce(r(sdiv("_a", "_mean"), 2), F.lit(1.0))
                   .alias("Seasonality_Index")))
    return (df.join(F.broadcast(idx), F.col(date_col) == F.col("_d"), "left")
            .withColumn("Seasonality_Index", F.coalesce("Seasonality_Index", F.lit(1.0)))
            .drop("_d"))


def seasonality_index(df: DataFrame, date_col: str = "date", target: str = "target",
                      key: str = "key") -> DataFrame:
    """Global monthly seasonality index (#65, S7).

    Per calendar month: mean of the target excluding that month's last row
    (ordered by date, key) ÷ mean of the 12 month means, rounded 2, default 1.0.
    Computed as (sum - last) / (n - 1) with a partial aggregate (12 groups),
    not a 12-partition window, so a hot month never lands in one task.
    """
    m, t = F.month(date_col), F.col(target).cast("double")
    # Hash aggregates on numbers and dates; the last row is looked for among the rows of
    # its month's last date only (12 dates).
    sums = df.groupBy(m.alias("_m")).agg(F.sum(t).alias("_s"), F.count(target).alias("_n"),
                                         F.max(date_col).alias("_d"))
    ends = F.broadcast(sums.select(F.col("_m").alias("_em"), F.col("_d").alias("_ed")))
    last = (df.join(ends, (m == F.col("_em")) & (F.col(date_col) == F.col("_ed")))
            .groupBy("_em").agg(F.max_by(t, F.col(key)).alias("_last")))
    by_month = (sums.join(F.broadcast(last), F.col("_m") == F.col("_em"))
                .select("_m", sdiv(F.col("_s") - F.col("_last"), F.col("_n") - 1).alias("_avg")))
    idx = by_month.select(
        "_m", F.coalesce(r(sdiv("_avg", F.avg("_avg").over(Window.partitionBy())), 2),
                         F.lit(1.0)).alias("Seasonality_Index"))
    # 12 rows at most: a proven size bound.
    return (df.withColumn("_m", m).join(F.broadcast(idx), "_m", "left")
            .withColumn("Seasonality_Index", F.coalesce("Seasonality_Index", F.lit(1.0)))
            .drop("_m"))


def seasonal_means(df: DataFrame, key: str = "key", date_col: str = "date",
                   target: str = "target", as_of: bool = False) -> DataFrame:
    """``{target}_seasonal_monthly`` / ``_quarterly`` (#66).

    Parity (default): mean over the same (calendar month, key) resp.
    (quarter, key) group with the group's last row left out, broadcast to
    every row of the group — it looks ahead, as the reference does.
    ``as_of=True``: mean of the group's rows strictly before the current row.
    """
    out = df
    t = F.col(target).cast("double")
    for name, part in (("monthly", F.month(date_col)), ("quarterly", F.quarter(date_col))):
        w = Window.partitionBy(F.col(key), part)
        if as_of:
            val = F.avg(t).over(w.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1))
        else:
            last = F.max_by(t, F.col(date_col)).over(w)
            val = sdiv(F.sum(t).over(w) - last, F.count(t).over(w) - 1)
        out = out.withColumn(f"{target}_seasonal_{name}", val)
    return out


def rate_of_sale(df: DataFrame, key: str = "key", date_col: str = "date",
                 target: str = "target", as_of: bool = False) -> DataFrame:
    """Average previous-month target per (key, year) (#50), joined back by (key, year).

    Parity (default) uses the whole year, later months included;
    ``as_of=True`` uses only the year's rows up to the current one (whose
    previous-month value is already known).
    """
    prev = F.lag(F.col(target).cast("double"), 1).over(_w(key, date_col))
    shifted = df.withColumn("_prev", prev).withColumn("_year", F.year(date_col))
    w = Window.partitionBy(key, "_year")
    if as_of:
        w = w.orderBy(date_col).rowsBetween(Window.unboundedPreceding, 0)
    months = F.count(F.when(F.col("_prev").isNotNull(), F.col(date_col))).over(w)
    return (shifted.withColumn("rate_of_sale", sdiv(F.sum("_prev").over(w), months))
            .drop("_prev", "_year"))


def derivatives(df: DataFrame, key: str = "key", date_col: str = "date",
                target: str = "target", as_of: bool = False) -> DataFrame:
    """Monthly %-change features, change-of-change, spike/trend flags, extremes (#52, #67-68, #109).

    Returns one row per (key, month) with ``year_month`` as DATE. The
    extremes span the key's whole history (parity) or, with ``as_of=True``,
    the months up to the current one.
    """
    monthly = (df.groupBy(key, F.trunc(date_col, "MM").alias("year_month"))
               .agg(F.sum(target).cast("double").alias("_t")))
    w = _w(key, "year_month")
    lag = {k: F.lag("_t", k).over(w) for k in (1, 2, 4, 7)}
    step1 = monthly.withColumns({
        "_p1": lag[1],
        "deriv_1_pct": pct_change(lag[1], lag[2]),
        "deriv_3_pct": pct_change(lag[1], lag[4]),
        "deriv_6_pct": pct_change(lag[1], lag[7]),
    })
    step2 = step1.withColumn("deriv_2_pct", pct_change("deriv_1_pct",
                                                       F.lag("deriv_1_pct", 1).over(w)))
    wk = (Window.partitionBy(key).orderBy("year_month")
          .rowsBetween(Window.unboundedPreceding, 0) if as_of else Window.partitionBy(key))
    out = step2.withColumns({
        **{c: F.coalesce(F.col(c), F.lit(0.0))
           for c in ("deriv_1_pct", "deriv_2_pct", "deriv_3_pct", "deriv_6_pct")},
        "monthly_max_qty": F.max("_p1").over(wk),
        "monthly_min_qty": F.min("_p1").over(wk),
    })
    return (out.withColumns({
        "deriv_1_flag": F.when(F.abs("deriv_2_pct") > 50, 1).otherwise(0),
        "deriv_2_trend_flag": F.when(F.col("deriv_2_pct") > 0, "increasing")
                               .when(F.col("deriv_2_pct") < 0, "decreasing")
                               .otherwise("fluctuating"),
    }).drop("_t", "_p1"))
