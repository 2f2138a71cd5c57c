"""Category encoders and quantile bins (#110-115).

Encoders are fit with one grouped aggregate on the training rows (output: one
row per category) and applied with a left join, so unseen categories get NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.safe import sdiv


#: Bins that exact quantiles are searched in (bounds the global step to one row per bin).
QUANTILE_BINS = 256


def quartile_cuts(df: DataFrame, col: str, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> Column:
    """Scalar subquery: array of the linear-interpolated quantiles, exact at every size.

    A sketch only deals the values into about equal bins; counts per bin place
    each wanted rank in its bin, and running counts over the bin's distinct
    values find it.  No task sees more than one bin's distinct values.
    """
    x = (df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull()))
    # One subquery for the count and the bins' edges.
    stats = x.select(F.struct(F.count("x").alias("n"), F.percentile_approx("x", F.array(
        *[F.lit(k / QUANTILE_BINS) for k in range(1, QUANTILE_BINS)]), 10_000).alias("e"))).scalar()
    values = (x.groupBy("x").agg(F.count("x").alias("n")).withColumn("s", stats)
              .select("x", "n", F.col("s.n").alias("total"),
                      F.size(F.filter("s.e", lambda e: e < F.col("x"))).alias("bin")))
    bins = values.groupBy("bin").agg(F.sum("n").alias("m"))
    before = bins.select("bin", (F.sum("m").over(Window.orderBy("bin")) - F.col("m")).alias("b"))
    upto = F.col("b") + F.sum("n").over(Window.partitionBy("bin").orderBy("x"))
    placed = (values.join(F.broadcast(before), "bin")
              .select("x", "n", "total", upto.alias("upto")))

    def at(rank: Column) -> Column:
        return F.min(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")),
                            F.col("x")))

    where = [(F.col("total") - 1) * F.lit(p) for p in probs]
    marks = placed.agg(F.max("total").alias("total"), *[
        at(f(w)).alias(f"{side}{k}") for k, w in enumerate(where)
        for f, side in ((F.floor, "lo"), (F.ceil, "hi"))])
    return marks.select(F.array(*[
        F.when(F.floor(w) == F.ceil(w), F.col(f"lo{k}")).otherwise(
            (F.ceil(w) - w) * F.col(f"lo{k}") + (w - F.floor(w)) * F.col(f"hi{k}"))
        for k, w in enumerate(where)])).scalar()


def quartile_bin(df: DataFrame, col: str, out: str | None = None,
                 of: DataFrame | None = None) -> DataFrame:
    """Labels 1..4 with right-closed intervals, lowest included (pandas ``qcut``, S14).

    Duplicate edges collapse instead of raising.  The cuts are those of ``of``
    (``df`` itself by default; pass the plain frame when binning several columns).
    """
    x, cut = F.col(col), lambda k: F.get("_cuts", F.lit(k))
    label = (F.when(x.isNull(), F.lit(None)).when(x <= cut(0), 1).when(x <= cut(1), 2)
             .when(x <= cut(2), 3).otherwise(4))
    return (df.withColumn("_cuts", quartile_cuts(df if of is None else of, col))
            .withColumn(out or f"{col}_cat", label.cast("int")).drop("_cuts"))


def target_encoding_table(train: DataFrame, col: str, target: str = "target",
                          min_samples_leaf: int = 20, smoothing: float = 10.0,
                          single_to_prior: bool = True, prior: Column | None = None) -> DataFrame:
    """Smoothed mean per category (S15): prior·(1−s) + mean·s, s = sigmoid((n−leaf)/smoothing).

    ``prior`` defaults to the mean target of ``train`` (a scalar subquery).
    """
    if prior is None:
        prior = train.select(F.avg(F.col(target).cast("double"))).scalar()
    stats = train.groupBy(col).agg(F.count(target).alias("_n"),
                                   F.avg(F.col(target).cast("double")).alias("_mean"))
    s = 1.0 / (1.0 + F.exp(-(F.col("_n") - min_samples_leaf) / smoothing))
    enc = prior * (1.0 - s) + F.col("_mean") * s
    if single_to_prior:
        enc = F.when(F.col("_n") == 1, prior).otherwise(enc)
    return stats.select(col, enc.alias(f"{col}_encode"))


def _hinted(table: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for categories whose domain is bounded by definition; no counting.

    A shuffle join would send all rows of such a value to one task.  The rest
    (store keys) is left to the planner: it joins on the panel's partitioning.
    """
    return F.broadcast(table) if small else table


def target_encode(df: DataFrame, cols: Sequence[str], train_filter: Column,
                  target: str = "target", small: Sequence[str] = (), **kw) -> DataFrame:
    """Fit on rows matching ``train_filter``; apply to all rows (#111).

    ``small`` names the columns with a fixed, small domain (channel, format, flags).
    """
    train = df.filter(train_filter)
    kw.setdefault("prior", train.select(F.avg(F.col(target).cast("double"))).scalar())
    out = df
    for c in cols:
        out = out.join(_hinted(target_encoding_table(train, c, target, **kw), c in small), c,
                       "left")
    return out


def target_share_encode(df: DataFrame, cols: Sequence[str], target: str = "target",
                        small: Sequence[str] = ()) -> DataFrame:
    """Category's share of the total target, ``{col}_target_pct`` (#112); ``small`` as above."""
    total = df.select(F.sum(target).cast("bigint")).scalar()
    out = df
    for c in cols:
        share = (df.filter(F.col(target).isNotNull()).groupBy(c)
                 .agg(sdiv(F.sum(target), total).alias(f"{c}_target_pct")))
        out = out.join(_hinted(share, c in small), c, "left")
    return out


def one_hot(df: DataFrame, col: str, levels: Sequence[str], drop_first: bool = True) -> DataFrame:
    """0/1 indicator per level (sorted), first level dropped (#113). Levels are explicit."""
    lv = sorted(levels)[1:] if drop_first else sorted(levels)
    return df.withColumns({f"{col}_{v}": (F.col(col) == v).cast("int") for v in lv}).drop(col)


def binary_map(df: DataFrame, col: str, one: str | Sequence[str],
               zero: str | Sequence[str] | None = None, out: str | None = None,
               fold: bool = False) -> DataFrame:
    """1 for ``one``, 0 for ``zero`` (or for anything else when ``zero`` is None), else NULL (#114).

    Either is a value or a set of values; ``fold`` compares without regard to case.  With
    ``zero`` None a NULL is 0, as it is in none of the sets.
    """
    def among(values):
        values = [values] if isinstance(values, str) else list(values)
        x = F.lower(F.col(col)) if fold else F.col(col)
        return x.isin([v.lower() for v in values] if fold else values)

    expr = (F.when(among(one), 1).when(among(zero), 0) if zero is not None
            else F.when(among(one), 1).otherwise(0))
    return df.withColumn(out or col, expr.cast("int"))


def apply_mapping(df: DataFrame, mapping: DataFrame, col: str, small: bool = False) -> DataFrame:
    """Join a saved (category → code) mapping (#115); unseen → NULL.

    ``small``: the category's domain is fixed and small, so the mapping is broadcast.
    """
    return df.join(_hinted(mapping, small), col, "left")
