"""Dataset profiles, value counts, correlations, duplicates and keep-first (#58-60, #69-70)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, date_col: str | None = "date") -> DataFrame:
    """One aggregate pass: rows, nulls per column, min/max date; stacked to long form (#59)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    if date_col:
        aggs += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    wide = df.agg(*aggs)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("nulls"))
                        for i, c in enumerate(cols)])
    keep = ["_rows"] + (["min_date", "max_date"] if date_col else [])
    return (wide.select(*keep, F.inline(entries))
            .withColumnRenamed("_rows", "rows")
            .withColumn("columns", F.lit(len(cols))))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, count) for each categorical column, stacked (#58)."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("s")).select("s.*")
    return stacked.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair (a, b), a listed before b, in one pass (#60).

    ``corr`` skips rows where either side is NULL, like pandas.
    """
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                 F.col(f"_c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])))


_MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def corr_matrix(df: DataFrame, cols: Sequence[str], least_spread: float = 1e-9) -> DataFrame:
    """Pearson correlation of every pair (a, b), a listed before b, of many columns (#60).

    Pairwise complete, like pandas: a pair's moments cover the rows that have both.  Every
    partition adds up the cross moments of all pairs as matrix products and gives one row
    a pair; these are summed.  Columns are centred and scaled by their own mean and spread
    first, so the sums stay small.  NULL where a pair has no spread.  NaN counts as missing.
    """
    cols = list(cols)
    x = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
         for c in cols}
    facts = df.agg(*[a for i, c in enumerate(cols) for a in (
        F.avg(x[c]).alias(f"m{i}"), F.stddev_samp(x[c]).alias(f"s{i}"))]).first()
    scaled = df.select(*[
        ((x[c] - F.lit(facts[f"m{i}"] or 0.0)) / F.lit(facts[f"s{i}"] or 1.0)).alias(f"c{i}")
        for i, c in enumerate(cols)])

    def moments(batches):
        import numpy as np
        import pyarrow as pa

        p = len(cols)
        total = np.zeros((6, p, p))
        for b in batches:
            v = np.column_stack([b.column(i).to_numpy(zero_copy_only=False).astype(float)
                                 for i in range(p)])
            known = (~np.isnan(v)).astype(float)
            v = np.where(known > 0, v, 0.0)
            total += [known.T @ known, v.T @ known, known.T @ v, (v * v).T @ known,
                      known.T @ (v * v), v.T @ v]
        i, j = np.triu_indices(p, 1)
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(i, pa.int32()), "b": pa.array(j, pa.int32())}
            | {m: pa.array(total[k][i, j], pa.float64()) for k, m in enumerate(_MOMENTS)})

    kind = "a int, b int, " + ", ".join(f"{m} double" for m in _MOMENTS)
    whole = scaled.mapInArrow(moments, kind).groupBy("a", "b").agg(
        *[F.sum(m).alias(m) for m in _MOMENTS])
    n, vx, vy = F.col("n"), *(F.col(f"s{z}{z}") - F.col(f"s{z}") ** 2 / F.col("n") for z in "xy")
    spread = (n > 1) & (vx > least_spread * n) & (vy > least_spread * n)
    names = F.array(*[F.lit(c) for c in cols])
    return whole.select(
        F.get(names, F.col("a")).alias("feature_a"), F.get(names, F.col("b")).alias("feature_b"),
        F.when(spread, (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(vx * vy))
        .alias("corr"))


def corr_groups(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """``corr_matrix`` of several lists of columns: grp, feature_a, feature_b, corr.

    A pair's correlation doesn't depend on its group, so the columns of all groups go
    through one matrix, and every group takes its pairs from it in its own order.
    """
    cols = list(dict.fromkeys(c for group in groups.values() for c in group))
    at = {c: i for i, c in enumerate(cols)}
    wanted = [(name, a, b, *sorted((a, b), key=at.get)) for name, group in groups.items()
              for i, a in enumerate(group) for b in list(group)[i + 1:]]
    taken = df.sparkSession.createDataFrame(
        wanted, "grp string, a string, b string, feature_a string, feature_b string")
    return (corr_matrix(df, cols).join(F.broadcast(taken), ["feature_a", "feature_b"])
            .select("grp", F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), "corr"))


def duplicates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Value combinations that occur more than once, with their count (#70)."""
    cols = list(cols or df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def keep_first(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row per ``subset`` under an explicit total order (#69).

    A grouped ``min_by`` (map-side partial aggregation) rather than a
    row_number window, so a hot key never gathers all its rows in one task.
    """
    rest = [c for c in df.columns if c not in subset]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order_by]))
    return df.groupBy(*subset).agg(best.alias("_r")).select(*subset, "_r.*")


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Raise when ``df`` is empty (#10); one short job (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
