"""Same-period-last-year extension, horizon grids and start alignment (#32, #81-85, #141).

The reference extends each group month by month in a Python loop. The loop
equals the recurrence v(m) = v(m - 12) for months after the group's last
month L, which has a closed form: every row of the last 12 months
(L - 12 < m <= L) is copied to m + 12k for k = 1.. while m + 12k <= T.
That is a per-row ``explode(sequence(1, K))``: no iteration, no join, no
shuffle beyond the per-group max of L (a partial aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def truncate_at(df: DataFrame, cutoff: str | Column, date_col: str = "date") -> DataFrame:
    """Keep rows up to the cutoff month (#81)."""
    c = F.lit(cutoff).cast("date") if isinstance(cutoff, str) else cutoff
    return df.filter(F.col(date_col) <= c)


def _replicate(src: DataFrame, t: Column, date_col: str, actual_flag: str | None) -> DataFrame:
    """Each row explodes k = 0..K; k = 0 is the row itself, k ≥ 1 its copies at +12k months.

    K is 0 outside the last 12 months of the group, so a single generate
    replaces "source ∪ copies" (no union, the input plan is computed once).
    """
    in_tail = F.col(date_col) > F.add_months("_L", -12)
    reps = F.when(in_tail, F.greatest(
        F.floor(F.months_between(t, F.col(date_col)) / 12).cast("int"), F.lit(0))).otherwise(0)
    out = (src.withColumn("_k", F.explode(F.sequence(F.lit(0), reps)))
           .withColumn(date_col, F.add_months(date_col, F.col("_k") * 12)))
    if actual_flag:
        out = out.withColumn(actual_flag, (F.col("_k") == 0).cast("int"))
    return out.drop("_k", "_L")


def sply_extend(df: DataFrame, keys: Sequence[str], horizon_end: str | Column,
                date_col: str = "date", actual_flag: str | None = None) -> DataFrame:
    """Extend each key group to ``horizon_end`` with same-month-last-year values.

    Gaps in the last 12 months stay gaps. ``actual_flag`` (if given) names an
    int column set to 1 on source rows and 0 on generated ones. The group's
    last month comes from a window over the group (groups here are monthly
    series, bounded by their number of months).
    """
    keys = list(keys)
    if not keys:  # never a global window: the last month is a scalar subquery
        return sply_extend_grouped(df, keys, horizon_end, date_col, actual_flag)
    t = F.lit(horizon_end).cast("date") if isinstance(horizon_end, str) else horizon_end
    last = F.max(date_col).over(Window.partitionBy(*keys))
    return _replicate(df.withColumn("_L", last), t, date_col, actual_flag)


def sply_extend_grouped(df: DataFrame, keys: Sequence[str], horizon_end: str | Column,
                        date_col: str = "date", actual_flag: str | None = None) -> DataFrame:
    """Same as :func:`sply_extend` with L from a partial aggregate joined back.

    Preferred when a group can be huge (a window would put the whole group in
    one task); the aggregate output is one row per group, and with no keys L
    is a scalar subquery.
    """
    keys = list(keys)
    t = F.lit(horizon_end).cast("date") if isinstance(horizon_end, str) else horizon_end
    if keys:
        src = df.join(df.groupBy(*keys).agg(F.max(date_col).alias("_L")), keys, "left")
    else:
        src = df.withColumn("_L", df.select(F.max(date_col)).scalar())
    return _replicate(src, t, date_col, actual_flag)


def horizon_months(origin: Column, months: int) -> Column:
    """Array of the ``months`` month starts after ``origin``'s month."""
    o = F.trunc(origin, "MM")
    return F.sequence(F.add_months(o, 1), F.add_months(o, months), F.expr("interval 1 month"))


def future_grid(keys_df: DataFrame, origin: Column, months: int,
                date_col: str = "date") -> DataFrame:
    """Every key × every future month (#32) as a per-row explode (no join)."""
    return keys_df.withColumn(date_col, F.explode(horizon_months(origin, months)))


def align_start(df: DataFrame, starts: Sequence[Column], date_col: str = "date") -> DataFrame:
    """Drop rows before the latest of the sources' first dates (#141).

    ``starts`` are scalar-subquery columns (``other.select(min(date)).scalar()``).
    """
    return df.filter(F.col(date_col) >= F.greatest(*starts))
