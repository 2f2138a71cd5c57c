"""Feature-store assembly: future rows, joins by date/key, fills (#20-21, #29-31, #75, #116, #128)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.extend import future_grid


def add_future_rows(history: DataFrame, keys: DataFrame, origin: Column, months: int,
                    key: str = "key", date_col: str = "date") -> DataFrame:
    """History ∪ (keys × next ``months`` months) with missing columns NULL (#32, #75)."""
    fut = future_grid(keys.select(key).distinct(), origin, months, date_col)
    return history.unionByName(fut, allowMissingColumns=True)


def left_join_by(df: DataFrame, other: DataFrame, on: Sequence[str],
                 fill: dict | None = None) -> DataFrame:
    """Left join on the given columns, then fill the listed columns (#21, #29-31).

    Fills only named columns (the reference's blanket ``fillna(0)`` is S13).
    """
    out = df.join(other, list(on), "left")
    return out.fillna(fill) if fill else out


def blanket_fill(df: DataFrame, value=0) -> DataFrame:
    """Fill every numeric column (explicit opt-in, #20)."""
    return df.fillna(value)


def split_flag(df: DataFrame, train_end: str, date_col: str = "date",
               out: str = "Pred_Flag") -> DataFrame:
    """1 for hold-out/future rows after ``train_end``, else 0 (#16, #116)."""
    return df.withColumn(out, (F.col(date_col) > F.lit(train_end).cast("date")).cast("int"))


def recency_weight(df: DataFrame, train_end: str, decay: float = 0.05,
                   date_col: str = "date", out: str = "weight") -> DataFrame:
    """exp(−decay · months before the train-end month) for sample weighting (#128)."""
    months = F.months_between(F.trunc(F.lit(train_end).cast("date"), "MM"),
                              F.trunc(F.col(date_col), "MM"))
    return df.withColumn(out, F.exp(-decay * months))
