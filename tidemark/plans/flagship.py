"""The flagship query: active-store monthly panel with lag and moving features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import windows as WN
from tidemark.plans.common import rnd, target_panel
from tidemark.plans.params import LAGS, TRAIN_END, WINDOWS


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = target_panel(spark, sf_dir)
    df = WN.lag_features(df, LAGS, train_end=TRAIN_END)
    df = WN.moving_stats(df, WINDOWS)
    cols = [f"Lag{k}_y" for k in LAGS] + [f"{p}{w}_y" for w in WINDOWS for p in ("MA", "STD", "EMA")]
    return rnd(df, cols)
