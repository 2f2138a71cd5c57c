"""Modelling checks (survey §5 item 6) and documented look-ahead features (item 5)."""

import math
import threading

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import ml as ML
from tidemark.operators import windows as WN


def seasonal_panel(spark, keys=12, months=48):
    rows = []
    for k in range(keys):
        for i in range(months):
            d = (pd.Timestamp("2018-01-01") + pd.DateOffset(months=i)).date()
            noise = ((k * 7919 + i * 104729) % 41) - 20          # deterministic ±20
            v = 100 + 10 * k + 40 * math.sin(2 * math.pi * (i % 12) / 12) + noise
            rows.append((f"s{k}", d, float(round(v))))
    return spark.createDataFrame(rows, "key string, date date, target double")


def features(df):
    f = WN.moving_stats(WN.lag_features(df, (12,), train_end="2020-12-31"), (6,))
    return ML.with_model_features(f)


def test_same_seed_same_predictions(spark):
    f = features(seasonal_panel(spark, 4, 36))
    a = ML.fit("random_forest", f).transform(f).select("key", "date", "prediction")
    b = ML.fit("random_forest", f).transform(f).select("key", "date", "prediction")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_model_beats_seasonal_naive(spark):
    f = features(seasonal_panel(spark))
    cut = F.lit("2020-12-31").cast("date")
    train, test = f.filter(F.col("date") <= cut), f.filter(F.col("date") > cut)
    model = ML.fit("random_forest", train)
    pred = model.transform(test)
    rmse_model = pred.select(F.sqrt(F.avg((F.col("target") - F.col("prediction")) ** 2))).first()[0]
    rmse_naive = pred.select(F.sqrt(F.avg((F.col("target") - F.col("Lag12_y")) ** 2))).first()[0]
    assert rmse_model < rmse_naive


def test_whole_history_features_look_ahead(spark):
    """#50, #65, #66, #68 use whole-history aggregates, as in the reference."""
    vals = [5, 3, 8, 1, 9, 2, 7, 4, 6, 0, 3, 5, 8, 2, 9]
    rows = [("a", (pd.Timestamp("2020-01-01") + pd.DateOffset(months=i)).date(), float(v))
            for i, v in enumerate(vals)]
    base = spark.createDataFrame(rows, "key string, date date, target double")
    changed = base.withColumn("target", F.when(F.col("date") == "2021-01-01", 999.0)
                              .otherwise(F.col("target")))

    def first_row(df):
        out = WN.seasonal_means(WN.seasonality_index(df))
        return out.orderBy("date").first()

    a, b = first_row(base), first_row(changed)
    assert a["target_seasonal_quarterly"] != b["target_seasonal_quarterly"]


def test_presets_and_search_space_are_the_reference_s(spark):
    forest, boost = ML.estimator("random_forest"), ML.estimator("xgboost")
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (50, 30)
    assert (boost.getMaxIter(), boost.getMaxDepth(), boost.getStepSize()) == (500, 6, 0.05)
    assert ML.estimator("lgbm").getMaxIter() == 100
    assert ML.estimator("xgboost", maxIter=3).getMaxIter() == 3
    for est, name, count, low, high in ((forest, "random_forest", "numTrees", 3, 15),
                                        (boost, "xgboost", "maxIter", 3, 10)):
        maps = ML.search_space(name, est)
        counts = {m[est.getParam(count)] for m in maps}
        depths = {m[est.maxDepth] for m in maps}
        assert (min(counts), max(counts), min(depths), max(depths)) == (100, 300, low, high)


def test_infinity_and_missing_are_imputed_and_flagged(spark):
    inf = float("inf")
    rows = [("a", float(i), x, 1.0, None) for i, x in
            enumerate([1.0, inf, 3.0, None, float("nan"), -inf, 5.0, 7.0] * 5)]
    df = spark.createDataFrame(rows, "key string, target double, x double, same double, none double")
    means, missing, constant, n = ML.column_facts(df, ["x", "same", "none"])
    assert means == {"x": 4.0, "same": 1.0, "none": 0.0} and n == 40
    assert missing == {"x", "none"} and constant == {"same", "none"}
    model = ML.fit("random_forest", df, ["x", "same", "none"], numTrees=2, maxDepth=2)
    assert model.stages[-2].getInputCols() == ["x__known", "x__missing", "none__missing"]
    out = model.transform(df.drop("target")).select("x", "x__known", "x__missing").collect()
    for r in out:
        odd = r["x"] is None or r["x"] != r["x"] or abs(r["x"]) == inf
        assert (r["x__known"], r["x__missing"]) == ((4.0, 1.0) if odd else (r["x"], 0.0))
    imp = ML.importances(spark, model, ["x", "same", "none"]).collect()
    assert {r["feature"] for r in imp} == {"x", "same", "none"}


def test_forests_keep_the_nodes_of_their_rows(spark):
    """Without it a level sends all trees to every task and walks each row from the root."""
    f = features(seasonal_panel(spark, 4, 36))
    quick, plain = ML.fit("random_forest", f), ML.fit("random_forest", f, cacheNodeIds=False)
    assert quick.stages[-1].getCacheNodeIds() and not plain.stages[-1].getCacheNodeIds()
    assert quick.stages[-1].toDebugString.split("\n", 1)[1] == \
        plain.stages[-1].toDebugString.split("\n", 1)[1]


def test_fits_and_importances_run_side_by_side(spark):
    """Jobs of several items are under way at once; results keep the items' order."""
    both = threading.Barrier(2, timeout=60)

    def count(n):
        both.wait()
        return spark.range(n).count()

    assert ML.side_by_side(spark, count, [5, 3, 8, 2], parallelism=2) == [5, 3, 8, 2]
    rows = [(f"k{i}", float(i % 7), float(i % 3), float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, a double, b double, target double")
    model = ML.fit("xgboost", df, ["a", "b"], maxIter=2, maxDepth=3)
    alone, beside = (ML.permutation_importance(spark, model, df, ["a", "b"], parallelism=n)
                     .collect() for n in (1, 3))
    assert alone == beside and alone[0]["feature"] == "a"


def test_boosting_spreads_its_rows_over_the_cores(spark, monkeypatch):
    """A level is a job: large training sets give every core a share of it."""
    rows = spark.range(0, 400, 1, 2).select(
        (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
        (F.col("id") % 7 * 2).cast("double").alias("target"), F.lit("x").alias("other"))
    assert ML.spread(rows, 400, ["a", "b", "target"]).rdd.getNumPartitions() == 2
    before = ML.rmse(ML.fit("xgboost", rows, ["a", "b"], maxIter=3), rows)
    monkeypatch.setattr(ML, "ROWS_OF_BOOSTING", (80, 1000))
    wide = ML.spread(rows, 400, ["a", "b", "target"])
    assert wide.rdd.getNumPartitions() == 5 and wide.columns == ["a", "b", "target"]
    assert wide.count() == 400
    assert math.isclose(ML.rmse(ML.fit("xgboost", rows, ["a", "b"], maxIter=3), rows), before)
    monkeypatch.setattr(ML, "ROWS_OF_BOOSTING", (10_000, 20))
    assert ML.spread(rows, 400, ["a", "b", "target"]).rdd.getNumPartitions() == 20
