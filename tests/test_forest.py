"""Forests grown in tasks: splits, whole trees, wide levels, models on disk."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import forest as FO
from tidemark.operators import ml as ML

FEATURES = ["a", "b", "c", "d"]


def rule(features=3, **kw):
    return FO.Rule(**dict(features=features, subset=features, depth=30, least=1, gain=0.0,
                          bootstrap=True, seed=7, bins=32) | kw)


def sample(n=300, features=3, top=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, top, (n, features)).astype(np.uint8)
    y = np.round(5.0 * (x[:, 0] > 4) + x[:, 1] + rng.normal(0, 2, n), 2)
    c = rng.integers(1, 4, n).astype(float)
    return x, y, c * rng.uniform(0.5, 2, n), c


def error(y, w):
    return float((w * (y - (w * y).sum() / w.sum()) ** 2).sum()) if len(y) else 0.0


@pytest.mark.parametrize("n", [3, 40, 300])
def test_the_first_split_is_the_best_of_all(n):
    x, y, w, c = sample(n)
    least = 1 if n == 3 else 9
    feature, cut, left, value, _ = FO.grow(rule(depth=1, least=least), np.random.default_rng(0),
                                           x, y, w, c)
    splits = []
    for f in range(3):
        for b in range(12):
            go = x[:, f] <= b
            if min(c[go].sum(), c[~go].sum()) >= least:
                splits.append(error(y[go], w[go]) + error(y[~go], w[~go]))
    go = x[:, feature[0]] <= cut[0]
    assert math.isclose(error(y[go], w[go]) + error(y[~go], w[~go]), min(splits), rel_tol=1e-9)
    assert feature.tolist()[1:] == [FO.LEAF] * 2 and left[0] == 1
    for side, v in ((go, value[1]), (~go, value[2])):
        assert math.isclose(v, (w * y)[side].sum() / w[side].sum())


def test_cells_counted_and_sorted_agree():
    x, y, w, c = sample(200)
    of = np.arange(200) // 50
    few, many = (FO.cells(rule(bins=n), of, x.T, w, w * y, c) for n in (32, 250))
    assert len(few[0]) == len(many[0]) and all(np.allclose(a, b) for a, b in zip(few[1:], many[1:]))
    assert (few[0] // 32 == many[0] // 250).all() and (few[0] % 32 == many[0] % 250).all()
    one = (of == 2) & (x[:, 1] == 5)
    at = few[0].tolist().index((2 * 3 + 1) * 32 + 5)
    assert np.allclose([z[at] for z in few[1:]], [z[one].sum() for z in (w, w * y, c)])
    plain = FO.cells(rule(), of, x.T, c, c * y, c)
    assert np.array_equal(plain[1], plain[3])


def test_trees_end_at_pure_nodes_depth_and_least_rows():
    x, y, w, c = sample(400)
    _, own = np.unique(x, axis=0, return_inverse=True)
    whole = FO.grow(rule(), np.random.default_rng(0), x, y, w, c)
    mean = np.bincount(own.ravel(), w * y) / np.bincount(own.ravel(), w)
    assert np.allclose(whole[3][FO.walk(*whole[:3], x)], mean[own.ravel()])
    short = FO.grow(rule(depth=3, least=20), np.random.default_rng(0), x, y, w, c)
    end = FO.walk(*short[:3], x)
    assert len(short[0]) <= 15 and np.bincount(end, c)[np.unique(end)].min() >= 20
    flat = FO.grow(rule(), np.random.default_rng(0), x, np.full(400, 3.3), w, c)
    assert len(flat[0]) == 1 and flat[3][0] == 3.3


def test_thresholds_lie_between_neighbours_at_equal_shares():
    assert FO.thresholds(np.array([3.0, 1, 1, 2]), np.array([1, 2, 3, 1]), 32).tolist() == [1.5, 2.5]
    assert FO.thresholds(np.array([4.0]), np.array([9]), 32).tolist() == []
    x = np.random.default_rng(0).normal(size=10_000)
    cuts = FO.thresholds(*np.unique(x, return_counts=True), 32)
    share = np.bincount(np.searchsorted(cuts, x)) / len(x)
    assert len(cuts) == 31 and abs(share - 1 / 32).max() < 0.001
    assert FO.binned(np.array([[1.5], [1.6]]), [np.array([1.5])]).tolist() == [[0], [1]]


def test_feature_subsets_have_spark_s_sizes():
    sizes = {"auto": 18, "all": 52, "onethird": 18, "sqrt": 8, "log2": 6, "0.9": 47, "0.85": 45,
             "1.0": 52, "5": 5}
    assert {s: FO.subset_size(s, 52, 50) for s in sizes} == sizes


def frame(spark, n=3000):
    x = F.xxhash64("id")
    return spark.range(n, numPartitions=3).select(
        F.col("id").cast("string").alias("key"),
        *[(F.pmod(F.xxhash64("id", F.lit(f)), F.lit(97)) / 7).alias(f) for f in FEATURES[:3]],
        F.when(F.pmod(x, F.lit(5)) == 0, F.lit(None)).otherwise(
            F.pmod(x, F.lit(3))).cast("double").alias("d"),
        (F.pmod(x, F.lit(4)) + 1.0).alias("weight"), F.pmod(x, F.lit(41)).alias("noise")
    ).withColumn("target", F.round(10 * F.sin("a") + F.col("b") * 3 + F.col("noise") / 10, 1))


def scores(model, df):
    return {r[0]: r[1] for r in model.transform(df).select("key", "prediction").collect()}


def test_large_forests_are_grown_in_tasks_and_reload(spark, monkeypatch, tmp_path):
    df = frame(spark)
    plain = ML.fit("random_forest", df, FEATURES, numTrees=12)
    monkeypatch.setattr(FO, "BAGGED_ROWS", 1000)
    model, again = (ML.fit("random_forest", df, FEATURES, numTrees=12) for _ in range(2))
    assert isinstance(model.stages[-1], FO.GrownForest)
    assert not isinstance(plain.stages[-1], FO.GrownForest)
    of = scores(model, df)
    assert len(of) == 3000 and of == scores(again, df)
    low, high = df.agg(F.min("target"), F.max("target")).first()
    assert low <= min(of.values()) and max(of.values()) <= high
    test = df.filter(F.pmod(F.xxhash64("key"), F.lit(4)) == 0)
    train = df.join(test, "key", "left_anti")
    ours = ML.rmse(ML.fit("random_forest", train, FEATURES, numTrees=12), test)
    monkeypatch.undo()
    spark_s = ML.rmse(ML.fit("random_forest", train, FEATURES, numTrees=12), test)
    assert abs(ours - spark_s) < 0.1 * spark_s
    a, b = (m.stages[-1].featureImportances.toArray() for m in (model, plain))
    assert math.isclose(a.sum(), 1) and abs(a - b).max() < 0.1
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert scores(loaded, df) == of
    assert loaded.stages[-1].featureImportances == model.stages[-1].featureImportances
    assert loaded.transform(df.limit(0)).count() == 0
    twice = df.union(df)
    assert model.transform(twice).filter("prediction IS NULL").count() == 0
    assert model.transform(twice).count() == 6000


def test_wide_levels_grow_the_same_trees_as_one_task(spark, monkeypatch):
    """All rows and features: nothing is drawn, so where a node is split can't matter."""
    df = frame(spark)
    monkeypatch.setattr(FO, "BAGGED_ROWS", 0)
    preset = dict(numTrees=2, bootstrap=False, featureSubsetStrategy="all")
    for more in ({}, {"weight_col": "weight"}, {"maxDepth": 3}, {"minInstancesPerNode": 40}):
        kw = preset | more
        monkeypatch.setattr(FO, "ROWS_PER_SUBTREE", 200_000)
        one = scores(ML.fit("random_forest", df, FEATURES, **kw), df)
        monkeypatch.setattr(FO, "ROWS_PER_SUBTREE", 500)
        wide = ML.fit("random_forest", df, FEATURES, **kw)
        assert any(len(top[0]) > 2 for top in wide.stages[-1].content["tops"])
        assert all(math.isclose(v, one[k], abs_tol=1e-9) for k, v in scores(wide, df).items())
        if more == {"maxDepth": 3}:
            assert len(set(one.values())) <= 8


def test_a_weight_counts_like_that_many_rows(spark, monkeypatch):
    monkeypatch.setattr(FO, "BAGGED_ROWS", 0)
    df = frame(spark, 400)
    many = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int"))))
    kw = dict(numTrees=2, bootstrap=False, featureSubsetStrategy="all", maxDepth=4)
    # Thresholds would see the copies; few values a feature keep them the same.
    df, many = (d.withColumns({c: F.floor(c) for c in FEATURES[:3]}) for d in (df, many))
    a = scores(ML.fit("random_forest", df, FEATURES, weight_col="weight", **kw), df)
    b = scores(ML.fit("random_forest", many, FEATURES, **kw), df)
    assert all(math.isclose(a[k], b[k], abs_tol=1e-9) for k in a)
