"""Versioned artefacts: atomic commits, scopes that don't touch, mappings and contracts."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tidemark.operators.contract import FeatureContract
from tidemark.sources import files, registry
from tidemark.sources.io import shared_dir


def scaled(spark, by):
    """A tiny model whose prediction tells which one it is."""
    df = spark.createDataFrame([(1.0,)], "x double")
    stage = SQLTransformer(statement=f"SELECT *, x * {by} AS prediction FROM __THIS__")
    return Pipeline(stages=[stage]).fit(df), FeatureContract.of(df, ["x"])


def predicted(spark, version):
    df = spark.createDataFrame([(2.0,)], "x double")
    return version.model("m").transform(df).first()["prediction"]


def test_brands_and_versions_stay_apart(spark):
    root = shared_dir(spark, "registry")
    scopes = {b: registry.Scope("units", b, "2001-11", "2000-06-30")
              for b in ("Brand#1", "Brand 1", "a/b")}
    for k, s in enumerate(scopes.values()):
        assert registry.latest(spark, root, s) is None
        draft = registry.Draft(spark, s, root)
        draft.model("m", *scaled(spark, k + 1))
        draft.commit()
    for k, s in enumerate(scopes.values()):
        assert predicted(spark, registry.latest(spark, root, s)) == 2.0 * (k + 1)
    again = registry.Draft(spark, scopes["a/b"], root)
    again.model("m", *scaled(spark, 9))
    # Not committed: readers still have the version before, of their own brand.
    assert predicted(spark, registry.latest(spark, root, scopes["a/b"])) == 6.0
    other = registry.Draft(spark, scopes["a/b"], root)
    assert other.version == again.version + 1
    again.commit()
    now = registry.latest(spark, root, scopes["a/b"])
    assert now.version == 2 and predicted(spark, now) == 18.0
    assert predicted(spark, registry.latest(spark, root, scopes["Brand#1"])) == 2.0
    with pytest.raises(KeyError):
        now.model("other")


def test_mapping_and_notes(spark):
    root, scope = shared_dir(spark, "registry"), registry.Scope("u", "b", "c", "t")
    draft = registry.Draft(spark, scope, root)
    table = spark.createDataFrame([("up", 1.5), ("down", -2.0), (None, 0.1)],
                                  "label string, code double")
    draft.mapping("trend", table, "label", "code")
    draft.note("mean", 4.5)
    v = draft.commit()
    again = registry.latest(spark, root, scope)
    assert again.codes("trend") == {"up": 1.5, "down": -2.0}
    assert again.note("mean") == 4.5 and v.version == again.version
    assert again.mapping("trend").count() == 3
    with pytest.raises(ValueError):
        again.codes("trend", most=1)


def test_contract_mends_missing_extra_mistyped(spark):
    good = spark.createDataFrame([(1, 2.5, "k", 7)], "a int, b double, key string, c bigint")
    contract = FeatureContract.of(good, ["b", "a", "c"], fills={"c": -1})
    assert FeatureContract.from_dict(contract.to_dict()) == contract
    bad = spark.createDataFrame([("k", "2.5", "x", 3.0), ("q", "oops", "y", None)],
                                "key string, B string, extra string, a double")
    assert contract.problems(bad) == {"missing": ["c"], "extra": ["key", "extra"],
                                      "mistyped": ["b", "a"]}
    out = contract.enforce(bad, keep=["key"])
    assert out.dtypes == [("key", "string"), ("b", "double"), ("a", "int"), ("c", "bigint")]
    assert [tuple(r) for r in out.collect()] == [("k", 2.5, 3, -1), ("q", None, None, -1)]
    with pytest.raises(ValueError):
        FeatureContract.of(good, ["none"])


def test_tree_stamp_sees_changes_in_subfolders(spark):
    path = shared_dir(spark, "stamped")
    df = spark.range(4).withColumn("p", F.col("id") % 2)
    df.write.partitionBy("p").parquet(path)
    before = files.tree_stamp(spark, path)
    df.limit(1).write.mode("append").partitionBy("p").parquet(path)
    assert files.tree_stamp(spark, path) != before


def test_models_of_two_brands_and_targets(spark):
    """Panels, models, mappings and forecasts of a run are of its brand and target."""
    from tests.conftest import SF_SMALL
    from tidemark.plans import fragments as FR
    from tidemark.plans import models as M
    from tidemark.plans.common import Run, target_panel

    with pytest.raises(ValueError):
        Run(SF_SMALL, target="profit")
    root = shared_dir(spark, "registry")
    runs = {b: Run(SF_SMALL, b, t) for b, t in (("all", "units"), ("Brand#1", "units"))}
    small = {"random_forest": dict(numTrees=3, maxDepth=4)}
    for b, run in runs.items():
        M.publish(spark, run, root, ["random_forest"], presets=small)
    sums = {b: target_panel(spark, r).agg(F.sum("target")).first()[0] for b, r in runs.items()}
    assert sums["all"] > sums["Brand#1"] > 0
    money = target_panel(spark, Run(SF_SMALL, "all", "sales")).agg(F.sum("target")).first()[0]
    assert money > sums["all"]
    for b, run in runs.items():
        version = registry.latest(spark, root, M.scope_of(spark, run))
        train, _ = FR.ml_frames(spark, run)
        assert version.scope.brand == b
        assert version.note("train_mean") == train.agg(F.avg("target")).first()[0]
        codes = {r[0]: r[1] for r in FR.trend_mapping(spark, run).collect()}
        assert version.codes("deriv_2_trend_flag") == {k: v for k, v in codes.items()}
        high = train.agg(F.max("target")).first()[0]
        fc = M.forecast(spark, run, version, "random_forest", M.train_origin(), 3).collect()
        stores = target_panel(spark, run).select("key").distinct().count()
        assert len(fc) == 3 * stores and all(0 <= r["forecast"] <= high for r in fc)
    assert len(M.publish(spark, runs["all"], root, ["random_forest"], presets=small)
               .contract("random_forest").names) == len(FR.FEATURES)


def test_every_candidate_is_tuned_in_its_own_space(spark):
    from tests.conftest import SF_SMALL
    from tidemark.operators import ml as ML
    from tidemark.plans import fragments as FR
    from pyspark.ml.tuning import ParamGridBuilder

    def space(name, est):
        trees = est.numTrees if name == "random_forest" else est.maxIter
        return (ParamGridBuilder().addGrid(trees, [1, 2]).addGrid(est.maxDepth, [1, 2])
                .build())

    train, _ = FR.ml_frames(spark, SF_SMALL)
    names = ["xgboost", "lgbm", "random_forest"]
    models, rows = ML.tuned(names, train, draws=3, folds=2, features=FR.FROM_TARGET, space=space)
    assert sorted(models) == sorted(names) and len(rows) == 9
    for n in names:
        mine = [r for r in rows if r[0] == n]
        assert len({r[2] for r in mine}) == 3 and sum(r[4] for r in mine) == 1
        best = min(mine, key=lambda r: r[3])
        assert best[4] and f"maxDepth={models[n].stages[-1].getMaxDepth()}" in best[2]
    spaces = {n: ML.search_space(n, ML.estimator(n)) for n in names}
    rates = {n: {m[p] for m in spaces[n] for p in m if p.name == "stepSize"} for n in names}
    assert rates["xgboost"] == {0.3, 0.2, 0.1, 0.05}
    assert rates["lgbm"] == {0.01, 0.02, 0.05, 0.07} and not rates["random_forest"]
