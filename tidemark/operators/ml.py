"""Spark ML trainers, randomised search and importances (#116-123, #127).

Trees in Spark ML take no NULL/NaN, so every pipeline starts with missing indicators and
mean imputation (the reference's boosters take NaN directly); ±infinity counts as missing.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.forest import DeepForestRegressor

FEATURES = ("Lag12_y", "MA6_y", "STD6_y", "EMA6_y", "month", "quarter")
SEED = 42
#: The reference's fixed presets.  Its forest has depth 200, of which Spark allows 30; its
#: leaf-wise boosting has LightGBM's 100 rounds of four leaves, which are two levels here.
PRESETS = {
    "random_forest": dict(numTrees=50, maxDepth=30),
    "xgboost": dict(maxIter=500, maxDepth=6, stepSize=0.05),
    "lgbm": dict(maxIter=100, maxDepth=2, stepSize=0.05, subsamplingRate=0.8,
                 featureSubsetStrategy="0.9"),
}
#: How deep trees are grown, not which: each row keeps its node, so no group of nodes sends
#: all trees to the tasks or walks every row down from the root.  Shallow rounds of
#: boosting are quicker without it.
DEEP = dict(cacheNodeIds=True)


def estimator(name: str, label: str = "target", weight_col: str | None = None, **preset):
    """Fixed presets: random forest, depth-wise boosting, fine leaf-style boosting (#117-119).

    ``weight_col`` feeds per-row sample weights (e.g. recency weights, #128); ``preset``
    replaces values of the preset.
    """
    common = dict(featuresCol="features", labelCol=label, predictionCol="prediction", seed=SEED)
    if weight_col:
        common["weightCol"] = weight_col
    if name == "random_forest":
        return DeepForestRegressor(**DEEP | PRESETS[name] | preset, **common)
    return GBTRegressor(**PRESETS[name] | preset, **common)


def known(c: str) -> str:
    """SQL: the column as a double, NULL where it is NaN or infinite."""
    x = f"CAST(`{c}` AS DOUBLE)"
    return f"CASE WHEN isnan({x}) OR abs({x}) = double('Infinity') THEN NULL ELSE {x} END"


def column_facts(train: DataFrame, features: Sequence[str]) -> tuple[dict, set, set, int]:
    """Of each feature its mean, which are missing somewhere and which are constant, and the
    number of rows, in one pass over ``train``.  A feature without a known value has mean 0.
    """
    x = {c: F.expr(known(c)) for c in features}
    row = train.agg(F.count(F.lit(1)).alias("rows"), *[a for c in features for a in (
        F.avg(x[c]).alias(f"m_{c}"), F.count(x[c]).alias(f"n_{c}"),
        (F.min(x[c]) < F.max(x[c])).alias(f"d_{c}"))]).first()
    return ({c: row[f"m_{c}"] or 0.0 for c in features},
            {c for c in features if row[f"n_{c}"] < row["rows"]},
            {c for c in features if not row[f"d_{c}"]}, row["rows"])


#: Rows of a training partition at least: a level of a tree costs a job, and every
#: partition of it sends all bins of all nodes.
ROWS_PER_PARTITION = 50_000


def compact(train: DataFrame, rows: int) -> DataFrame:
    """Small training sets in two partitions, larger ones as they come."""
    return train.coalesce(max(2, -(-rows // ROWS_PER_PARTITION)))


#: Rows of a partition of depth-wise boosting, at least and at most.
ROWS_OF_BOOSTING = 10_000, 250_000


def spread(train: DataFrame, rows: int, columns: Sequence[str]) -> DataFrame:
    """Training rows for depth-wise boosting, whose thousands of levels are a job each: a
    partition a core, and no plan of the input behind them.  Small sets stay as they are."""
    from tidemark.session import checkpoint

    least, most = ROWS_OF_BOOSTING
    cores = train.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, rows // least), -(-rows // most))
    if parts <= 2:
        return compact(train, rows)
    return checkpoint(train.select(*dict.fromkeys(columns)).repartition(parts))


def pipeline(est, features: Sequence[str], means: dict, missing: set,
             constant: set = frozenset()) -> Pipeline:
    """Mean imputation, missing indicators → assembler → estimator (#122).

    The rest is :func:`column_facts` of the training rows: features that are never missing
    there need no indicator, and no tree splits on constant ones.
    """
    used = [c for c in features if c not in constant] or list(features)[:1]
    filled = [f"COALESCE({known(c)}, {float(means[c])!r}D) AS `{c}__known`" for c in used]
    lacking = [c for c in features if c in missing]
    flags = [f"CAST({known(c)} IS NULL AS DOUBLE) AS `{c}__missing`" for c in lacking]
    prepared = SQLTransformer(statement=f"SELECT *, {', '.join(filled + flags)} FROM __THIS__")
    assembler = VectorAssembler(
        inputCols=[f"{c}__known" for c in used] + [f"{c}__missing" for c in lacking],
        outputCol="features")
    return Pipeline(stages=[prepared, assembler, est])


def with_model_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Calendar covariates known for any month; the label as double."""
    return df.withColumns({"month": F.month(date_col), "quarter": F.quarter(date_col),
                           "target": F.col("target").cast("double")})


def search_space(name: str, est) -> list:
    """Parameter grid per model family (#120): the reference's ranges, where Spark has the
    parameter.  Fine boosting has 25 to 40 leaves there, which are 5 or 6 levels here."""
    g = ParamGridBuilder()
    if name == "random_forest":
        g = (g.addGrid(est.numTrees, list(range(100, 301, 10)))
             .addGrid(est.maxDepth, list(range(3, 16)))
             .addGrid(est.minInstancesPerNode, list(range(1, 8)))
             .addGrid(est.featureSubsetStrategy, ["all", "sqrt", "log2", "0.9", "0.85", "0.75"])
             .addGrid(est.bootstrap, [True, False]))
    elif name == "xgboost":
        g = (g.addGrid(est.maxIter, list(range(100, 301, 20)))
             .addGrid(est.maxDepth, list(range(3, 11)))
             .addGrid(est.stepSize, [0.3, 0.2, 0.1, 0.05])
             .addGrid(est.minInfoGain, [0.0, 0.1, 0.01, 0.001])
             .addGrid(est.subsamplingRate, [0.9, 0.8, 0.7])
             .addGrid(est.featureSubsetStrategy, ["0.9", "0.8", "0.7"]))
    else:
        g = (g.addGrid(est.maxDepth, [5, 6])
             .addGrid(est.stepSize, [0.01, 0.02, 0.05, 0.07])
             .addGrid(est.featureSubsetStrategy, ["0.5", "0.7", "0.9"])
             .addGrid(est.subsamplingRate, [0.7, 0.75, 0.8]))
    return g.build()


def fold_column(df: DataFrame, key: str = "key", folds: int = 3, out: str = "fold") -> DataFrame:
    """Whole keys per fold (a key's months never straddle train and validation)."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.col(key)), F.lit(folds)).cast("int"))


def random_search(name: str, train: DataFrame, draws: int = 10, folds: int = 3,
                  parallelism: int = 4, features: Sequence[str] = FEATURES,
                  space=None):
    """Sample ``draws`` parameter maps (seed 42) and cross-validate them on RMSE (#121).

    Returns the search, whose ``bestModel`` is the best draw fitted on all of ``train``,
    and the draws.  ``space(name, estimator)`` lists the parameter maps to draw from
    (default: :func:`search_space`).
    """
    est = estimator(name)
    maps = (space or search_space)(name, est)
    sampled = random.Random(SEED).sample(maps, min(draws, len(maps)))
    *facts, rows = column_facts(train, features)
    cv = CrossValidator(estimator=pipeline(est, features, *facts),
                        estimatorParamMaps=sampled,
                        evaluator=RegressionEvaluator(labelCol="target", metricName="rmse"),
                        foldCol="fold", numFolds=folds, parallelism=parallelism, seed=SEED)
    model = cv.fit(fold_column(compact(train, rows), folds=folds))
    return model, sampled


def search_rows(name: str, search, sampled: list) -> list[tuple]:
    """(model, draw, params, mean RMSE over the folds, chosen) of a search; of equally good
    draws the first is chosen."""
    text = [", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name))
            for m in sampled]
    scores = [float(x) for x in search.avgMetrics]
    best = scores.index(min(scores))
    return [(name, i, t, x, i == best) for i, (t, x) in enumerate(zip(text, scores))]


def tuned(names: Sequence[str], train: DataFrame, draws: int = 10, folds: int = 3,
          features: Sequence[str] = FEATURES, **kw) -> tuple[dict, list[tuple]]:
    """Every candidate searched in its own space, and its best draw fitted again on all
    training rows: {name: model}, rows of :func:`search_rows`."""
    models, rows = {}, []
    for name in names:
        search, sampled = random_search(name, train, draws, folds, features=features, **kw)
        models[name] = search.bestModel
        rows += search_rows(name, search, sampled)
    return models, rows


def fit(name: str, train: DataFrame, features: Sequence[str] = FEATURES,
        weight_col: str | None = None, **preset) -> PipelineModel:
    est = estimator(name, weight_col=weight_col, **preset)
    *facts, rows = column_facts(train, features)
    used = [*features, "target", *([weight_col] if weight_col else [])]
    given = spread(train, rows, used) if name == "xgboost" else compact(train, rows)
    return pipeline(est, features, *facts).fit(given)


def side_by_side(spark: SparkSession, run: Callable, items: Sequence,
                 parallelism: int = 4) -> list:
    """``run`` of each item, whose jobs run beside those of the others; results in order."""
    # Each has local properties of its own, where a query keeps its execution's id.
    tasks = [inheritable_thread_target(spark)(partial(run, x)) for x in items]
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda task: task(), tasks))


def rmse(model: PipelineModel, df: DataFrame) -> float:
    return RegressionEvaluator(labelCol="target", metricName="rmse").evaluate(model.transform(df))


def importances(spark: SparkSession, model: PipelineModel,
                features: Sequence[str] = FEATURES) -> DataFrame:
    """Model feature importances, indicators folded into their feature, ranked (#127)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    total = dict.fromkeys(features, 0.0)
    for name, x in zip(model.stages[-2].getInputCols(), imp):
        total[name.rpartition("__")[0]] += float(x)
    df = spark.createDataFrame(list(total.items()), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def permute_column(df: DataFrame, col: str, seed: int = SEED, buckets: int | None = None,
                   rows_per_group: int = 4096,
                   by: Sequence[str] = ("key", "date")) -> DataFrame:
    """Replace ``col`` by a derangement of its values, without a global sort.

    Rows are hashed by ``by`` into ``buckets`` groups (default: as many as give about
    ``rows_per_group`` rows each) and ordered by another hash inside each; every row takes the value of its successor (the last takes the
    first). The order depends on the rows alone, so reruns agree.
    """
    groups = F.lit(buckets) if buckets else F.greatest(df.select(
        F.ceil(F.count(F.lit(1)) / rows_per_group).alias("n")).scalar(), F.lit(1))
    by = [c for c in by if c in df.columns] or list(df.columns)
    salt = [F.lit(f"{seed}|{col}"), *[F.col(c).cast("string") for c in by]]
    shuffled = df.withColumns({
        "_pb": F.pmod(F.xxhash64(F.lit("group"), *salt), groups),
        "_po": F.xxhash64(F.lit("order"), *salt)})
    w = Window.partitionBy("_pb").orderBy("_po", *by)
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = F.coalesce(F.lead(col, 1).over(w), F.first(col).over(wall))
    return shuffled.withColumn(col, nxt).drop("_pb", "_po")


def permutation_importance(spark: SparkSession, model: PipelineModel, df: DataFrame,
                           features: Sequence[str] = FEATURES, seed: int = SEED,
                           parallelism: int = 4) -> DataFrame:
    """RMSE increase when one feature is permuted, one scoring job per feature (#127)."""
    def error(f):
        return rmse(model, df if f is None else permute_column(df, f, seed))

    base, *errors = side_by_side(df.sparkSession, error, [None, *features], parallelism)
    rows = [(f, e - base) for f, e in zip(features, errors)]
    return (spark.createDataFrame(rows, "feature string, rmse_increase double")
            .orderBy(F.desc("rmse_increase"), "feature"))
