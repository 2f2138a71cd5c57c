"""Fitted models of a run, kept in the registry: trained once, loaded where they are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import evaluate as EV
from tidemark.operators import feature_store as FS
from tidemark.operators import ml as ML
from tidemark.operators import recursive as RC
from tidemark.operators.contract import FeatureContract
from tidemark.plans import fragments as FR
from tidemark.plans.common import brand_of, inputs_stamp, target_of
from tidemark.plans.params import HORIZON_MONTHS, TRAIN_END
from tidemark.sources import registry
from tidemark.sources.io import shared_dir

TREND = "deriv_2_trend_flag"
#: How a model is fitted: its family, and whether recent rows weigh more.
KINDS = {n: (n, False) for n in EV.MODELS} | {"weighted_forest": ("random_forest", True)}


def scope_of(spark: SparkSession, d: str) -> registry.Scope:
    cutoff = FR.panel(spark, d).select(F.date_format(F.max("date"), "yyyy-MM")).first()[0]
    return registry.Scope(target_of(d), brand_of(d), cutoff or "none", TRAIN_END)


def publish(spark: SparkSession, d: str, root: str, names=EV.MODELS,
            tuning: dict | None = None, presets: dict | None = None) -> registry.Version:
    """Fit the named models on the run's train rows and commit them as one version.

    With ``tuning`` ({draws, folds, …}) every candidate is searched and its best draw fitted
    again; ``presets`` overrides fixed values.  The version also holds the trend mapping,
    the train mean and the search's rows.
    """
    train, _ = FR.ml_frames(spark, d)
    contract = FeatureContract.of(train, FR.FEATURES, fill=0.0)
    draft = registry.Draft(spark, scope_of(spark, d), root)
    rows = []
    if tuning is None:
        models = {}
        for n in names:
            family, weighted = KINDS[n]
            t = FS.recency_weight(train, TRAIN_END) if weighted else train
            models[n] = ML.fit(family, t, FR.FEATURES, "weight" if weighted else None,
                               **(presets or {}).get(n, {}))
    else:
        models, rows = ML.tuned(names, train, features=FR.FEATURES, **tuning)
    for n, model in models.items():
        draft.model(n, model, contract)
    draft.mapping(TREND, FR.trend_mapping(spark, d), TREND, f"{TREND}_encode")
    draft.note("train_mean", train.agg(F.avg("target")).first()[0])
    draft.note("search", rows)
    return draft.commit()


_PUBLISHED: dict = {}


def published(spark: SparkSession, d: str, name: str) -> registry.Version:
    """The version that holds ``name`` for this application and state of the inputs."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), brand_of(d), target_of(d), name)
    stamp = inputs_stamp(spark, d, FR.MODEL_INPUTS)
    version, made_from = _PUBLISHED.get(key, (None, None))
    if version is None or made_from != stamp:
        version = publish(spark, d, shared_dir(spark, "registry"), [name])
        _PUBLISHED[key] = (version, stamp)
    return version


def all_published(spark: SparkSession, d: str, names=EV.MODELS) -> dict:
    """{name: version} of several models; those to be fitted are fitted side by side."""
    FR.model_table(spark, d)
    versions = ML.side_by_side(spark, lambda n: published(spark, d, n), names)
    return dict(zip(names, versions))


def predictions(version: registry.Version, name: str, rows: DataFrame) -> DataFrame:
    """key, date, target, prediction of rows that go through the model's contract."""
    model, contract = version.model(name), version.contract(name)
    given = contract.enforce(rows, keep=["key", "date", "target"])
    return model.transform(given).select("key", "date", "target", "prediction")


def forecast(spark: SparkSession, d: str, version: registry.Version, name: str, origin,
             months: int = HORIZON_MONTHS) -> DataFrame:
    """key, date, forecast of every active store for the ``months`` months after the origin.

    History, covariates and keys come from the run's model table; the model, its feature
    contract and the codes of trend labels from the version.
    """
    table = FR.model_table(spark, d)
    model, contract = version.model(name), version.contract(name)
    state = ["key", "_origin", "_mean", "_covs", "tail", "_n", "_ema", "_ros", "_season", "preds"]

    def score(x: DataFrame) -> DataFrame:
        return model.transform(contract.enforce(x, keep=state))

    # A covariate that the table lacks is left to the contract, which fills it.
    ahead = [c for c in contract.names if c not in FR.FROM_TARGET and c in table.columns]
    steps = [c for c in contract.names if c in FR.FROM_TARGET]
    return RC.recursive_forecast_scorer(
        table, months, score, [*steps, *ahead], F.lit(version.note("train_mean")),
        origin=origin, keys=table, covariate_cols=ahead,
        covariates=RC.covariates_by_step(table, ahead, origin, months),
        codes={TREND: version.codes(TREND)}, season="all")


def train_origin():
    return F.trunc(F.lit(TRAIN_END).cast("date"), "MM")


def wide_forecasts(spark: SparkSession, d: str, versions: dict, origin,
                   months: int = HORIZON_MONTHS) -> DataFrame:
    """All models' forecasts side by side, with the actuals where there are any (#125-126)."""
    wide = None
    for name, version in versions.items():
        fc = forecast(spark, d, version, name, origin, months).withColumnRenamed(
            "forecast", f"forecast_{name}")
        wide = fc if wide is None else wide.join(fc, ["key", "date"])
    actual = FR.target_panel(spark, d).select("key", "date",
                                              F.col("target").cast("double").alias("target"))
    return wide.join(actual, ["key", "date"], "left")
