"""The reference's three entry points as Spark jobs (survey §3).

* :func:`feature_build`   — panel, temporal, calendar, store, marketing and promo features
* :func:`master_table`    — the assembled feature store
* :func:`train_forecast`  — fit every model, forecast recursively, pick champions, report
* :func:`inference`       — load saved models, forecast from the latest actuals, report

A run has a target and a brand: the panel holds that brand's sales only, and the target is
its units, sales amount or transactions.  Outputs are Parquet under
``out/<table>/target=…/brand=…/cutoff_month=…/train_end=…`` (the reference's folder layout
as partition columns, so later reads prune); models, mappings and feature lists are
versions of the same scope in the registry ``out/registry``.  ``out`` must be a folder
every executor can reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import evaluate as EV
from tidemark.plans import fragments as FR
from tidemark.plans import models as M
from tidemark.plans import queries as Q
from tidemark.plans.common import Run
from tidemark.plans.params import HORIZON_MONTHS, TRAIN_END
from tidemark.sources import registry
from tidemark.sources.io import write_checked

LAYOUT = ("target", "brand", "cutoff_month", "train_end")


def _registry(out: str) -> str:
    return f"{out.rstrip('/')}/registry"


def _write(df: DataFrame, out: str, name: str, scope: registry.Scope) -> str:
    """Write ``df`` under the layout; data columns named like a layout column get ``_value``.

    An empty result raises (#10): a run without rows is an error of its inputs.
    """
    clash = {c: f"{c}_value" for c in LAYOUT if c in df.columns}
    tagged = df.withColumnsRenamed(clash).withColumns({
        c: F.lit(getattr(scope, c)) for c in LAYOUT})
    return write_checked(tagged, f"{out.rstrip('/')}/{name}", list(LAYOUT), name)


def feature_build(spark: SparkSession, sf_dir: str, out: str, target: str = "units",
                  brand: str = "all") -> dict[str, str]:
    """Entry point A: every feature table of the feature-engineering stage."""
    run = Run(sf_dir, brand, target)
    tables = {
        "panel": FR.panel(spark, run),
        "temporal": FR.flagship(spark, run),
        "derivatives": FR.WN.derivatives(FR.target_panel(spark, run)),
        "calendar": FR.CA.calendar_monthly(FR.cal(spark, run, "A"), "A"),
        "stores": FR.stores_binned(spark, run),
        "marketing": Q.q_sply_marketing(spark, run),
        "promotions": FR.sply_promo(spark, run),
    }
    scope = M.scope_of(spark, run)
    return {n: _write(df, out, n, scope) for n, df in tables.items()}


def master_table(spark: SparkSession, sf_dir: str, out: str, target: str = "units",
                 brand: str = "all") -> str:
    """Entry point B: the assembled feature store."""
    run = Run(sf_dir, brand, target)
    return _write(FR.master_table(spark, run), out, "master_table", M.scope_of(spark, run))


def train_forecast(spark: SparkSession, sf_dir: str, out: str, target: str = "units",
                   brand: str = "all", tuning: dict | None = None,
                   presets: dict | None = None) -> dict[str, str]:
    """Entry point C: fit or tune every candidate on the master table's features, commit them
    to the registry, recurse from the train end, select champions, report."""
    run = Run(sf_dir, brand, target)
    version = M.publish(spark, run, _registry(out), EV.MODELS, tuning, presets)
    from tidemark.session import checkpoint
    forecasts = checkpoint(M.wide_forecasts(spark, run, dict.fromkeys(EV.MODELS, version),
                                            M.train_origin()))
    scored = EV.scored(EV.row_ape(forecasts))
    champions = EV.champion_store(scored)
    applied = EV.apply_store_champion(scored, champions)
    tables = {"forecasts": forecasts, "champions": champions, "champion_mix": applied,
              "metrics": EV.metrics(scored)}
    return {n: _write(df, out, n, version.scope) for n, df in tables.items()}


def inference(spark: SparkSession, sf_dir: str, out: str, months: int = HORIZON_MONTHS,
              target: str = "units", brand: str = "all") -> dict[str, str]:
    """Batch inference: load saved models, forecast from the latest actuals, report.

    Models, feature lists and the trend mapping are those of the registry's latest version
    for this target, brand, cutoff and train end; the store → champion mapping comes from
    ``out/champions``.  Forecasts start after the last month of the panel, for all stores.
    """
    run = Run(sf_dir, brand, target)
    scope = M.scope_of(spark, run)
    version = registry.latest(spark, _registry(out), scope)
    if version is None:
        raise LookupError(f"no models for {scope} in {_registry(out)}")
    wide = M.wide_forecasts(spark, run, dict.fromkeys(EV.MODELS, version),
                            FR.last_month(spark, run), months).drop("target")
    champs = (spark.read.parquet(f"{out.rstrip('/')}/champions")
              .filter((F.col("target") == target) & (F.col("brand") == brand)
                      & (F.col("cutoff_month") == scope.cutoff_month)
                      & (F.col("train_end") == TRAIN_END))
              .select("key", "best_model_store"))
    pick = F.lit(None).cast("double")
    for m in reversed(EV.MODELS):
        pick = F.when(F.col("best_model_store") == m, F.col(f"forecast_{m}")).otherwise(pick)
    report = (wide.join(champs, "key", "left")
              .select("date", F.col("key").cast("bigint").alias("store"),
                      F.lit(brand).alias("brand_name"),
                      F.coalesce("best_model_store", F.lit(EV.MODELS[0])).alias("model"),
                      F.bround(F.coalesce(pick, F.col(f"forecast_{EV.MODELS[0]}")), 0)
                      .cast("bigint").alias("forecasted_units"),
                      F.lit("Monthly").alias("frequency")))
    return {"future_forecasts": _write(wide, out, "future_forecasts", scope),
            "report": _write(report, out, "report", scope)}
