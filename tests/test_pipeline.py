"""The three entry points run end to end, per brand, and write the partitioned layout."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans import pipeline as P
from tidemark.sources.io import shared_dir
from tests.conftest import SF_SMALL

SMALL = {"random_forest": dict(numTrees=4, maxDepth=4), "xgboost": dict(maxIter=3, maxDepth=3),
         "lgbm": dict(maxIter=3)}


def test_pipeline_end_to_end(spark):
    out = shared_dir(spark, "pipeline")
    written = P.feature_build(spark, SF_SMALL, out)
    assert set(written) == {"panel", "temporal", "derivatives", "calendar", "stores",
                            "marketing", "promotions"}
    P.feature_build(spark, SF_SMALL, out, target="sales", brand="Brand#1")
    panels = spark.read.parquet(f"{out}/panel").groupBy("brand", "target").agg(
        F.sum("units").alias("u")).collect()
    units = {(r["brand"], r["target"]): r["u"] for r in panels}
    assert units["all", "units"] > units["Brand#1", "sales"] > 0
    temporal = spark.read.parquet(f"{out}/temporal")
    by_target = {r["target"]: r["m"] for r in temporal.groupBy("target").agg(
        F.avg("target_value").alias("m")).collect()}
    assert by_target["sales"] > by_target["units"]
    P.master_table(spark, SF_SMALL, out)
    mt = spark.read.parquet(f"{out}/master_table")
    assert mt.filter(F.col("cutoff_month").isNotNull()).count() > 0

    with pytest.raises(LookupError):
        P.inference(spark, SF_SMALL, out, months=3)
    res = P.train_forecast(spark, SF_SMALL, out, presets=SMALL)
    champs = spark.read.parquet(res["champions"]).filter(F.col("target") == "units")
    assert champs.count() > 0
    assert {"best_model_store", "best_mape", "target_value"} <= set(champs.columns)
    stores = _active_store_count(spark)
    assert spark.read.parquet(res["forecasts"]).count() == 15 * stores
    inf = P.inference(spark, SF_SMALL, out, months=3)
    rep = spark.read.parquet(inf["report"])
    assert rep.count() == 3 * stores
    assert rep.filter(F.col("forecasted_units").isNull()).count() == 0


def _active_store_count(spark):
    from tidemark.plans.fragments import target_panel
    return target_panel(spark, SF_SMALL).select("key").distinct().count()
