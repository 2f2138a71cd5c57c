"""Every registered query with a DuckDB oracle matches it (names, types, rows, values)."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import canon, duck, rows_of

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module", autouse=True)
def small_models():
    """The facts of the model queries hold for any size; the reference's sizes take minutes."""
    from pyspark.ml.tuning import ParamGridBuilder

    from tidemark.operators import ml as ML
    patch = pytest.MonkeyPatch()
    patch.setattr(ML, "PRESETS", {
        "random_forest": dict(numTrees=5, maxDepth=5), "xgboost": dict(maxIter=4, maxDepth=3),
        "lgbm": dict(maxIter=4, maxDepth=2)})
    patch.setattr(ML, "search_space", lambda name, est: (
        ParamGridBuilder().addGrid(est.maxDepth, [1, 2, 3, 4])
        .addGrid(est.minInstancesPerNode, [1, 2, 3]).addGrid(est.numTrees, [2]).build()))
    yield
    patch.undo()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    dtypes = {d[0]: str(d[1]) for d in cur.description}
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    for c, t in sdf.dtypes:
        assert canon(t) == canon(dtypes[c]), (c, t, dtypes[c])
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"key", "date", "target", "Lag12_y", "MA6_y", "STD6_y", "EMA6_y"} <= set(df.columns)
