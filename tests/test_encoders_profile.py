"""Hand-checked encoders, profile and series cleaning."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode as EN
from tidemark.operators import profile as PR
from tidemark.operators import series as SE


def test_target_encoding_formula(spark):
    rows = [("one", 10.0)] + [("few", v) for v in (1.0, 2.0, 3.0)] + \
           [("many", float(v)) for v in range(25)]
    df = spark.createDataFrame(rows, "c string, target double")
    got = {r["c"]: r["c_encode"] for r in EN.target_encoding_table(df, "c").collect()}
    prior = sum(v for _, v in rows) / len(rows)

    def enc(vals):
        n, m = len(vals), sum(vals) / len(vals)
        s = 1 / (1 + math.exp(-(n - 20) / 10))
        return prior if n == 1 else prior * (1 - s) + m * s

    assert got["one"] == pytest.approx(prior)
    assert got["few"] == pytest.approx(enc([1.0, 2.0, 3.0]))
    assert got["many"] == pytest.approx(enc([float(v) for v in range(25)]))


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    got = {r["column_name"]: (r["nulls"], r["rows"], r["columns"])
           for r in PR.profile(df, date_col=None).collect()}
    assert got == {"a": (1, 3, 2), "b": (2, 3, 2)}


def test_one_hot_drops_first_level(spark):
    df = spark.createDataFrame([("retail",), ("ecommerce",), ("outlet",)], "channel string")
    out = EN.one_hot(df, "channel", ["retail", "ecommerce", "outlet"])
    assert sorted(out.columns) == ["channel_outlet", "channel_retail"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, 0), (0, 1), (1, 0)]


def test_clean_month_series(spark):
    df = spark.createDataFrame([(2024, "January", "1,234 "), (2024, "FEB", "56"),
                                (2024, "Mar", "n/a")], "year int, month string, tourists string")
    got = {r["month"]: (r["date"].isoformat(), r["tourists"])
           for r in SE.clean_month_series(df).collect()}
    assert got == {1: ("2024-01-01", 1234), 2: ("2024-02-01", 56), 3: ("2024-03-01", None)}


def test_value_counts_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    vc = {(r["column_name"], r["value"]): r["count"] for r in PR.value_counts(df, ["k"]).collect()}
    assert vc == {("k", "a"): 2, ("k", "b"): 1}
    dup = PR.duplicates(df).collect()
    assert [(r["k"], r["v"], r["n"]) for r in dup] == [("a", 1, 2)]
    first = PR.keep_first(df.withColumn("o", F.lit(0)), ["k"], ["v"]).collect()
    assert sorted((r["k"], r["v"]) for r in first) == [("a", 1), ("b", 2)]


def test_corr_matrix_is_pairwise_complete(spark):
    import numpy as np
    import pandas as pd

    from tidemark.operators import profile as PR
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 5)) * [1, 1e6, 1, 1, 1] + [0, 1e9, 0, 0, 0]
    v[:, 2] = 0.5 * v[:, 0] + v[:, 2]
    pdf = pd.DataFrame(v, columns=list("abcde"))
    pdf.loc[rng.random(400) < 0.3, "a"] = np.nan
    pdf.loc[rng.random(400) < 0.3, "c"] = np.nan
    pdf["constant"] = 7.0
    pdf["none"] = np.nan
    pdf["a b"] = pdf["d"] * 2
    rows = [tuple(None if x != x else float(x) for x in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in pdf.columns))
    want = pdf.corr()
    got = PR.corr_matrix(df.repartition(7), pdf.columns).collect()
    assert len(got) == 8 * 7 // 2
    for r in got:
        w = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["corr"] is None) if w != w else abs(r["corr"] - w) < 1e-9
    assert all(r["corr"] is None for r in PR.corr_matrix(df.limit(0), ["a", "b"]).collect())


def test_groups_of_correlations_share_one_pass(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(rng.random(), rng.random() if i % 5 else None, float(i), 3.0) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, `b c` double, d double, e double")
    groups = {"all": ["a", "b c", "d", "e"], "back": ["d", "b c"], "one": ["a"]}
    passes, whole = [], PR.corr_matrix
    monkeypatch.setattr(PR, "corr_matrix", lambda *a: passes.append(a) or whole(*a))
    got = {(r["grp"], r["feature_a"], r["feature_b"]): r["corr"]
           for r in PR.corr_groups(df, groups).collect()}
    assert len(passes) == 1
    alone = {(g, r["feature_a"], r["feature_b"]): r["corr"]
             for g, cols in groups.items() for r in whole(df, cols).collect()}
    assert got.keys() == alone.keys() and len(got) == 7
    for k, v in alone.items():
        assert got[k] == (v if v is None else pytest.approx(v, abs=1e-12)), k
