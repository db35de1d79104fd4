"""Scalar features and encoders: edge cases from the fixture notes."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrix.functions import scalar as M
from tabrix.operators import encoders as enc
from tabrix.operators import groupstats as G
from tabrix.operators import schema as R


def test_fixed_cut_edges(spark):
    df = spark.createDataFrame([(0,), (25,), (26,), (100,), (101,)], "age int")
    got = [r[0] for r in df.select(M.fixed_cut("age")).collect()]
    assert got == [None, "0-25", "26-35", "65+", None]


def test_width_cut_labels_and_constant(spark):
    cut = M.WidthCut(16).fit_range(18, 95)
    assert cut.labels[0] == "(17.923, 22.812]" and cut.labels[-1] == "(90.188, 95.0]"
    df = spark.createDataFrame([(18,), (95,), (22,), (23,)], "age int")
    assert [r[0] for r in df.select(cut.index("age")).collect()] == [0, 15, 0, 1]
    const = M.WidthCut(5).fit_range(7, 7)
    df2 = spark.createDataFrame([(7,)], "age int")
    assert df2.select(const.index("age")).first()[0] == 2  # middle bin


def test_width_cut_matches_pandas():
    import numpy as np
    ages = np.array([18, 30, 41, 57, 95, 64, 22])
    cut = M.WidthCut(16).fit_range(ages.min(), ages.max())
    ref = pd.cut(pd.Series(ages), bins=16).astype(str).tolist()
    mine = [cut.labels[sum(a > e for e in cut.edges) - 1] for a in ages]
    assert ref == mine


def test_month_and_ratios(spark):
    df = spark.createDataFrame([("Jan", 5, 0), ("xyz", 3, -1), (None, None, 2)],
                               "month string, duration int, day int")
    r = df.select(M.month_number("month").alias("m"),
                  M.ratio_plus_one("duration", "day").alias("q")).collect()
    assert r[0]["m"] == 1 and r[1]["m"] is None and r[2]["m"] is None
    assert r[0]["q"] == 5.0 and r[1]["q"] is None and r[2]["q"] is None  # 0 denominator -> NULL


def test_null_and_unseen_keys(spark):
    tr = spark.createDataFrame([(1, "a", 1), (2, "a", 0), (3, "b", 1), (4, None, 1)],
                               "id long, k string, y int")
    te = spark.createDataFrame([(5, "a"), (6, "c"), (7, None)], "id long, k string")
    te_fit = enc.TargetEncoder(["k"], "y", 10).fit(tr)
    out = {r["id"]: r["k_target_enc"] for r in enc.target_transform(te_fit, te, ["k"]).collect()}
    g = 3 / 4
    a = (0.5 * 2 + g * 10) / 12
    b = (1.0 * 1 + g * 10) / 11
    assert math.isclose(out[5], a) and math.isclose(out[6], (a + b) / 2)
    assert math.isclose(out[7], (a + b) / 2)  # NULL key -> default as well
    oe = enc.OrdinalEncoder(["k"], null_as="nan").fit(tr)
    codes = {r["id"]: r["k"] for r in oe.transform(te).collect()}
    assert codes == {5: 0, 6: -1, 7: 2}  # levels: a, b, nan
    oe2 = enc.OrdinalEncoder(["k"], null_as=None).fit(tr)
    codes2 = {r["id"]: r["k"] for r in oe2.transform(te).collect()}
    assert codes2 == {5: 0, 6: -1, 7: None}
    with pytest.raises(Exception):
        enc.OrdinalEncoder(["k"], on_unseen="error").fit(tr).transform(te).collect()


def test_group_means_null_key(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, None, 9.0)],
                               "id long, k string, x double")
    out = {r["id"]: r["x_mean_by_k"] for r in G.add_group_means(df, ["k"], ["x"]).collect()}
    assert out == {1: 3.0, 2: 3.0, 3: None}


def test_frequency_with_empty_bins(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    f = enc.FrequencyEncoder(["g"], levels={"g": ["a", "b", "z"]}).fit(df)
    assert f.defaults["g"]["freq"] == 0.0  # empty level kept at 0 -> min is 0


def test_medians_exact(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, None), (10.0, 3), (4.0, 4)], "a double, b int")
    med = {r["feature"]: r["median"] for r in G.medians(df, ["a", "b"]).collect()}
    assert med == {"a": 3.0, "b": 3.0}


def test_sanitize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `a_b` int")
    with pytest.raises(ValueError):
        R.sanitize_columns(df)
    ok = R.sanitize_columns(spark.createDataFrame([(1,)], "`(x, y]` int"))
    assert ok.columns == ["x_y"]


def test_align_columns(spark):
    a = spark.createDataFrame([(1, 0, 1, 1)], "id long, c_x int, c_y int, y int")
    b = spark.createDataFrame([(2, 1, 5)], "id long, c_x int, c_z int")
    out = R.align_columns(b, a)
    assert out.columns == ["id", "c_x", "c_y"] and out.first()["c_y"] == 0


def test_broadcast_bound_is_respected(spark):
    from tabrix.operators.joins import sized_broadcast
    df = spark.range(10)
    spark.conf.set("spark.tabrix.broadcastMaxRows", "5")
    try:
        big = sized_broadcast(df, 10)
        small = sized_broadcast(df, 3)
    finally:
        spark.conf.unset("spark.tabrix.broadcastMaxRows")
    j1 = spark.range(100).join(big, "id")
    j2 = spark.range(100).join(small, "id")
    assert "broadcast" not in j1._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in j2._jdf.queryExecution().logical().toString().lower()


def test_one_hot_vectors_match_wide(spark):
    tr = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c"), (4, "b")], "id long, k string")
    te = spark.createDataFrame([(5, "a"), (6, "c"), (7, "zz"), (8, None)], "id long, k string")
    ordf = enc.OrdinalEncoder(["k"], null_as=None).fit(tr)
    v = {r["id"]: r["k_vec"].toArray().tolist() for r in enc.one_hot_vectors(ordf, te).collect()}
    wide = enc.one_hot_transform(te, enc.OneHotEncoder(["k"]).fit(tr))
    w = {r["id"]: [r["k_b"], r["k_c"]] for r in wide.collect()}
    assert v == {k: [float(x) for x in w[k]] for k in w}
    assert v[5] == [0.0, 0.0] and v[6] == [0.0, 1.0] and v[7] == [0.0, 0.0] and v[8] == [0.0, 0.0]
