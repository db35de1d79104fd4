"""Encoders of all folds from one scan equal separate fits on the other folds."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrix.operators import fold_encoders
from tabrix.operators.encoders import EncoderSet
from tabrix.operators.fold_encoders import NO_FOLD, FoldEncoders
from tabrix.operators.groupstats import grouped_means, medians

SCHEMA = "id long, a string, b string, x double, z double, y int, fold int"


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = []
    for i in range(600):
        a = "hot" if i % 3 == 0 else rnd.choice(["p", "q", "r", None])
        fold = None if i % 50 == 7 else rnd.randrange(4)
        b = "only2" if fold == 2 and i % 5 == 0 else rnd.choice(["u", "nan", "w"])
        data.append((i, a, b, None if i % 11 == 0 else rnd.gauss(0, 1e6),
                     float(rnd.randrange(5)) if i % 7 else None,
                     None if i % 13 == 0 else rnd.randrange(2), fold))
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def fitted(rows):
    return FoldEncoders(["a", "b"], targets=["x", "z"], numeric=["x", "z"]).fit(rows)


def _outside(rows, f):
    return rows.where(~F.coalesce("fold", F.lit(NO_FOLD)).eqNullSafe(F.lit(f)))


def _close(got, want):
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True),
                                  check_dtype=False, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("f", [NO_FOLD, 0, 1, 2, 3])
def test_equal_to_separate_fits(rows, fitted, f):
    part = _outside(rows, f)
    want = EncoderSet(["a", "b"]).fit(part)
    _close(fitted.encoder(f).transform(rows).orderBy("id").toPandas(),
           want.transform(rows).orderBy("id").toPandas())
    means = fitted.table.where(F.col("fold") == f).where("m1 is not null").select(
        "feature", "level", "m1", "m2").orderBy("feature", "level").toPandas()
    plain = grouped_means(part, ["a", "b"], ["x", "z"]).where("x is not null").toDF(
        "feature", "level", "m1", "m2").orderBy("feature", "level").toPandas()
    _close(means, plain)
    got = fitted.medians_table.where(F.col("fold") == f).select("feature", "median")
    _close(got.orderBy("feature").toPandas(),
           medians(part, ["x", "z"]).orderBy("feature").toPandas())


def test_out_of_fold_rows_take_their_folds_encoder(rows, fitted):
    got = fitted.out_of_fold(rows).orderBy("id").toPandas()
    assert len(got) == 600
    parts = []
    for f in fitted.folds:
        own = rows.where(F.coalesce("fold", F.lit(NO_FOLD)) == f)
        e = fitted.encoder(f).transform(fitted.impute(own, f), replace_with_code=False)
        parts.append(e.select("id", "x", "z", *[c + s for c in "ab" for s in (
            "_target_enc", "_freq", "_code")]).toPandas())
    want = pd.concat(parts).sort_values("id")
    _close(got[list(want.columns)], want)
    assert got.loc[got.b == "only2", "b_code"].eq(-1).all()  # held out with its only fold


def test_level_means_and_ratio(rows, fitted):
    got = {r["id"]: r for r in fitted.level_means(rows, 1).collect()}
    part = _outside(rows, 1).toPandas()
    mean = part.groupby("a").x.mean()
    r = got[3]
    assert r["x_mean_by_a"] == pytest.approx(mean["hot"], rel=1e-9)
    assert r["x_ratio_by_a"] == pytest.approx(r["x"] / (mean["hot"] + 1e-5), rel=1e-9)


def test_one_scan_of_the_rows(rows, monkeypatch):
    written = []
    real = fold_encoders.materialize
    hits = rows.sparkSession.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(i):
        hits.add(1)
        return i

    monkeypatch.setattr(fold_encoders, "materialize", lambda d: written.append(d) or real(d))
    counted = rows.select(seen("id").alias("id"), "a", "b", "x", "z", "y",
                          (seen("fold")).cast("int").alias("fold"))
    FoldEncoders(["a", "b"], targets=["x"], numeric=["z"]).fit(counted)
    assert hits.value == 600  # the fold is read once a row, the unused id never


def test_empty_and_odd_tables(spark, rows):
    empty = FoldEncoders(["a"], targets=["x"], numeric=["z"]).fit(rows.limit(0))
    assert empty.folds == [] and empty.out_of_fold(rows.limit(0)).count() == 0
    one = rows.where("fold = 0")  # a single fold: nothing outside it
    got = FoldEncoders(["a"], numeric=["z"]).fit(one).out_of_fold(one)
    assert got.where("a_target_enc is not null or a_code <> -1").count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, None, None, 0),
                                   (2, None, None, None, None, None, 1)], SCHEMA)
    out = FoldEncoders(["a"], targets=["x"], numeric=["z"]).fit(nulls).out_of_fold(nulls)
    assert [r["a_code"] for r in out.orderBy("id").collect()] == [0, 0]
    assert out.where("z is not null or a_freq is not null").count() == 0
    repeated = rows.unionByName(rows)
    assert FoldEncoders(["a"]).fit(repeated).out_of_fold(repeated).count() == 1200
