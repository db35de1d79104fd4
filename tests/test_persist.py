"""Fitted state saved and loaded gives equal output."""

from pyspark.sql import functions as F

from tabrix.functions.scalar import WidthCut
from tabrix.operators import encoders as enc
from tabrix.operators import models as G
from tabrix.operators.persist import load, save


def rows(spark):
    return spark.range(120).select(
        "id", F.concat(F.lit("k"), F.col("id") % 5).alias("a"),
        F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("b"),
        (F.col("id") % 11).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))


def same(p, q):
    assert p.columns == q.columns
    assert sorted(map(str, p.collect())) == sorted(map(str, q.collect()))


def test_encoders(spark, tmp_path):
    df = rows(spark)
    other = spark.newSession()
    new = df.withColumn("a", F.when(F.col("id") < 9, "new").otherwise(F.col("a")))
    for i, fitted in enumerate((enc.OrdinalEncoder(["a", "b"]).fit(df),
                                enc.EncoderSet(["a", "b"], "y").fit(df))):
        save(fitted, str(tmp_path / f"e{i}"), spark)
        back = load(other, str(tmp_path / f"e{i}"))
        same(fitted.transform(new), back.transform(new))
    target = enc.TargetEncoder(["a", "b"], "y", 10).fit(df)
    save(target, str(tmp_path / "t"), spark)
    same(enc.target_transform(target, new, ["a", "b"]),
         enc.target_transform(load(other, str(tmp_path / "t")), new, ["a", "b"]))


def test_cuts_levels_and_medians(spark, tmp_path):
    df = rows(spark)
    cut = WidthCut(4).fit(df, "x")
    save(cut, str(tmp_path / "c"), spark)
    back = load(spark, str(tmp_path / "c"))
    same(df.select(cut.label("x").alias("l")), df.select(back.label("x").alias("l")))
    levels = enc.OneHotEncoder(["a", "b"]).fit(df)
    save(levels, str(tmp_path / "l"), spark)
    assert load(spark, str(tmp_path / "l")) == levels
    med = enc.MedianImputer(["x"]).fit(df)
    save(med, str(tmp_path / "m"), spark)
    assert load(spark, str(tmp_path / "m")) == med


def test_models(spark, tmp_path):
    df = rows(spark).withColumn("a", (F.col("id") % 5).cast("int"))
    cfg = G.TreeConfig(max_iter=2, num_trees=2, max_depth=3, min_instances=1)
    mllib = cfg.with_params(learner="mllib")
    for name, fit, cfg_, cats in (("g", G.fit_gbt, cfg, {"a": 5}), ("r", G.fit_forest, cfg, None),
                                  ("m", G.fit_gbt, mllib, {"a": 5}),
                                  ("f", G.fit_forest, mllib, {"a": 5})):
        m = fit(df, ["a", "x"], cfg_, categorical=cats)
        save(m, str(tmp_path / name), spark)
        same(G.score(m, df), G.score(load(spark, str(tmp_path / name)), df))
