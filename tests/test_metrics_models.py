"""Metric edge cases, MLlib cross-check, model invariants."""

import math

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tabrix.operators import metrics as V
from tabrix.operators import models as G
from tabrix.operators import explain as X
from tabrix.operators import ensemble as EN


def test_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    assert math.isclose(V.auc(df).first()["auc"], (1 + 0.5 + 1 + 1) / 4)
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert V.auc(one).first()["auc"] is None
    tied = spark.createDataFrame([(1, 0.3), (0, 0.3), (0, 0.3)], "y int, p double")
    assert V.auc(tied).first()["auc"] == 0.5


def test_auc_matches_mllib(spark):
    df = spark.range(0, 3000).select((F.rand(1) < 0.3).cast("int").alias("y"),
                                     F.rand(2).alias("r"))
    df = df.select("y", F.round(F.col("r") * 0.5 + F.col("y") * 0.3, 4).alias("p"))
    mine = V.auc(df).first()["auc"]
    from pyspark.ml.functions import array_to_vector
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    ref = ev.evaluate(df.select(F.col("y").cast("double").alias("label"),
                                array_to_vector(F.array(1 - F.col("p"), F.col("p"))).alias("raw")))
    assert abs(mine - ref) < 1e-9


def test_threshold_default_when_all_zero(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.2)], "y int, p double")
    t = V.f1_by_threshold(df, V.threshold_grid(0.3, 0.8, 0.01))
    assert t.count() == 50
    assert V.best_threshold(t) == (0.5, 0.0)
    assert len(V.threshold_grid(0.3, 0.7, 0.01)) == 40


def test_class_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, y_pred int")
    rep = {r["label"]: r for r in V.class_report(df).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0
    assert math.isclose(rep["accuracy"]["f1"], 2 / 3)


def _fixture_frame(spark):
    from tests.conftest import SF_MID
    from tabrix.plans.q_models import f3_frames
    return f3_frames(spark, SF_MID)


def test_model_invariants(spark):
    trf, tef, feats = _fixture_frame(spark)
    cfg = G.TreeConfig(max_iter=8, max_depth=4)
    sc, ts = G.oof(trf, lambda d: G.fit_gbt(d, feats, cfg), k=3, seed=1, test=tef)
    pdf = sc.toPandas()
    assert pdf["id"].is_unique and len(pdf) == trf.count()
    assert pdf["p"].between(0, 1).all()
    assert V.auc(sc).first()["auc"] > 0.5
    avg = EN.mean_scores(ts)
    assert avg.count() == tef.count()
    fit = G.fit_gbt(trf, feats, cfg)
    c = X.contributions(fit, tef)
    d = c.select((F.col("bias") + F.aggregate("contrib", F.lit(0.0), lambda a, b: a + b)
                  - F.col("margin")).alias("d"))
    assert d.agg(F.max(F.abs("d"))).first()[0] < 1e-9
    imp = X.split_importance(fit, None).toPandas()
    assert imp["splits"].sum() > 0 and set(imp["feature"]) == set(feats)


def test_native_categories(spark):
    from tabrix.plans.q_models import cats
    trf, tef, feats = _fixture_frame(spark)
    ar = cats(trf)
    assert ar["month"] == 12 and ar["marital"] == 3
    for learner in ("mllib", "histogram"):
        cfg = G.TreeConfig(max_iter=6, max_depth=4, learner=learner)
        fit = G.fit_gbt(trf, feats, cfg, categorical=ar)
        if learner == "mllib":
            nodes = X.node_table(fit)
            assert nodes.where("numCategories >= 0 AND leftChild >= 0").count() > 0
        else:
            assert any((t.category >= 0).any() for t in fit.model.trees)
        c = X.contributions(fit, tef)
        d = c.select((F.col("bias") + F.aggregate("contrib", F.lit(0.0), lambda a, b: a + b)
                      - F.col("margin")).alias("d"))
        assert d.agg(F.max(F.abs("d"))).first()[0] < 1e-9


def test_score_algebra_conveniences(spark):
    a = spark.createDataFrame([(1, 0, 0.2), (1, 1, 0.4), (2, 0, 0.6), (2, 1, 0.8)],
                              "id long, fold int, p double")
    b = spark.createDataFrame([(1, 0, 0.0), (1, 1, 0.0), (2, 0, 1.0), (2, 1, 1.0)],
                              "id long, fold int, p double")
    got = {r["id"]: r["p"] for r in EN.seed_average([a, b]).collect()}
    assert math.isclose(got[1], 0.15) and math.isclose(got[2], 0.85)
    train = spark.createDataFrame([(10, 1.0, 1)], "id long, x double, y int")
    rows = spark.range(1, 41).select("id", F.col("id").cast("double").alias("x"))
    scores = rows.select("id", (F.col("x") / 40).alias("p"))
    aug = EN.pseudo_label(train, rows, scores, 0.05).toPandas()
    assert len(aug) == 5 and set(aug[aug["id"] != 10]["id"]) == {1, 2, 39, 40}
    assert aug.set_index("id").loc[40, "y"] == 1 and aug.set_index("id").loc[1, "y"] == 0
    df = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.7), (0, 0.75)], "y int, p double")
    t, f1, table = V.search_threshold(df)
    assert table.count() == 50 and 0.3 <= t < 0.8 and f1 > 0


def test_mllib_fits_take_tasks_of_bounded_rows(spark, monkeypatch):
    from tabrix.operators import models as G
    seen = []
    parted = G._parted
    monkeypatch.setattr(G, "FIT_ROWS", 100)
    monkeypatch.setattr(G, "_parted", lambda d: seen.append(parted(d)) or seen[-1])
    df = spark.range(950).coalesce(1).selectExpr("id", "cast(id % 3 = 0 as int) AS y",
                                                 "double(id % 7) AS a", "double(id % 5) AS b")
    G.fit_gbt(df, ["a", "b"], G.TreeConfig(max_iter=2, max_depth=2, learner="mllib"))
    G.fit_forest(df.repartition(20), ["a", "b"], G.TreeConfig(num_trees=2, max_depth=2,
                                                              learner="mllib"))
    assert [d.rdd.getNumPartitions() for d in seen] == [10, 20]
    assert [d.count() for d in seen] == [950, 950]
