"""Boosted models of a small table: a task each, with the models that passes over blocks give."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrix.operators import boosting as B
from tests.test_boosting import FEATURES, frame, plain_auc, same, table

CONFIGS = [B.BoostConfig(rounds=25, leaves=12, learning_rate=0.4, patience=5),
           B.BoostConfig(rounds=6, leaves=0, max_depth=4, row_fraction=0.7, column_fraction=0.6),
           B.BoostConfig(rounds=25, l1=0.3, l2=1.0, learning_rate=0.4, patience=4,
                         metric="logloss"),
           B.BoostConfig(rounds=12, patience=3, metric="rmse", min_rows=5)]


def fit(df, edges):
    roles = [F.when(F.col("fold") == k, 2).otherwise(1) for k in (0, 1)]
    return B.fit_many(df, FEATURES, [B.Job(c, i % 2, i == 2) for i, c in enumerate(CONFIGS)], roles,
                      weight="w", categorical={"k": 6}, edges=edges)


def test_a_task_for_each_model_gives_the_models_of_shared_passes(spark, monkeypatch):
    df = frame(spark, table(1500, seed=3))
    edges = B.bin_edges(df, FEATURES, {"k": 6}, 32)
    alone = fit(df, edges)
    monkeypatch.setattr(B, "ALONE_BYTES", 0)
    monkeypatch.setattr(B, "BLOCK_ROWS", 400)
    passes = fit(df, edges)
    monkeypatch.setattr(B, "FEW_ROWS", 0)  # joint bins
    joint = fit(df, edges)
    for a, b, c in zip(alone, passes, joint):
        assert same(a, b) and same(a, c) and len(a.history) == len(b.history) == len(c.history)
        assert np.allclose(a.history, b.history, atol=1e-12)
        assert np.allclose(a.history, c.history, atol=1e-12)
    assert any(len(a.trees) < c.rounds for a, c in zip(alone, CONFIGS))


def test_rounds_of_a_small_table_are_no_jobs_of_their_own(spark):
    df = frame(spark, table(600))
    sc = spark.sparkContext
    sc.setJobGroup("alone", "alone")
    try:
        models = B.fit_many(df, FEATURES, [B.Job(B.BoostConfig(rounds=40))], [F.lit(1)])
        jobs = sc.statusTracker().getJobIdsForGroup("alone")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(models[0].trees) == 40 and len(jobs) < 40


@pytest.mark.parametrize("slice_rows", [20, 1 << 18])
def test_auc_from_slices_of_the_margin(slice_rows, spark, monkeypatch):
    """Shared passes: the AUC of every round equals the one from all pairs, ties included."""
    rows = table(900, seed=5)
    df = frame(spark, rows)
    monkeypatch.setattr(B, "ALONE_BYTES", 0)
    monkeypatch.setattr(B, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(B, "BLOCK_ROWS", 200)
    cfg = B.BoostConfig(rounds=12, leaves=5, patience=30, learning_rate=0.5)
    m = B.fit_many(df, FEATURES, [B.Job(cfg)], [F.when(F.col("fold") == 0, 2).otherwise(1)],
                   categorical={"k": 6})[0]
    y = np.array([r[5] for r in rows if r[7] == 0])
    x = m.bins([np.array([r[i] for r in rows if r[7] == 0], float) for i in (1, 2, 3, 4)])
    margin = np.full(len(y), m.init)
    for t, auc in zip(m.trees, m.history):
        t.add_to(margin, x)
        assert abs(plain_auc(y, margin) - auc) < 1e-12
