"""Bin edges of boosted trees: quantiles from one scan of distinct values."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabrix.operators import boosting as B


def test_bin_edges_are_exact_quantiles(spark):
    df = spark.range(0, 400_000).select(
        (F.xxhash64("id") % 10_000 / 7).alias("a"),
        F.when(F.col("id") % 3 == 0, float("nan")).when(F.col("id") % 3 == 1, F.col("id") % 10)
        .alias("b"), F.lit(None).cast("double").alias("c"))
    a, b, c = B.bin_edges(df, ["a", "b", "c"], {}, 64)
    v = np.sort(df.select("a").toPandas()["a"].to_numpy())
    rank = np.ceil(np.arange(1, 63) / 63 * len(v)).astype(int)
    assert np.array_equal(a, np.unique(v[rank - 1]))
    assert np.array_equal(b, np.arange(10.0)) and not len(c)


def test_thinned_summaries_keep_ranks():
    rng = np.random.default_rng(1)
    v = rng.normal(size=300_000)
    parts = [B.thinned(B.merged([(np.sort(x), np.ones(len(x), np.int64))]), 4096)
             for x in np.split(v, 6)]
    s = B.merged(parts)
    share = np.arange(1, 63) / 63
    rank = np.searchsorted(np.sort(v), B.quantiles(s, share), "right") / len(v)
    assert s[1].sum() == len(v) and np.abs(rank - share).max() < 2 / 4096
