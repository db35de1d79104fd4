"""Salted group counts, bucketed quotas, threshold places, inputs replaced at one path."""

import shutil
import tempfile

import numpy as np
import pyarrow.parquet as pq
import pytest

from pyspark.sql import functions as F

from tabrix.operators import groupstats as G
from tabrix.operators import metrics as V
from tabrix.operators import sampling as S


@pytest.fixture
def small_tasks(spark):
    spark.conf.set("spark.tabrix.rowsPerTask", "100")
    yield
    spark.conf.unset("spark.tabrix.rowsPerTask")


def test_group_count_of_hot_keys_is_salted(spark, small_tasks):
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 == 3, None).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(
            F.lit("k"), F.col("id"))).alias("key"), F.lit(1).alias("x"))
    got = G.add_group_count(df, "key")
    plain = df.groupBy("key").agg(F.count("id").alias("user_count")).where("key is not null")
    want = df.join(plain, "key", "left").select(*df.columns, "user_count")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0
    assert got.count() == 3000
    assert "_tbx_salt" in got._jdf.queryExecution().optimizedPlan().toString()
    few = G.add_group_count(df.where("key <> 'hot' or key is null"), "key")
    assert "_tbx_salt" not in few._jdf.queryExecution().optimizedPlan().toString()


def test_quota_equals_plain_window(spark):
    counts = spark.createDataFrame([(None, 7), *[(i, 1 + i * 7 % 23) for i in range(300)]],
                                   "y int, n long")
    got = S.stratified_quota(counts, "y", 0.2)
    n = {r["y"]: r["n"] for r in counts.collect()}
    total = sum(n.values())
    hold = -(-total // 5)
    share = {y: c * hold / total for y, c in n.items()}
    left = hold - sum(int(s) for s in share.values())
    order = sorted(share, key=lambda y: (-(share[y] - int(share[y])), y is None, y or 0))
    want = {y: int(share[y]) + (i < left) for i, y in enumerate(order)}
    assert {r["_tbx_y"]: r["_tbx_q"] for r in got.collect()} == want
    assert sum(want.values()) == hold


@pytest.mark.parametrize("ts", [V.threshold_grid(), [0.1, 0.2, 0.9], [0.5], [0.2, 0.3],
                                [i / 1000 for i in range(1000)]])
def test_place_among_thresholds(spark, ts):
    rnd = np.random.default_rng(4)
    near = np.concatenate((np.nextafter(ts, 2), np.nextafter(ts, -2), ts, rnd.random(300),
                           [-1.0, 0.0, 1.0, 5.0, float("inf"), float("-inf")]))
    df = spark.createDataFrame([(float(v),) for v in near] + [(float("nan"),)], "p double")
    got = df.select("p", V._thresholds_below(F.col("p"), ts).alias("k")).collect()
    for r in got:
        want = len(ts) if np.isnan(r["p"]) else sum(t < r["p"] for t in ts)
        assert r["k"] == want, r


def test_replaced_inputs_are_seen(spark):
    from tabrix.sources.fixture import campaign
    d = tempfile.mkdtemp(prefix="tbx-stale-")
    for t in ("orders", "customer", "nation", "region", "lineitem"):
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", f"{d}/{t}.parquet")
    whole = campaign(spark, d).count()
    orders = pq.read_table("/root/testdata/sf0.001/orders.parquet")
    kept = orders.num_rows // 2
    pq.write_table(orders.slice(0, kept), f"{d}/orders.parquet")
    assert 0 < kept < whole and campaign(spark, d).count() == kept
