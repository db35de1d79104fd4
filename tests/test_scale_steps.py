"""Steps shared by feature tables: same results as the plain form, without its cost."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabrix.operators import sampling as S
from tabrix.operators.ranking import exact_rank
from tabrix.plans.common import round_doubles


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("y", [None, "y", "s"])
@pytest.mark.parametrize("frac", [0.0, 0.1, 0.2, 0.333, 1.0])
def test_holdout_moves_no_rows(spark, y, frac, monkeypatch):
    monkeypatch.setattr(S, "CUT_ROWS", 3)  # several rounds of digits
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 1999 != 0, F.col("id")).alias("id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 7 == 0).cast("int")).alias("y"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("s"))
    if y is None:
        df = df.where("id is not null")
    got = S.holdout(df, frac, 9, y=y)
    want = S._ranked_holdout(df, frac, 9, "id", y, "is_holdout", "unique")
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert "Exchange" not in plan(got) and "Window" not in plan(got)


def test_holdout_with_repeated_ids_keeps_its_size(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("id"))
    assert S.holdout(df, 0.2).where("is_holdout").count() == 200


def test_holdout_of_many_classes(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 50).alias("y"))
    assert S.holdout(df, 0.2, y="y").where("is_holdout").count() == 200


def test_rounding_equals_sparks(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([
        rng.normal(size=3000) * 10.0 ** rng.integers(-9, 9, 3000),
        rng.integers(-10**7, 10**7, 3000) / 1e6 + 5e-7,  # ties
        np.nextafter(rng.integers(-10**7, 10**7, 3000) / 1e6 + 5e-7, 0),
        [0.0, -0.0, -1e-9, 1e300, -1e300, np.inf, -np.inf, np.nan, 123456.4999995, 1e6, 999999.9999999]])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "x double")
    got = round_doubles(df.select("x")).collect()
    want = df.select(F.round("x", 6)).collect()
    assert [repr(r[0]) for r in got] == [repr(r[0]) for r in want]


def test_rounding_a_wide_table_is_compiled(spark):
    """The JVM does not compile methods of more than 8,000 bytes."""
    df = spark.range(0, 10).select("id", *[F.sin(F.col("id") + i).alias(f"c{i}") for i in range(45)])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = round_doubles(df)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_only_groups_across_slices_have_offsets(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, 7).when(F.col("id") < 1040, None).otherwise(F.col("id") % 400)
        .alias("g"), "id", (F.col("id") * 37 % 101).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = exact_rank(df, ["v", "id"], by=["g"], name="r", num_buckets=16, lag=["v"])
        assert "SortMergeJoin" not in plan(got)
        w = Window.partitionBy("g").orderBy("v", "id")
        want = df.select("*", F.row_number().over(w).cast("long").alias("r"),
                         F.lag("v").over(w).alias("prev_v"))
        assert sorted(got.select(want.columns).collect(), key=str) == sorted(
            want.collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
