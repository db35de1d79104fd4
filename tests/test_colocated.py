"""Bucketed score tables: no exchange, and every key checked in the same pass."""

import pytest
from pyspark.sql import functions as F

from tabrix.operators import colocated as C
from tabrix.operators import ensemble as EN
from tabrix.operators.joins import attach_scores


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def long_scores(spark):
    rows = spark.range(300).crossJoin(spark.createDataFrame(
        [("a", 0), ("a", 1), ("b", 0), ("b", 1)], "model string, fold int"))
    return rows.select("id", "model", "fold", (F.pmod(F.hash("id", "model", "fold"), F.lit(997))
                                               / 997).alias("p"))


def test_blend_and_means_without_exchange(spark, long_scores):
    table = C.bucketed(long_scores)
    got = C.blend_colocated(table, {"a": 0.7, "b": 0.3}, each=2)
    assert "Exchange" not in _plan(got)
    means = EN.mean_scores(table, keep=["model"])
    assert "Exchange" not in _plan(means)
    want = EN.blend({m: EN.mean_scores(long_scores.where(F.col("model") == m)) for m in "ab"},
                    {"a": 0.7, "b": 0.3})
    a, b = ({r["id"]: r["p"] for r in d.collect()} for d in (got, want))
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-12 for i in a)


@pytest.mark.parametrize("change", ["missing", "extra", "null_score", "null_id", "stranger"])
def test_blend_raises_unless_complete(spark, long_scores, change):
    one = long_scores.where("id = 7 and model = 'b' and fold = 0")
    rest = long_scores.where("not (id = 7 and model = 'b' and fold = 0)")
    bad = {"missing": rest, "extra": long_scores.unionByName(one),
           "null_score": rest.unionByName(one.withColumn("p", F.lit(None).cast("double"))),
           "null_id": long_scores.unionByName(one.withColumn("id", F.lit(None).cast("long"))),
           "stranger": long_scores.unionByName(one.withColumn("model", F.lit("c")))}[change]
    with pytest.raises(Exception, match="blend: scores are missing"):
        C.blend_colocated(C.bucketed(bad), {"a": 0.7, "b": 0.3}, each=2).collect()


def test_attach_without_exchange(spark):
    rows = spark.range(500).select("id", F.lit("x").alias("a.b"), F.lit(1).alias("_tbx_k"))
    scores = rows.select("id", (F.col("id") / 500).alias("p"))
    got = C.attach_colocated(C.bucketed(rows), C.bucketed(scores))
    assert "Exchange" not in _plan(got)
    want = attach_scores(rows, scores)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    assert got.select("id").count() == 500


@pytest.mark.parametrize("ids, scored", [([1, 1, 2, 3], [1, 1, 5, 6]), ([1, 2], [1]), ([1], [1, 2]),
                                         ([1, 1], [1]), ([1], [1, 1]), ([1, None], [1, None])])
def test_attach_raises_unless_one_to_one(spark, ids, scored):
    a = spark.createDataFrame([(i, "x") for i in ids], "id long, v string")
    b = spark.createDataFrame([(i, 0.5) for i in scored], "id long, p double")
    with pytest.raises(Exception, match="not one row and one score"):
        # the check holds even if only a count is asked for
        C.attach_colocated(C.bucketed(a), C.bucketed(b)).count()


def test_empty_tables(spark, long_scores):
    none = C.bucketed(long_scores.where("id < 0"))
    assert C.blend_colocated(none, {"a": 1.0}).count() == 0
    assert C.attach_colocated(none.select("id", "fold"), none.select("id", "p")).count() == 0
