"""Null ids, labels, scores and categories; dirty files; labels outside the grid."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.operators import encoders as enc
from tabrix.operators import ensemble as E
from tabrix.operators import joins as J
from tabrix.operators import metrics as V
from tabrix.operators import models as G
from tabrix.operators import sampling as S
from tabrix.operators import schema as R
from tabrix.sources.io import read_table


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(None if i % 5 == 0 else i, i % 3 if i % 7 else None, float(i)) for i in range(20)],
        "id long, y int, p double").cache()


def test_null_ids_stay_in_seeded_operators(rows):
    assert S.kfold(rows, 3).count() == 20
    assert S.holdout(rows, 0.2).count() == 20
    flagged = S.holdout(rows, 0.25, y="y")
    assert flagged.count() == 20 and flagged.where("is_holdout").count() == 5
    assert S.sample_n(rows, 100).count() == 20 and S.sample_n(rows, 7).count() == 7
    smallest = min(r["n"] for r in S.class_counts(rows, "y").collect())
    assert S.balance(rows).count() == smallest * 4
    train, test = S.carve_holdout(rows, 6, 1, 1000)
    assert train.count() == 14 and test.count() == 6


def test_many_classes_need_no_cap(spark):
    df = spark.range(30_000).select("id", F.floor(F.col("id") / 2).alias("y"))
    assert S.balance(df).count() == 30_000
    assert G.class_weights(df).agg(F.min("w"), F.max("w")).first() == (1.0, 1.0)


def test_unlabelled_rows_do_not_count(spark):
    known = [(1, 0.9), (0, 0.4), (1, 0.35), (0, 0.1)]
    a = spark.createDataFrame(known, "y int, p double")
    b = spark.createDataFrame([*known, (None, 0.2), (None, 0.0), (1, None)], "y int, p double")
    assert V.auc(a).first() == V.auc(b).first()
    grid = V.threshold_grid()
    assert V.f1_by_threshold(a, grid).orderBy("j").collect() == V.f1_by_threshold(
        b, grid).orderBy("j").collect()


def test_rows_without_score_are_not_labelled(spark):
    df = spark.createDataFrame([(i, None if i < 5 else i / 10) for i in range(15)],
                               "id long, p double")
    got = {r["id"]: r["y"] for r in E.pseudo_labels(df, 0.2).collect()}
    assert got == {5: 0, 6: 0, 13: 1, 14: 1}
    with pytest.raises(ValueError):
        S.extremes(df, "p", 0.6)
    assert S.extremes(df, "p", n=9).count() == 10


def test_labels_outside_the_grid_are_an_error(spark):
    df = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (None, 0)], "y int, y_pred int")
    for bad in (df, df.where("y is not null"), df.where("y is null or y < 2")):
        with pytest.raises(Exception, match="not in"):
            V.class_report(bad).collect()
    assert V.confusion(df.where("y < 2")).agg(F.sum("n")).first()[0] == 2


def test_attached_scores_must_match(spark):
    df, sc = spark.range(5), spark.range(4).withColumn("p", F.lit(0.5))
    with pytest.raises(ValueError):
        J.attach_scores(df, sc)


def test_one_hot_levels_with_dots(spark):
    df = spark.createDataFrame([("admin.",), ("admin._y",), ("a b",), (None,)], "job string")
    levels = enc.OneHotEncoder(["job"], drop_first=False).fit(df)
    wide = enc.one_hot_transform(df, levels, keep_source=True)
    assert {c for c in wide.columns} == {"job", "job_admin.", "job_admin._y", "job_a b"}
    for r in wide.collect():
        assert [c for c in wide.columns[1:] if r[c]] == ([f"job_{r['job']}"] if r["job"] else [])
    clean = R.sanitize_columns(wide.drop("job_admin._y"))
    assert "job_admin" in clean.columns


def test_trees_take_null_and_unknown_categories(spark):
    df = spark.range(200).select(
        "id", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 4 - 1).cast("int")
        .alias("code"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 4 == 3).cast("int").alias("y"))
    cat = G.categorical_arity(df, ["code"])
    assert cat == {"code": 3}
    for fit in (G.fit_gbt, G.fit_forest):
        m = fit(df, ["code", "x"], G.TreeConfig(max_iter=2, num_trees=2, max_depth=3),
                categorical=cat)
        new = df.withColumn("code", F.when(F.col("id") < 50, 99).otherwise(F.col("code")))
        sc = G.score(m, new)
        assert sc.count() == 200 and sc.where("p is null or isnan(p)").count() == 0


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.IntegerType()),
                       T.StructField("job", T.StringType()),
                       T.StructField("bal", T.DoubleType())])


def test_csv_is_read_by_name_with_missing_texts(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("job,bal,extra,age,id\nNA,NaN,1,30.0,1\nx,1.5,2,,2\nnone,n/a,3,41,3\n")
    got = [tuple(r) for r in read_table(spark, str(f), SCHEMA).orderBy("id").collect()]
    assert got == [(1, 30, None, None), (2, None, "x", 1.5), (3, 41, "none", None)]


@pytest.mark.parametrize("value", ["30.5", "abc", "99999999999999"])
def test_values_that_do_not_fit_are_an_error(spark, tmp_path, value):
    f = tmp_path / "b.csv"
    f.write_text(f"id,age,job,bal\n1,{value},x,1\n")
    with pytest.raises(Exception, match="column age"):
        read_table(spark, str(f), SCHEMA).collect()


def test_parquet_nan_is_null(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "id long, bal double")
    df.write.parquet(str(tmp_path / "p"))
    for schema in (None, T.StructType([SCHEMA["bal"], SCHEMA["id"]])):
        got = read_table(spark, str(tmp_path / "p"), schema, "parquet").orderBy("id")
        assert [r["bal"] for r in got.collect()] == [None, 1.0]


def test_kfold_shuffles_rows_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(5000).select("id", (F.col("id") % 2).cast("int").alias("y"))
        out = S.kfold(df, 5)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        assert final.count(" Exchange ") <= 3  # rows once, the small bucket totals twice
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
