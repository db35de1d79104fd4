"""Hot groups (one key / class / score value holding a third of the rows): results equal a
pandas brute force, and plans never window over a raw class or key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabrix.operators import encoders as enc
from tabrix.operators import groupstats as G
from tabrix.operators import metrics as V
from tabrix.operators import sampling as S

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(0)
    key = np.where(np.arange(N) % 3 == 0, "hot", rng.choice([f"k{i}" for i in range(200)], N))
    y = (rng.random(N) < np.where(key == "hot", 0.3, 0.1)).astype(int)
    p = np.where(np.arange(N) % 3 == 1, 0.5, np.round(rng.random(N), 3))
    x = rng.normal(size=N)
    pdf = pd.DataFrame({"id": np.arange(N, dtype=np.int64), "key": key, "y": y, "p": p, "x": x})
    return pdf, spark.createDataFrame(pdf).repartition(12)


def test_group_means_hot_key(skewed):
    pdf, df = skewed
    got = {r["id"]: r["x_mean_by_key"] for r in G.add_group_means(df, ["key"], ["x"],
                                                                    ratio=False).collect()}
    ref = pdf.groupby("key")["x"].transform("mean")
    assert np.allclose([got[i] for i in pdf["id"]], ref)


def test_group_count_hot_key(skewed):
    pdf, df = skewed
    got = {r["id"]: r["n"] for r in G.add_group_count(df, "key", "id", "n").collect()}
    ref = pdf.groupby("key")["id"].transform("count")
    assert [got[i] for i in pdf["id"]] == ref.tolist()


def test_encoders_hot_key(skewed):
    pdf, df = skewed
    out = enc.EncoderSet(["key"], "y", 10).fit(df).transform(df).toPandas().set_index("id")
    g = pdf["y"].mean()
    st = pdf.groupby("key")["y"].agg(["mean", "size"])
    smooth = (st["mean"] * st["size"] + g * 10) / (st["size"] + 10)
    assert np.allclose(out.loc[pdf["id"], "key_target_enc"], pdf["key"].map(smooth))
    assert np.allclose(out.loc[pdf["id"], "key_freq"], pdf["key"].map(st["size"] / N))
    codes = {k: i for i, k in enumerate(sorted(st.index))}
    assert (out.loc[pdf["id"], "key"].to_numpy() == pdf["key"].map(codes).to_numpy()).all()



def test_auc_hot_score_bruteforce(skewed):
    pdf, df = skewed
    got = V.auc(df).first()["auc"]
    r = pdf["p"].rank(method="average")
    n1 = pdf["y"].sum()
    n0 = len(pdf) - n1
    ref = (r[pdf["y"] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert abs(got - ref) < 1e-12


def test_medians_hot_value(skewed):
    pdf, df = skewed
    got = {r["feature"]: r["median"] for r in G.medians(df, ["p", "x"]).collect()}
    assert np.isclose(got["p"], pdf["p"].median()) and np.isclose(got["x"], pdf["x"].median())


def test_folds_balanced_with_hot_class(skewed):
    pdf, df = skewed
    kf = S.kfold(df.select("id", "key"), 5, 1, y="key")
    plan = kf._sc._jvm.PythonSQLUtils.explainString(kf._jdf.queryExecution(), "simple")
    assert "windowspecdefinition(_tbx_bucket" in plan  # bucketed, never by the raw class
    c = kf.where(F.col("key") == "hot").groupBy("fold").count().toPandas()
    assert c["count"].max() - c["count"].min() <= 1 and c["count"].sum() == N // 3


def test_seeded_rank_with_hot_copy_group(spark):
    from tabrix.operators.ranking import seeded_rank
    # a third of the rows are copies of id 7
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("id"),
        (F.col("id") % 2).cast("int").alias("y"))
    outs = []
    for n in (4, 32):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        r = seeded_rank(df, "id", 1, by=["y"], duplicates="split").toPandas()
        outs.append(r.groupby("y")["rank"].apply(lambda s: sorted(s.tolist())).to_dict())
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    for ranks in outs[0].values():
        assert ranks == list(range(1, len(ranks) + 1))  # a permutation within each class
    assert outs[0] == outs[1]
