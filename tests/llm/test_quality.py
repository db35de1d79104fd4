"""Factorisation machine: the linear-time identity, held-out accuracy, awkward rows."""

import itertools
import zlib

import numpy as np
import pytest

from tabrix.llm import quality_fm as Q
from tests.conftest import SF_MID
from tests.llm import common


def test_margin_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    fm = Q.FM(bits=6, factors=3)
    fm.w, fm.b = rng.normal(size=len(fm.w)), 0.3
    for _ in range(20):
        at = rng.choice(len(fm.w), 12, replace=False)
        x = rng.normal(size=12)
        want = fm.b + fm.w[at] @ x + sum(
            fm.v[at[i]] @ fm.v[at[j]] * x[i] * x[j] for i, j in itertools.combinations(range(12), 2))
        assert fm.margin(at, x) == pytest.approx(want)


def test_held_out_accuracy(spark):
    from tabrix.llm.queries import QUERIES
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_scores"](spark, SF_MID).collect()}
    assert len(got) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(
        f"{SF_MID}/labels.parquet").collect()}
    test = [i for i in labels if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == labels[i] for i in test]) > 0.95


def test_labels_of_held_out_rows_are_not_learnt(spark):
    docs = common.documents(spark)
    labels = spark.read.parquet(f"{common.SF_SMALL}/labels.parquet")
    held = "crc32(cast(doc_id as string)) % 3 = 1"
    wrong = labels.selectExpr("doc_id", f"if({held}, 1 - quality, quality) as quality")
    a, b = (Q.FM.load(Q.fit_quality(docs, x)) for x in (labels, wrong))
    assert np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)


def test_awkward_rows(spark):
    docs = common.awkward(spark, "score string")
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (5, None), (6, 7), (None, 1), (8, 1),
                                    (8, 1)], "doc_id long, quality int")
    rows = Q.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = Q.classify(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}
    assert Q.classify(common.empty(spark), labels).count() == 0


def test_sample_bound(spark):
    docs, labels = common.documents(spark), spark.read.parquet(f"{common.SF_SMALL}/labels.parquet")
    a, b = Q.fit_quality(docs, labels, max_rows=20), Q.fit_quality(docs, labels)
    assert a != b and a == Q.fit_quality(docs.repartition(7), labels, max_rows=20)
