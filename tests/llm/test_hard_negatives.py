"""Hard negatives: brute force, slots, several blocks, awkward vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrix.llm import hard_negatives as H


def brute(rows, every=5, positives=5, negatives=3, low=50, high=95, scale=256):
    """(id, label, vector) rows -> result rows."""
    good = [(i, str(lab), [math.floor(scale * x) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, q in good:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, r)), j, other) for j, other, r in good
                        if j != i and len(r) == len(q))
        for neg_p, p, _ in [x for x in scored if x[2] == lab][:positives]:
            fits = [(s, j) for s, j, other in scored
                    if other != lab and low * -neg_p <= 100 * -s <= high * -neg_p]
            out += [(i, p, k + 1, j, -neg_p, -s) for k, (s, j) in enumerate(fits[:negatives])]
    return sorted(out)


def result(spark, rows, every=5, **options):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, "
                               "embedding array<double>, key int, q string")
    got = H.hard_negatives(df, F.col("vec_id") % every == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def made(n, dim=8, labels=3, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(labels)), (rng.normal(size=dim) + 0.7).round(2).tolist())
            for i in range(n)]


def test_equals_brute_force(spark):
    rows = made(150)
    assert result(spark, rows) == brute(rows)
    options = dict(positives=3, negatives=4, low=20, high=80, scale=16)
    assert result(spark, rows, **options) == brute(rows, **options)


def test_several_blocks_equal_one(spark, monkeypatch):
    rows = made(360, dim=4, labels=2)
    want = brute(rows, every=1)
    for name, v in (("BLOCK_BYTES", 1), ("GROUP_ROWS", 50), ("MIN_GROUP", 16), ("SUB", 7),
                    ("STEP", 5)):
        monkeypatch.setattr(H, name, v)
    # a block has 1,024 anchors at least, so more of them come from copies of the table
    assert result(spark, rows, every=1) == want
    many = [(i, lab, v) for k in range(3) for i, lab, v in
            ((i + 360 * k, lab, v) for i, lab, v in rows)]
    assert result(spark, many, every=1) == brute(many, every=1)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [-1.0, -0.5]),
            (3, 2, [0.6, 0.3]), (4, 2, [0.6, 0.3]), (5, 2, [0.6, 0.3]), (6, 2, [0.6, 0.3]),
            (None, 2, [0.6, 0.3]), (7, None, [0.6, 0.3]), (8, 2, None), (9, 2, [None, 1.0]),
            (10, 2, [nan, 1.0]), (15, 2, [inf, 1.0]), (20, 2, []), (21, 2, []), (22, 1, []),
            (25, 3, [1.0, 0.5]), (30, 2, [0.0, 0.0]), (31, 2, [0.0, 0.0]), (32, 1, [0.0, 0.0])]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [v, 1.0]) for i, v in enumerate(
        [3e6, 3e6 + 1, 2e6, 2e6 + 1, 2.5e6, 1e6, 1.8e6, 3e6])]
    assert result(spark, rows, every=2) == brute(rows, every=2)
    # beyond 64 bits nothing fails
    assert result(spark, [(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [1e30]), (3, 2, [1.0])]) == []


@pytest.mark.parametrize("k", [1, 3])
def test_best_keeps_the_first_of_equals(k):
    score = np.array([[5, 7, 5, 5, 7, 9]])
    ids = np.array([3, 4, 6, 8, 9, 11])
    best = H.Best(np.array([[5, 9]]), np.array([[7, 9]]), k)
    for at in (slice(0, 2), slice(2, 6)):
        best.add(slice(0, 1), score[:, at], ids[at], np.ones((1, at.stop - at.start), bool))
    want = [(7, 4), (7, 9), (5, 3)][:k]
    assert list(zip(best.score[0, 0].tolist(), best.id[0, 0].tolist())) == want
    assert (best.n[0, 1], best.id[0, 1, 0]) == (1, 11)
