"""Randomised trees: a plain recursive version, partitions and passes, many forests at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrix.operators import forest as T

FEATURES = ["a", "b", "c", "d"]


def table(n=700, seed=2):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n), rng.exponential(size=n),
                  np.full(n, 7.0)], axis=1)
    y = (x[:, 0] + (x[:, 1] == 1) + rng.normal(size=n) > 0.8).astype(int)
    x[rng.random(n) < 0.1, 2] = np.nan
    return [(i, *map(float, x[i]), int(y[i]), int(i % 4)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int, "
                                       "fold int")


def plain(x, y, seed, depth, least, take):
    """{path of turns: (feature, cut)} and {path: share of class 1} by recursion."""
    cuts, leaves = {}, {}

    def grow(rows, turns, path):
        n, n1 = len(rows), int(y[rows].sum())
        best = None
        if len(turns) < depth and n >= 2 * least and 0 < n1 < n:
            low = np.array([max(x[rows, f].min(), -np.finfo(float).max) for f in range(x.shape[1])])
            high = x[rows].max(0)
            order = sorted((int(T.mix(seed, path, f, 0)), f) for f in range(x.shape[1])
                           if high[f] > low[f])
            for _, f in order[:take]:
                u = (int(T.mix(seed, path, f, 1)) >> 11) / (1 << 53)
                cut = low[f] + u * (high[f] - low[f])
                cut = math.nextafter(low[f], math.inf) if cut <= low[f] else min(cut, high[f])
                left = x[rows, f] < cut
                a, a1 = int(left.sum()), int(y[rows][left].sum())
                if min(a, n - a) >= least:
                    b, b1 = n - a, n1 - a1
                    gain = (a1 ** 2 + (a - a1) ** 2) / a + (b1 ** 2 + (b - b1) ** 2) / b
                    if best is None or (gain, -f) > (best[0], -best[1]):
                        best = (gain, f, cut, left)
        if best is None:
            leaves[turns] = n1 / n
            return
        _, f, cut, left = best
        cuts[turns] = (f, cut)
        grow(rows[left], turns + "l", T.mix(path, 2))
        grow(rows[~left], turns + "r", T.mix(path, 3))

    grow(np.arange(len(y)), "", np.uint64(1))
    return cuts, leaves


def shape(t):
    cuts, leaves, todo = {}, {}, [(0, "")]
    for n, turns in todo:
        if t.feature[n] < 0:
            leaves[turns] = t.p[n]
        else:
            cuts[turns] = (int(t.feature[n]), float(t.cut[n]))
            todo += [(t.left[n], turns + "l"), (t.left[n] + 1, turns + "r")]
    return cuts, leaves


def arrays(rows):
    x = np.nan_to_num(np.array([r[1:5] for r in rows], float), nan=-np.inf)
    return x, np.array([r[5] for r in rows])


def test_equals_a_plain_version(spark):
    rows = table()
    x, y = arrays(rows)
    forest, = T.fit_forests(frame(spark, rows), FEATURES, [F.lit(1)], trees=5, max_depth=9,
                            min_rows=6, take=2, seeds=[11])
    want = [plain(x, y, T.mix(11, t), 9, 6, 2) for t in range(5)]
    assert [shape(t) for t in forest.trees] == want
    assert max(len(c) for c, _ in want) > 20
    got = {r["id"]: r["p"][0] for r in T.score([forest], frame(spark, rows), ["id"]).collect()}

    def leaf(v, cuts, leaves):
        turns = ""
        while turns in cuts:
            f, cut = cuts[turns]
            turns += "l" if v[f] < cut else "r"
        return leaves[turns]

    assert all(math.isclose(got[i], np.mean([leaf(x[i], *w) for w in want])) for i in range(len(x)))


def test_same_forests_in_any_partitions_groups_and_shards(spark, monkeypatch):
    rows = table(400)
    df = frame(spark, rows)
    roles = [F.when(F.col("fold") != f, 1) for f in (0, 1)]
    size = dict(trees=4, max_depth=6, min_rows=5, seeds=[3, 4])
    first = T.fit_forests(df, FEATURES, roles, **size)
    p = {r["id"]: r["p"] for r in T.score(first, df, ["id"]).collect()}
    for name, v in (("BLOCK_ROWS", 40), ("GROUP_TREES", 3), ("PASS_BYTES", 1), ("SLICE", 3),
                    ("SHARD_BYTES", 100), ("CUT_LEVELS", 2)):
        monkeypatch.setattr(T, name, v)
    again = T.fit_forests(df.repartition(9), FEATURES, roles, **size)
    assert [[shape(t) for t in f.trees] for f in first] == [[shape(t) for t in f.trees]
                                                            for f in again]
    own = T.score(again, df, ["id"], which=F.when(F.col("fold") < 2, F.col("fold"))).collect()
    for r in own:
        fold = r["id"] % 4
        assert (r["p"] is None) if fold > 1 else math.isclose(r["p"], p[r["id"]][fold])


def test_full_size_runs(spark):
    rows = table(300)
    df = frame(spark, rows)
    forest, none = T.fit_forests(df, FEATURES, [F.lit(1), F.lit(0)], trees=500, max_depth=20,
                                 min_rows=10)
    assert len(forest.trees) == 500 and all(t.cover[0] == 300 for t in forest.trees)
    got = T.score([forest, none], df, ["id", "y"]).collect()
    assert all(0 <= r["p"][0] <= 1 and r["p"][1] == 0.5 for r in got)
    pos, neg = ([r["p"][0] for r in got if r["y"] == v] for v in (1, 0))
    assert np.mean(pos) > np.mean(neg) + 0.1
    empty = T.fit_forests(df.limit(0), FEATURES, [F.lit(1)], trees=2)
    assert empty[0].trees == []


@pytest.mark.parametrize("few", [0, 45, 10 ** 6])
def test_subtrees_of_nodes_left_aside_equal_a_plain_version(spark, monkeypatch, few):
    rows = table()
    x, y = arrays(rows)
    passes = []
    ranges = T._ranges
    monkeypatch.setattr(T, "FINISH_BYTES", few * 8 * len(FEATURES))
    monkeypatch.setattr(T, "SHUFFLE_BYTES", 2000)
    monkeypatch.setattr(T, "_ranges", lambda *a: passes.append(1) or ranges(*a))
    forest, = T.fit_forests(frame(spark, rows), FEATURES, [F.lit(1)], trees=3, max_depth=9,
                            min_rows=6, take=2, seeds=[11])
    assert [shape(t) for t in forest.trees] == [plain(x, y, T.mix(11, t), 9, 6, 2)
                                                for t in range(3)]
    assert (not passes) == (few > len(rows))  # small tables take no passes


def test_groups_of_trees_are_bounded_by_their_rows(spark, monkeypatch):
    rows = table(200)
    sizes = []
    grow = T._grow
    monkeypatch.setattr(T, "GROUP_BYTES", 3 * 200 * 8 * len(FEATURES))
    monkeypatch.setattr(T, "_grow", lambda p, nf, roles, *a: sizes.append(len(roles)) or grow(
        p, nf, roles, *a))
    forest, = T.fit_forests(frame(spark, rows), FEATURES, [F.lit(1)], trees=7)
    assert sizes == [3, 3, 1] and len(forest.trees) == 7
