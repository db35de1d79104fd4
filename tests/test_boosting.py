"""Histogram boosting: a plain single-machine version, partitions, patience, many models at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabrix.operators import boosting as B

FEATURES = ["a", "b", "c", "k"]


def table(n=2000, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 40, n).astype(float), rng.exponential(size=n)
    k = rng.integers(0, 6, n)
    z = a + (b > 25) * 1.5 - (c > 1) * a + np.array([0, 1, -1, 2, 0, -2])[k] + rng.normal(size=n)
    a[rng.random(n) < 0.1] = np.nan
    k[rng.random(n) < 0.05] = -1
    y = (z > 0.7).astype(int)
    return [(i, *map(float, (a[i], b[i], c[i])), int(k[i]), int(y[i]), float(1 + i % 3),
             int(i % 5)) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, k int, y int, "
                                       "w double, fold int")


# ---- a plain version: loops over rows, cuts and leaves, on the same bins ----
def plain_split(x, rows, g, h, cfg, counts, cats, unit):
    best = None
    G, H = g[rows].sum(), h[rows].sum()

    def offer(key, left):
        nonlocal best
        cl, cr = left.sum(), len(rows) - left.sum()
        gl, hl = g[rows][left].sum(), h[rows][left].sum()
        if min(cl, cr) < max(1, cfg.min_rows) or min(hl, H - hl) * unit < cfg.min_hessian:
            return
        gain = (B.leaf_score(gl * unit, hl * unit, cfg) + B.leaf_score(
            (G - gl) * unit, (H - hl) * unit, cfg) - B.leaf_score(G * unit, H * unit, cfg))
        if gain > max(cfg.min_gain, 1e-9) and (best is None or gain > best[0] + 1e-9):
            best = (gain, key, left)

    for f, n in enumerate(counts):
        v = x[f][rows]
        if f in cats:
            seen = np.unique(v)
            rate = [g[rows][v == s].sum() * unit / (h[rows][v == s].sum() * unit
                                                     + B.CATEGORY_SMOOTHING) for s in seen]
            order = seen[np.argsort(rate, kind="stable")]
            for i in range(1, len(order)):
                offer((f, -1, False, tuple(sorted(order[:i].tolist()))), np.isin(v, order[:i]))
        else:
            for t in range(1, n):
                low = (v >= 1) & (v <= t)
                if (v == 0).any():
                    offer((f, t, False, None), low)
                    offer((f, t, True, None), low | (v == 0))
                else:
                    offer((f, t, bool(low.sum() >= len(rows) - low.sum()), None), low)
    return best


def plain_fit(x, y, w, cfg, counts, cats, unit, init):
    margin, trees = np.full(len(y), init), []
    for _ in range(cfg.rounds):
        g, h = (v.astype(np.int64) for v in B.gradients(y, margin, w))
        leaves = {1: np.arange(len(y))}
        known = {1: plain_split(x, leaves[1], g, h, cfg, counts, cats, unit)}
        cuts = {}
        while len(leaves) < (cfg.leaves or 1 << 60):
            able = [(-s[0], p) for p, s in known.items() if p in leaves and s]
            if not able:
                break
            p = min(able)[1]
            _, cuts[p], left = known[p]
            rows = leaves.pop(p)
            for q, part in ((2 * p, rows[left]), (2 * p + 1, rows[~left])):
                leaves[q] = part
                deep = cfg.max_depth and q.bit_length() > cfg.max_depth
                known[q] = None if deep else plain_split(x, part, g, h, cfg, counts, cats, unit)
        for rows in leaves.values():
            margin[rows] += B.leaf_value(g[rows].sum() * unit, h[rows].sum() * unit, cfg)
        trees.append(cuts)
    return margin, trees


def shape(tree):
    out, todo = {}, [(0, 1)]
    for n, p in todo:
        if tree.feature[n] >= 0:
            c = tree.category[n]
            members = None if c < 0 else tuple(np.flatnonzero(tree.sets[c]).tolist())
            out[p] = (int(tree.feature[n]), int(tree.threshold[n]), bool(tree.missing_left[n]),
                      members)
            todo += [(tree.left[n], 2 * p), (tree.right[n], 2 * p + 1)]
    return out


@pytest.mark.parametrize("cfg", [
    B.BoostConfig(rounds=3, leaves=12, min_rows=20, l1=0.5, l2=1.0),
    B.BoostConfig(rounds=2, leaves=0, max_depth=4, min_rows=5, min_gain=0.5, learning_rate=0.3)])
def test_equals_a_plain_version(spark, cfg):
    rows = table()
    df = frame(spark, rows)
    m = B.fit_many(df, FEATURES, [B.Job(cfg)], [F.lit(1)], weight="w", categorical={"k": 6},
                   max_bins=24)[0]
    cols = [np.array([r[i] for r in rows], float) for i in (1, 2, 3, 4)]
    x = m.bins(cols)
    y, w = (np.array([r[i] for r in rows], float) for i in (5, 6))
    counts = B.bin_counts(FEATURES, {"k": 6}, m.edges)
    margin, trees = plain_fit(x, y, w / w.max(), cfg, counts, {3}, w.max() / B.UNIT, m.init)
    assert [shape(t) for t in m.trees] == trees
    assert any(k for t in trees for *_, k in t.values())  # categories were split
    assert np.allclose(m.margin(x), margin, atol=1e-12)
    got = {r["id"]: r["p"][0] for r in B.score_all([m], df, ["id"]).collect()}
    assert np.allclose([got[r[0]] for r in rows], B.sigmoid(margin), atol=1e-12)


def same(a, b):
    return len(a.trees) == len(b.trees) and all(
        shape(s) == shape(t) and np.array_equal(s.value, t.value) for s, t in zip(a.trees, b.trees))


def test_models_do_not_depend_on_partitions_or_company(spark, monkeypatch):
    rows = table(1200)
    cfg = B.BoostConfig(rounds=4, leaves=8, row_fraction=0.7, column_fraction=0.6, seed=3)
    other = B.BoostConfig(rounds=2, leaves=5)
    df = frame(spark, rows)
    roles = [F.when(F.col("fold") != 0, 1), F.lit(1)]
    edges = B.bin_edges(df, FEATURES, {}, 32)
    one = B.fit_many(df, FEATURES, [B.Job(cfg, balanced=True)], roles[:1], edges=edges)[0]
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)  # twelve blocks: sums on the executors first
    many = B.fit_many(df.repartition(13), FEATURES, [B.Job(other, 1), B.Job(cfg, 0, True)], roles,
                      edges=edges)
    assert same(one, many[1]) and len(many[0].trees) == 2
    own = B.score_own(many, df, ["id"], [F.col("id") % 3, F.lit(0)]).collect()
    both = {r["id"]: r["p"] for r in B.score_all(many, df, ["id"]).collect()}
    for scored in (B.score_all(many, df, ["id"]), B.score_own(many, df, ["id"], [F.lit(0)])):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ExistingRDD") == 1 and plan.count("MapInArrow") == 1  # one scan
    alone = {r["id"]: r["p"][0] for r in B.score_all(many[1:], df, ["id"]).collect()}
    assert all(alone[i] == p[1] for i, p in both.items())
    assert all(r["p"] == [(both[r["id"]] + [None])[r["id"] % 3], both[r["id"]][0]] for r in own)


def plain_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))


@pytest.mark.parametrize("metric", ["auc", "logloss"])
def test_patience_keeps_the_best_round(spark, metric):
    rows = table(900, seed=5)
    df = frame(spark, rows)
    base = B.BoostConfig(rounds=40, leaves=16, min_rows=5, learning_rate=0.4)
    watch = B.replace(base, patience=6, metric=metric)
    roles = [F.when(F.col("fold") == 0, 2).otherwise(1)]
    full, stopped = B.fit_many(df, FEATURES, [B.Job(base), B.Job(watch)], roles,
                               categorical={"k": 6})
    assert len(full.trees) == 40
    cols = [np.array([r[i] for r in rows if r[7] == 0], float) for i in (1, 2, 3, 4)]
    y = np.array([r[5] for r in rows if r[7] == 0])
    x = full.bins(cols)
    values = []
    for n in range(1, 41):
        part = B.BoostedModel(full.features, full.categorical, full.edges, full.init,
                              full.trees[:n])
        p = B.sigmoid(part.margin(x))
        values.append({"auc": plain_auc(y, p), "logloss": -np.mean(np.where(
            y == 1, np.log(p), np.log(1 - p))), "rmse": np.sqrt(np.mean((p - y) ** 2))}[metric])
        best = (max if metric == "auc" else min)(values)
        if n - 1 - values.index(best) >= 6:
            break
    assert len(values) < 40
    assert np.allclose(stopped.history, values, atol=1e-12)
    assert len(stopped.trees) == values.index(best) + 1
    assert all(shape(a) == shape(b) for a, b in zip(stopped.trees, full.trees))


def test_awkward_rows(spark):
    rows = [(i, None, float("nan"), 1.0, None, None if i == 7 else i % 2, 1.0, 0)
            for i in range(60)]
    rows += [(None, 2.0, 1.0, 1.0, 99, 1, 1.0, 0)] * 30
    df = frame(spark, rows)
    cfg = B.BoostConfig(rounds=3, min_rows=2, patience=2)
    # no validation rows: all rounds stay; one class only: no trees
    a, b = B.fit_many(df, FEATURES, [B.Job(cfg), B.Job(cfg, 1)],
                      [F.lit(1), F.when(F.col("y") == 1, 1)], categorical={"k": 3})
    assert len(a.trees) == 3 and b.trees == []
    p = [r["p"] for r in B.score_all([a, b], df, ["id"]).collect()]
    assert len(p) == 90 and all(0 < x < 1 and z == 0.5 for x, z in p)
    none = B.fit_many(df.limit(0), FEATURES, [B.Job(cfg)], [F.lit(1)])[0]
    assert none.trees == [] and B.score_all([none], df.limit(0), ["id"]).collect() == []
    with pytest.raises(ValueError):
        B.fit_many(df.withColumn("w", F.lit(-1.0)), FEATURES, [B.Job(cfg)], [F.lit(1)], weight="w")


def test_partial_sums_of_a_pass_do_not_grow_with_the_rows(spark):
    df = spark.range(1)
    cores = spark.sparkContext.defaultParallelism
    for rows in (cores * B.PART_ROWS // 4, cores * B.PART_ROWS):
        assert B.tasks(df, rows, B.BLOCK_ROWS, B.TASK_ROWS) == cores
    assert B.tasks(df, 10 * cores * B.PART_ROWS, B.BLOCK_ROWS, B.TASK_ROWS) == 10 * cores


def test_rows_parted_by_node_end_in_their_leaves():
    """Root on feature 0 (missing right), left child on a category set, right child on feature 0."""
    tree = B.Tree(np.array([0, 1, 0, -1, -1, -1, -1]), np.array([2, -1, 3, -1, -1, -1, -1]),
                  np.array([False] * 7), np.array([-1, 0, -1, -1, -1, -1, -1]),
                  np.array([1, 3, 5, -1, -1, -1, -1]), np.array([2, 4, 6, -1, -1, -1, -1]),
                  np.arange(7.0), np.zeros(7, int), np.zeros(7),
                  np.array([[True, False, True, False, False]]))
    bins = np.array([[0, 1, 2, 3, 4, 1, 2], [0, 0, 1, 2, 3, 4, 2]], np.uint8)
    want = [6, 3, 4, 5, 6, 4, 3]
    got = {n: r.tolist() for n, r in tree.parts(bins, np.arange(7))}
    assert got == {n: [i for i, w in enumerate(want) if w == n] for n in (3, 4, 5, 6)}
    some = dict(tree.parts(bins, np.arange(7), np.arange(7) == 4))
    assert list(some) == [4] and some[4].tolist() == [2, 5]
    margin = np.zeros(7)
    tree.add_to(margin, bins)
    assert margin.tolist() == want
