"""TreeSHAP contributions equal brute-force Shapley values of the path-dependent value
function, and contributions + bias equal the raw margin."""

import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from tabrix.operators import explain as X
from tabrix.operators import models as G
from tests.conftest import SF_SMALL


def _value(a, j, x, S):
    if a["left"][j] < 0:
        return a["pred"][j]
    f = int(a["feat"][j])
    if f in S:
        left = bool(X._goes_left(a, j, np.array([x[f]]))[0])
        return _value(a, a["left"][j] if left else a["right"][j], x, S)
    lc, rc = a["left"][j], a["right"][j]
    return (a["cover"][lc] * _value(a, lc, x, S) + a["cover"][rc] * _value(a, rc, x, S)) / a["cover"][j]


def _brute(a, x, nf):
    used = sorted({int(f) for f, l in zip(a["feat"], a["left"]) if l >= 0})
    m = len(used)
    phi = np.zeros(nf)
    for root, w in zip(a["roots"], a["weights"]):
        for i in used:
            others = [u for u in used if u != i]
            for r in range(len(others) + 1):
                for S in itertools.combinations(others, r):
                    c = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                    phi[i] += w * c * (_value(a, root, x, set(S) | {i}) - _value(a, root, x, set(S)))
    return phi


def test_treeshap_matches_bruteforce(spark):
    from tabrix.plans.q_models import cats, f3_frames
    trf, tef, feats = f3_frames(spark, SF_SMALL)
    for categorical in (None, cats(trf)):
        fit = G.fit_gbt(trf, feats, G.TreeConfig(max_iter=3, max_depth=2, learner="mllib"),
                        categorical=categorical)
        a = X._tree_arrays(fit)
        rows = tef.limit(25)
        got = {r["id"]: r for r in X.contributions(fit, rows).collect()}
        xs = rows.select("id", *[F.coalesce(F.col(c).cast("double"), F.lit(G.MISSING)).alias(c)
                                 for c in feats]).collect()
        for r in xs:
            x = np.array([r[c] for c in feats])
            ref = _brute(a, x, len(feats))
            assert np.allclose(np.array(got[r["id"]]["contrib"]), ref, atol=1e-9)
            assert abs(sum(got[r["id"]]["contrib"]) + got[r["id"]]["bias"] - got[r["id"]]["margin"]) < 1e-9


def test_boosted_treeshap_matches_bruteforce_in_any_number_of_shards(spark, monkeypatch):
    from tabrix.plans.q_models import cats, f3_frames
    trf, tef, feats = f3_frames(spark, SF_SMALL)
    fit = G.fit_gbt(trf, feats, G.TreeConfig(max_iter=4, max_depth=3, min_instances=5),
                    categorical=cats(trf))
    a = X._tree_arrays(fit)
    rows = tef.limit(25)
    got = {r["id"]: r for r in X.contributions(fit, rows).collect()}
    monkeypatch.setattr(X, "SHARD_NODES", 20)
    assert len(X._shards(fit, X.SHARD_NODES)) > 1
    again = {r["id"]: r for r in X.contributions(fit, rows).collect()}
    p = {r["id"]: r["p"] for r in G.score(fit, rows).collect()}
    for r in rows.select("id", *[F.col(c).cast("double").alias(c) for c in feats]).collect():
        x = np.array([np.nan if r[c] is None else r[c] for c in feats])
        bins = fit.model.bins([x[i:i + 1] for i in range(len(feats))])[:, 0]
        mine = got[r["id"]]
        assert np.allclose(mine["contrib"], _brute(a, bins, len(feats)), atol=1e-9)
        assert abs(sum(mine["contrib"]) + mine["bias"] - mine["margin"]) < 1e-9
        assert abs(1 / (1 + math.exp(-mine["margin"])) - p[r["id"]]) < 1e-9
        assert np.allclose(mine["contrib"], again[r["id"]]["contrib"], atol=1e-12)
