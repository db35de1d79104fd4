"""Sizes of the expensive loops: the reference's folds and seeds, its sizes as defaults."""

import pytest

from tabrix.operators import models as G
from tabrix.plans import q_models as Q
from tabrix.plans import workflows as WF
from tests.conftest import SF_SMALL


def test_defaults_are_the_references():
    sizes = {name: (b.trials, b.folds, b.rounds, b.final_rounds, b.seeds, b.forest_trees)
             for name in WF.REFERENCE for b in [WF.Budget().of(name)]}
    assert sizes["onehot_cv"][:3] == (50, 5, 3000)
    assert sizes["encoders_holdout"][:3] == (100, 5, 2000)
    assert sizes["balanced"][:3] == (50, 5, 2000)
    assert sizes["trial"][:3] == (50, 5, 1000)
    assert sizes["hybrid_ensemble"][1:] == (5, 1000, 1500, (42, 2024), 500)
    assert (G.TreeConfig().max_iter, G.TreeConfig().num_trees) == (1000, 500)
    given = WF.Budget(trials=3, rounds=7).of("hybrid_ensemble")
    assert (given.trials, given.rounds, given.final_rounds) == (3, 7, 7)


def test_registered_queries_use_all_folds_and_seeds(spark, monkeypatch):
    assert (Q._wf_budget().folds, Q._wf_budget().seeds) == (5, (42, 2024))
    calls = []

    def folds(df, feats, cfgs, k, **kw):
        cfgs = cfgs if isinstance(cfgs, list) else [cfgs]
        calls.append((k, [c.seed for c in cfgs]))
        if len(calls) == 2:
            raise InterruptedError
        return G.Folds(None, None, {})

    monkeypatch.setattr(Q.G, "oof_gbt", folds)
    monkeypatch.setattr(Q.G, "oof_forest", folds)
    with pytest.raises(InterruptedError):
        Q.g12_refit(spark, SF_SMALL)
    assert calls == [(5, [42, 2024]), (5, [99])]


@pytest.mark.parametrize("query, workflow", [
    ("wf_onehot_cv", "onehot_cv"), ("wf_encoders_holdout", "encoders_holdout"),
    ("wf_hybrid_ensemble", "hybrid_ensemble"), ("wf_balanced", "balanced"),
    ("wf_trial", "trial")])
def test_registered_workflows_run_at_the_references_sizes(spark, monkeypatch, query, workflow):
    given = []

    def run(tr, te, out, budget):
        given.append(budget.of(workflow))
        raise InterruptedError

    monkeypatch.setattr(WF, workflow, run)
    with pytest.raises(InterruptedError):
        getattr(Q, query)(spark, SF_SMALL)
    b = given[0]
    assert (b.trials, b.rounds, b.final_rounds) == WF.REFERENCE[workflow]
    assert (b.folds, b.depth, b.seeds, b.forest_trees) == (5, 8, (42, 2024), 500)
