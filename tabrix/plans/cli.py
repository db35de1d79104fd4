"""Run a workflow on CSV (or parquet) train/test files and write the submission.

    python -m tabrix.plans.cli hybrid-ensemble --train train.csv --test test.csv --out sub/

``--test`` may be missing or point to a file that does not exist: a pseudo-test is then
carved from train (``--holdout-rows`` rows, ids renumbered from ``--holdout-id-base``).
"""

from __future__ import annotations

import argparse

from pyspark.sql.types import StructType

from tabrix.plans import workflows as WF
from tabrix.session import get_session
from tabrix.sources import io

WORKFLOWS = {"onehot-cv": WF.onehot_cv, "encoders-holdout": WF.encoders_holdout,
             "hybrid-ensemble": WF.hybrid_ensemble, "balanced": WF.balanced,
             "trial": WF.trial}


def _test_schema() -> StructType:
    return StructType([f for f in io.CAMPAIGN_SCHEMA.fields if f.name != "y"])


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("workflow", choices=sorted(WORKFLOWS))
    ap.add_argument("--train", required=True)
    ap.add_argument("--test")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--master")
    ap.add_argument("--trials", type=int, help="default: the reference's")
    ap.add_argument("--folds", type=int, default=5)
    ap.add_argument("--rounds", type=int, help="default: the reference's")
    ap.add_argument("--depth", type=int, default=8)
    ap.add_argument("--forest-trees", type=int, default=500)
    ap.add_argument("--holdout-rows", type=int, default=2000)
    ap.add_argument("--holdout-id-base", type=int, default=30000)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    train = io.read_table(spark, a.train, io.CAMPAIGN_SCHEMA, a.format)
    train, test = io.read_or_holdout(spark, train, a.test, a.holdout_rows, 99,
                                     a.holdout_id_base, _test_schema(), a.format)
    budget = WF.Budget(trials=a.trials, folds=a.folds, rounds=a.rounds, depth=a.depth,
                       forest_trees=a.forest_trees)
    return WORKFLOWS[a.workflow](train, test, a.out, budget)


if __name__ == "__main__":
    main()
