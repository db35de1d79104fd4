"""The CLI runs a workflow on CSV files end to end (test file missing -> carved holdout)."""

import os
import tempfile

from tabrix.plans import cli
from tabrix.sources.fixture import CAMPAIGN_COLUMNS, campaign
from tests.conftest import SF_SMALL


def test_cli_hybrid_on_csv(spark):
    d = tempfile.mkdtemp(prefix="tbx-cli-")
    tr = os.path.join(d, "train.csv")
    campaign(spark, SF_SMALL).select(*CAMPAIGN_COLUMNS).write.option("header", True).csv(tr)
    out = os.path.join(d, "sub")
    res = cli.main(["hybrid-ensemble", "--train", tr, "--test", os.path.join(d, "none.csv"),
                    "--out", out, "--trials", "1", "--folds", "2", "--rounds", "3",
                    "--depth", "3", "--forest-trees", "5", "--holdout-rows", "300"])
    sub = spark.read.option("header", True).schema("id long, y double").csv(out).toPandas()
    assert len(sub) == 300 and sub["id"].min() == 30000 and sub["y"].between(0, 1).all()
    assert res["pseudo_labels"].count() == 2 * int(0.05 * 300)
