"""Same results with 1, 4 and 64 shuffle partitions."""

import pytest

import __spark_entry__ as E
from tabrix.sources.fixture import derive_campaign
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.collect())


def _under(spark, n, fn):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        return fn()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_campaign_derivation(spark):
    outs = [_under(spark, n, lambda: _rows(derive_campaign(spark, SF_SMALL))) for n in (1, 4, 64)]
    assert outs[0] == outs[1] == outs[2]


@pytest.mark.parametrize("name", ["x5_stratified_kfold", "x1_balance_classes", "e1_ordinal_encode",
                                  "k2_extremes", "v1_auc_by_fold", "a8_medians",
                                  "e4b_oof_target_encode"])
def test_query(spark, name):
    q = E.queries()[name]
    outs = [_under(spark, n, lambda: _rows(q(spark, SF_SMALL))) for n in (1, 4, 64)]
    assert outs[0] == outs[1] == outs[2]
