"""Registered queries: sampling and splitting (X1-X5), ordering (K1-K3)."""

from __future__ import annotations


from tabrix.operators import sampling as S
from tabrix.operators.ranking import seeded_rank
from tabrix.plans.common import camp
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.q_scalar import FIXED_SCORE_SQL, fixed_score
from tabrix.plans.registry import query


def _rk(seed: int, by: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return (f"row_number() OVER ({part}ORDER BY md5(concat(CAST(id AS VARCHAR), ':', '{seed}')), id)")


@query("x1_balance_classes", with_campaign(f"""
r AS (SELECT id, y, {_rk(42, 'y')} AS rk FROM campaign)""", """
m AS (SELECT min(n) AS m FROM (SELECT y, count(*) AS n FROM campaign GROUP BY y))""") + """
SELECT id, y FROM r WHERE rk <= (SELECT m FROM m)""")
def x1(spark, sf):
    return S.balance(camp(spark, sf).select("id", "y"), "y", seed=42)


@query("x2_sample_n", with_campaign() + f"""
SELECT id, y FROM (SELECT id, y, {_rk(42)} AS rk FROM campaign) WHERE rk <= 1000""")
def x2(spark, sf):
    return S.sample_n(camp(spark, sf).select("id", "y"), 1000, seed=42)


_X3_SQL = with_campaign("""
cc AS (SELECT y, count(*) AS n FROM campaign GROUP BY y)""", """
tot AS (SELECT sum(n) AS n_all, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_hold FROM cc)""", """
al AS (SELECT y, n * n_hold / n_all AS cont, floor(n * n_hold / n_all) AS base, n_hold FROM cc CROSS JOIN tot)""", """
q AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY cont - base DESC, y)
                               <= n_hold - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM al)""", f"""
r AS (SELECT id, y, {_rk(42, 'y')} AS rk FROM campaign)""") + """
SELECT r.id, r.y, r.rk <= q.quota AS is_holdout FROM r JOIN q ON r.y = q.y"""


@query("x3_stratified_holdout", _X3_SQL)
def x3(spark, sf):
    return S.holdout(camp(spark, sf).select("id", "y"), 0.2, seed=42, y="y")


@query("x4_holdout", with_campaign() + f"""
SELECT id, y, {_rk(42)} <= ceil(0.2 * count(*) OVER ()) AS is_holdout FROM campaign""")
def x4(spark, sf):
    return S.holdout(camp(spark, sf).select("id", "y"), 0.2, seed=42)


@query("x5_stratified_kfold", with_campaign() + f"""
SELECT id, y, CAST(({_rk(42, 'y')} - 1) % 5 AS INTEGER) AS fold FROM campaign""")
def x5(spark, sf):
    return S.kfold(camp(spark, sf).select("id", "y"), k=5, seed=42, y="y")


@query("k1_top_k", with_campaign() + """
SELECT id, duration FROM campaign ORDER BY duration DESC NULLS LAST, id LIMIT 20""")
def k1(spark, sf):
    return S.top_k(camp(spark, sf).select("id", "duration"), "duration", 20, tie=["id"])


@query("k2_extremes", with_campaign(f"""
s AS (SELECT id, {FIXED_SCORE_SQL} AS p FROM campaign)""", """
r AS (SELECT id, p, row_number() OVER (ORDER BY p, id) AS rk, count(*) OVER () AS n FROM s)""") + """
SELECT id, p, CASE WHEN rk <= floor(0.05 * n) THEN 'bottom' ELSE 'top' END AS "end"
FROM r WHERE rk <= floor(0.05 * n) OR rk > n - floor(0.05 * n)""")
def k2(spark, sf):
    d = camp(spark, sf)
    return S.extremes(d.select("id", fixed_score(d).alias("p")), "p", 0.05)


@query("k3_shuffle", with_campaign() + f"""
SELECT id, y, {_rk(42)} AS pos FROM campaign""")
def k3(spark, sf):
    """K3: seeded shuffle; ``pos`` is each row's position in the shuffled order."""
    d = camp(spark, sf).select("id", "y")
    return seeded_rank(d, "id", 42, name="pos")


