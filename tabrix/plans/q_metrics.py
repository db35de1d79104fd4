"""Registered queries: evaluation V1-V8 on the fixed score (ties included, no model)."""

from __future__ import annotations


from tabrix.functions import scalar as M
from tabrix.operators import metrics as V
from tabrix.operators.sampling import kfold
from tabrix.plans.common import camp, rnd
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.q_scalar import FIXED_SCORE_SQL, fixed_score
from tabrix.plans.registry import query

THRESH = 0.05  # hard-label threshold used by the confusion/report queries


def scored(spark, sf):
    d = camp(spark, sf)
    return d.select("id", "y", fixed_score(d).alias("p"))


S_SQL = f"s AS (SELECT id, y, {FIXED_SCORE_SQL} AS p FROM campaign)"
P_SQL = f"s AS (SELECT id, y, {FIXED_SCORE_SQL} AS p, CAST({FIXED_SCORE_SQL} > {THRESH} AS INTEGER) AS y_pred FROM campaign)"

_AUC_BODY = """
g AS (SELECT {by}p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
      FROM {src} GROUP BY {by}p)""", """
c AS (SELECT {by}pos, neg, sum(neg) OVER ({part}ORDER BY p ROWS UNBOUNDED PRECEDING) - neg AS below FROM g)"""


def _auc_ctes(src: str, by: str | None = None, sfx: str = ""):
    b = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    out = [x.format(by=b, part=part, src=src) for x in _AUC_BODY]
    if sfx:
        out = [out[0].replace("g AS", f"g{sfx} AS"),
               out[1].replace("c AS", f"c{sfx} AS").replace("FROM g)", f"FROM g{sfx})")]
    return out


_AUC_EXPR = "sum(pos * (below + 0.5 * neg)) / nullif(sum(pos) * sum(neg), 0)"


@query("v1_auc", with_campaign(S_SQL, *_auc_ctes("s")) + f"SELECT round({_AUC_EXPR}, 6) AS auc FROM c")
def v1(spark, sf):
    return V.auc(scored(spark, sf)).select(rnd("auc", "auc"))


_KF = ("kf AS (SELECT id, y, p, CAST((row_number() OVER (PARTITION BY y ORDER BY "
       "md5(concat(CAST(id AS VARCHAR), ':', '42')), id) - 1) % 5 AS INTEGER) AS fold FROM s)")


@query("v1_auc_by_fold", with_campaign(S_SQL, _KF, *_auc_ctes("kf", "fold")) +
       f"SELECT fold, round({_AUC_EXPR}, 6) AS auc FROM c GROUP BY fold")
def v1_fold(spark, sf):
    sc = kfold(scored(spark, sf), k=5, seed=42, y="y")
    return V.auc(sc, by=["fold"]).select("fold", rnd("auc", "auc"))


@query("v2_cv_report", with_campaign(S_SQL, _KF, *_auc_ctes("kf", "fold"),
       f"pf AS (SELECT fold, {_AUC_EXPR} AS auc FROM c GROUP BY fold)",
       *_auc_ctes("s", sfx="2")) + f"""
SELECT round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS std_auc,
       (SELECT round({_AUC_EXPR}, 6) FROM c2) AS oof_auc, count(*) AS n_folds FROM pf""")
def v2(spark, sf):
    sc = kfold(scored(spark, sf), k=5, seed=42, y="y")
    r = V.cv_report(sc)
    return r.select(rnd("mean_auc", "mean_auc"), rnd("std_auc", "std_auc"),
                    rnd("oof_auc", "oof_auc"), "n_folds")


_TS = V.threshold_grid(0.3, 0.8, 0.01)
_TS_VALUES = ", ".join(f"({j}, CAST('{t!r}' AS DOUBLE))" for j, t in enumerate(_TS))


@query("v3_threshold_search", with_campaign(S_SQL, f"t(j, threshold) AS (VALUES {_TS_VALUES})", """
m AS (SELECT t.j, t.threshold,
             sum(CASE WHEN s.y = 1 AND s.p > t.threshold THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN s.y <> 1 AND s.p > t.threshold THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN s.y = 1 AND NOT (s.p > t.threshold) THEN 1 ELSE 0 END) AS fn
      FROM t CROSS JOIN s GROUP BY t.j, t.threshold)""", """
f AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM m)""") + """
SELECT CAST(j AS INTEGER) AS j, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, round(f1, 6) AS f1,
       (row_number() OVER (ORDER BY f1 DESC, j) = 1 AND f1 > 0) AS best FROM f""")
def v3(spark, sf):
    """V3: F1 for thresholds 0.30..0.79 (step 0.01, strict >), first maximum marked."""
    t = V.f1_by_threshold(scored(spark, sf), _TS)
    return t.select("j", "threshold", "tp", "fp", "fn", rnd("f1", "f1"), "best")


@query("v4_accuracy", with_campaign(P_SQL) + """
SELECT round(avg(CAST(y = y_pred AS DOUBLE)), 6) AS accuracy FROM s""")
def v4(spark, sf):
    d = scored(spark, sf).select("y", M.binarize("p", THRESH).alias("y_pred"))
    return V.accuracy(d).select(rnd("accuracy", "accuracy"))


@query("v5_confusion", with_campaign(P_SQL) + """
SELECT g.y, g.y_pred, coalesce(c.n, 0) AS n
FROM (SELECT a AS y, b AS y_pred FROM (VALUES (0), (1)) x(a) CROSS JOIN (VALUES (0), (1)) z(b)) g
LEFT JOIN (SELECT y, y_pred, count(*) AS n FROM s GROUP BY y, y_pred) c ON g.y = c.y AND g.y_pred = c.y_pred""")
def v5(spark, sf):
    d = scored(spark, sf).select("y", M.binarize("p", THRESH).alias("y_pred"))
    return V.confusion(d)


def _report_sql() -> str:
    per = []
    for lab in (0, 1):
        per.append(f"""SELECT '{lab}' AS label,
  CASE WHEN sum(CASE WHEN y_pred = {lab} THEN 1 ELSE 0 END) = 0 THEN 0.0 ELSE
    sum(CASE WHEN y = {lab} AND y_pred = {lab} THEN 1 ELSE 0 END) / sum(CASE WHEN y_pred = {lab} THEN 1 ELSE 0 END) END AS precision,
  CASE WHEN sum(CASE WHEN y = {lab} THEN 1 ELSE 0 END) = 0 THEN 0.0 ELSE
    sum(CASE WHEN y = {lab} AND y_pred = {lab} THEN 1 ELSE 0 END) / sum(CASE WHEN y = {lab} THEN 1 ELSE 0 END) END AS recall,
  sum(CASE WHEN y = {lab} THEN 1 ELSE 0 END) AS support FROM s""")
    return with_campaign(P_SQL, "pc AS (" + " UNION ALL ".join(per) + ")", """
r AS (SELECT label, precision, recall,
             CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
             support FROM pc)""") + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, round(avg(CAST(y = y_pred AS DOUBLE)), 6), count(*) FROM s
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM r"""


@query("v6_class_report", _report_sql())
def v6(spark, sf):
    d = scored(spark, sf).select("y", M.binarize("p", THRESH).alias("y_pred"))
    r = V.class_report(d)
    return r.select("label", rnd("precision", "precision"), rnd("recall", "recall"),
                    rnd("f1", "f1"), "support")


@query("v7_mse", with_campaign(P_SQL) + """
SELECT round(avg(pow(y - y_pred, 2)), 6) AS mse, round(sqrt(avg(pow(y - y_pred, 2))), 6) AS rmse FROM s""")
def v7(spark, sf):
    d = scored(spark, sf).select("y", M.binarize("p", THRESH).alias("y_pred"))
    return V.mse(d).select(rnd("mse", "mse"), rnd("rmse", "rmse"))


@query("v8_prediction_summary", with_campaign(P_SQL) + """
SELECT y_pred, count(*) AS n, round(count(*) / (SELECT count(*) FROM s), 6) AS share FROM s GROUP BY y_pred""")
def v8(spark, sf):
    d = scored(spark, sf).select(M.binarize("p", THRESH).alias("y_pred"))
    return V.prediction_summary(d).select("y_pred", "n", rnd("share", "share"))


