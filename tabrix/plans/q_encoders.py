"""Registered queries: the campaign view itself and the encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrix.functions import scalar as M
from tabrix.operators import encoders as enc
from tabrix.operators.sampling import kfold
from tabrix.plans.common import SPLIT_SQL, camp, rnd, train_test
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.registry import query
from tabrix.sources.fixture import CAMPAIGN_COLUMNS, CATEGORICAL


@query("fixture_campaign", with_campaign() + "SELECT * FROM campaign")
def fixture_campaign(spark, sf):
    """The campaign view itself (input rows for every other query)."""
    return camp(spark, sf).select(*CAMPAIGN_COLUMNS)


_E4_SQL = with_campaign("""
g AS (SELECT avg(y) AS gm FROM campaign)""", """
st AS (SELECT job AS level, count(*) AS n, avg(y) AS m FROM campaign WHERE job IS NOT NULL GROUP BY job)""", """
e AS (SELECT level, (m * n + gm * 10.0) / (n + 10.0) AS enc FROM st CROSS JOIN g)""", """
d AS (SELECT avg(enc) AS d FROM e)""") + """
SELECT c.id, c.job, round(coalesce(e.enc, d.d), 6) AS job_target_enc
FROM campaign c LEFT JOIN e ON c.job = e.level CROSS JOIN d"""


@query("e4_target_encode", _E4_SQL)
def e4_target_encode(spark, sf):
    """E4 minimal slice: smoothed target encoding of ``job`` fitted on the campaign rows
    and joined back to every row."""
    df = camp(spark, sf)
    fitted = enc.TargetEncoder(["job"], "y", smoothing=10).fit(df)
    out = enc.target_transform(fitted, df.select("id", "job"), ["job"])
    return out.select("id", "job", rnd("job_target_enc", "job_target_enc"))


# ------------------------------------------------------------------ E1-E6 on train/test
WS = with_campaign(SPLIT_SQL)


def _codes_sql(col: str, fit: str, null_text: bool = True) -> str:
    q = f'"{col}"'
    lv = f"coalesce(CAST({q} AS VARCHAR), 'nan')" if null_text else f"CAST({q} AS VARCHAR)"
    return (f"c_{col} AS (SELECT lvl, CAST(row_number() OVER (ORDER BY lvl) - 1 AS INTEGER) AS code "
            f"FROM (SELECT DISTINCT {lv} AS lvl FROM {fit} WHERE {lv} IS NOT NULL))")


_E1_SQL = with_campaign(SPLIT_SQL, "u AS (SELECT * EXCLUDE (y) FROM train UNION ALL SELECT * FROM test)",
                        *[_codes_sql(c, "u") for c in CATEGORICAL]) + \
    "SELECT t.id, " + ", ".join(f'coalesce(c_{c}.code, -1) AS "{c}"' for c in CATEGORICAL) + \
    " FROM test t " + " ".join(
        f"""LEFT JOIN c_{c} ON coalesce(CAST(t."{c}" AS VARCHAR), 'nan') = c_{c}.lvl""" for c in CATEGORICAL)


@query("e1_ordinal_encode", _E1_SQL)
def e1(spark, sf):
    """Ordinal codes of the 9 categorical columns, fitted on train+test ('union'
    scope, text form so NULL is category 'nan'), applied to test; unseen -> -1."""
    tr, te = train_test(spark, sf)
    fit_on = tr.drop("y").unionByName(te)
    fitted = enc.OrdinalEncoder(CATEGORICAL, null_as="nan").fit(fit_on)
    return fitted.transform(te.select("id", *CATEGORICAL))


_FPC = ["age", "job", "marital", "education", "housing", "loan"]
_FP_SQL = " || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in _FPC)


@query("e2_label_encode_unseen", with_campaign(
    SPLIT_SQL, f"trh AS (SELECT {_FP_SQL} AS user_hash FROM train)", _codes_sql("user_hash", "trh")) + f"""
SELECT t.id, t.user_hash, coalesce(c.code, -1) AS user_hash_code
FROM (SELECT id, {_FP_SQL} AS user_hash FROM test) t LEFT JOIN c_user_hash c ON t.user_hash = c.lvl""")
def e2(spark, sf):
    """Label codes of a high-cardinality key (profile fingerprint) fitted on train;
    test levels never seen in train get -1."""
    tr, te = train_test(spark, sf)
    fp = M.fingerprint(_FPC).alias("user_hash")
    fitted = enc.OrdinalEncoder(["user_hash"], null_as="nan").fit(tr.select(fp))
    return fitted.transform(te.select("id", fp), replace=False)


_AGE_CASE = "CASE " + " ".join(
    f"WHEN age > {lo} AND age <= {hi} THEN '{lab}'"
    for lo, hi, lab in zip(M.AGE_EDGES[:-1], M.AGE_EDGES[1:], M.AGE_LABELS)) + " END"
_E3_COLS = ["job", "marital", "education", "contact", "poutcome", "age_group"]


def _freq_sql(col: str) -> str:
    lv = "" if col != "age_group" else \
        " UNION ALL ".join(f"SELECT '{x}' AS lvl, 0 AS n" for x in M.AGE_LABELS)
    counts = f"SELECT {col} AS lvl, count(*) AS n FROM trx WHERE {col} IS NOT NULL GROUP BY {col}"
    base = f"SELECT lvl, sum(n) AS n FROM ({counts} UNION ALL {lv}) GROUP BY lvl" if lv else counts
    return (f"f_{col} AS (SELECT lvl, n / sum(n) OVER () AS freq FROM ({base}))")


_E3_SQL = with_campaign(SPLIT_SQL, f"trx AS (SELECT *, {_AGE_CASE} AS age_group FROM train)",
                        f"tex AS (SELECT *, {_AGE_CASE} AS age_group FROM test)",
                        *[_freq_sql(c) for c in _E3_COLS]) + \
    "SELECT t.id, " + ", ".join(
        f"round(coalesce(f_{c}.freq, (SELECT min(freq) FROM f_{c})), 6) AS {c}_freq" for c in _E3_COLS) + \
    " FROM tex t " + " ".join(f"LEFT JOIN f_{c} ON t.{c} = f_{c}.lvl" for c in _E3_COLS)


@query("e3_frequency_encode", _E3_SQL)
def e3(spark, sf):
    """Frequency encoding fitted on train (age bins keep empty levels at 0), applied
    to test; unseen -> the smallest fitted frequency."""
    tr, te = train_test(spark, sf)
    ag = M.fixed_cut("age").alias("age_group")
    trx, tex = tr.select("*", ag), te.select("id", *_E3_COLS[:-1], ag)
    fitted = enc.FrequencyEncoder(_E3_COLS, levels={"age_group": M.AGE_LABELS}).fit(trx)
    out = enc.frequency_transform(fitted, tex, _E3_COLS)
    return out.select("id", *[rnd(f"{c}_freq", f"{c}_freq") for c in _E3_COLS])


def _te_sql(col: str) -> str:
    return (f"t_{col} AS (SELECT {col} AS lvl, (avg(y) * count(*) + (SELECT avg(y) FROM trx) * 10.0)"
            f" / (count(*) + 10.0) AS enc FROM trx WHERE {col} IS NOT NULL GROUP BY {col})")


_E4T_SQL = with_campaign(SPLIT_SQL, f"trx AS (SELECT *, {_AGE_CASE} AS age_group FROM train)",
                         f"tex AS (SELECT *, {_AGE_CASE} AS age_group FROM test)",
                         *[_te_sql(c) for c in _E3_COLS]) + \
    "SELECT t.id, " + ", ".join(
        f"round(coalesce(t_{c}.enc, (SELECT avg(enc) FROM t_{c})), 6) AS {c}_target_enc" for c in _E3_COLS) + \
    " FROM tex t " + " ".join(f"LEFT JOIN t_{c} ON t.{c} = t_{c}.lvl" for c in _E3_COLS)


@query("e4_target_encode_test", _E4T_SQL)
def e4_test(spark, sf):
    """E4 train-fit / test-apply for six columns (one statistics scan)."""
    tr, te = train_test(spark, sf)
    ag = M.fixed_cut("age").alias("age_group")
    trx, tex = tr.select("*", ag), te.select("id", *_E3_COLS[:-1], ag)
    fitted = enc.TargetEncoder(_E3_COLS, "y", 10).fit(trx)
    out = enc.target_transform(fitted, tex, _E3_COLS)
    return out.select("id", *[rnd(f"{c}_target_enc", f"{c}_target_enc") for c in _E3_COLS])


_E4B_COLS = ["job", "education", "contact"]
_E4B_SQL = with_campaign("""
kf AS (SELECT id, y, job, education, contact,
              CAST((row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(id AS VARCHAR), ':', '42')), id) - 1) % 5 AS INTEGER) AS fold
       FROM campaign)""", """
gf AS (SELECT fold, ((SELECT sum(y) FROM kf) - sum(y)) / ((SELECT count(*) FROM kf) - count(*)) AS g FROM kf GROUP BY fold)""",
    *[f"""s_{c} AS (SELECT a.{c} AS lvl, f.fold,
           (sum(CASE WHEN a.fold <> f.fold THEN a.y ELSE 0 END) + max(gf.g) * 10.0)
             / (sum(CASE WHEN a.fold <> f.fold THEN 1 ELSE 0 END) + 10.0) AS enc,
           sum(CASE WHEN a.fold <> f.fold THEN 1 ELSE 0 END) AS n_out
         FROM kf a CROSS JOIN (SELECT DISTINCT fold FROM kf) f JOIN gf ON gf.fold = f.fold
         WHERE a.{c} IS NOT NULL GROUP BY a.{c}, f.fold)""" for c in _E4B_COLS]) + \
    "SELECT k.id, k.fold, " + ", ".join(
        f"round(CASE WHEN s_{c}.n_out > 0 THEN s_{c}.enc ELSE gf.g END, 6) AS {c}_target_enc" for c in _E4B_COLS) + \
    " FROM kf k JOIN gf ON k.fold = gf.fold " + " ".join(
        f"LEFT JOIN s_{c} ON k.{c} = s_{c}.lvl AND k.fold = s_{c}.fold" for c in _E4B_COLS)


@query("e4b_oof_target_encode", _E4B_SQL)
def e4b(spark, sf):
    """Out-of-fold smoothed target encoding over stratified 5 folds."""
    d = kfold(camp(spark, sf).select("id", "y", *_E4B_COLS), k=5, seed=42, y="y")
    out = enc.oof_target_encode(d, _E4B_COLS, "y", "fold", 10)
    return out.select("id", "fold", *[rnd(f"{c}_target_enc", f"{c}_target_enc") for c in _E4B_COLS])


# fixed values: the level sets of the campaign view's categories (from the TPC-H spec and
# month names); used only to spell out the SQL twin's one-hot columns.
_LEVELS = {
    "job": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "marital": ["F", "O", "P"],
    "education": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "contact": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "poutcome": ["failure", "other", "success", "unknown"],
}
_E5_COLS = ["job", "marital", "education", "contact", "poutcome", "job_education"]


def _e5_sql() -> str:
    lv = dict(_LEVELS)
    lv["job_education"] = sorted(f"{a}_{b}" for a in lv["job"] for b in lv["education"])
    cols = ["id"]
    for c in _E5_COLS:
        for x in sorted(lv[c])[1:]:
            src = "job || '_' || education" if c == "job_education" else c
            cols.append(f"CAST(coalesce({src} = '{x}', false) AS INTEGER) AS \"{c}_{x}\"")
    return WS + "SELECT " + ", ".join(cols) + " FROM train"


@query("e5_one_hot", _e5_sql())
def e5(spark, sf):
    """E5: one-hot (first sorted level dropped) fitted on train, incl. an interaction."""
    tr, _ = train_test(spark, sf)
    d = tr.select("id", *_E5_COLS[:-1], M.interaction("job", "education").alias("job_education"))
    levels = enc.OneHotEncoder(_E5_COLS).fit(d)
    return enc.one_hot_transform(d, levels)


_E6 = ["duration", "pdays", "balance"]


@query("e6_median_impute", with_campaign(SPLIT_SQL, "med AS (SELECT " + ", ".join(
    f"median(CAST({c} AS DOUBLE)) AS {c}" for c in _E6) + " FROM train)") + "SELECT t.id, " + ", ".join(
    f"round(coalesce(CAST(t.{c} AS DOUBLE), med.{c}), 6) AS {c}" for c in _E6) + " FROM test t CROSS JOIN med")
def e6(spark, sf):
    """Exact medians fitted on train, NULLs of test replaced by them."""
    tr, te = train_test(spark, sf)
    med = enc.MedianImputer(_E6).fit(tr)
    out = enc.MedianImputer.transform(te.select("id", *_E6), med)
    return out.select("id", *[rnd(c, c) for c in _E6])

