"""Registered queries: scalar feature functions M1-M20 over the whole campaign view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrix.functions import scalar as M
from tabrix.plans.common import camp, rnd
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.registry import query

W = with_campaign()


@query("m1_contact_flags", W + """
SELECT id, CAST(coalesce(pdays = -1, false) AS INTEGER) AS pdays_never,
       CAST(pdays IS DISTINCT FROM -1 AS INTEGER) AS has_previous_contact,
       CAST(pdays IS DISTINCT FROM 999 AS INTEGER) AS has_contact_999
FROM campaign""")
def m1(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.sentinel_flag("pdays", -1).alias("pdays_never"),
                    M.has_contact("pdays", -1).alias("has_previous_contact"),
                    M.has_contact("pdays", 999).alias("has_contact_999"))


@query("m2_ratio_eps", W + """
SELECT id, round(CAST(duration AS DOUBLE) / (campaign + 1e-5), 6) AS duration_per_contact
FROM campaign""")
def m2(spark, sf):
    d = camp(spark, sf)
    return d.select("id", rnd(M.ratio_eps("duration", "campaign"), "duration_per_contact"))


@query("m3_ratio_plus_one", W + """
SELECT id, round(CAST(duration AS DOUBLE) / (day + 1), 6) AS duration_per_day,
       round(CAST(duration AS DOUBLE) / (campaign + 1), 6) AS campaign_efficiency
FROM campaign""")
def m3(spark, sf):
    d = camp(spark, sf)
    return d.select("id", rnd(M.ratio_plus_one("duration", "day"), "duration_per_day"),
                    rnd(M.ratio_plus_one("duration", "campaign"), "campaign_efficiency"))


@query("m4_log1p", W + """
SELECT id, round(ln(1 + CAST(duration AS DOUBLE)), 6) AS duration_log FROM campaign""")
def m4(spark, sf):
    d = camp(spark, sf)
    return d.select("id", rnd(M.log1p("duration"), "duration_log"))


@query("m5_shifted_log", with_campaign("mn AS (SELECT min(balance) AS m FROM campaign)") + """
SELECT id, round(ln(1 + (balance - mn.m + 1)), 6) AS balance_log FROM campaign CROSS JOIN mn""")
def m5(spark, sf):
    d = camp(spark, sf)
    lo, _ = M.fitted_min_max(d, "balance")
    return d.select("id", rnd(M.shifted_log("balance", lo), "balance_log"))


@query("m6_sign_flags", W + """
SELECT id, CAST(coalesce(balance > 0, false) AS INTEGER) AS balance_positive,
       CAST(coalesce(balance < 0, false) AS INTEGER) AS balance_negative FROM campaign""")
def m6(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.positive_flag("balance").alias("balance_positive"),
                    M.negative_flag("balance").alias("balance_negative"))


@query("m7_replace_sentinel", W + """
SELECT id, CASE WHEN pdays = -1 THEN 999 ELSE pdays END AS pdays_clean,
       CASE WHEN pdays = -1 THEN 1 ELSE pdays END AS pdays_one FROM campaign""")
def m7(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.replace_value("pdays", -1, 999).alias("pdays_clean"),
                    M.replace_value("pdays", -1, 1).alias("pdays_one"))


@query("m8_sentinel_safe_ratio", W + """
SELECT id, round(CAST(previous AS DOUBLE) / ((CASE WHEN pdays = -1 THEN 1 ELSE pdays END) + 1), 6)
       AS previous_per_pdays FROM campaign""")
def m8(spark, sf):
    d = camp(spark, sf)
    return d.select("id", rnd(M.sentinel_safe_ratio("previous", "pdays"), "previous_per_pdays"))


_MONTH_CASE = ("CASE lower(month) " + " ".join(
    f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(M.MONTHS)) + " END")


@query("m9_month_number", W + f"""
SELECT id, month, CAST({_MONTH_CASE} AS INTEGER) AS month_int FROM campaign""")
def m9(spark, sf):
    d = camp(spark, sf)
    return d.select("id", "month", M.month_number("month").alias("month_int"))


@query("m10_cyclic", W + f"""
SELECT id, round(sin(2 * pi() * ({_MONTH_CASE}) / 12.0), 6) AS month_sin,
       round(cos(2 * pi() * ({_MONTH_CASE}) / 12.0), 6) AS month_cos,
       round(sin(2 * pi() * day / 31.0), 6) AS day_sin,
       round(cos(2 * pi() * day / 31.0), 6) AS day_cos FROM campaign""")
def m10(spark, sf):
    d = camp(spark, sf)
    ms, mc = M.cyclic(M.month_number("month"), 12)
    ds, dc = M.cyclic("day", 31)
    return d.select("id", rnd(ms, "month_sin"), rnd(mc, "month_cos"),
                    rnd(ds, "day_sin"), rnd(dc, "day_cos"))


@query("m11_yes_no", W + """
SELECT id, CAST(CASE "default" WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS "default",
       CAST(CASE housing WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS housing,
       CAST(CASE loan WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS loan FROM campaign""")
def m11(spark, sf):
    d = camp(spark, sf)
    return d.select("id", *[M.yes_no(c).alias(c) for c in ("default", "housing", "loan")])


@query("m12_loan_counts", W + """
SELECT id, CAST(coalesce(housing = 'yes', false) AS INTEGER) + CAST(coalesce(loan = 'yes', false) AS INTEGER) AS total_loans,
       CAST((CAST(coalesce(housing = 'yes', false) AS INTEGER) + CAST(coalesce(loan = 'yes', false) AS INTEGER)) > 0 AS INTEGER) AS has_any_loan
FROM campaign""")
def m12(spark, sf):
    d = camp(spark, sf)
    t = M.count_yes(["housing", "loan"])
    return d.select("id", t.alias("total_loans"), M.any_flag(t).alias("has_any_loan"))


@query("m13_interactions", W + """
SELECT id, coalesce(job, 'nan') || '_' || coalesce(education, 'nan') AS job_education,
       coalesce(marital, 'nan') || '_' || coalesce(education, 'nan') AS marital_education,
       coalesce(contact, 'nan') || '_' || coalesce(month, 'nan') AS contact_month FROM campaign""")
def m13(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.interaction("job", "education").alias("job_education"),
                    M.interaction("marital", "education").alias("marital_education"),
                    M.interaction("contact", "month").alias("contact_month"))


_FP_COLS = ["age", "job", "marital", "education", "housing", "loan"]


@query("m14_fingerprint", W + """
SELECT id, """ + " || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in _FP_COLS) + """ AS user_hash
FROM campaign""")
def m14(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.fingerprint(_FP_COLS).alias("user_hash"))


@query("m15_clean_labels", W + r"""
SELECT id, regexp_replace(coalesce(contact, 'nan') || ' (' || month || ')', '[\(\)\[\]\{\}\:\"\,\.\s]', '_', 'g') AS contact_clean_b,
       regexp_replace(coalesce(contact, 'nan') || ' [' || month || '.]', '[(),.\[\] ]', '_', 'g') AS contact_clean_o
FROM campaign""")
def m15(spark, sf):
    d = camp(spark, sf)
    b = F.concat(M.text_of("contact"), F.lit(" ("), F.col("month"), F.lit(")"))
    o = F.concat(M.text_of("contact"), F.lit(" ["), F.col("month"), F.lit(".]"))
    return d.select("id", M.clean_label(b, M.NAME_CHARS_B).alias("contact_clean_b"),
                    M.clean_label(o, M.NAME_CHARS_O).alias("contact_clean_o"))


_AGE_CASE = "CASE " + " ".join(
    f"WHEN age > {lo} AND age <= {hi} THEN '{lab}'"
    for lo, hi, lab in zip(M.AGE_EDGES[:-1], M.AGE_EDGES[1:], M.AGE_LABELS)) + " END"


@query("m16_fixed_cut", W + f"SELECT id, age, {_AGE_CASE} AS age_group FROM campaign")
def m16(spark, sf):
    d = camp(spark, sf)
    return d.select("id", "age", M.fixed_cut("age").alias("age_group"))


def _edges_sql(col: str, k: int, src: str = "campaign", sfx: str = "") -> str:
    """DuckDB CTEs ending in `ed{sfx}(i, e)`: k equal-width edges of `col` over `src`."""
    return f"""
mm{sfx} AS (SELECT CAST(min({col}) AS DOUBLE) AS lo0, CAST(max({col}) AS DOUBLE) AS hi0 FROM {src}),
mm2{sfx} AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - (CASE WHEN lo0 = 0 THEN 0.001 ELSE abs(lo0) * 0.001 END) ELSE lo0 END AS lo,
               CASE WHEN lo0 = hi0 THEN hi0 + (CASE WHEN hi0 = 0 THEN 0.001 ELSE abs(hi0) * 0.001 END) ELSE hi0 END AS hi,
               lo0 = hi0 AS const FROM mm{sfx}),
ed{sfx} AS (SELECT i, CASE WHEN i = {k} THEN hi
                      WHEN i = 0 AND NOT const THEN (lo) - (hi - lo) * 0.001
                      ELSE CAST(i AS DOUBLE) * ((hi - lo) / {float(k)}) + lo END AS e
       FROM mm2{sfx} CROSS JOIN range(0, {k + 1}) t(i))"""


def _shown_sql(x: str) -> str:
    """An edge as labels show it: three places, not counting zeros after the point."""
    scale = (f"pow(10.0, 3 + CASE WHEN abs({x}) > 0 AND abs({x}) < 1 "
             f"THEN CAST(-floor(log10(abs({x}))) AS INTEGER) - 1 ELSE 0 END)")
    return f"(round_even(CAST({x} AS DOUBLE) * {scale}, 0) / {scale})"


_M17_SQL = with_campaign(_edges_sql("age", 16).strip().rstrip(","), """
b AS (SELECT c.id, c.age, CAST(sum(CASE WHEN c.age > ed.e THEN 1 ELSE 0 END) AS INTEGER) - 1 AS bin
      FROM campaign c CROSS JOIN ed GROUP BY c.id, c.age)""", """
lab AS (SELECT a.i AS bin, '(' || CAST(""" + _shown_sql("a.e") + """ AS VARCHAR) || ', ' ||
               CAST(""" + _shown_sql("b2.e") + """ AS VARCHAR) || ']' AS label
        FROM ed a JOIN ed b2 ON b2.i = a.i + 1)""") + """
SELECT b.id, b.age, CASE WHEN b.bin BETWEEN 0 AND 15 THEN b.bin END AS age_bin, lab.label AS age_group,
       regexp_replace(lab.label, '[\\(\\)\\[\\]\\{\\}\\:\\"\\,\\.\\s]', '_', 'g') AS age_group_clean
FROM b LEFT JOIN lab ON b.bin = lab.bin"""


@query("m17_width_cut_labels", _M17_SQL)
def m17(spark, sf):
    d = camp(spark, sf)
    cut = M.WidthCut(16).fit(d, "age")
    lab = cut.label("age")
    return d.select("id", "age", cut.index("age").alias("age_bin"),
                    lab.alias("age_group"), M.clean_label(lab, M.NAME_CHARS_B).alias("age_group_clean"))


_M18_SQL = with_campaign(_edges_sql("age", 5).strip().rstrip(","), """
b AS (SELECT c.id, c.age, CAST(sum(CASE WHEN c.age > ed.e THEN 1 ELSE 0 END) AS INTEGER) - 1 AS bin
      FROM campaign c CROSS JOIN ed GROUP BY c.id, c.age)""") + """
SELECT id, age, CASE WHEN bin BETWEEN 0 AND 4 THEN bin END AS age_bin FROM b"""


@query("m18_width_cut_ordinal", _M18_SQL)
def m18(spark, sf):
    d = camp(spark, sf)
    cut = M.WidthCut(5).fit(d, "age")
    return d.select("id", "age", cut.index("age").alias("age_bin"))


@query("m19_equals_flag", W + """
SELECT id, CAST(coalesce(poutcome = 'success', false) AS INTEGER) AS is_success_prev FROM campaign""")
def m19(spark, sf):
    d = camp(spark, sf)
    return d.select("id", M.equals_flag("poutcome", "success").alias("is_success_prev"))


# Fixed score with ties used by the metric queries (no model needed).  Rounded as
# round(x*100)/100 so both engines round the same binary value.
FIXED_SCORE_SQL = "(round(least(coalesce(duration, 0), 4000) / 4000.0 * 100) / 100.0)"


def fixed_score(df):
    x = F.least(F.coalesce(F.col("duration"), F.lit(0)), F.lit(4000)) / 4000.0
    return F.round(x * 100) / 100.0


@query("m20_binarize", W + f"""
SELECT id, {FIXED_SCORE_SQL} AS p, CAST({FIXED_SCORE_SQL} > 0.05 AS INTEGER) AS y_pred FROM campaign""")
def m20(spark, sf):
    d = camp(spark, sf)
    p = fixed_score(d)
    return d.select("id", p.alias("p"), M.binarize(p, 0.05).alias("y_pred"))
