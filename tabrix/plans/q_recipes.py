"""Registered queries: the notebooks' feature recipes end to end, with DuckDB twins."""

from __future__ import annotations

from tabrix.functions import scalar as M
from tabrix.plans import recipes as RC
from tabrix.plans.common import SPLIT_SQL, camp, round_doubles, train_test
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.q_encoders import _codes_sql, _freq_sql, _te_sql
from tabrix.plans.q_scalar import _MONTH_CASE, _edges_sql, _shown_sql
from tabrix.plans.registry import query
from tabrix.sources.fixture import CAMPAIGN_COLUMNS, CATEGORICAL

NUMS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
FP = " || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')" for c in RC.FP_COLS)
AGE_CASE = "CASE " + " ".join(
    f"WHEN age > {lo} AND age <= {hi} THEN '{lab}'"
    for lo, hi, lab in zip(M.AGE_EDGES[:-1], M.AGE_EDGES[1:], M.AGE_LABELS)) + " END"
UNION = ("u AS (SELECT *, 1 AS is_train FROM train UNION ALL "
         "SELECT *, CAST(NULL AS INTEGER) AS y, 0 AS is_train FROM test)")


def q(c: str) -> str:
    return f'"{c}"'


def _code_joins(src: str, cols) -> str:
    return " ".join(f"LEFT JOIN c_{c} ON coalesce(CAST({src}.{q(c)} AS VARCHAR), 'nan') = c_{c}.lvl"
                    for c in cols)


def _code_cols(cols) -> list[str]:
    return [f"coalesce(c_{c}.code, -1) AS {q(c)}" for c in cols]


# ----------------------------------------------------------------------------- F1
_F1_SQL = with_campaign(*[_codes_sql(c, "campaign", null_text=False) for c in CATEGORICAL]) + \
    "SELECT t.id, t.y, " + ", ".join([f"t.{c}" for c in NUMS] + [
        f"CASE WHEN t.{q(c)} IS NULL THEN NULL ELSE coalesce(c_{c}.code, -1) END AS {q(c)}" for c in CATEGORICAL] + [
        "CAST(coalesce(t.pdays = -1, false) AS INTEGER) AS pdays_never",
        "round(CAST(t.duration AS DOUBLE) / (t.campaign + 1e-5), 6) AS duration_per_contact"]) + \
    " FROM campaign t " + " ".join(f"LEFT JOIN c_{c} ON CAST(t.{q(c)} AS VARCHAR) = c_{c}.lvl" for c in CATEGORICAL)


@query("recipe_f1", _F1_SQL)
def recipe_f1(spark, sf):
    """Hybrid cell 1: never-contacted flag, duration per contact, ordinal codes fitted on
    the frame itself (NULL stays NULL)."""
    d = camp(spark, sf).select(*CAMPAIGN_COLUMNS)
    return round_doubles(RC.recipe_f1(d))


# ----------------------------------------------------------------------------- F2
def _f2_sql() -> str:
    ctes = [SPLIT_SQL, UNION, f"""
f AS (SELECT u.*, {_MONTH_CASE} AS month_int, {FP} AS user_hash FROM u)""",
            "uc AS (SELECT user_hash AS uh, count(id) AS user_count FROM f GROUP BY user_hash)"]
    for k in RC.F2_KEYS:
        ctes.append(f"g_{k} AS (SELECT {k} AS lvl, " + ", ".join(
            f"avg({t}) AS {t}" for t in RC.F2_TARGETS) + f" FROM f WHERE {k} IS NOT NULL GROUP BY {k})")
    ctes += [_codes_sql(c, "f") for c in CATEGORICAL]
    cols = ["f.id", "f.y", "f.is_train"] + [f"f.{c}" for c in NUMS] + _code_cols(CATEGORICAL) + [
        "CAST(f.month_int AS INTEGER) AS month_int",
        "round(sin(2 * pi() * f.month_int / 12.0), 6) AS month_sin",
        "round(cos(2 * pi() * f.month_int / 12.0), 6) AS month_cos",
        "round(ln(1 + CAST(f.duration AS DOUBLE)), 6) AS duration_log",
        "round(CAST(f.duration AS DOUBLE) / (f.campaign + 1e-5), 6) AS duration_per_campaign",
        "uc.user_count",
        "CAST(coalesce(f.pdays = -1, false) AS INTEGER) AS is_new_client"]
    for k in RC.F2_KEYS:
        for t in RC.F2_TARGETS:
            cols.append(f"round(g_{k}.{t}, 6) AS {t}_mean_by_{k}")
            cols.append(f"round(f.{t} / (g_{k}.{t} + 1e-5), 6) AS {t}_ratio_by_{k}")
    joins = "LEFT JOIN uc ON f.user_hash = uc.uh " + " ".join(
        f"LEFT JOIN g_{k} ON f.{k} = g_{k}.lvl" for k in RC.F2_KEYS) + " " + _code_joins("f", CATEGORICAL)
    return with_campaign(*ctes) + "SELECT " + ", ".join(cols) + " FROM f " + joins


@query("recipe_f2", _f2_sql())
def recipe_f2(spark, sf):
    """Hybrid cell 2 on the tagged train+test union: cyclic month, duration log and
    ratio, fingerprint counts, 4x3 group means and ratios, new-client flag, ordinal codes
    (statistics and codes fitted on the union)."""
    tr, te = train_test(spark, sf)
    return round_doubles(RC.recipe_f2(RC.tagged_union(tr, te)))


# ----------------------------------------------------------------------------- F3
def _f3_sql() -> str:
    ctes = [SPLIT_SQL, UNION, _edges_sql("age", 5, "u").strip().rstrip(","), """
b AS (SELECT u.id, CAST(sum(CASE WHEN u.age > ed.e THEN 1 ELSE 0 END) AS INTEGER) - 1 AS bin
      FROM u CROSS JOIN ed GROUP BY u.id)""", """
f AS (SELECT u.*, CASE WHEN b.bin BETWEEN 0 AND 4 THEN b.bin END AS age_bin FROM u JOIN b ON u.id = b.id)"""]
    for k in ("job", "housing", "age_bin"):
        ctes.append(f"g_{k} AS (SELECT {k} AS lvl, avg(duration) AS m FROM f WHERE {k} IS NOT NULL GROUP BY {k})")
    ctes += [_codes_sql(c, "f") for c in CATEGORICAL]
    cols = ["f.id", "f.y", "f.is_train"] + [f"f.{c}" for c in NUMS] + _code_cols(CATEGORICAL) + [
        "round(ln(1 + CAST(f.duration AS DOUBLE)), 6) AS duration_log",
        "round(CAST(f.duration AS DOUBLE) / (f.campaign + 1e-5), 6) AS efficiency",
        "f.age_bin"] + [
        f"round(f.duration / (g_{k}.m + 1e-5), 6) AS duration_ratio_{k}" for k in ("job", "housing", "age_bin")] + [
        f"CAST({_MONTH_CASE.replace('lower(month)', 'lower(f.month)')} AS INTEGER) AS month_int",
        f"round(sin(2 * pi() * ({_MONTH_CASE.replace('lower(month)', 'lower(f.month)')}) / 12.0), 6) AS month_sin",
        f"round(cos(2 * pi() * ({_MONTH_CASE.replace('lower(month)', 'lower(f.month)')}) / 12.0), 6) AS month_cos",
        "round(sin(2 * pi() * f.day / 31.0), 6) AS day_sin",
        "round(cos(2 * pi() * f.day / 31.0), 6) AS day_cos",
        "CAST(coalesce(f.poutcome = 'success', false) AS INTEGER) AS is_success_prev",
        "CASE WHEN f.pdays = -1 THEN 999 ELSE f.pdays END AS pdays_clean"]
    joins = " ".join(f"LEFT JOIN g_{k} ON f.{k} = g_{k}.lvl" for k in ("job", "housing", "age_bin")) + \
        " " + _code_joins("f", CATEGORICAL)
    return with_campaign(*ctes) + "SELECT " + ", ".join(cols) + " FROM f " + joins


@query("recipe_f3", _f3_sql())
def recipe_f3(spark, sf):
    """Hybrid cell 3 on the tagged union: duration log, efficiency, 5 equal-width age bins,
    duration ratio to job / housing / age-bin means, cyclic month and day, success flag,
    pdays sentinel replaced, ordinal codes (union-fitted)."""
    tr, te = train_test(spark, sf)
    return round_doubles(RC.recipe_f3(RC.tagged_union(tr, te)))


# ----------------------------------------------------------------------------- B / O
def _b_sql() -> str:
    lab = ("'(' || CAST(" + _shown_sql("a.e") + " AS VARCHAR) || ', ' || CAST("
           + _shown_sql("b2.e") + " AS VARCHAR) || ']'")
    ctes = [SPLIT_SQL, _edges_sql("age", 16, "train").strip().rstrip(","), f"""
lab AS (SELECT a.i AS bin, regexp_replace({lab}, '[\\(\\)\\[\\]\\{{\\}}\\:\\"\\,\\.\\s]', '_', 'g') AS label
        FROM ed a JOIN ed b2 ON b2.i = a.i + 1)""", """
bn AS (SELECT t.id, CAST(sum(CASE WHEN t.age > ed.e THEN 1 ELSE 0 END) AS INTEGER) - 1 AS bin
       FROM train t CROSS JOIN ed GROUP BY t.id)""", "mn AS (SELECT min(balance) AS m FROM train)"]
    yn = lambda c: f"CAST(CASE t.{q(c)} WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS {q(c)}"  # noqa
    loans = ("(CAST(coalesce(t.housing = 'yes', false) AS INTEGER) + "
             "CAST(coalesce(t.loan = 'yes', false) AS INTEGER))")
    mcase = _MONTH_CASE.replace("lower(month)", "lower(t.month)")
    cols = ["t.id", "t.y", "t.age", "t.job", "t.marital", "t.education", "t.balance", "t.contact",
            "t.day", "t.duration", "t.campaign", "t.pdays", "t.previous", "t.poutcome",
            yn("default"), yn("housing"), yn("loan"), "lab.label AS age_group",
            "round(ln(1 + (t.balance - mn.m + 1)), 6) AS balance_log",
            "CAST(coalesce(t.balance > 0, false) AS INTEGER) AS balance_positive",
            "CAST(coalesce(t.balance < 0, false) AS INTEGER) AS balance_negative",
            "round(CAST(t.duration AS DOUBLE) / (t.day + 1), 6) AS duration_per_day",
            "round(CAST(t.duration AS DOUBLE) / (t.campaign + 1), 6) AS campaign_efficiency",
            "round(ln(1 + CAST(t.duration AS DOUBLE)), 6) AS duration_log",
            "CAST(t.pdays IS DISTINCT FROM -1 AS INTEGER) AS has_previous_contact",
            "round(CAST(t.previous AS DOUBLE) / ((CASE WHEN t.pdays = -1 THEN 1 ELSE t.pdays END) + 1), 6) AS previous_per_pdays",
            f"round(sin(2 * pi() * ({mcase}) / 12.0), 6) AS month_sin",
            f"round(cos(2 * pi() * ({mcase}) / 12.0), 6) AS month_cos",
            f"{loans} AS total_loans", f"CAST({loans} > 0 AS INTEGER) AS has_any_loan",
            "t.job || '_' || t.education AS job_education",
            "t.contact || '_' || t.month AS contact_month"]
    return (with_campaign(*ctes) + "SELECT " + ", ".join(cols) +
            " FROM train t JOIN bn ON t.id = bn.id LEFT JOIN lab ON bn.bin = lab.bin CROSS JOIN mn")


@query("recipe_b", _b_sql())
def recipe_b(spark, sf):
    """One-hot notebooks' features on the train part, bins and minimum fitted on that
    frame itself (the reference's per-frame scope)."""
    tr, _ = train_test(spark, sf)
    out, _cats = RC.recipe_b(tr.select(*CAMPAIGN_COLUMNS))
    return round_doubles(out)


# ----------------------------------------------------------------------------- L / T
def _l_sql(interactions: bool) -> str:
    cats = RC.T_CATS if interactions else RC.ENC_CATS
    mc = _MONTH_CASE.replace("lower(month)", "lower(x.month)")
    loans = ("(CAST(coalesce(x.housing = 'yes', false) AS INTEGER) + "
             "CAST(coalesce(x.loan = 'yes', false) AS INTEGER))")

    def base(src: str) -> str:
        extra = (", x.job || '_' || x.education AS job_education, "
                 "x.marital || '_' || x.education AS marital_education, "
                 "x.contact || '_' || x.month AS contact_month") if interactions else ""
        return (f"SELECT x.* EXCLUDE ({q('default')}, housing, loan), "
                + ", ".join(f"CAST(CASE x.{q(c)} WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS {q(c)}"
                            for c in ("default", "housing", "loan"))
                + f", {AGE_CASE.replace('age', 'x.age').replace('x.age_group', 'age_group')} AS age_group, "
                f"ln(1 + (x.balance - (SELECT min(balance) FROM train) + 1)) AS balance_log, "
                "CAST(x.duration AS DOUBLE) / (x.day + 1) AS duration_per_day, "
                "CAST(x.duration AS DOUBLE) / (x.campaign + 1) AS campaign_efficiency, "
                "CAST(x.pdays IS DISTINCT FROM -1 AS INTEGER) AS has_previous_contact, "
                "CAST(x.previous AS DOUBLE) / ((CASE WHEN x.pdays = -1 THEN 1 ELSE x.pdays END) + 1) AS previous_success_rate, "
                f"{loans} AS total_loans, CAST({loans} > 0 AS INTEGER) AS has_any_loan"
                + ("" if interactions else
                   f", sin(2 * pi() * ({mc}) / 12.0) AS month_sin, cos(2 * pi() * ({mc}) / 12.0) AS month_cos")
                + f"{extra} FROM {src} x")

    ctes = [SPLIT_SQL, f"trx AS ({base('train')})", f"tex AS ({base('test')})"]
    ctes += [_te_sql(c).replace(f"SELECT {c} AS", f"SELECT {q(c)} AS").replace(
        f"WHERE {c} IS", f"WHERE {q(c)} IS").replace(f"GROUP BY {c})", f"GROUP BY {q(c)})") for c in cats]
    freq = [_freq_sql(c).replace(f"SELECT {c} AS", f"SELECT {q(c)} AS").replace(
        f"WHERE {c} IS", f"WHERE {q(c)} IS").replace(f"GROUP BY {c})", f"GROUP BY {q(c)})") for c in cats]
    ctes += freq + [_codes_sql(c, "trx") for c in cats]
    drop_month = "" if interactions else ", month"
    dbl = ["balance_log", "duration_per_day", "campaign_efficiency", "previous_success_rate"] + (
        [] if interactions else ["month_sin", "month_cos"])
    keep = f"t.* EXCLUDE ({', '.join(q(c) for c in cats)}{drop_month}, {', '.join(dbl)})"
    cols = [keep] + [f"round(t.{c}, 6) AS {c}" for c in dbl] + _code_cols(cats) + [
        f"round(coalesce(t_{c}.enc, (SELECT avg(enc) FROM t_{c})), 6) AS {c}_target_enc" for c in cats] + [
        f"round(coalesce(f_{c}.freq, (SELECT min(freq) FROM f_{c})), 6) AS {c}_freq" for c in cats]
    joins = " ".join(f"LEFT JOIN t_{c} ON t.{q(c)} = t_{c}.lvl LEFT JOIN f_{c} ON t.{q(c)} = f_{c}.lvl"
                     for c in cats) + " " + _code_joins("t", cats)
    return with_campaign(*ctes) + "SELECT " + ", ".join(cols) + " FROM tex t " + joins


@query("recipe_l", _l_sql(False))
def recipe_l(spark, sf):
    """Fitted-encoder recipe: state (balance minimum, smoothed target means, frequencies,
    label codes) fitted on train, applied to test; unseen -> mean / min / -1."""
    tr, te = train_test(spark, sf)
    fitted = RC.fit_recipe_l(tr.select(*CAMPAIGN_COLUMNS), sentinel=-1, interactions=False)
    return round_doubles(fitted.transform(te))


@query("recipe_l_reloaded", _l_sql(False))
def recipe_l_reloaded(spark, sf):
    """``recipe_l`` with its encoders saved as parquet and loaded again."""
    from tabrix.operators.persist import load, save
    from tabrix.sources.io import scratch_path
    tr, te = train_test(spark, sf)
    fitted = RC.fit_recipe_l(tr.select(*CAMPAIGN_COLUMNS), sentinel=-1, interactions=False)
    path = scratch_path(spark, "recipe_l_state")
    save(fitted.encoders, path, spark)
    fitted.encoders = load(spark, path)
    return round_doubles(fitted.transform(te))


@query("recipe_t", _l_sql(True))
def recipe_t(spark, sf):
    """Same with interaction categories (13 encoded columns, month kept)."""
    tr, te = train_test(spark, sf)
    fitted = RC.fit_recipe_l(tr.select(*CAMPAIGN_COLUMNS), sentinel=-1, interactions=True)
    return round_doubles(fitted.transform(te))


@query("stream_encode_test", _l_sql(False))
def stream_encode_test(spark, sf):
    """The fitted-encoder recipe applied to the test rows arriving as a stream: test rows
    are landed as parquet files, read with ``readStream``, encoded with state fitted on the
    batch train part (stream-static joins), written by an ``availableNow`` query and read
    back.  Same rows as ``recipe_l``."""
    import uuid

    from tabrix.sources import io
    from tabrix.streaming import scoring as ST
    tr, te = train_test(spark, sf)
    fitted = RC.fit_recipe_l(tr.select(*CAMPAIGN_COLUMNS), sentinel=-1, interactions=False)
    tag = uuid.uuid4().hex[:10]
    src = io.scratch_path(spark, f"stream_src_{tag}")
    te.write.mode("overwrite").parquet(src)
    stream = ST.read_stream(spark, src, te.schema, max_files_per_trigger=4)
    sink = io.scratch_path(spark, f"stream_sink_{tag}")
    ST.run_available(ST.score_stream(stream, lambda d: round_doubles(fitted.transform(d))), sink)
    return spark.read.parquet(sink)
