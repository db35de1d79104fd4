"""Registered queries: sources/sinks (S), profiling (P), schema (R), aggregations (A),
group statistics (W), joins (J) and set operators (U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrix.functions import scalar as M
from tabrix.operators import encoders as enc
from tabrix.operators import groupstats as G
from tabrix.operators import joins as J
from tabrix.operators import profile as P
from tabrix.operators import schema as R
from tabrix.operators.sampling import carve_holdout
from tabrix.plans.common import SPLIT_SQL, camp, rnd, train_test
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.q_scalar import FIXED_SCORE_SQL, fixed_score
from tabrix.plans.registry import query
from tabrix.sources import io
from tabrix.sources.fixture import CAMPAIGN_COLUMNS, CATEGORICAL

W = with_campaign()
WS = with_campaign(SPLIT_SQL)


# ------------------------------------------------------------------ S: sources and sinks
@query("s1_read_table", W + "SELECT * FROM campaign")
def s1(spark, sf):
    """Write the campaign rows as header CSV, read back with the declared schema."""
    d = camp(spark, sf).select(*CAMPAIGN_COLUMNS)
    path = io.scratch_path(spark, "s1_campaign_csv")
    d.write.mode("overwrite").option("header", True).csv(path)
    return io.read_table(spark, path, io.CAMPAIGN_SCHEMA, "csv")


_CARVE = with_campaign("""
ck AS (SELECT c.*, row_number() OVER (ORDER BY md5(concat(CAST(id AS VARCHAR), ':', '99')), id) AS _rk
       FROM campaign c)""")


@query("s2_read_or_holdout", _CARVE + """
SELECT CAST(1000000000 + _rk - 1 AS BIGINT) AS id, * EXCLUDE (id, y, _rk) FROM ck WHERE _rk <= 2000""")
def s2(spark, sf):
    """The test file is missing, so a 2000-row pseudo-test is carved from train."""
    d = camp(spark, sf).select(*CAMPAIGN_COLUMNS)
    _, test = io.read_or_holdout(spark, d, f"{sf}/no_such_test_table.csv", 2000, 99,
                                 1_000_000_000)
    return test


@query("s3_carve_holdout", _CARVE + "SELECT * EXCLUDE (_rk) FROM ck WHERE _rk > 2000")
def s3(spark, sf):
    """S3: train after carving (sampled rows removed)."""
    d = camp(spark, sf).select(*CAMPAIGN_COLUMNS)
    train, _ = carve_holdout(d, 2000, 99, 1_000_000_000)
    return train


@query("s4_submission_headerless", W + f"""
SELECT id, CAST({FIXED_SCORE_SQL} > 0.05 AS INTEGER) AS y FROM campaign""")
def s4(spark, sf):
    """Write (id, y) without header, read it back."""
    d = camp(spark, sf)
    sub = d.select("id", M.binarize(fixed_score(d), 0.05).alias("y"))
    path = io.scratch_path(spark, "s4_submission")
    io.write_submission(sub, path, header=False)
    return spark.read.schema("id long, y int").option("header", False).csv(path)


@query("s5_submission_with_proba", W + f"""
SELECT id, {FIXED_SCORE_SQL} AS y_proba, CAST({FIXED_SCORE_SQL} > 0.05 AS INTEGER) AS y_pred
FROM campaign""")
def s5(spark, sf):
    """Write (id, y_proba, y_pred) with header, read it back."""
    d = camp(spark, sf)
    p = fixed_score(d)
    sub = d.select("id", p.alias("y_proba"), M.binarize(p, 0.05).alias("y_pred"))
    path = io.scratch_path(spark, "s5_submission")
    io.write_submission(sub, path, header=True)
    return (spark.read.schema("id long, y_proba double, y_pred int").option("header", True)
            .csv(path))


@query("s6_head", W + "SELECT * FROM campaign ORDER BY id LIMIT 5")
def s6(spark, sf):
    return io.head(camp(spark, sf).select(*CAMPAIGN_COLUMNS), 5, "id")


# ------------------------------------------------------------------ P: profiling
@query("p1_shape", W + "SELECT count(*) AS n_rows, CAST(18 AS BIGINT) AS n_cols FROM campaign")
def p1(spark, sf):
    return P.shape(camp(spark, sf).select(*CAMPAIGN_COLUMNS))


@query("p2_value_counts", W + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(\"{c}\" AS VARCHAR) AS value, count(*) AS n FROM campaign "
    f"WHERE \"{c}\" IS NOT NULL GROUP BY \"{c}\"" for c in CATEGORICAL))
def p2(spark, sf):
    return P.value_counts(camp(spark, sf), CATEGORICAL)


@query("p3_positive_rate", W + "SELECT round(avg(CAST(y AS DOUBLE)), 6) AS positive_rate FROM campaign")
def p3(spark, sf):
    return P.positive_rate(camp(spark, sf)).select(rnd("positive_rate", "positive_rate"))


_TYPES = {"id": "bigint", "age": "int", "balance": "double", "day": "int", "duration": "int",
          "campaign": "int", "pdays": "int", "previous": "int", "y": "int"}


@query("p4_profile", W + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_TYPES.get(c, 'string')}' AS dtype, count(\"{c}\") AS non_null "
    f"FROM campaign" for c in CAMPAIGN_COLUMNS))
def p4(spark, sf):
    return P.profile(camp(spark, sf).select(*CAMPAIGN_COLUMNS))


@query("p5_class_counts", W + "SELECT y, count(*) AS n FROM campaign GROUP BY y")
def p5(spark, sf):
    return P.class_counts(camp(spark, sf))


# ------------------------------------------------------------------ R: projection / schema
@query("r1_filter_class", W + "SELECT * FROM campaign WHERE y = 1")
def r1(spark, sf):
    return camp(spark, sf).select(*CAMPAIGN_COLUMNS).where(F.col("y") == 1)


@query("r2_drop_select", W + "SELECT * EXCLUDE (id, y) FROM campaign")
def r2(spark, sf):
    return camp(spark, sf).select(*CAMPAIGN_COLUMNS).drop("id", "y")


@query("r3_tag_origin", WS + """
SELECT *, 1 AS is_train FROM train UNION ALL SELECT *, CAST(NULL AS INTEGER) AS y, 0 AS is_train FROM test""")
def r3(spark, sf):
    tr, te = train_test(spark, sf)
    return R.tag_origin(tr.select(*CAMPAIGN_COLUMNS), te)


@query("r4_split_origin", WS + "SELECT * FROM test")
def r4(spark, sf):
    tr, te = train_test(spark, sf)
    _, back = R.split_origin(R.tag_origin(tr.select(*CAMPAIGN_COLUMNS), te))
    return back


_CONTACTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("r5_align_columns", WS + "SELECT id, " + ", ".join(
    ["CAST(0 AS INTEGER) AS \"poutcome_other\""] +
    [f"CAST(coalesce(poutcome = '{v}', false) AS INTEGER) AS \"poutcome_{v}\""
     for v in ("success", "unknown")]) + " FROM test WHERE poutcome <> 'other'")
def r5(spark, sf):
    """One-hot fitted on each frame alone ('self' scope); the test part lacks a level
    (all 'other' rows removed), so its columns are aligned to train's: missing -> 0."""
    tr, te = train_test(spark, sf)
    te = te.where(F.col("poutcome") != "other")
    a_lv = enc.OneHotEncoder(["poutcome"]).fit(tr)
    b_lv = enc.OneHotEncoder(["poutcome"]).fit(te)
    a = enc.one_hot_transform(tr.select("id", "poutcome"), a_lv)
    b = enc.one_hot_transform(te.select("id", "poutcome"), b_lv)
    return R.align_columns(b, a, exclude=("y",))


@query("r6_sanitize_columns", W + "SELECT id, " + ", ".join(
    f"CAST(contact = '{v}' AS INTEGER) AS \"contact_{R.clean_name(v)}\"" for v in _CONTACTS[1:])
    + " FROM campaign")
def r6(spark, sf):
    d = camp(spark, sf).select("id", "contact")
    oh = enc.one_hot_transform(d, enc.OneHotEncoder(["contact"]).fit(d))
    return R.sanitize_columns(oh)


@query("r7_cast", W + """
SELECT id, TRY_CAST(contact AS INTEGER) AS contact, TRY_CAST(substr(contact, 1, 1) AS INTEGER) AS contact_rank,
       CAST(trunc(balance) AS BIGINT) AS balance, CAST(day AS VARCHAR) AS day FROM campaign""")
def r7(spark, sf):
    d = camp(spark, sf).select("id", "contact", "balance", "day",
                               F.substring("contact", 1, 1).alias("contact_rank"))
    out = R.cast_columns(d, {"contact": "int", "contact_rank": "int"}, safe=True)
    out = R.cast_columns(out, {"balance": "bigint", "day": "string"}, safe=False)
    return out.select("id", "contact", "contact_rank", "balance", "day")


# ------------------------------------------------------------------ A: aggregations
@query("a1_mean_by_key", W + """
SELECT job, round(avg(duration), 6) AS duration_mean FROM campaign WHERE job IS NOT NULL GROUP BY job""")
def a1(spark, sf):
    return G.mean_by(camp(spark, sf), "job", "duration").select(
        "job", rnd("duration_mean", "duration_mean"))


@query("a2_size_by_key", W + "SELECT education, count(*) AS n FROM campaign GROUP BY education")
def a2(spark, sf):
    return G.size_by(camp(spark, sf), "education")


@query("a3_global_mean", W + "SELECT round(avg(y), 6) AS y_mean FROM campaign")
def a3(spark, sf):
    return G.global_mean(camp(spark, sf), "y").select(rnd("y_mean", "y_mean"))


@query("a4_min_max", W + "SELECT min(balance) AS balance_min, max(balance) AS balance_max FROM campaign")
def a4(spark, sf):
    return G.global_min_max(camp(spark, sf), "balance")


_FP = " || ".join(f"coalesce(CAST({c} AS VARCHAR), 'nan')"
                  for c in ["age", "job", "marital", "education", "housing", "loan"])


@query("a5_count_id_by_key", W + f"""
SELECT {_FP} AS user_hash, count(id) AS n FROM campaign GROUP BY 1""")
def a5(spark, sf):
    d = camp(spark, sf)
    d = d.select("id", M.fingerprint(["age", "job", "marital", "education", "housing",
                                      "loan"]).alias("user_hash"))
    return G.count_id_by(d, "user_hash")


@query("a6_relative_frequency", W + """
SELECT contact, round(count(*) / (SELECT count(*) FROM campaign WHERE contact IS NOT NULL), 6) AS freq
FROM campaign WHERE contact IS NOT NULL GROUP BY contact""")
def a6(spark, sf):
    return G.relative_frequency(camp(spark, sf), "contact").select("contact", rnd("freq", "freq"))


@query("a7_mean_std_pop", W + """
SELECT round(avg(balance), 6) AS mean, round(stddev_pop(balance), 6) AS std FROM campaign""")
def a7(spark, sf):
    return G.mean_std_pop(camp(spark, sf), "balance").select(rnd("mean", "mean"), rnd("std", "std"))


_MED = ["age", "balance", "duration", "campaign", "pdays"]


@query("a8_medians", W + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(median(CAST({c} AS DOUBLE)), 6) AS median FROM campaign"
    for c in _MED))
def a8(spark, sf):
    return G.medians(camp(spark, sf), _MED).select("feature", rnd("median", "median"))


_A9_SQL = with_campaign("""
g AS (SELECT avg(y) AS gm FROM campaign)""", """
te AS (SELECT 'job' AS feature, (avg(y) * count(*) + (SELECT gm FROM g) * 10.0) / (count(*) + 10.0) AS enc
       FROM campaign WHERE job IS NOT NULL GROUP BY job
       UNION ALL
       SELECT 'education', (avg(y) * count(*) + (SELECT gm FROM g) * 10.0) / (count(*) + 10.0)
       FROM campaign WHERE education IS NOT NULL GROUP BY education)""", """
fr AS (SELECT 'job' AS feature, count(*) / (SELECT count(job) FROM campaign) AS freq
       FROM campaign WHERE job IS NOT NULL GROUP BY job
       UNION ALL
       SELECT 'education', count(*) / (SELECT count(education) FROM campaign)
       FROM campaign WHERE education IS NOT NULL GROUP BY education)""") + """
SELECT t.feature, round(t.enc_default, 6) AS target_default, round(f.freq_default, 6) AS freq_default
FROM (SELECT feature, avg(enc) AS enc_default FROM te GROUP BY feature) t
JOIN (SELECT feature, min(freq) AS freq_default FROM fr GROUP BY feature) f USING (feature)"""


@query("a9_encoder_defaults", _A9_SQL)
def a9(spark, sf):
    """Unseen-level defaults of fitted encoders: unweighted mean of the target
    encodings, minimum of the frequencies (aggregates over the fitted lookup)."""
    d = camp(spark, sf)
    te = enc.TargetEncoder(["job", "education"]).fit(d)
    fr = enc.FrequencyEncoder(["job", "education"]).fit(d)
    t = te.table.groupBy("feature").agg(F.avg("enc").alias("target_default"))
    f = fr.table.groupBy("feature").agg(F.min("freq").alias("freq_default"))
    return t.join(f, "feature").select("feature", rnd("target_default", "target_default"),
                                       rnd("freq_default", "freq_default"))


# ------------------------------------------------------------------ W: group stats to rows
_W1_KEYS = ["job", "education", "marital", "contact"]
_W1_T = ["duration", "balance", "pdays"]


def _w1_sql() -> str:
    ctes = [f"g_{k} AS (SELECT {k} AS lvl, " + ", ".join(f"avg({t}) AS {t}" for t in _W1_T)
            + f" FROM campaign WHERE {k} IS NOT NULL GROUP BY {k})" for k in _W1_KEYS]
    cols = ["c.id"]
    for k in _W1_KEYS:
        for t in _W1_T:
            cols.append(f"round(g_{k}.{t}, 6) AS {t}_mean_by_{k}")
            cols.append(f"round(c.{t} / (g_{k}.{t} + 1e-5), 6) AS {t}_ratio_by_{k}")
    joins = " ".join(f"LEFT JOIN g_{k} ON c.{k} = g_{k}.lvl" for k in _W1_KEYS)
    return with_campaign(*ctes) + "SELECT " + ", ".join(cols) + " FROM campaign c " + joins


@query("w1_group_means", _w1_sql())
def w1(spark, sf):
    """W1+W2: 4 keys x 3 targets group means and ratios, statistics in one scan."""
    d = camp(spark, sf)
    out = G.add_group_means(d.select("id", *_W1_KEYS, *_W1_T), _W1_KEYS, _W1_T)
    cols = ["id"] + [f"{t}_{kind}_by_{k}" for k in _W1_KEYS for t in _W1_T
                     for kind in ("mean", "ratio")]
    return out.select(*[rnd(c, c) if c != "id" else F.col(c) for c in cols])


@query("w2_group_ratio", with_campaign(
    "g AS (SELECT housing AS lvl, avg(duration) AS m FROM campaign WHERE housing IS NOT NULL GROUP BY housing)")
    + """SELECT c.id, round(c.duration / (g.m + 1e-5), 6) AS duration_ratio_housing
    FROM campaign c LEFT JOIN g ON c.housing = g.lvl""")
def w2(spark, sf):
    d = camp(spark, sf).select("id", "housing", "duration")
    out = G.add_group_means(d, ["housing"], ["duration"], ratio_fmt="{t}_ratio_{k}")
    return out.select("id", rnd("duration_ratio_housing", "duration_ratio_housing"))


@query("w3_group_count", W + f"""
SELECT id, count(id) OVER (PARTITION BY {_FP}) AS user_count FROM campaign""")
def w3(spark, sf):
    d = camp(spark, sf)
    d = d.select("id", M.fingerprint(["age", "job", "marital", "education", "housing",
                                      "loan"]).alias("user_hash"))
    return G.add_group_count(d, "user_hash").select("id", "user_count")


# ------------------------------------------------------------------ J: joins
_J_SQL = with_campaign(SPLIT_SQL, """
m AS (SELECT job AS lvl, avg(duration) AS job_duration_mean FROM train WHERE job IS NOT NULL GROUP BY job)""")


@query("j1_lookup", _J_SQL + """
SELECT t.id, t.job, round(m.job_duration_mean, 6) AS job_duration_mean FROM test t LEFT JOIN m ON t.job = m.lvl""")
def j1(spark, sf):
    tr, te = train_test(spark, sf)
    lk = G.mean_by(tr, "job", "duration", "job_duration_mean")
    out = J.lookup(te.select("id", "job"), lk, "job", ["job_duration_mean"], rows=None)
    return out.select("id", "job", rnd("job_duration_mean", "job_duration_mean"))


@query("j2_lookup_default", with_campaign(SPLIT_SQL, """
f AS (SELECT cm, count(*) / (SELECT count(*) FROM train) AS freq
      FROM (SELECT contact || '_' || month AS cm FROM train) GROUP BY cm)""") + """
SELECT t.id, t.contact_month, round(coalesce(f.freq, (SELECT min(freq) FROM f)), 6) AS contact_month_freq
FROM (SELECT id, contact || '_' || month AS contact_month FROM test) t
LEFT JOIN f ON t.contact_month = f.cm""")
def j2(spark, sf):
    """Frequency lookup fitted on train; unseen test levels get the minimum."""
    tr, te = train_test(spark, sf)
    cm = M.interaction("contact", "month").alias("contact_month")
    fitted = enc.FrequencyEncoder(["contact_month"]).fit(tr.select(cm))
    out = enc.frequency_transform(fitted, te.select("id", cm), ["contact_month"])
    return out.select("id", "contact_month", rnd("contact_month_freq", "contact_month_freq"))


@query("j3_anti_join", _CARVE + "SELECT * EXCLUDE (_rk) FROM ck WHERE _rk > 1000")
def j3(spark, sf):
    from tabrix.operators.sampling import sample_n
    d = camp(spark, sf).select(*CAMPAIGN_COLUMNS)
    return J.exclude(d, sample_n(d, 1000, seed=99), "id")


@query("j4_attach_scores", W + f"SELECT id, job, y, {FIXED_SCORE_SQL} AS p FROM campaign")
def j4(spark, sf):
    d = camp(spark, sf)
    scores = d.select("id", fixed_score(d).alias("p"))
    return J.attach_scores(d.select("id", "job", "y"), scores, "id")


# ------------------------------------------------------------------ U: set operators
@query("u1_stack_train_test", WS + """
SELECT * FROM train UNION ALL SELECT *, CAST(NULL AS INTEGER) AS y FROM test""")
def u1(spark, sf):
    tr, te = train_test(spark, sf)
    return R.stack(tr.select(*CAMPAIGN_COLUMNS), te)


@query("u2_stack_class_samples", W + """
SELECT id, y FROM campaign WHERE y = 1 UNION ALL SELECT id, y FROM campaign WHERE y = 0""")
def u2(spark, sf):
    d = camp(spark, sf).select("id", "y")
    return R.stack(d.where("y = 1"), d.where("y = 0"))


@query("u3_append_pseudo_labels", with_campaign(SPLIT_SQL, f"""
ts AS (SELECT id, {FIXED_SCORE_SQL} AS p FROM test)""", """
r AS (SELECT id, row_number() OVER (ORDER BY p, id) AS rk, count(*) OVER () AS n FROM ts)""", """
lab AS (SELECT id, CAST(CASE WHEN rk > n - floor(0.05 * n) THEN 1 ELSE 0 END AS INTEGER) AS y
        FROM r WHERE rk <= floor(0.05 * n) OR rk > n - floor(0.05 * n))""") + """
SELECT id, age, duration, y FROM train
UNION ALL SELECT t.id, t.age, t.duration, lab.y FROM test t JOIN lab ON t.id = lab.id""")
def u3(spark, sf):
    """Test rows at the extremes of a score (top / bottom 5% -> 1 / 0) appended, with
    their features and pseudo labels, to the training rows."""
    from tabrix.operators import ensemble as EN
    tr, te = train_test(spark, sf)
    scores = te.select("id", fixed_score(te).alias("p"))
    labels = EN.pseudo_labels(scores, 0.05)
    return EN.augment(tr.select("id", "age", "duration", "y"),
                      te.select("id", "age", "duration"), labels)
