"""Registered queries: encoders of all folds (E1-E4, E6, W1), median sketches (A8), reject
tables (S1, R7), co-located scores (J4, G9-G11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabrix.operators import colocated as C
from tabrix.operators import sketches as K
from tabrix.operators.fold_encoders import FoldEncoders
from tabrix.operators.sampling import kfold
from tabrix.plans.common import camp, rnd
from tabrix.plans.oracle_base import with_campaign
from tabrix.plans.q_models import FOLD_SCORES_SQL, fold_scores
from tabrix.plans.q_scalar import FIXED_SCORE_SQL, fixed_score
from tabrix.plans.registry import query
from tabrix.sources import io
from tabrix.sources.fixture import CAMPAIGN_COLUMNS
from tabrix.sources.rejects import cast_with_rejects, read_with_rejects

_CATS, _MEANS, _NUMS = ["job", "education", "contact"], ["balance", "duration"], ["age", "pdays"]
_KEYS = [f"{c}_{s}" for c in _CATS for s in ("target_enc", "freq", "code")]
# ages of every seventh row are hidden, so that there is something to impute
_FOLDS = """
kf AS (SELECT id, y, job, education, contact, balance, duration,
              CASE WHEN id % 7 = 0 THEN NULL ELSE age END AS age,
              CASE WHEN pdays < 0 THEN NULL ELSE pdays END AS pdays,
              CAST((row_number() OVER (PARTITION BY y ORDER BY md5(concat(CAST(id AS VARCHAR), ':', '42')), id) - 1) % 5 AS INTEGER) AS fold
       FROM campaign)""", """
o AS (SELECT f.fold AS f, k.* EXCLUDE (fold) FROM kf k JOIN (SELECT DISTINCT fold FROM kf) f ON k.fold <> f.fold)""", """
g AS (SELECT f, avg(y) AS g FROM o GROUP BY f)"""


def _level_sql(c: str) -> str:
    means = ", ".join(f"avg(CAST({t} AS DOUBLE)) AS {t}_mean" for t in _MEANS)
    return f"""
s_{c} AS (SELECT o.f, o.{c} AS lvl, (avg(y) * count(*) + max(g.g) * 10.0) / (count(*) + 10.0) AS enc,
       count(*) / CAST(sum(count(*)) OVER (PARTITION BY o.f) AS DOUBLE) AS freq,
       CAST(row_number() OVER (PARTITION BY o.f ORDER BY o.{c}) - 1 AS INTEGER) AS code, {means}
  FROM o JOIN g ON o.f = g.f WHERE o.{c} IS NOT NULL GROUP BY o.f, o.{c}),
d_{c} AS (SELECT f, avg(enc) AS enc, min(freq) AS freq FROM s_{c} GROUP BY f)"""


def _fold_sql() -> str:
    med = "m AS (SELECT f, " + ", ".join(
        f"median(CAST({n} AS DOUBLE)) AS {n}" for n in _NUMS) + " FROM o GROUP BY f)"
    out = ["k.id", "k.fold", *[f"round(coalesce(CAST(k.{n} AS DOUBLE), m.{n}), 6) AS {n}" for n in _NUMS]]
    for c in _CATS:
        out += [f"round(coalesce(s_{c}.enc, d_{c}.enc), 6) AS {c}_target_enc",
                f"round(coalesce(s_{c}.freq, d_{c}.freq), 6) AS {c}_freq",
                f"coalesce(s_{c}.code, -1) AS {c}_code",
                *[f"round(s_{c}.{t}_mean, 6) AS {t}_mean_by_{c}" for t in _MEANS]]
    joins = " ".join(f"LEFT JOIN s_{c} ON k.{c} = s_{c}.lvl AND k.fold = s_{c}.f "
                     f"JOIN d_{c} ON k.fold = d_{c}.f" for c in _CATS)
    return with_campaign(*_FOLDS, *[_level_sql(c) for c in _CATS], med) + (
        f"SELECT {', '.join(out)} FROM kf k JOIN m ON k.fold = m.f {joins}")


@query("e_fold_encoders", _fold_sql())
def fold_encoders(spark, sf):
    """E1-E4, E6, W1 for cross-validation: every row with the encoders that have not seen its
    fold, all five fitted from one scan."""
    d = camp(spark, sf).select(
        "id", "y", *_CATS, *_MEANS, F.when(F.col("id") % 7 != 0, F.col("age")).alias("age"),
        F.when(F.col("pdays") >= 0, F.col("pdays")).alias("pdays"))
    d = kfold(d, k=5, seed=42, y="y")
    out = FoldEncoders(_CATS, targets=_MEANS, numeric=_NUMS).fit(d).out_of_fold(d)
    return out.select(
        "id", "fold", *[rnd(n, n) for n in _NUMS],
        *[F.col(k) if k.endswith("_code") else rnd(k, k) for k in _KEYS],
        *[rnd(f"{t}_mean_by_{c}", f"{t}_mean_by_{c}") for c in _CATS for t in _MEANS])


_SKETCHED = ["age", "balance", "duration", "campaign", "pdays", "previous"]


@query("a8_median_sketch", with_campaign() + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, true AS within_bound FROM campaign"
    for c in _SKETCHED))
def a8_sketch(spark, sf):
    """A8 approximate: sketches per month merged; whether the rank of each median, counted on
    all rows, lies within twice the stated rank error of one half."""
    d = camp(spark, sf).select("month", *_SKETCHED)
    merged = K.merge_sketches(K.quantile_sketches(d, _SKETCHED, by=["month"]))
    med = K.sketch_quantiles(merged, {"median": 0.5})
    long = d.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v"))
        for c in _SKETCHED])).alias("s")).select("s.*").where("v is not null")
    rank = (long.join(F.broadcast(med), "feature").groupBy("feature")  # one row a column
            .agg(F.max("n").alias("n"), F.count_if(F.col("v") < F.col("median")).alias("low"),
                 F.count_if(F.col("v") <= F.col("median")).alias("high")))
    gap = F.greatest(F.lit(0.0), F.col("low") / F.col("n") - 0.5, 0.5 - F.col("high") / F.col("n"))
    return rank.select("feature", "n", (gap <= 2 * K.rank_error()).alias("within_bound"))


_DIRTY_SQL = """
dirty AS (SELECT id, age, balance, job, id % 11 = 3 AS bad_age, id % 13 = 5 AS bad_balance
          FROM campaign)"""


@query("s1_read_with_rejects", with_campaign(_DIRTY_SQL) + """
SELECT id, CASE WHEN bad_age OR bad_balance THEN NULL ELSE age END AS age,
       CASE WHEN bad_age OR bad_balance THEN NULL ELSE balance END AS balance,
       CASE WHEN bad_age OR bad_balance THEN NULL ELSE job END AS job,
       CAST(CASE WHEN bad_age THEN 1 ELSE 0 END + CASE WHEN bad_balance THEN 1 ELSE 0 END AS INTEGER) AS n_errors
FROM dirty""")
def s1_rejects(spark, sf):
    """The campaign rows written as CSV with spoilt ages and balances and read back: accepted
    rows as they are, rejected ones by the id in their record."""
    d = camp(spark, sf).select("id", "age", "balance", "job")
    path = io.scratch_path(spark, "s1_dirty_csv")
    (d.select("id", F.when(F.col("id") % 11 == 3, F.concat(F.lit("x"), F.coalesce(
        F.col("age").cast("string"), F.lit(""))))
              .otherwise(F.col("age").cast("string")).alias("age"),
              F.when(F.col("id") % 13 == 5, F.lit("1,5")).otherwise(
                  F.col("balance").cast("string")).alias("balance"), "job")
     .write.option("header", True).csv(path))
    got = read_with_rejects(spark, path, d.schema)
    bad = got.rejects.select(F.get_json_object("record", "$.id").cast("long").alias("id"),
                             F.size("errors").alias("n_errors"))
    return got.rows.withColumn("n_errors", F.lit(0)).unionByName(bad, allowMissingColumns=True)


@query("r7_cast_with_rejects", with_campaign() + """
SELECT id, try_cast(substr(contact, 1, 1) || CASE WHEN id % 9 = 2 THEN '?' ELSE '' END AS INTEGER) AS priority
FROM campaign WHERE id % 9 <> 2""")
def r7_rejects(spark, sf):
    """The leading digit of the order priority as a number, spoilt on every ninth row."""
    d = camp(spark, sf).select("id", F.concat(
        F.substring("contact", 1, 1),
        F.when(F.col("id") % 9 == 2, F.lit("?")).otherwise(F.lit(""))).alias("priority"))
    return cast_with_rejects(d, {"priority": "int"}).rows


@query("j4_attach_colocated", with_campaign() + f"SELECT id, job, y, {FIXED_SCORE_SQL} AS p FROM campaign")
def j4_colocated(spark, sf):
    """J4 on two tables bucketed by id: no exchange, one-to-one checked in the same pass."""
    d = camp(spark, sf)
    scores = C.bucketed(d.select("id", fixed_score(d).alias("p")))
    return C.attach_colocated(C.bucketed(d.select("id", "job", "y")), scores)


@query("g11_blend_colocated", with_campaign(FOLD_SCORES_SQL) + """
SELECT id, round(0.7 * avg(CASE WHEN model = 'gbt' THEN p END)
                 + 0.3 * avg(CASE WHEN model = 'forest' THEN p END), 6) AS p FROM sc GROUP BY id""")
def g11_colocated(spark, sf):
    """Fold and seed means and the blend from one bucketed table, no exchange."""
    table = C.bucketed(fold_scores(spark, sf).select("id", "model", "p"))
    got = C.blend_colocated(table, {"gbt": 0.7, "forest": 0.3}, each=None)
    return got.select("id", F.round("p", 6).alias("p"))
