"""Feature recipes of the reference notebooks, each one ``select`` over fitted state.

* ``recipe_b``  one-hot notebooks (per-frame bins, shifted log, ratios, cyclic month,
  loan counts, yes/no maps, interactions) -> (frame, categorical columns)
* ``recipe_l``  fitted-encoder notebook: fixed age cut, ratios, target / frequency /
  label encoders fitted on train and applied to any frame
* ``recipe_t``  like L with interaction categories
* ``recipe_f1`` / ``recipe_f2`` / ``recipe_f3`` hybrid-ensemble notebook cells (F2/F3 fit
  group statistics and ordinal codes on the train+test union)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions import scalar as M
from tabrix.operators import encoders as enc
from tabrix.operators import groupstats as G
from tabrix.operators import schema as R
from tabrix.sources.fixture import CATEGORICAL

ONE_HOT_CATS = ["job", "marital", "education", "contact", "poutcome", "age_group"]
ENC_CATS = ["job", "marital", "education", "contact", "poutcome", "age_group"]
T_CATS = ["job", "marital", "education", "default", "housing", "loan", "contact", "month",
          "poutcome", "age_group", "job_education", "marital_education", "contact_month"]


def recipe_b(df: DataFrame, bins: int = 16, fit_on: DataFrame | None = None,
             name_chars: str = M.NAME_CHARS_B) -> tuple[DataFrame, list[str]]:
    """One-hot notebooks' features.  ``fit_on`` (default: ``df`` itself, the reference's
    per-frame behaviour) supplies the age range and the balance minimum."""
    src = fit_on if fit_on is not None else df
    cut = M.WidthCut(bins).fit(src, "age")
    bal_min = src.agg(F.min("balance")).scalar()
    month_n = M.month_number("month")
    ms, mc = M.cyclic(month_n, 12)
    loans = M.count_yes(["housing", "loan"])
    keep = [c for c in df.columns if c not in ("month", "default", "housing", "loan")]
    out = df.select(
        *keep,
        *[M.yes_no(c).alias(c) for c in ("default", "housing", "loan")],
        M.clean_label(cut.label("age"), name_chars).alias("age_group"),
        M.shifted_log("balance", bal_min).alias("balance_log"),
        M.positive_flag("balance").alias("balance_positive"),
        M.negative_flag("balance").alias("balance_negative"),
        M.ratio_plus_one("duration", "day").alias("duration_per_day"),
        M.ratio_plus_one("duration", "campaign").alias("campaign_efficiency"),
        M.log1p("duration").alias("duration_log"),
        M.has_contact("pdays", -1).alias("has_previous_contact"),
        M.sentinel_safe_ratio("previous", "pdays", -1, 1).alias("previous_per_pdays"),
        ms.alias("month_sin"), mc.alias("month_cos"),
        loans.alias("total_loans"), M.any_flag(loans).alias("has_any_loan"),
        M.interaction("job", "education").alias("job_education"),
        M.interaction("contact", "month").alias("contact_month"))
    return out, ONE_HOT_CATS + ["job_education", "contact_month"]


def _l_base(df: DataFrame, bal_min, sentinel: int, interactions: bool, keep_month: bool):
    month_n = M.month_number("month")
    ms, mc = M.cyclic(month_n, 12)
    loans = M.count_yes(["housing", "loan"])
    drop = {"default", "housing", "loan"} | (set() if keep_month else {"month"})
    cols = [c for c in df.columns if c not in drop]
    extra = []
    if not keep_month:
        extra += [ms.alias("month_sin"), mc.alias("month_cos")]
    if interactions:
        extra += [M.interaction("job", "education").alias("job_education"),
                  M.interaction("marital", "education").alias("marital_education"),
                  M.interaction("contact", "month").alias("contact_month")]
    return df.select(
        *cols,
        *[M.yes_no(c).alias(c) for c in ("default", "housing", "loan")],
        M.fixed_cut("age").alias("age_group"),
        M.shifted_log("balance", bal_min).alias("balance_log"),
        M.ratio_plus_one("duration", "day").alias("duration_per_day"),
        M.ratio_plus_one("duration", "campaign").alias("campaign_efficiency"),
        M.has_contact("pdays", sentinel).alias("has_previous_contact"),
        M.sentinel_safe_ratio("previous", "pdays", sentinel, 1).alias("previous_success_rate"),
        loans.alias("total_loans"), M.any_flag(loans).alias("has_any_loan"), *extra)


@dataclass
class FittedL:
    bal_min: float
    encoders: enc.FittedEncoderSet
    cats: list[str]
    sentinel: int
    interactions: bool

    def transform(self, df: DataFrame) -> DataFrame:
        base = _l_base(df, self.bal_min, self.sentinel, self.interactions,
                       keep_month=self.interactions)
        return self.encoders.transform(base, self.cats)


def fit_recipe_l(train: DataFrame, sentinel: int = -1, interactions: bool = False) -> FittedL:
    """Fit the encoder notebooks' state on train (L; ``interactions=True`` gives T):
    balance minimum, then target / frequency / label encodings of every categorical column
    in one scan.  The reference used 999 as the no-contact sentinel; -1 is the data's."""
    bal_min = train.agg(F.min("balance")).first()[0]
    base = _l_base(train, bal_min, sentinel, interactions, keep_month=interactions)
    cats = T_CATS if interactions else ENC_CATS
    encs = enc.EncoderSet(cats, "y", 10, freq_levels={"age_group": M.AGE_LABELS}).fit(base)
    return FittedL(bal_min, encs, cats, sentinel, interactions)


def recipe_f1(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Hybrid notebook cell 1: contact flag, duration per contact, ordinal codes."""
    out = df.select("*", M.sentinel_flag("pdays", -1).alias("pdays_never"),
                    M.ratio_eps("duration", "campaign").alias("duration_per_contact"))
    codes = enc.OrdinalEncoder(CATEGORICAL, null_as=None).fit(
        fit_on if fit_on is not None else df)
    return codes.transform(out)


F2_KEYS = ["job", "education", "marital", "contact"]
F2_TARGETS = ["duration", "balance", "pdays"]
FP_COLS = ["age", "job", "marital", "education", "housing", "loan"]


def recipe_f2(all_rows: DataFrame) -> DataFrame:
    """Hybrid notebook cell 2 on the tagged train+test union: cyclic month, duration
    log/ratio, profile fingerprint count, 4x3 group means and ratios, new-client flag,
    ordinal codes of the text forms (all statistics fitted on the union)."""
    month_n = M.month_number("month")
    ms, mc = M.cyclic(month_n, 12)
    d = all_rows.select("*", month_n.alias("month_int"), ms.alias("month_sin"),
                        mc.alias("month_cos"), M.log1p("duration").alias("duration_log"),
                        M.ratio_eps("duration", "campaign").alias("duration_per_campaign"),
                        M.fingerprint(FP_COLS).alias("user_hash"))
    d = G.add_group_count(d, "user_hash", "id", "user_count")
    d = G.add_group_means(d, F2_KEYS, F2_TARGETS)
    d = d.select("*", M.sentinel_flag("pdays", -1).alias("is_new_client"))
    codes = enc.OrdinalEncoder(CATEGORICAL, null_as="nan").fit(d)
    return codes.transform(d).drop("user_hash")


def recipe_f3(all_rows: DataFrame) -> DataFrame:
    """Hybrid notebook cell 3 on the tagged union: duration log, efficiency, 5 equal-width
    age bins, duration ratio to the job / housing / age-bin means, cyclic month and day,
    previous-success flag, pdays sentinel replaced, ordinal codes (union-fitted)."""
    cut = M.WidthCut(5).fit(all_rows, "age")
    month_n = M.month_number("month")
    ms, mc = M.cyclic(month_n, 12)
    ds, dc = M.cyclic("day", 31)
    d = all_rows.select("*", M.log1p("duration").alias("duration_log"),
                        M.ratio_eps("duration", "campaign").alias("efficiency"),
                        cut.index("age").alias("age_bin"))
    d = G.add_group_means(d, ["job", "housing", "age_bin"], ["duration"], ratio=True,
                          mean_fmt="_{t}_mean_{k}", ratio_fmt="{t}_ratio_{k}")
    d = d.drop(*[f"_duration_mean_{k}" for k in ("job", "housing", "age_bin")])
    d = d.select("*", month_n.alias("month_int"), ms.alias("month_sin"), mc.alias("month_cos"),
                 ds.alias("day_sin"), dc.alias("day_cos"),
                 M.equals_flag("poutcome", "success").alias("is_success_prev"),
                 M.replace_value("pdays", -1, 999).alias("pdays_clean"))
    codes = enc.OrdinalEncoder(CATEGORICAL, null_as="nan").fit(d)
    return codes.transform(d)


def tagged_union(train: DataFrame, test: DataFrame) -> DataFrame:
    return R.tag_origin(train, test)
