"""E1-E6 (+E4b): fitted encoders.  ``fit`` turns data into small lookup tables (one row per
(column, level)), computed for all columns in one scan and written as parquet to the shared
folder; ``transform`` is one broadcast join per column behind the fitted row count.

``scope`` of the reference notebooks is expressed by what the caller passes to ``fit``:
train only (default), the train+test union, or each frame alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.operators.joins import sized_broadcast
from tabrix.operators.ranking import exact_rank
from tabrix.session import materialize

NAN_TEXT = "nan"  # fixed value: text form of a missing value after a string cast


def _long(df: DataFrame, cols: Sequence[str], null_as: str | None, extra=()) -> DataFrame:
    """Unpivot ``cols`` to (feature, level[, extra...]) in one scan."""
    def lvl(c):
        v = F.col(c).cast("string")
        return F.coalesce(v, F.lit(null_as)) if null_as is not None else v
    structs = [F.struct(F.lit(c).alias("feature"), lvl(c).alias("level"),
                        *[F.col(e).alias(e) for e in extra]) for c in cols]
    return df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def _level_expr(df: DataFrame, c: str, null_as: str | None):
    v = df[c].cast("string")
    return F.coalesce(v, F.lit(null_as)) if null_as is not None else v


@dataclass
class FittedLookup:
    """Long lookup (feature, level, <values>) + per-feature defaults for unseen levels."""
    table: DataFrame
    rows: int
    values: list[str]
    defaults: dict[str, dict[str, object]] = field(default_factory=dict)
    null_as: str | None = None

    def apply(self, df: DataFrame, cols: Sequence[str], out: dict[str, str],
              replace: bool = False, fill_unseen: bool = True) -> DataFrame:
        """For every column c and value v, add column ``out[v].format(c=c)`` (or replace c).
        ``fill_unseen=False`` leaves NULL where a level was not fitted."""
        res = df
        keep = list(df.columns)
        new_cols = {}
        for c in cols:
            t = (self.table.where(F.col("feature") == c)
                 .select(F.col("level").alias("_tbx_lvl"),
                         *[F.col(v).alias(f"_tbx_{c}_{v}") for v in self.values]))
            t = sized_broadcast(t, self.rows)
            res = res.join(t, _level_expr(res, c, self.null_as) == t["_tbx_lvl"], "left")
            res = res.drop("_tbx_lvl")
            for v in self.values:
                col = F.col(f"_tbx_{c}_{v}")
                d = self.defaults.get(c, {}).get(v) if fill_unseen else None
                if d is not None:
                    col = F.coalesce(col, F.lit(d))
                new_cols[(c, v)] = col
        sel = []
        for k in keep:
            if replace and k in cols:
                sel.append(new_cols[(k, self.values[0])].alias(k))
            else:
                sel.append(F.col(k))
        if not replace:
            for c in cols:
                for v in self.values:
                    sel.append(new_cols[(c, v)].alias(out[v].format(c=c)))
        return res.select(*sel)


def _fit_table(table: DataFrame, values: list[str], null_as,
               default_aggs=None) -> FittedLookup:
    t = materialize(table)
    rows = t.count()
    defaults: dict[str, dict[str, object]] = {}
    if default_aggs:
        # one small aggregate over the fitted table (rows = levels), not over the data
        for r in t.groupBy("feature").agg(*default_aggs).collect():
            defaults[r["feature"]] = {k: r[k] for k in r.asDict() if k != "feature"}
    return FittedLookup(t, rows, values, defaults, null_as)


# ---------------------------------------------------------------- E1 / E2 ordinal & label
class OrdinalEncoder:
    """Sorted distinct levels -> 0..n-1 per column; unseen -> ``unknown_value``.

    ``null_as='nan'`` mirrors encoding the text form (NULL becomes category 'nan');
    ``null_as=None`` keeps NULL as NULL.  ``on_unseen='error'`` raises instead."""

    def __init__(self, cols: Sequence[str], null_as: str | None = NAN_TEXT,
                 unknown_value: int = -1, on_unseen: str = "value"):
        self.cols, self.null_as = list(cols), null_as
        self.unknown_value, self.on_unseen = unknown_value, on_unseen

    def fit(self, df: DataFrame) -> "FittedOrdinal":
        lv = _long(df, self.cols, self.null_as).where(F.col("level").isNotNull()).distinct()
        ranked = exact_rank(lv, ["level"], by=["feature"], name="code")
        table = ranked.select("feature", "level", (F.col("code") - 1).cast("int").alias("code"))
        return FittedOrdinal(_fit_table(table, ["code"], self.null_as), self)


class FittedOrdinal:
    def __init__(self, lk: FittedLookup, spec: OrdinalEncoder):
        self.lookup, self.spec = lk, spec

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None,
                  replace: bool = True, suffix: str = "_code") -> DataFrame:
        cols = list(cols or self.spec.cols)
        res, codes = df, {}
        for i, c in enumerate(cols):
            t = (self.lookup.table.where(F.col("feature") == c)
                 .select(F.col("level").alias(f"_tbx_l{i}"), F.col("code").alias(f"_tbx_c{i}")))
            t = sized_broadcast(t, self.lookup.rows)
            lvl = _level_expr(res, c, self.spec.null_as)
            res = res.join(t, lvl == t[f"_tbx_l{i}"], "left")
            code = F.col(f"_tbx_c{i}")
            missing = code.isNull() & lvl.isNotNull()
            if self.spec.on_unseen == "error":
                fill = F.raise_error(F.concat(F.lit(f"unseen level in {c}: "), lvl))
            else:
                fill = F.lit(self.spec.unknown_value)
            codes[c] = F.when(missing, fill).otherwise(code).cast("int")
        sel = [codes[c].alias(c) if (replace and c in codes) else F.col(c) for c in df.columns]
        if not replace:
            sel += [codes[c].alias(c + suffix) for c in cols]
        return res.select(*sel)


# ---------------------------------------------------------------- E3 frequency
class FrequencyEncoder:
    """Share of each level among non-null rows; unseen -> the smallest fitted share.
    ``levels``: optional fixed level list per column (e.g. bins), missing ones get 0."""

    def __init__(self, cols: Sequence[str], levels: dict[str, Sequence[str]] | None = None):
        self.cols, self.levels = list(cols), levels or {}

    def fit(self, df: DataFrame) -> FittedLookup:
        lv = _long(df, self.cols, None).where(F.col("level").isNotNull())
        cnt = lv.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
        if self.levels:
            spark = df.sparkSession
            fixed = spark.createDataFrame(
                [(c, lvl) for c, ls in self.levels.items() for lvl in ls],
                "feature string, level string")
            cnt = (fixed.join(cnt, ["feature", "level"], "full")
                   .select("feature", "level", F.coalesce("n", F.lit(0)).alias("n")))
        tot = cnt.groupBy("feature").agg(F.sum("n").alias("_tot"))
        table = (cnt.join(F.broadcast(tot), "feature")
                 .select("feature", "level", (F.col("n") / F.col("_tot")).alias("freq")))
        return _fit_table(table, ["freq"], None, default_aggs=[F.min("freq").alias("freq")])


def frequency_transform(fitted: FittedLookup, df: DataFrame, cols: Sequence[str],
                        suffix: str = "_freq") -> DataFrame:
    return fitted.apply(df, cols, {"freq": "{c}" + suffix})


# ---------------------------------------------------------------- E4 / E4b target
class TargetEncoder:
    """``(mean*n + global*m)/(n+m)`` per level (m = ``smoothing``); NULL levels are not
    fitted.  Unseen (and NULL) levels get the unweighted mean of the encoded values.
    ``smooth_on_apply=False`` stores the raw level mean instead (one notebook's test path)."""

    def __init__(self, cols: Sequence[str], target: str = "y", smoothing: float = 10.0,
                 smooth_on_apply: bool = True):
        self.cols, self.target, self.m = list(cols), target, float(smoothing)
        self.smooth_on_apply = smooth_on_apply

    def stats(self, df: DataFrame) -> DataFrame:
        """(feature, level, n, mean) for all columns in one scan."""
        lv = _long(df, self.cols, None, extra=[self.target]).where(F.col("level").isNotNull())
        return lv.groupBy("feature", "level").agg(
            F.count(F.lit(1)).alias("n"), F.avg(self.target).alias("mean"))

    def fit(self, df: DataFrame) -> FittedLookup:
        g = df.agg(F.avg(self.target)).scalar()  # A3, a scalar subquery
        st = self.stats(df)
        smooth = (F.col("mean") * F.col("n") + g * F.lit(self.m)) / (F.col("n") + F.lit(self.m))
        enc = smooth if self.smooth_on_apply else F.col("mean")
        table = st.select("feature", "level", enc.alias("enc"))
        return _fit_table(table, ["enc"], None, default_aggs=[F.avg("enc").alias("enc")])


def target_transform(fitted: FittedLookup, df: DataFrame, cols: Sequence[str],
                     suffix: str = "_target_enc", fill_unseen: bool = True) -> DataFrame:
    return fitted.apply(df, cols, {"enc": "{c}" + suffix}, fill_unseen=fill_unseen)


def oof_target_encode(df: DataFrame, cols: Sequence[str], target: str = "y",
                      fold: str = "fold", smoothing: float = 10.0,
                      suffix: str = "_target_enc") -> DataFrame:
    """Out-of-fold smoothed target encoding.  A row in fold f is encoded with
    statistics of the other folds: ``(sum_all - sum_f)/(n_all - n_f)`` and the out-of-fold
    global mean, so no row sees its own label.  One aggregate per (column, level, fold)."""
    lv = _long(df, cols, None, extra=[target, fold]).where(F.col("level").isNotNull())
    per = lv.groupBy("feature", "level", fold).agg(
        F.count(F.lit(1)).alias("nf"), F.sum(target).alias("sf"))
    lvl = per.groupBy("feature", "level").agg(F.sum("nf").alias("na"), F.sum("sf").alias("sa"))
    gf = df.groupBy(fold).agg(F.count(F.lit(1)).alias("gn"), F.sum(target).alias("gs"))
    g_all = df.agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("s"))
    gN, gS = g_all.select("n").scalar(), g_all.select("s").scalar()
    folds = gf.select(fold, ((gS - F.col("gs")) / (gN - F.col("gn"))).alias("g_oof"))
    t = (per.join(lvl, ["feature", "level"]).join(F.broadcast(folds), fold)
         .select("feature", "level", fold,
                 (F.col("na") - F.col("nf")).alias("n"),
                 (F.col("sa") - F.col("sf")).alias("s"), "g_oof"))
    m = F.lit(float(smoothing))
    t = t.select("feature", "level", fold,
                 F.when(F.col("n") > 0, (F.col("s") + F.col("g_oof") * m) / (F.col("n") + m))
                  .otherwise(F.col("g_oof")).alias("enc"))
    t = materialize(t)
    rows = t.count()
    res = df
    sel = [F.col(c) for c in df.columns]
    for c in cols:
        tc = (t.where(F.col("feature") == c)
              .select(F.col("level").alias("_l"), F.col(fold).alias("_f"),
                      F.col("enc").alias(f"_e_{c}")))
        tc = sized_broadcast(tc, rows)
        res = res.join(tc, (res[c].cast("string") == tc["_l"]) & (res[fold] == tc["_f"]),
                       "left").drop("_l", "_f")
        sel.append(F.col(f"_e_{c}").alias(c + suffix))
    return res.select(*sel)


# ---------------------------------------------------------------- E5 one-hot
class OneHotEncoder:
    """E5: one 0/1 column per fitted level, first sorted level dropped; NULL -> all 0.
    Output names ``{col}_{level}``.  ``max_levels`` guards the width of the select."""

    def __init__(self, cols: Sequence[str], drop_first: bool = True, max_levels: int = 2000):
        self.cols, self.drop_first, self.max_levels = list(cols), drop_first, max_levels

    def fit(self, df: DataFrame) -> dict[str, list[str]]:
        lv = (_long(df, self.cols, None).where(F.col("level").isNotNull())
              .groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n")))
        found = lv.select("feature", "level").limit(self.max_levels + 1).collect()
        if len(found) > self.max_levels:
            raise ValueError(f"one-hot: more than max_levels={self.max_levels} levels; "
                             "use the sparse vector path (one_hot_vectors)")
        levels: dict[str, list[str]] = {c: [] for c in self.cols}
        for r in found:
            levels[r[0]].append(r[1])
        for c in levels:
            levels[c].sort()
            if self.drop_first:
                levels[c] = levels[c][1:]
        return levels


def one_hot_transform(df: DataFrame, levels: dict[str, list[str]], keep_source: bool = False
                      ) -> DataFrame:
    sel = [F.col(f"`{c}`") for c in df.columns if keep_source or c not in levels]
    for c, ls in levels.items():
        for lvl in ls:  # NULL source -> 0 in every indicator
            sel.append(F.coalesce(F.col(f"`{c}`").cast("string") == F.lit(lvl), F.lit(False))
                       .cast("int").alias(f"{c}_{lvl}"))
    return df.select(*sel)


# ---------------------------------------------------------------- E6 median impute
class MedianImputer:
    """Interpolated median per column, fitted once, NULL -> median.  Exact, or by a quantile
    sketch of size ``sketch_k`` (rank error ``sketches.rank_error``)."""

    def __init__(self, cols: Sequence[str], sketch_k: int | None = None):
        self.cols, self.sketch_k = list(cols), sketch_k

    def fit(self, df: DataFrame) -> dict[str, float]:
        from tabrix.operators.groupstats import medians
        from tabrix.operators.sketches import approx_medians
        table = (medians(df, self.cols) if self.sketch_k is None
                 else approx_medians(df, self.cols, self.sketch_k))
        return {r["feature"]: r["median"] for r in table.collect()}

    @staticmethod
    def transform(df: DataFrame, med: dict[str, float]) -> DataFrame:
        return df.select(*[
            (F.coalesce(F.col(c).cast("double"), F.lit(float(med[c]))).alias(c)
             if med.get(c) is not None else F.col(c)) for c in df.columns])


# ---------------------------------------------------------------- E2+E3+E4 in one pass
class EncoderSet:
    """Target (E4), frequency (E3) and label (E2) encodings of many columns fitted in
    ONE scan of the training rows: (feature, level) -> n, mean(y), n_all; one materialised
    table; one broadcast join per column at transform time carrying all three values.

    Level text: the string form, NULL -> 'nan' for the label codes (the text form of a
    missing value); target and frequency statistics ignore NULL levels, and a NULL input is
    treated as unseen by them.  Unseen: target -> unweighted mean of the encodings,
    frequency -> the smallest fitted frequency, label -> ``unknown_value``."""

    def __init__(self, cols: Sequence[str], target: str = "y", smoothing: float = 10.0,
                 freq_levels: dict[str, Sequence[str]] | None = None,
                 unknown_value: int = -1):
        self.cols, self.target, self.m = list(cols), target, float(smoothing)
        self.freq_levels = freq_levels or {}
        self.unknown_value = unknown_value

    def fit(self, df: DataFrame) -> "FittedEncoderSet":
        structs = [F.struct(F.lit(c).alias("feature"),
                            F.coalesce(F.col(c).cast("string"), F.lit(NAN_TEXT)).alias("level"),
                            F.col(c).isNull().alias("isnull"),
                            F.col(self.target).cast("double").alias("t"))
                   for c in self.cols]
        lv = df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")
        # n counts the level's rows, my averages its non-null labels (mean * n as pandas'
        # groupby mean times size: rows with a missing label still count in n)
        st = lv.groupBy("feature", "level").agg(
            F.count(F.when(~F.col("isnull"), 1)).alias("n"),
            F.avg(F.when(~F.col("isnull"), F.col("t"))).alias("my"),
            F.count(F.lit(1)).alias("n_all"), F.sum("t").alias("t_sum"),
            F.count("t").alias("t_n"))
        if self.freq_levels:
            fixed = df.sparkSession.createDataFrame(
                [(c, x) for c, ls in self.freq_levels.items() for x in ls],
                "feature string, level string")
            st = (fixed.join(st, ["feature", "level"], "full")
                  .select("feature", "level", F.coalesce("n", F.lit(0)).alias("n"),
                          "my", F.coalesce("n_all", F.lit(0)).alias("n_all"), "t_sum", "t_n"))
        st = materialize(st)  # one row per level; all below reads this table, not the rows
        # every column's levels cover all rows, so any column gives the mean over all rows
        g = st.where(F.col("feature") == self.cols[0]).agg(F.sum("t_sum") / F.sum("t_n")).scalar()
        tot = st.groupBy("feature").agg(F.sum("n").alias("_tot"))
        m = F.lit(self.m)
        st = st.join(F.broadcast(tot), "feature").select(
            "feature", "level", "n", "n_all",
            F.when(F.col("n") > 0, (F.col("my") * F.col("n") + g * m) / (F.col("n") + m))
             .alias("enc"),
            F.when((F.col("n") > 0) | (F.col("n_all") == 0), F.col("n") / F.col("_tot"))
             .alias("freq"))
        seen = st.where(F.col("n_all") > 0)
        codes = exact_rank(seen.select("feature", "level"), ["level"], by=["feature"],
                           name="code")
        table = (st.join(codes, ["feature", "level"], "left")
                 .select("feature", "level", "enc", "freq",
                         (F.col("code") - 1).cast("int").alias("code")))
        lk = _fit_table(table, ["enc", "freq", "code"], NAN_TEXT,
                        default_aggs=[F.avg("enc").alias("enc"), F.min("freq").alias("freq")])
        return FittedEncoderSet(lk, self)


class FittedEncoderSet:
    def __init__(self, lk: FittedLookup, spec: EncoderSet):
        self.lookup, self.spec = lk, spec

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None,
                  target_suffix: str = "_target_enc", freq_suffix: str = "_freq",
                  replace_with_code: bool = True) -> DataFrame:
        cols = list(cols or self.spec.cols)
        res, new = df, {}
        for i, c in enumerate(cols):
            t = (self.lookup.table.where(F.col("feature") == c)
                 .select(F.col("level").alias(f"_tbx_l{i}"), F.col("enc").alias(f"_tbx_e{i}"),
                         F.col("freq").alias(f"_tbx_f{i}"), F.col("code").alias(f"_tbx_c{i}")))
            t = sized_broadcast(t, self.lookup.rows)
            lvl = F.coalesce(res[c].cast("string"), F.lit(NAN_TEXT))
            isnull = res[c].isNull()
            res = res.join(t, lvl == t[f"_tbx_l{i}"], "left")
            d = self.lookup.defaults.get(c, {})
            enc_v = F.when(isnull, F.lit(d.get("enc"))).otherwise(
                F.coalesce(F.col(f"_tbx_e{i}"), F.lit(d.get("enc"))))
            frq_v = F.when(isnull, F.lit(d.get("freq"))).otherwise(
                F.coalesce(F.col(f"_tbx_f{i}"), F.lit(d.get("freq"))))
            code_v = F.coalesce(F.col(f"_tbx_c{i}"), F.lit(self.spec.unknown_value)).cast("int")
            new[c] = (enc_v.cast("double"), frq_v.cast("double"), code_v)
        sel = [new[c][2].alias(c) if (replace_with_code and c in new) else F.col(c)
               for c in df.columns]
        sel += [new[c][0].alias(c + target_suffix) for c in cols]
        sel += [new[c][1].alias(c + freq_suffix) for c in cols]
        if not replace_with_code:
            sel += [new[c][2].alias(c + "_code") for c in cols]
        return res.select(*sel)


# ---------------------------------------------------------------- E5 sparse (for models)
def one_hot_vectors(fitted: "FittedOrdinal", df: DataFrame, cols: Sequence[str] | None = None,
                    suffix: str = "_vec") -> DataFrame:
    """E5, sparse path for models: one sparse vector per column of size n_levels - 1 over
    the fitted sorted levels, first level dropped (all zeros), unseen and NULL all zeros.

    Built on MLlib's OneHotEncoder over the fitted codes shifted by one: the first level
    and every unknown become an invalid index, which ``handleInvalid='keep'`` maps to the
    extra last slot that ``dropLast`` removes.  Category sizes come from the fitted level
    table (no pass over the data)."""
    from pyspark.ml.feature import OneHotEncoder as MLOneHot
    cols = list(cols or fitted.spec.cols)
    sizes = {r["feature"]: int(r["n"]) for r in fitted.lookup.table.groupBy("feature")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    coded = fitted.transform(df, cols, replace=False, suffix="_tbx_code")
    shifted = coded.select("*", *[
        F.when(F.col(f"{c}_tbx_code") >= 1, F.col(f"{c}_tbx_code") - 1)
         .otherwise(F.lit(-1)).cast("double").alias(f"{c}_tbx_idx") for c in cols])
    # fit the encoder on a tiny frame holding each column's largest index (its size)
    spark = df.sparkSession
    probe = spark.createDataFrame(
        [tuple(float(max(sizes.get(c, 1) - 2, 0)) for c in cols)],
        ", ".join(f"`{c}_tbx_idx` double" for c in cols))
    enc = MLOneHot(inputCols=[f"{c}_tbx_idx" for c in cols],
                   outputCols=[f"{c}{suffix}" for c in cols], dropLast=True,
                   handleInvalid="keep").fit(probe)
    out = enc.transform(shifted)
    drop = [f"{c}_tbx_code" for c in cols] + [f"{c}_tbx_idx" for c in cols]
    return out.drop(*drop)
