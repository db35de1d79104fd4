"""V1-V8 evaluation metrics, exact and distributed.

Scores are aggregated to distinct values first (partial aggregation absorbs ties and hot
values), so every later step works on at most #distinct-scores rows; the AUC prefix sum
uses the range-bucketed exact prefix sum, never a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.operators.ranking import ordered_prefix
from tabrix.session import materialize


def auc(scores: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (),
        bucket: Column | None = None) -> DataFrame:
    """V1: exact ROC AUC (Mann-Whitney; tied scores count one half), per ``by`` group.
    A group with a single class gets NULL.  Rows without label or score do not count.
    ``bucket``: slices of the order, see :func:`ordered_prefix`; by default they are taken
    from the data."""
    return _auc_of_counts(_score_counts(scores, y, p, by), p, by, bucket)


def _score_counts(scores: DataFrame, y: str, p: str, by: Sequence[str]) -> DataFrame:
    return scores.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*by, p).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).cast("double").alias("_neg"))


def _auc_of_counts(g: DataFrame, p: str, by: Sequence[str],
                   bucket: Column | None = None) -> DataFrame:
    by = list(by)
    cum = ordered_prefix(g, [p], {"_cneg": F.col("_neg")}, by=by, bucket=bucket)
    part = F.col("_pos") * (F.col("_cneg") - F.col("_neg") + F.col("_neg") * 0.5)
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(part), F.sum("_pos") * F.sum("_neg")).alias("auc"))


def cv_report(scores: DataFrame, fold: str = "fold", y: str = "y", p: str = "p") -> DataFrame:
    """V2: per-fold AUC, their mean and population std, and the overall (pooled) AUC, as
    one row: (mean_auc, std_auc, oof_auc, n_folds)."""
    counts = materialize(_score_counts(scores, y, p, [fold]))  # one pass over the scores
    per = _auc_of_counts(counts, p, [fold])
    stats = per.agg(F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"),
                    F.count(F.lit(1)).alias("n_folds"))
    pooled = counts.groupBy(p).agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    overall = _auc_of_counts(pooled, p, []).select(F.col("auc").alias("oof_auc"))
    return stats.select("mean_auc", "std_auc", overall.scalar().alias("oof_auc"), "n_folds")


def threshold_grid(lo: float = 0.3, hi: float = 0.8, step: float = 0.01) -> list[float]:
    """Candidate thresholds exactly as ``arange(lo, hi, step)`` produces them."""
    return [float(t) for t in np.arange(lo, hi, step)]


def _thresholds_below(p: Column, ts: list[float]) -> Column:
    """How many of the ascending ``ts`` lie below ``p`` (NaN: above all).  On an even grid the
    place is computed and corrected by the neighbouring thresholds; else each is compared."""
    n = len(ts)
    step = (ts[-1] - ts[0]) / (n - 1) if n > 1 else 0.0
    if n < 3 or step <= 0 or any(abs(t - ts[0] - i * step) > step / 4 for i, t in enumerate(ts)):
        return sum((F.when(p > F.lit(t), 1).otherwise(0) for t in ts), F.lit(0))
    grid = F.array(*[F.lit(t) for t in ts])
    at = F.floor((F.least(F.greatest(p, F.lit(ts[0] - step)), F.lit(ts[-1] + step))
                  - F.lit(ts[0])) / F.lit(step)).cast("int") + 1
    at = F.greatest(F.least(at, F.lit(n)), F.lit(0))
    return (F.when(F.coalesce(F.get(grid, at - 1) >= p, F.lit(False)), at - 1)
            .when(F.coalesce(F.get(grid, at) < p, F.lit(False)), at + 1).otherwise(at))


def f1_by_threshold(scores: DataFrame, thresholds: Sequence[float], y: str = "y",
                    p: str = "p") -> DataFrame:
    """V3 table: (j, threshold, tp, fp, fn, f1, best) for every candidate, prediction
    ``p > threshold``.  One pass over the data: each row's score becomes the number of
    thresholds below it (<= len+1 groups; rows without label or score do not count); suffix sums over that tiny table give the
    counts for every threshold.  ``best`` marks the first maximum F1 (none if all 0)."""
    ts = list(thresholds)
    spark = scores.sparkSession
    idx = _thresholds_below(F.col(p).cast("double"), ts)
    cnt = scores.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(idx.alias("k")).agg(
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("neg"))
    grid = spark.createDataFrame([(j + 1, j, t) for j, t in enumerate(ts)],
                                 "k int, j int, threshold double")
    u = (cnt.select("k", "pos", "neg", F.lit(None).cast("int").alias("j"),
                    F.lit(None).cast("double").alias("threshold"))
         .unionByName(grid.select("k", F.lit(0).cast("long").alias("pos"),
                                  F.lit(0).cast("long").alias("neg"), "j", "threshold"))
         .groupBy("k").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                           F.max("j").alias("j"), F.max("threshold").alias("threshold")))
    w = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    total_pos = F.sum("pos").over(Window.partitionBy())
    s = u.select("k", "j", "threshold", F.sum("pos").over(w).alias("tp"),
                 F.sum("neg").over(w).alias("fp"), total_pos.alias("P"))
    s = s.where(F.col("j").isNotNull()).select(
        "j", "threshold", "tp", "fp", (F.col("P") - F.col("tp")).alias("fn"))
    den = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(den == 0, F.lit(0.0)).otherwise(2 * F.col("tp") / den)
    s = s.select("*", f1.alias("f1"))
    rank = F.row_number().over(Window.orderBy(F.col("f1").desc(), F.col("j")))
    return s.select("*", ((rank == 1) & (F.col("f1") > 0)).alias("best"))


def best_threshold(table: DataFrame, default: float = 0.5) -> tuple[float, float]:
    """Pick (threshold, f1) from the <= 51-row table; default 0.5 / 0.0 if all F1 are 0."""
    r = table.where("best").select("threshold", "f1").first()
    return (float(r[0]), float(r[1])) if r else (default, 0.0)


def accuracy(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """V4."""
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, y: str = "y", pred: str = "y_pred",
              labels: Sequence[int] = (0, 1)) -> DataFrame:
    """V5: (y, y_pred, n) on the full label grid (zero cells included).  A row whose label
    or prediction is null or not in ``labels`` is an error."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels],
                                 f"{y} int, {pred} int")

    def known(name: str) -> Column:
        v = F.col(name).cast("int")
        return F.when(v.isin(*labels), v).otherwise(F.raise_error(F.lit(
            f"confusion: {name} is not in {list(labels)}")).cast("int")).alias(name)

    c = df.groupBy(known(y), known(pred)).agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(grid).join(c, [y, pred], "left")
            .select(y, pred, F.coalesce("n", F.lit(0)).alias("n")))


def class_report(df: DataFrame, y: str = "y", pred: str = "y_pred",
                 labels: Sequence[int] = (0, 1)) -> DataFrame:
    """V6: per-class precision / recall / F1 / support, accuracy, macro and weighted
    averages (0/0 -> 0).  Rows: label in ('0', '1', 'accuracy', 'macro avg',
    'weighted avg')."""
    cm = confusion(df, y, pred, labels)

    def cells(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    hit = F.col(y) == F.col(pred)
    one = cm.agg(  # one row: three counters per label
        cells(hit).alias("hits"), F.sum("n").alias("total"),
        *[cells(c).alias(f"{k}{i}") for i, lab in enumerate(labels) for k, c in (
            ("tp", hit & (F.col(y) == lab)), ("pp", F.col(pred) == lab),
            ("sup", F.col(y) == lab))])

    def share(a: Column, b: Column) -> Column:
        return F.when(b == 0, 0.0).otherwise(a / b)

    def row(label: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    per = []
    for i in range(len(labels)):
        tp, pp, sup = (F.col(f"{k}{i}") for k in ("tp", "pp", "sup"))
        prec, rec = share(tp, pp), share(tp, sup)
        per.append((prec, rec, share(2 * prec * rec, prec + rec), sup))
    n = F.col("total")
    none = F.lit(None).cast("double")
    macro = [sum((r[k] for r in per), F.lit(0.0)) / len(per) for k in range(3)]
    weighted = [sum((r[k] * r[3] for r in per), F.lit(0.0)) / n for k in range(3)]
    return one.select(F.inline(F.array(
        *[row(str(lab), *r) for lab, r in zip(labels, per)],
        row("accuracy", none, none, F.col("hits") / n, n),
        row("macro avg", *macro, n), row("weighted avg", *weighted, n))))


def mse(df: DataFrame, y: str = "y", pred: str = "y_pred") -> DataFrame:
    """V7: mean squared error (what one notebook prints as "RMSE") and its root."""
    e = F.pow(F.col(y).cast("double") - F.col(pred).cast("double"), 2)
    return df.agg(F.avg(e).alias("mse")).select("mse", F.sqrt("mse").alias("rmse"))


def prediction_summary(df: DataFrame, pred: str = "y_pred") -> DataFrame:
    """V8: distribution of predictions with the positive rate: (y_pred, n, share)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(pred).agg(F.count(F.lit(1)).alias("n")).select(
        pred, "n", (F.col("n") / total).alias("share"))



def search_threshold(scores: DataFrame, lo: float = 0.3, hi: float = 0.8, step: float = 0.01,
                     y: str = "y", p: str = "p", default: float = 0.5):
    """V3 in one call: (threshold, f1, table) for thresholds ``arange(lo, hi, step)``."""
    table = f1_by_threshold(scores, threshold_grid(lo, hi, step), y, p)
    t, f1 = best_threshold(table, default)
    return t, f1, table
