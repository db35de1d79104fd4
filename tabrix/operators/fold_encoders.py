"""Encoders of all training folds from one scan (E1-E3, E4, E6, W1 for cross-validation).

A model of fold f may only see encoders fitted on the other folds.  Instead of k fits, one
aggregation counts every (column, level, fold); the training part of fold f is the total less
that fold.  Rows are unpivoted over the categorical and numeric columns before the partial
aggregation, so a level with a third of the rows costs nothing extra, and the table that all k
encoders are taken from has one row per level (or distinct number) and fold.

Counts are subtracted.  Sums of floating-point columns are added up over the other folds, as a
difference of two large sums would lose digits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.operators.encoders import (NAN_TEXT, EncoderSet, FittedEncoderSet, FittedLookup,
                                       MedianImputer)
from tabrix.operators.groupstats import EPS
from tabrix.operators.joins import sized_broadcast
from tabrix.operators.ranking import exact_rank, ordered_prefix
from tabrix.session import materialize

NO_FOLD = -1  # rows without a fold are a fold of their own


class FoldEncoders:
    """Label codes, frequencies, smoothed target means (as ``EncoderSet``), means of ``targets``
    per level and medians of ``numeric`` columns, for every training part of a cross-validation.

    A level that only occurs in the held-out fold is unseen by that fold's encoders.  Rows with
    a null fold are a fold of their own, ``NO_FOLD``: they train all others.  NULL levels are the
    code of 'nan' and no part of frequencies, target means and level means; NULL labels and
    numbers do not count in means and medians."""

    def __init__(self, cols: Sequence[str], y: str = "y", smoothing: float = 10.0,
                 targets: Sequence[str] = (), numeric: Sequence[str] = (), fold: str = "fold",
                 unknown_value: int = -1):
        self.cols, self.y, self.m = list(cols), y, float(smoothing)
        self.targets, self.numeric, self.fold = list(targets), list(numeric), fold
        self.unknown_value = unknown_value

    def _cells(self, df: DataFrame) -> DataFrame:
        """(feature, level, v, fold) -> counts and sums, in one scan of the rows."""
        sums = [self.y, *self.targets]
        no_sums = [F.lit(None).cast("double").alias(f"x{i}") for i in range(len(sums))]
        own = [F.col(f"`{t}`").cast("double").alias(f"x{i}") for i, t in enumerate(sums)]
        cats = [F.struct(F.lit(c).alias("feature"),
                         F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NAN_TEXT)).alias("level"),
                         F.lit(None).cast("double").alias("v"),
                         F.col(f"`{c}`").isNull().alias("isnull"), *own) for c in self.cols]
        nums = [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("string").alias("level"),
                         F.col(f"`{c}`").cast("double").alias("v"), F.lit(False).alias("isnull"),
                         *no_sums) for c in self.numeric]
        fold = F.coalesce(F.col(f"`{self.fold}`").cast("int"), F.lit(NO_FOLD))
        rows = df.select(fold.alias("fold"), F.explode(F.array(*cats, *nums)).alias("s")).select(
            "fold", "s.*").where("level is not null or v is not null")
        level = ~F.col("isnull")
        return rows.groupBy("feature", "level", "v", "fold").agg(
            F.count(F.lit(1)).alias("n_all"), F.count_if(level).alias("n"),
            *[F.sum(F.when(level, F.col(f"x{i}"))).alias(f"s{i}") for i in range(len(sums))],
            *[F.count(F.when(level, F.col(f"x{i}"))).alias(f"c{i}") for i in range(len(sums))],
            F.sum("x0").alias("y_sum"), F.count("x0").alias("y_n"))

    @staticmethod
    def _rest(cells: DataFrame, keys: Sequence[str], folds: DataFrame, sums: Sequence[str]
              ) -> DataFrame:
        """Per key and fold the sums over the other folds; keys without a row there go."""
        cell = F.collect_list(F.struct("fold", *sums))  # at most one entry a fold
        per = cells.groupBy(*keys).agg(cell.alias("cells"),
                                       F.sum("n_all").alias("_total")).join(
            F.broadcast(folds.select(F.col("fold").alias("f"))))  # one row per fold
        held = F.filter("cells", lambda c: c["fold"] == F.col("f"))
        others = F.array_sort(F.filter("cells", lambda c: c["fold"] != F.col("f")))

        def rest(name: str) -> Column:
            kind = "double" if name.startswith("s") or name == "y_sum" else "long"
            return F.aggregate(others, F.lit(0).cast(kind),
                               lambda a, c: a + F.coalesce(c[name].cast(kind), F.lit(0)))

        n_all = F.col("_total") - F.coalesce(F.get(held, F.lit(0))["n_all"], F.lit(0))
        return per.select(F.col("f").alias("fold"), *keys, n_all.alias("n_all"),
                          *[rest(s).alias(s) for s in sums if s != "n_all"]).where("n_all > 0")

    def fit(self, df: DataFrame) -> "FittedFoldEncoders":
        """One scan of ``df`` (columns, label, targets and the fold); all that follows reads the
        table of cells."""
        cells = materialize(self._cells(df))
        folds = materialize(cells.select("fold").distinct())
        k = range(1 + len(self.targets))
        table = rows = None
        if self.cols:
            sums = ["n_all", "n", "y_sum", "y_n", *[f"s{i}" for i in k], *[f"c{i}" for i in k]]
            rest = materialize(self._rest(cells.where("level is not null"), ["feature", "level"],
                                          folds, sums))
            # every column's levels cover all rows, so any column gives a part's mean label
            part = rest.where(F.col("feature") == self.cols[0]).groupBy("fold").agg(
                F.try_divide(F.sum("y_sum"), F.sum("y_n")).alias("_g"))
            total = rest.groupBy("fold", "feature").agg(F.sum("n").alias("_tot"))
            codes = exact_rank(rest.select("fold", "feature", "level"), ["level"],
                               by=["fold", "feature"], name="code")
            n, m = F.col("n"), F.lit(self.m)
            enc = (F.try_divide(F.col("s0"), F.col("c0")) * n + F.col("_g") * m) / (n + m)
            table = materialize(
                rest.join(F.broadcast(part), "fold").join(F.broadcast(total), ["fold", "feature"])
                .join(codes, ["fold", "feature", "level"])
                .select("fold", "feature", "level", F.when(n > 0, enc).alias("enc"),
                        F.when(n > 0, n / F.col("_tot")).alias("freq"),
                        (F.col("code") - 1).cast("int").alias("code"),
                        *[F.try_divide(F.col(f"s{i}"), F.col(f"c{i}")).alias(f"m{i}")
                          for i in k[1:]]))
            rows = table.count()
        med = None
        if self.numeric:
            cnt = self._rest(cells.where("v is not null"), ["feature", "v"], folds, ["n_all"])
            cum = ordered_prefix(cnt, ["v"], {"cum": F.col("n_all")}, by=["fold", "feature"])
            size = cum.groupBy("fold", "feature").agg(F.max("cum").alias("size"))
            low, high = F.floor((F.col("size") + 1) / 2), F.floor(F.col("size") / 2) + 1
            med = materialize(
                cum.join(F.broadcast(size), ["fold", "feature"])
                .where((F.col("cum") - F.col("n_all") < high) & (F.col("cum") >= low))
                .groupBy("fold", "feature").agg(((F.min("v") + F.max("v")) / 2).alias("median")))
        return FittedFoldEncoders(self, table, rows, med,
                                  sorted(r["fold"] for r in folds.collect()))


class FittedFoldEncoders:
    """``table``: (fold, feature, level) -> enc, freq, code and means m1, m2, ... of the targets
    over all other folds; ``medians_table``: (fold, feature) -> median."""

    def __init__(self, spec: FoldEncoders, table: DataFrame | None, rows: int | None,
                 med: DataFrame | None, folds: list[int]):
        self.spec, self.table, self.rows = spec, table, rows
        self.medians_table, self.folds = med, folds
        self._defaults: dict[int, dict[str, dict[str, float]]] = {f: {} for f in folds}
        if table is not None:  # one row per fold and column
            for r in table.groupBy("fold", "feature").agg(
                    F.avg("enc").alias("enc"), F.min("freq").alias("freq")).collect():
                self._defaults[r["fold"]][r["feature"]] = {"enc": r["enc"], "freq": r["freq"]}
        self._medians: dict[int, dict[str, float]] = {f: {} for f in folds}
        for r in med.collect() if med is not None else []:
            self._medians[r["fold"]][r["feature"]] = r["median"]

    def encoder(self, fold: int) -> FittedEncoderSet:
        """The encoder fitted without ``fold``: for the training and validation rows of that
        fold's model and for test rows."""
        s = self.spec
        own = self.table.where(F.col("fold") == fold).select("feature", "level", "enc", "freq",
                                                             "code")
        return FittedEncoderSet(
            FittedLookup(own, self.rows, ["enc", "freq", "code"], self._defaults[fold], NAN_TEXT),
            EncoderSet(s.cols, s.y, s.m, unknown_value=s.unknown_value))

    def impute(self, df: DataFrame, fold: int) -> DataFrame:
        """Nulls of the numeric columns replaced by their medians without ``fold``."""
        return MedianImputer.transform(df, self._medians[fold])

    def level_means(self, df: DataFrame, fold: int, fmt: str = "{t}_mean_by_{k}",
                    ratio_fmt: str | None = "{t}_ratio_by_{k}") -> DataFrame:
        """W1/W2 with the means of the rows outside ``fold``."""
        own = self.table.where(F.col("fold") == fold)
        new, out = [F.col(f"`{c}`") for c in df.columns], df
        for j, k in enumerate(self.spec.cols):
            t = own.where(F.col("feature") == k).select(
                F.col("level").alias(f"_tbx_l{j}"),
                *[F.col(f"m{i}").alias(f"_tbx_m{j}_{i}")
                  for i in range(1, len(self.spec.targets) + 1)])
            out = out.join(sized_broadcast(t, self.rows),
                           out[f"`{k}`"].cast("string") == t[f"_tbx_l{j}"], "left")
            for i, name in enumerate(self.spec.targets, 1):
                m = F.col(f"_tbx_m{j}_{i}")
                new.append(m.alias(fmt.format(t=name, k=k)))
                if ratio_fmt:
                    new.append(F.try_divide(F.col(f"`{name}`").cast("double"), m + F.lit(EPS))
                               .alias(ratio_fmt.format(t=name, k=k)))
        return out.select(*new)

    def out_of_fold(self, df: DataFrame, target_suffix: str = "_target_enc",
                    freq_suffix: str = "_freq", code_suffix: str = "_code",
                    mean_fmt: str = "{t}_mean_by_{k}") -> DataFrame:
        """Every row with the values of the encoders that have not seen its fold: one lookup a
        column by (level, fold), and the numeric columns imputed."""
        s, out = self.spec, df
        spark = df.sparkSession
        fold = F.coalesce(F.col(f"`{s.fold}`").cast("int"), F.lit(NO_FOLD))
        known = [(f, *[self._defaults[f].get(c, {}).get(v) for c in s.cols
                       for v in ("enc", "freq")],
                  *[self._medians[f].get(c) for c in s.numeric]) for f in self.folds]
        names = [f"_tbx_{v}{j}" for j in range(len(s.cols)) for v in ("de", "df")] + [
            f"_tbx_med{j}" for j in range(len(s.numeric))]
        if not known:
            known = [(NO_FOLD, *[None] * len(names))]
        small = spark.createDataFrame(known, "_tbx_f int" + "".join(f", {x} double" for x in names))
        out = out.join(F.broadcast(small), fold == small["_tbx_f"], "left")  # one row a fold
        new = []
        for j, c in enumerate(s.cols):
            t = self.table.where(F.col("feature") == c).select(
                F.col("fold").alias(f"_tbx_f{j}"), F.col("level").alias(f"_tbx_l{j}"),
                *[F.col(v).alias(f"_tbx_{v}{j}") for v in ("enc", "freq", "code")],
                *[F.col(f"m{i}").alias(f"_tbx_m{j}_{i}") for i in range(1, len(s.targets) + 1)])
            col = F.col(f"`{c}`")
            level = F.coalesce(col.cast("string"), F.lit(NAN_TEXT))
            out = out.join(sized_broadcast(t, self.rows), (level == t[f"_tbx_l{j}"])
                           & (F.col("_tbx_f") == t[f"_tbx_f{j}"]), "left")
            there = col.isNotNull()
            new += [F.coalesce(F.when(there, F.col(f"_tbx_enc{j}")), F.col(f"_tbx_de{j}"))
                    .alias(c + target_suffix),
                    F.coalesce(F.when(there, F.col(f"_tbx_freq{j}")), F.col(f"_tbx_df{j}"))
                    .alias(c + freq_suffix),
                    F.coalesce(F.col(f"_tbx_code{j}"), F.lit(s.unknown_value)).cast("int")
                    .alias(c + code_suffix)]
            new += [F.when(there, F.col(f"_tbx_m{j}_{i}")).alias(mean_fmt.format(t=name, k=c))
                    for i, name in enumerate(s.targets, 1)]
        med = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_tbx_med{j}")).alias(c)
               for j, c in enumerate(s.numeric)}
        return out.select(*[med.get(c, F.col(f"`{c}`")) for c in df.columns], *new)
