"""Distributed tree models, scored into keyed tables.

Scores are DataFrames keyed by ``id``: ``(id, y, fold, seed, model, p)``.  Boosted trees are
grown from histograms (``boosting``) and forests by random cuts (``forest``), all folds and
seeds in one scan; vector features, and ``learner="mllib"``, go to Spark MLlib.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.operators import boosting as B
from tabrix.operators import forest as T
from tabrix.operators.sampling import holdout, kfold
from tabrix.session import checkpoint_dir, materialize

MISSING = -999.0  # fixed fill for missing feature values before vector assembly


@dataclass
class TreeConfig:
    """Boosted-tree / forest settings (MLlib names): rounds, learning rate, depth, rows of a leaf,
    share of rows, of columns ("all" or a fraction) and least gain of a split.  ``leaves``
    (0: no limit), ``l1``, ``l2``, ``patience`` and ``metric`` belong to histogram boosting;
    ``patience`` None is 10 rounds on an internal and 100 on a given validation part.
    ``validation_tol`` and ``bootstrap`` are MLlib's alone."""
    max_iter: int = 1000
    step_size: float = 0.1
    max_depth: int = 8
    min_instances: int = 20
    subsampling_rate: float = 1.0
    feature_subset: str = "all"
    min_info_gain: float = 0.0
    max_bins: int = 64
    seed: int = 42
    validation_tol: float = 0.01
    num_trees: int = 500         # forests only
    bootstrap: bool = False      # forests only
    leaves: int = 31
    l1: float = 0.0
    l2: float = 0.0
    patience: int | None = None
    metric: str = "auc"
    learner: str = "histogram"

    def boosting(self, patience: int = 0) -> B.BoostConfig:
        """The same for histogram boosting; ``patience`` where none is set."""
        share = 1.0 if self.feature_subset == "all" else float(self.feature_subset)
        return B.BoostConfig(
            rounds=self.max_iter, learning_rate=self.step_size, leaves=self.leaves,
            max_depth=self.max_depth, min_rows=self.min_instances, l1=self.l1, l2=self.l2,
            min_gain=self.min_info_gain, row_fraction=self.subsampling_rate,
            column_fraction=share, metric=self.metric, seed=self.seed,
            patience=(self.patience if self.patience is not None else patience) if patience else 0)

    def with_params(self, **kw) -> "TreeConfig":
        d = dict(self.__dict__)
        d.update(kw)
        return TreeConfig(**d)


def feature_value(c: str, categorical: dict[str, int] | None = None) -> Column:
    """A scalar feature as models see it: missing numbers are ``MISSING``, missing and unknown
    categories one level of their own."""
    v = F.col(c).cast("double")
    if categorical and c in categorical:
        n = float(categorical[c])
        return F.when((v >= 0) & (v < n), v).otherwise(F.lit(n))
    return F.coalesce(v, F.lit(MISSING))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features",
             categorical: dict[str, int] | None = None) -> DataFrame:
    """Vector column from numeric features (vector columns, e.g. sparse one-hot blocks, are
    appended as they are); missing values become ``MISSING`` (trees split on it).  Use
    median imputation first where a neutral value is wanted.

    ``categorical``: feature -> number of levels (codes 0..n-1); NULL, negative and larger
    codes (unknown levels) share one more level n.  Those features are declared nominal in the vector's ML attribute metadata, so MLlib trees split them
    as unordered categories (the boosted-tree notebooks' native categories)."""
    from pyspark.ml.linalg import VectorUDT
    is_vec = {c for c in features if isinstance(df.schema[c].dataType, VectorUDT)}
    if is_vec and categorical:
        raise ValueError("categorical metadata needs scalar feature columns only")
    filled = df.select("*", *[(F.col(c) if c in is_vec else
                               feature_value(c, categorical))
                              .alias(f"_tbx_f{i}") for i, c in enumerate(features)])
    va = VectorAssembler(inputCols=[f"_tbx_f{i}" for i in range(len(features))],
                         outputCol=out, handleInvalid="keep")
    v = va.transform(filled).drop(*[f"_tbx_f{i}" for i in range(len(features))])
    if categorical:
        nominal = [{"idx": i, "name": c, "num_vals": int(categorical[c]) + 1}
                   for i, c in enumerate(features) if c in categorical]
        numeric = [{"idx": i, "name": c} for i, c in enumerate(features) if c not in categorical]
        meta = {"ml_attr": {"attrs": {"nominal": nominal, "numeric": numeric},
                            "num_attrs": len(features)}}
        v = v.withColumn(out, F.col(out).alias(out, metadata=meta))
    return v


VECTOR = "_tbx_features"


def vectorise(df: DataFrame, features: Sequence[str], keep: Sequence[str],
              categorical: dict[str, int] | None = None) -> DataFrame:
    """``keep`` columns and the assembled feature vector, written once.  Fits and scores use
    the vector of such a frame instead of assembling the features again, so folds, seeds and
    trials share one assembly."""
    v = assemble(df.select(*keep, *features), features, VECTOR, categorical)
    return materialize(v.select(*keep, VECTOR))


FIT_ROWS = 250_000  # rows of a task in MLlib's fits, which hold all features of a row as bins


def _parted(df: DataFrame) -> DataFrame:
    """``df`` in tasks of at most about FIT_ROWS rows; splits of a file may hold all of its rows
    or none, so their number alone says little."""
    parts = math.ceil(df.count() / FIT_ROWS)
    return df.repartition(max(parts, df.rdd.getNumPartitions())) if parts > 1 else df


def _training(df: DataFrame, cols: Sequence[str], features: Sequence[str],
              categorical: dict[str, int] | None) -> DataFrame:
    if VECTOR in df.columns:
        return df.select(*cols, VECTOR)
    return assemble(df.select(*cols, *features), features, VECTOR, categorical)


def categorical_arity(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Number of levels of code columns (max code + 1), one aggregate row."""
    r = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    return {c: int(r[c]) + 1 for c in cols if r[c] is not None and r[c] >= 0}


@dataclass
class Fitted:
    model: object
    features: list[str]
    kind: str
    extra: dict = field(default_factory=dict)


def _bins(cfg: TreeConfig, categorical: dict[str, int] | None) -> int:
    return max([cfg.max_bins, *(n + 1 for n in (categorical or {}).values())])


INTERNAL_PATIENCE = 10
GIVEN_PATIENCE = 100


def _uses_mllib(df: DataFrame, features: Sequence[str], cfg: TreeConfig) -> bool:
    from pyspark.ml.linalg import VectorUDT
    return (cfg.learner == "mllib" or VECTOR in df.columns
            or any(isinstance(df.schema[c].dataType, VectorUDT) for c in features))


def fit_gbt(df: DataFrame, features: Sequence[str], cfg: TreeConfig = TreeConfig(),
            label: str = "y", weight: str | None = None, val_col: str | None = None,
            internal_val: float | None = None,
            categorical: dict[str, int] | None = None, id_col: str = "id",
            balanced: bool = False) -> Fitted:
    """Gradient-boosted trees.  ``val_col``: given early-stopping flag (G2);
    ``internal_val``: carve that share of the training rows as the early-stopping part
    (G1); neither: fixed rounds (G3).  ``categorical``: code columns split as categories.
    ``balanced``: classes weighted to equal sums over the rows trained on."""
    d = df
    if internal_val:
        val_col = "_tbx_val"
        d = holdout(d, internal_val, seed=cfg.seed, id_col=id_col, y=label, name=val_col)
    if not _uses_mllib(df, features, cfg):
        wait = 0 if not val_col else INTERNAL_PATIENCE if internal_val else GIVEN_PATIENCE
        role = F.when(F.col(f"`{val_col}`"), 2).otherwise(1) if val_col else F.lit(1)
        if internal_val:
            d = materialize(d)
        model = B.fit_many(d, features, [B.Job(cfg.boosting(wait), balanced=balanced)], [role],
                           label, weight, id_col, categorical, cfg.max_bins)[0]
        return Fitted(model, list(features), "boosted", {"categorical": categorical or {}})
    if balanced:
        raise ValueError("balanced classes need the histogram learner; give weights instead")
    kw = dict(labelCol=label, featuresCol=VECTOR, maxIter=cfg.max_iter,
              stepSize=cfg.step_size, maxDepth=cfg.max_depth,
              minInstancesPerNode=cfg.min_instances, subsamplingRate=cfg.subsampling_rate,
              featureSubsetStrategy=cfg.feature_subset, minInfoGain=cfg.min_info_gain,
              maxBins=_bins(cfg, categorical), seed=cfg.seed,
              checkpointInterval=10)
    if weight:
        kw["weightCol"] = weight
    if val_col:
        kw["validationIndicatorCol"] = val_col
        kw["validationTol"] = cfg.validation_tol
    checkpoint_dir(df.sparkSession)  # MLlib checkpointInterval needs the shared folder
    est = GBTClassifier(**kw)
    cols = [label] + ([weight] if weight else []) + ([val_col] if val_col else [])
    data = _parted(_training(d, cols, features, categorical))
    return Fitted(est.fit(data), list(features), "gbt", {"categorical": categorical or {}})


def fit_forest(df: DataFrame, features: Sequence[str], cfg: TreeConfig = TreeConfig(),
               label: str = "y", weight: str | None = None,
               categorical: dict[str, int] | None = None) -> Fitted:
    """Extremely randomised trees (``forest``): one random cut for each of the square root
    of the number of features in a node, codes taken as numbers.  With weights, bootstrap, native categories,
    vector features or ``learner="mllib"``: MLlib's forest, whose thresholds are best splits
    and whose depth is at most 30."""
    if not (weight or cfg.bootstrap or categorical or _uses_mllib(df, features, cfg)):
        if cfg.subsampling_rate != 1.0:
            raise ValueError("randomised trees train on all rows")
        take = (None if cfg.feature_subset == "all" else
                max(1, round(float(cfg.feature_subset) * len(features))))
        model = T.fit_forests(df, features, [F.lit(1)], cfg.num_trees, cfg.max_depth,
                              cfg.min_instances, take, [cfg.seed], label)[0]
        return Fitted(model, list(features), "random")
    kw = dict(labelCol=label, featuresCol=VECTOR, numTrees=cfg.num_trees,
              maxDepth=cfg.max_depth, minInstancesPerNode=cfg.min_instances,
              featureSubsetStrategy="sqrt" if cfg.feature_subset == "all" else cfg.feature_subset,
              bootstrap=cfg.bootstrap, maxBins=_bins(cfg, categorical), seed=cfg.seed,
              subsamplingRate=cfg.subsampling_rate, checkpointInterval=10)
    if weight:
        kw["weightCol"] = weight
    cols = [label] + ([weight] if weight else [])
    data = _parted(_training(df, cols, features, categorical))
    checkpoint_dir(df.sparkSession)
    return Fitted(RandomForestClassifier(**kw).fit(data), list(features), "forest",
                  {"categorical": categorical or {}})


def score(fitted: Fitted, df: DataFrame, keep: Sequence[str] = ("id",),
          hard: bool = False, threshold: float = 0.5) -> DataFrame:
    """Probability of class 1 (and ``y_pred = p > threshold`` when ``hard``)."""
    if fitted.kind == "boosted":
        out = B.score_all([fitted.model], df, keep).select(*keep, F.col("p")[0].alias("p"))
    elif fitted.kind == "random":
        out = T.score([fitted.model], df, keep).select(*keep, F.col("p")[0].alias("p"))
    else:
        data = _training(df, keep, fitted.features, fitted.extra.get("categorical"))
        out = fitted.model.transform(data).select(
            *keep, vector_to_array("probability")[1].alias("p"))
    if hard:
        out = out.select("*", (F.col("p") > threshold).cast("int").alias("y_pred"))
    return out


def class_weights(df: DataFrame, y: str = "y", name: str = "w") -> DataFrame:
    """Balanced weights n / (k * n_c) attached to every row: class counts joined back."""
    from tabrix.operators.sampling import class_counts
    cc = class_counts(df, y)
    n, k = (cc.agg(a).scalar() for a in (F.sum("n"), F.count(F.lit(1))))
    w = cc.select(F.col(y).alias("_tbx_y"), (n / (k * F.col("n"))).alias(name))
    return df.join(w, df[y].eqNullSafe(w["_tbx_y"]), "left").drop("_tbx_y")


FitFn = Callable[[DataFrame], Fitted]


def oof(df: DataFrame, fit: FitFn, k: int = 5, seed: int = 42, y: str = "y",
        test: DataFrame | None = None, model: str = "m", id_col: str = "id",
        parallelism: int | None = None, val_col: str | None = None):
    """Out-of-fold scores -- each row scored by the model that did not see it -- and,
    if ``test`` is given, every fold model's test scores.  Returns (oof, test_scores) with
    columns (id, [y,] fold, seed, model, p).  The fold-tagged frame is materialised once
    so that every fold fit reads the same materialised split (a frame that already has a
    ``fold`` column is used as it is).  The k fits are independent Spark jobs and are
    submitted from ``parallelism`` driver threads (default k), as MLlib's own
    cross-validator does; results do not depend on the order they finish in.

    A frame from :func:`vectorise` is assembled once for all folds.  ``val_col``: ``fit`` gets
    all rows with that flag on the fold left out, to stop early on it (the flagged rows are
    not trained on); without it, only the other folds' rows."""
    from concurrent.futures import ThreadPoolExecutor
    if "fold" in df.columns:
        folded = df
    else:
        folded = materialize(kfold(df, k=k, seed=seed, y=y, id_col=id_col))
    with ThreadPoolExecutor(max_workers=max(1, parallelism or k)) as pool:
        def part(f: int) -> DataFrame:
            if val_col:
                return folded.withColumn(val_col, F.col("fold") == f)
            return folded.where(F.col("fold") != f)
        fits = list(pool.map(lambda f: fit(part(f)), range(k)))
    parts, tparts = [], []
    for f, fitted in enumerate(fits):
        sc = score(fitted, folded.where(F.col("fold") == f), keep=(id_col, y))
        parts.append(sc.select(id_col, y, F.lit(f).alias("fold"), "p"))
        if test is not None:
            ts = score(fitted, test, keep=(id_col,))
            tparts.append(ts.select(id_col, F.lit(f).alias("fold"), "p"))
    tag = [F.lit(seed).alias("seed"), F.lit(model).alias("model")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(id_col, y, "fold", *tag, "p")
    tout = None
    if tparts:
        tout = tparts[0]
        for p in tparts[1:]:
            tout = tout.unionByName(p)
        tout = tout.select(id_col, "fold", *tag, "p")
    return out, tout


@dataclass
class Folds:
    """Out-of-fold scores, every fold model's test scores (or None) and the models by
    (configuration, fold)."""
    oof: DataFrame
    test: DataFrame | None
    models: dict[tuple[int, int], Fitted]


def oof_gbt(df: DataFrame, features: Sequence[str], cfgs: Sequence[TreeConfig], k: int = 5,
            y: str = "y", test: DataFrame | None = None, model: str = "gbt", id_col: str = "id",
            internal_val: float | None = None, stop_on_fold: bool = False,
            categorical: dict[str, int] | None = None, balanced: bool = False) -> Folds:
    """G8 for boosted trees: k folds for each of ``cfgs``, split by its seed (or by a ``fold``
    column that is there), grown together; rows are scored by the models that did not see them
    in one scan, test rows by all models in another.  Tables as :func:`oof` gives them.

    ``stop_on_fold``: stop early on the fold left out; ``internal_val``: on that share of the
    other folds' rows."""
    d, own = df, []
    for i, cfg in enumerate(cfgs):
        name = f"_tbx_fold{i}"
        d = (d.withColumn(name, F.col("fold")) if "fold" in df.columns
             else kfold(d, k=k, seed=cfg.seed, y=y, id_col=id_col, name=name))
        if internal_val:
            d = holdout(d, internal_val, seed=cfg.seed, id_col=id_col, y=y, name=f"_tbx_val{i}")
        own.append(F.col(name))
    d = materialize(d)
    jobs, roles = [], []
    for i, cfg in enumerate(cfgs):
        for f in range(k):
            out = own[i] == f
            role = F.when(out, 2 if stop_on_fold else 0)
            if internal_val:
                role = role.when(F.col(f"_tbx_val{i}"), 2)
            wait = INTERNAL_PATIENCE if internal_val else GIVEN_PATIENCE if stop_on_fold else 0
            jobs.append(B.Job(cfg.boosting(wait), len(roles), balanced))
            roles.append(role.otherwise(1))
    fits = B.fit_many(d, features, jobs, roles, y, None, id_col, categorical,
                      cfgs[0].max_bins)
    seed = F.array(*[F.lit(c.seed) for c in cfgs])
    scored = B.score_own(fits, d, [id_col, y, *[f"_tbx_fold{i}" for i in range(len(cfgs))]],
                         [F.lit(i * k) + c for i, c in enumerate(own)])
    fold = F.array(*own)
    oof = scored.select(id_col, y, fold.alias("_f"), F.posexplode("p").alias("_i", "p")).select(
        id_col, y, F.col("_f")[F.col("_i")].alias("fold"), seed[F.col("_i")].alias("seed"),
        F.lit(model).alias("model"), "p")
    test_scores = None
    if test is not None:
        test_scores = (B.score_all(fits, test, [id_col])
                       .select(id_col, F.posexplode("p").alias("_i", "p"))
                       .select(id_col, (F.col("_i") % k).alias("fold"),
                               seed[F.floor(F.col("_i") / k).cast("int")].alias("seed"),
                               F.lit(model).alias("model"), "p"))
    return Folds(oof, test_scores, {(i // k, i % k): Fitted(
        m, list(features), "boosted", {"categorical": categorical or {}})
        for i, m in enumerate(fits)})


def oof_forest(df: DataFrame, features: Sequence[str], cfg: TreeConfig, k: int = 5,
               y: str = "y", test: DataFrame | None = None, model: str = "forest",
               id_col: str = "id") -> Folds:
    """G8 for forests of randomised trees: the k fold forests grow in the same passes; one scan
    for the out-of-fold scores, one for test."""
    name = "_tbx_fold"
    d = (df.withColumn(name, F.col("fold")) if "fold" in df.columns
         else kfold(df, k=k, seed=cfg.seed, y=y, id_col=id_col, name=name))
    d = materialize(d)
    fits = T.fit_forests(d, features, [F.when(F.col(name) != f, 1) for f in range(k)],
                         cfg.num_trees, cfg.max_depth, cfg.min_instances, None,
                         [cfg.seed + f for f in range(k)], y)
    tag = [F.lit(cfg.seed).alias("seed"), F.lit(model).alias("model"), "p"]
    oof = T.score(fits, d, [id_col, y, name], F.col(name)).select(
        id_col, y, F.col(name).alias("fold"), *tag)
    test_scores = None
    if test is not None:
        test_scores = (T.score(fits, test, [id_col])
                       .select(id_col, F.posexplode("p").alias("fold", "p"))
                       .select(id_col, "fold", *tag))
    return Folds(oof, test_scores, {(0, f): Fitted(m, list(features), "random")
                                    for f, m in enumerate(fits)})
