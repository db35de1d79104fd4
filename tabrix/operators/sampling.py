"""X1-X5 sampling and splitting, K1-K3 ordering operators, S3 holdout carving.

Seeded operators order rows by md5(id:seed), id -- the same digest in every engine -- and
rank them exactly with the bucketed prefix sum (no class-sized windows).  Ids are expected
to be unique; ``duplicates='split'`` handles inputs where copies of one id are common.  scikit-learn's
row choice is not reproduced (its RNG is not portable); counts and balance are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.operators.ranking import exact_rank, seed_key, seeded_rank
from tabrix.session import materialize


def class_counts(df: DataFrame, y: str) -> DataFrame:
    """Per-class row counts: ``y``, ``n`` (one row per class)."""
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))


def sample_n(df: DataFrame, n: int, seed: int = 42, id_col: str = "id",
             duplicates: str = "unique") -> DataFrame:
    """Exactly ``n`` rows (all if fewer), chosen by the seeded order."""
    r = seeded_rank(df, id_col, seed, name="_tbx_rk", duplicates=duplicates)
    return r.where(F.col("_tbx_rk") <= n).drop("_tbx_rk")


def balance(df: DataFrame, y: str = "y", seed: int = 42, id_col: str = "id",
            duplicates: str = "unique") -> DataFrame:
    """Undersample every class to the smallest class count (exact counts)."""
    m = class_counts(df, y).agg(F.min("n")).scalar()
    r = seeded_rank(df, id_col, seed, by=[y], name="_tbx_rk", duplicates=duplicates)
    return r.where(F.col("_tbx_rk") <= m).drop("_tbx_rk")


def holdout(df: DataFrame, frac: float = 0.2, seed: int = 42, id_col: str = "id",
            y: str | None = None, name: str = "is_holdout",
            duplicates: str = "unique") -> DataFrame:
    """Flag an exact holdout part.

    Plain: ``ceil(frac*n)`` rows.  Stratified on ``y``: the same total, spread over classes
    in proportion, floors first and the remainder to the largest fractional parts (ties to
    the smaller class value) -- scikit-learn's allocation with a deterministic tie rule.

    The flagged rows are those up to one place of the seeded order (of each class), so rows
    are compared with that place and not moved.  Labels of more than ``CUT_CLASSES`` values and
    ids that repeat at the place itself are ranked instead."""
    cut = _cuts(df, frac, seed, id_col, y) if duplicates == "unique" else None
    if cut is not None:
        return df.select(*[column(c) for c in df.columns], cut.alias(name))
    return _ranked_holdout(df, frac, seed, id_col, y, name, duplicates)


def _ranked_holdout(df: DataFrame, frac: float, seed: int, id_col: str, y: str | None, name: str,
                    duplicates: str) -> DataFrame:
    """:func:`holdout` by the rank of every row."""
    if y is None:
        n_hold = F.ceil(F.lit(frac) * df.agg(F.count(F.lit(1))).scalar())
        r = seeded_rank(df, id_col, seed, name="_tbx_rk", duplicates=duplicates)
        return r.select(*df.columns, (F.col("_tbx_rk") <= n_hold).alias(name))
    q = stratified_quota(class_counts(df, y), y, frac)
    r = seeded_rank(df, id_col, seed, by=[y], name="_tbx_rk", duplicates=duplicates)
    j = r.join(q, r[y].eqNullSafe(q["_tbx_y"]), "left")
    return j.select(*[r[c] for c in df.columns],
                    (F.col("_tbx_rk") <= F.coalesce(F.col("_tbx_q"), F.lit(0))).alias(name))


CUT_CLASSES = 8  # classes whose cuts are looked for; each takes a small job
CUT_ROWS = 50_000  # rows of the seeded order that are sorted to find a cut


def column(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _cuts(df: DataFrame, frac: float, seed: int, id_col: str, y: str | None) -> Column | None:
    """Whether a row is in the holdout part, from the last place of each class's part in the
    seeded order; None where there are too many classes or ids repeat at that place.

    Rows are counted by class and leading digits of the key; only the rows of the
    slice that holds the cut are sorted."""
    whole = ("integer", "long", "short", "byte", "string")
    if any(c is not None and df.schema[c].dataType.typeName() not in whole for c in (id_col, y)):
        return None
    rows = df.select((column(y) if y is not None else F.lit(0)).alias("y"),
                     column(id_col).alias("id"), seed_key(id_col, seed).alias("key"))
    most = CUT_CLASSES * 4097  # slices of three digits, and rows without a key
    slices = (rows.groupBy("y", F.substring("key", 1, 3).alias("d"))
              .agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect())
    counts: dict = {}
    for r in slices:
        counts[r["y"]] = counts.get(r["y"], 0) + r["n"]
    if len(slices) > most or len(counts) > CUT_CLASSES:
        return None
    out = F.lit(False)
    for c, left in _quotas(counts, frac).items():
        if not left:
            continue
        part = rows.where(F.col("y").eqNullSafe(F.lit(c)))
        found = {r["d"]: r["n"] for r in slices if r["y"] == c}
        while True:
            for lead in sorted(found, key=lambda d: d or ""):  # rows without a key come first
                if left <= found[lead]:
                    break
                left -= found[lead]
            if lead is None:
                return None
            inside = part.where(F.col("key").startswith(lead))
            if found[lead] <= CUT_ROWS or len(lead) >= 30:
                break
            found = {r["d"]: r["n"] for r in inside.groupBy(
                F.substring("key", 1, len(lead) + 3).alias("d")).agg(
                F.count(F.lit(1)).alias("n")).collect()}
        near = inside.orderBy("key", "id").select("key", "id").limit(left + 1).offset(
            left - 1).collect()
        if len(near) == 2 and near[0] == near[1]:
            return None
        # one comparison, so that the key is computed once; no key is below every key
        upto = (F.struct(seed_key(id_col, seed).alias("k"), column(id_col).alias("i"))
                <= F.struct(F.lit(near[0]["key"]).alias("k"),
                            F.lit(near[0]["id"]).cast(df.schema[id_col].dataType).alias("i")))
        mine = F.lit(True) if y is None else column(y).eqNullSafe(F.lit(c))
        out = F.when(mine, upto).otherwise(out)
    return out


def _quotas(counts: dict, frac: float) -> dict:
    """:func:`stratified_quota` of a few classes, at the driver."""
    total = sum(counts.values())
    n_hold = math.ceil(frac * total)
    share = {c: float(n * n_hold) / float(total) for c, n in counts.items()}
    quota = {c: math.floor(s) for c, s in share.items()}
    left = n_hold - sum(quota.values())
    order = sorted(counts, key=lambda c: (quota[c] - share[c], c is None, 0 if c is None else c))
    return {c: quota[c] + (i < left) for i, c in enumerate(order)}


def stratified_quota(counts: DataFrame, y: str, frac: float) -> DataFrame:
    """Holdout rows per class (``_tbx_y``, ``_tbx_q``) from the (y, n) class table: floors
    of the proportional shares, the remainder by largest fraction, ties by class, null last."""
    total = counts.agg(F.sum("n")).scalar()
    n_hold = F.ceil(F.lit(frac) * total)
    share = F.col("n") * n_hold / total
    part = counts.select(F.col(y).alias("_tbx_y"), F.floor(share).alias("base"),
                         (share - F.floor(share)).alias("rest"))
    left = n_hold - part.agg(F.sum("base")).scalar()
    # range buckets: a label with very many values does not meet in one task
    ranked = exact_rank(part, [-F.col("rest"), F.col("_tbx_y").isNull(), "_tbx_y"], name="_tbx_o")
    return ranked.select("_tbx_y", (F.col("base") + (F.col("_tbx_o") <= left)
                                    .cast("int")).alias("_tbx_q"))


def kfold(df: DataFrame, k: int = 5, seed: int = 42, y: str | None = "y",
          id_col: str = "id", name: str = "fold", duplicates: str = "unique") -> DataFrame:
    """(stratified) shuffled k-fold: ``fold = (rank_in_class - 1) % k``, so class counts
    differ by at most one across folds."""
    by = [y] if y else []
    r = seeded_rank(df, id_col, seed, by=by, name="_tbx_rk", duplicates=duplicates)
    return r.select(*df.columns, ((F.col("_tbx_rk") - 1) % k).cast("int").alias(name))


def shuffle(df: DataFrame, seed: int = 42, id_col: str = "id") -> DataFrame:
    """K3: seeded row order (meaningful for output order only)."""
    return df.orderBy(seed_key(id_col, seed), F.col(id_col))


def top_k(df: DataFrame, by: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """K1: the ``k`` largest by ``by`` (ties broken by ``tie`` ascending)."""
    return df.orderBy(F.col(by).desc(), *[F.col(t) for t in tie]).limit(k)


def extremes(df: DataFrame, score: str = "p", frac: float = 0.05, id_col: str = "id",
             n: int | None = None) -> DataFrame:
    """K2: lowest and highest ``n = int(frac*N)`` rows by score (ties by id, ascending
    order; the highest are the last n) among the N rows that have a score; a given ``n`` is
    halved where both ends would meet.  n = 0 gives no rows.  Adds ``end`` = 'top' /
    'bottom'.  Exact rank via a range-partitioned prefix sum, so a score value shared by a
    third of the rows still splits across tasks."""
    if n is None and not 0 <= frac <= 0.5:
        raise ValueError("frac must lie between 0 and 0.5: the two ends would overlap")
    known = df.where(F.col(score).isNotNull())
    total = known.agg(F.count(F.lit(1))).scalar()
    nn = F.lit(n) if n is not None else F.floor(F.lit(frac) * total)
    nn = F.least(nn, F.floor(total / 2))
    r = exact_rank(known, [score, id_col], name="_tbx_rk")
    end = (F.when(F.col("_tbx_rk") <= nn, F.lit("bottom"))
            .when(F.col("_tbx_rk") > total - nn, F.lit("top")))
    return (r.select(*df.columns, end.alias("end")).where(F.col("end").isNotNull()))


def carve_holdout(df: DataFrame, n: int, seed: int, id_base: int, id_col: str = "id",
                  y: str = "y"):
    """S3: sample ``n`` rows as a pseudo-test set: drop ``y``, renumber ids from
    ``id_base`` in sampled order, and remove them from train.  Returns (train, test)."""
    # written once, so that both parts come from one ranking
    r = materialize(seeded_rank(df, id_col, seed, name="_tbx_rk"))
    picked = r.where(F.col("_tbx_rk") <= n)
    test = picked.select(*[(F.lit(id_base) + F.col("_tbx_rk") - 1).cast("long").alias(c)
                           if c == id_col else F.col(c) for c in df.columns if c != y])
    train = r.where(F.col("_tbx_rk") > n).drop("_tbx_rk")
    return train, test
