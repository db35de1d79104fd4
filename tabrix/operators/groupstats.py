"""A1-A9 aggregations and W1-W3 group statistics broadcast back to rows.

Group means are computed with one shuffle-light aggregation (partial aggregation on the map
side, so a key holding a third of the rows costs nothing extra) and joined back, never with
``Window.partitionBy(key)``, which would put a whole hot group into one task.
Several (key, target) pairs are computed in a single pass over the data with an unpivot
(Expand) before the partial aggregate -- the GROUPING SETS idea.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.operators.joins import sized_broadcast
from tabrix.operators.ranking import ordered_prefix
from tabrix.session import materialize, rows_per_task

EPS = 1e-5  # fixed value: ratio epsilon of the reference recipes


def mean_by(df: DataFrame, key: str, target: str, name: str | None = None) -> DataFrame:
    """A1: mean of ``target`` per non-null ``key`` (NULL targets skipped)."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.avg(target).alias(name or f"{target}_mean")))


def size_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """A2: rows per non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def global_mean(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """A3."""
    return df.agg(F.avg(col).alias(name or f"{col}_mean"))


def global_min_max(df: DataFrame, col: str) -> DataFrame:
    """A4."""
    return df.agg(F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))


def count_id_by(df: DataFrame, key: str, id_col: str = "id", name: str = "n") -> DataFrame:
    """A5: count of non-null ids per key (NULL keys kept as their own group, like SQL)."""
    return df.groupBy(key).agg(F.count(id_col).alias(name))


def relative_frequency(df: DataFrame, key: str, name: str = "freq") -> DataFrame:
    """Share of each non-null level among non-null rows."""
    c = materialize(size_by(df, key, "_n").where(F.col(key).isNotNull()))
    total = c.agg(F.sum("_n")).scalar()
    return c.select(key, (F.col("_n") / total).alias(name))


def mean_std_pop(df: DataFrame, col: str) -> DataFrame:
    """Mean and population standard deviation."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact interpolated medians of many numeric columns in one pass.

    Not ``percentile`` (holds every distinct value of a column in one buffer): values are
    counted per (column, value), ranked by an exact bucketed prefix sum, and the two middle
    order statistics are picked.  Returns one row per column: (feature, median).
    """
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("s")).select("s.*").where(F.col("v").isNotNull())
    cnt = long.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c"))
    cum = ordered_prefix(cnt, ["v"], {"cum": F.col("c")}, by=["feature"])
    # totals from the running counts (read back from the materialised buckets): the data
    # itself is scanned once
    tot = cum.groupBy("feature").agg(F.max("cum").alias("n"))
    lo_k = F.floor((F.col("n") + 1) / 2)  # lower middle rank
    hi_k = F.floor(F.col("n") / 2) + 1    # upper middle rank
    j = cum.join(F.broadcast(tot), "feature")  # one row per column
    # value at rank k = the first value whose running count reaches k
    picked = j.where(((F.col("cum") - F.col("c")) < hi_k) & (F.col("cum") >= lo_k))
    return picked.groupBy("feature").agg(
        ((F.min("v") + F.max("v")) / 2).alias("median"))


def grouped_means(df: DataFrame, keys: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Means of every target for every key, in one scan: (key_col, level, <target>...).
    Rows are unpivoted over the keys only (Expand before the partial aggregate); NULL
    levels are dropped (they never match)."""
    pieces = [F.struct(F.lit(k).alias("key_col"), F.col(k).cast("string").alias("level"),
                       *[F.col(t).cast("double").alias(t) for t in targets]) for k in keys]
    long = df.select(F.explode(F.array(*pieces)).alias("s")).select("s.*")
    return (long.where(F.col("level").isNotNull()).groupBy("key_col", "level")
                .agg(*[F.avg(t).alias(t) for t in targets]))


def add_group_means(df: DataFrame, keys: Sequence[str], targets: Sequence[str],
                    fit_on: DataFrame | None = None, ratio: bool = True,
                    mean_fmt: str = "{t}_mean_by_{k}", ratio_fmt: str = "{t}_ratio_by_{k}",
                    ) -> DataFrame:
    """For each (key, target) add the group mean (and ``x/(mean+1e-5)``) to rows.

    Statistics come from ``fit_on`` (default: ``df`` itself) in one scan.  The statistics
    table (one row per key level) is materialised and counted; each key's slice is
    broadcast behind that count, otherwise joined by shuffle (AQE handles a hot level)."""
    stats = materialize(grouped_means(fit_on if fit_on is not None else df, keys, targets))
    n_stats = stats.count()
    out = df
    cols = list(df.columns)
    for k in keys:
        wide = stats.where(F.col("key_col") == k).select(
            F.col("level").alias(f"_lvl_{k}"), *[F.col(t).alias(f"_m_{k}_{t}") for t in targets])
        out = out.join(sized_broadcast(wide, n_stats),
                       out[k].cast("string") == wide[f"_lvl_{k}"], "left")
        for t in targets:
            m = F.col(f"_m_{k}_{t}")
            cols.append(m.alias(mean_fmt.format(t=t, k=k)))
            if ratio:
                cols.append(F.try_divide(F.col(t).cast("double"), m + F.lit(EPS))
                            .alias(ratio_fmt.format(t=t, k=k)))
    return out.select(*cols)


def add_group_count(df: DataFrame, key: str, id_col: str = "id",
                    name: str = "user_count") -> DataFrame:
    """Number of non-null ids sharing the row's key (high-cardinality key); NULL key -> NULL.

    Partial aggregation absorbs a hot key.  For the way back, rows of keys with more than
    ``rows_per_task`` rows, and rows without a key, are salted by a hash of their id, and only
    those keys' counts are copied per salt.  Such keys are few (all rows / rows_per_task)."""
    spark = df.sparkSession
    target = rows_per_task(spark)
    cnt = materialize(df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_tbx_key"))
                      .agg(F.count(id_col).alias(name), F.count(F.lit(1)).alias("_tbx_rows")))
    top = cnt.agg(F.max("_tbx_rows")).first()[0] or 0
    if top <= target:
        j = df.join(cnt.drop("_tbx_rows"), df[key] == cnt["_tbx_key"], "left")
        return j.drop("_tbx_key")
    salts = -(-top // target)
    hot = cnt.where(F.col("_tbx_rows") > target).select(F.col("_tbx_key").alias("_tbx_hot"))
    draw = F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int")
    rows = df.join(sized_broadcast(hot, hot.count()), df[key] == hot["_tbx_hot"], "left")
    rows = rows.select("*", F.when(F.col("_tbx_hot").isNotNull() | F.col(key).isNull(), draw)
                       .otherwise(F.lit(0)).alias("_tbx_salt"))
    last = F.when(F.col("_tbx_rows") > target, F.lit(salts - 1)).otherwise(F.lit(0))
    copies = cnt.select("_tbx_key", name, F.explode(F.sequence(F.lit(0), last)).alias("_tbx_s"))
    j = rows.join(copies, (rows[key] == copies["_tbx_key"])
                  & (rows["_tbx_salt"] == copies["_tbx_s"]), "left")
    return j.drop("_tbx_key", "_tbx_hot", "_tbx_salt", "_tbx_s")
