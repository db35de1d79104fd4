"""Exact ranks and prefix sums without a single-task window.

``row_number() over (partition by c order by k)`` sends a whole class to one task, and with
no partition at all the whole table.  Here the order is cut into contiguous *buckets*:

* a range partition of the (unique) sort key, sampled by Spark, which stays balanced even
  when one class or one score value holds a third of all rows (the tagged rows are
  written once to the shared folder, see below); or
* a caller-given bucket column that is a monotone prefix of the sort key (for example the
  first hex digits of an md5 ordering key), which needs no extra shuffle at all.

Per-bucket totals form a small table (<= buckets x groups rows); its running sums are the
bucket offsets.  Inside each bucket a window adds the local running sum.  offset + local is
exactly the global running sum, i.e. the plain SQL window result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.session import materialize, rows_per_task, shuffle_partitions

_BUCKET = "_tbx_bucket"
_GROUP = "_tbx_group"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_prefix(df: DataFrame, order: Sequence, sums: Mapping[str, Column],
                   by: Sequence[str] = (), bucket: Column | None = None,
                   num_buckets: int | None = None, lag: Sequence[str] = ()) -> DataFrame:
    """Add, for every name in ``sums``, the inclusive running sum of its expression over
    the rows of each ``by`` group taken in ``order`` (which must be a total order within a
    group, e.g. end with a unique id, so the result is deterministic).

    ``bucket``: optional Column, non-decreasing along ``order`` within each group.  When it
    is None the rows are range-partitioned on (by, order) into ``num_buckets`` slices
    (default: enough for ``spark.tabrix.rowsPerTask`` rows each, at least the shuffle
    partitions).  The per-bucket totals are materialised; from them the local windows get
    an exchange sized to the same row target when the data is large.
    ``lag``: columns whose value on the previous row of the group is added as
    ``prev_<col>`` (NULL on the first row); across a bucket boundary it comes from the last
    row of the nearest earlier bucket, carried in the same small offsets table.  Ascending
    plain-column orders only.
    """
    by = list(by)
    order_cols = [_col(c) for c in order]
    spark = df.sparkSession
    base = shuffle_partitions(spark)
    target = rows_per_task(spark)
    if bucket is None:
        # slices sized from the data: never fewer than the shuffle partitions, never more
        # than ``target`` rows each on average (one counting pass over the input)
        # one evaluation of the input: it is counted, sampled for the bounds and sliced from
        # the written copy
        df = materialize(df)
        counted = df.count()
        n = num_buckets or max(base, -(-counted // target))
        # The range bounds come from a sample seeded by the exchange's RDD id, so two
        # evaluations of the same plan may cut differently.  Tag each row with its slice
        # once and materialise it (parquet, shared folder): totals and local sums agree.
        keyed = materialize(df.repartitionByRange(n, *[F.col(b) for b in by], *order_cols)
                              .withColumn(_BUCKET, F.spark_partition_id()))
    else:
        counted = None
        keyed = df.withColumn(_BUCKET, bucket)
    # the group as one non-null key: structs compare null fields as equal, so the join below
    # is a plain equality and reuses the local windows' partitioning
    if by:
        keyed = keyed.withColumn(_GROUP, F.struct(*by))
    group = [_GROUP] if by else []
    # with no groups the offsets table has one row per bucket: bounded by num_buckets or by
    # the caller's bucket domain, so it is safe to broadcast.  With groups, AQE sees its
    # real size at runtime and picks broadcast or a co-partitioned shuffle join.
    small_offsets = not by

    names = list(sums)
    tmp = {n: f"_tbx_v_{i}" for i, n in enumerate(names)}
    keyed = keyed.select("*", *[sums[n].alias(tmp[n]) for n in names])

    lag = list(lag)
    okey = F.struct(*order_cols)
    # totals per (bucket, group) -> exclusive running sums across buckets = offsets;
    # the last row's lag columns of each (bucket, group), shifted by one bucket.
    counts_of = keyed
    if bucket is None and by:
        # range slices: a group lies in several only where it crosses a bound, which at most
        # one group a bound does; no other group has an offset
        crossing = materialize(
            keyed.groupBy(*by).agg(F.min(_BUCKET).alias("_tbx_lo"), F.max(_BUCKET).alias("_tbx_hi"))
            .where("_tbx_lo < _tbx_hi").select(F.struct(*by).alias("_tbx_crossing")))
        small_offsets = True
        counts_of = keyed.join(F.broadcast(crossing),
                               keyed[_GROUP] == crossing["_tbx_crossing"], "left_semi")
    tot = materialize(counts_of.groupBy(_BUCKET, *group).agg(
        F.count(F.lit(1)).alias("_tbx_rows"),
        *[F.sum(tmp[n]).alias(tmp[n]) for n in names],
        *[F.max_by(F.col(c), okey).alias(f"_tbx_last_{c}") for c in lag]))
    # rows per (bucket, group) are known now: size the local windows' exchange so that no
    # task holds more than ``target`` rows on average (AQE can coalesce, never split)
    total_rows = counted if counted is not None else (tot.agg(F.sum("_tbx_rows")).first()[0] or 0)
    tasks = -(-total_rows // target)
    w_off = (Window.partitionBy(*group).orderBy(_BUCKET)
             .rowsBetween(Window.unboundedPreceding, -1))
    w_prev = Window.partitionBy(*group).orderBy(_BUCKET)
    offs = tot.select(_BUCKET, *group, *[
        F.coalesce(F.sum(tmp[n]).over(w_off), F.lit(0)).alias(tmp[n] + "_off") for n in names],
        *[F.lag(f"_tbx_last_{c}").over(w_prev).alias(f"_tbx_plast_{c}") for c in lag])
    if small_offsets:
        offs = F.broadcast(offs)

    w_loc = (Window.partitionBy(_BUCKET, *group).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_row = Window.partitionBy(_BUCKET, *group).orderBy(*order_cols)
    src = keyed.repartition(tasks, _BUCKET, *group) if tasks > base else keyed
    loc = src.select("*", *[F.sum(tmp[n]).over(w_loc).alias(tmp[n] + "_loc") for n in names],
                       *([F.row_number().over(w_row).alias("_tbx_lrn")] if lag else []),
                       *[F.lag(c).over(w_row).alias(f"_tbx_llag_{c}") for c in lag])

    cond = [loc[c] == offs[c] for c in [_BUCKET, *group]]
    partial = bucket is None and by  # only groups in several slices have offsets
    j = loc.join(offs, cond, "left" if partial else "inner")
    out_cols = [loc[c] for c in df.columns]
    return j.select(*out_cols, *[
        ((F.coalesce(offs[tmp[n] + "_off"], F.lit(0)) if partial else offs[tmp[n] + "_off"])
         + loc[tmp[n] + "_loc"]).alias(n) for n in names], *[
        F.when(loc["_tbx_lrn"] == 1, offs[f"_tbx_plast_{c}"])
         .otherwise(loc[f"_tbx_llag_{c}"]).alias(f"prev_{c}") for c in lag])


def exact_rank(df: DataFrame, order: Sequence, by: Sequence[str] = (), name: str = "rank",
               bucket: Column | None = None, num_buckets: int | None = None,
               lag: Sequence[str] = ()) -> DataFrame:
    """``row_number()`` over (partition by ``by`` order by ``order``), computed exactly and
    without single-task windows.  ``order`` must be unique within a group.  ``lag`` adds
    ``prev_<col>`` as ``lag(col)`` over the same window would."""
    return ordered_prefix(df, order, {name: F.lit(1).cast("long")}, by=by, bucket=bucket,
                          num_buckets=num_buckets, lag=lag)


# md5 ordering key used by every seeded operator: identical digest in Spark and DuckDB.
def seed_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(":"), F.lit(str(seed))))


def seeded_rank(df: DataFrame, id_col: str, seed: int, by: Sequence[str] = (),
                name: str = "rank", digits: int = 4, duplicates: str = "unique") -> DataFrame:
    """Rank rows in seeded pseudo-random order: order by md5(id:seed), id.

    The first ``digits`` hex digits of the key are a monotone prefix of the order and are
    uniform whatever the data, so they bucket every class into 16**digits even slices.

    ``duplicates='split'`` is for inputs whose ids repeat (a group of copies may hold a
    third of the rows): rows get a unique tag written once with the data (so it is stable
    on recomputation), the order becomes (md5 key, id, tag) and range buckets split a hot
    copy group across tasks.  Ranks among copies of one id then follow the tag.
    """
    key = seed_key(id_col, seed)
    keyed = df.withColumn("_tbx_key", key)
    if duplicates == "split":
        from tabrix.session import materialize
        tagged = materialize(keyed.withColumn("_tbx_tag", F.monotonically_increasing_id()))
        r = exact_rank(tagged, ["_tbx_key", id_col, "_tbx_tag"], by=by, name=name)
        return r.drop("_tbx_key", "_tbx_tag")
    if duplicates != "unique":
        raise ValueError(duplicates)
    # a null id has no key; nulls come first, so do their buckets
    bucket = F.coalesce(F.conv(F.substring(key, 1, digits), 16, 10).cast("int"), F.lit(-1))
    r = exact_rank(keyed, ["_tbx_key", id_col], by=by, name=name, bucket=bucket)
    return r.drop("_tbx_key")
