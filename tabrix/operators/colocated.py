"""J4, G9-G11 on co-located tables: written once in buckets of the id, then joined and averaged
without moving a row.

A table that is scored, averaged and blended several times is hashed by its key once, when it is
written to the shared folder.  Aggregations and joins on the key then read their bucket from both
sides.  Whether every key has exactly one row on each side is found in the same pass: the job
fails at a key that has not.  Keys must have one type on all sides (the bucket of an int is not
that of a long; results stay right, but rows move).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.session import shuffle_partitions
from tabrix.sources.io import scratch_path


def buckets(spark) -> int:
    """``spark.tabrix.scoreBuckets``, else the shuffle partitions; all tables that are to meet
    need one number."""
    return int(spark.conf.get("spark.tabrix.scoreBuckets", None) or shuffle_partitions(spark))


def bucketed(df: DataFrame, key: str = "id", n: int | None = None) -> DataFrame:
    """``df`` written once as a table of ``n`` buckets by ``key``, sorted within them."""
    spark = df.sparkSession
    n = n or buckets(spark)
    name = f"tabrix_{uuid.uuid4().hex}"
    (df.repartition(n, F.col(f"`{key}`")).write.format("parquet").bucketBy(n, key).sortBy(key)
     .option("path", scratch_path(spark, "bucketed")).saveAsTable(name))
    return spark.table(name)


def _fail(what: str, key: Column) -> Column:
    return F.raise_error(F.concat(F.lit(what), F.coalesce(key.cast("string"), F.lit("null")))
                         ).cast("boolean")


def attach_colocated(df: DataFrame, scores: DataFrame, key: str = "id") -> DataFrame:
    """J4 of two tables ``bucketed`` by ``key``: the rows of ``df`` with the other columns of
    ``scores``.  A key that is null, repeated or without a partner ends the job."""
    order = Window.partitionBy("_tbx_k").orderBy("_tbx_k")
    values = [c for c in scores.columns if c != key]
    a = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_tbx_a"),
                  F.col(f"`{key}`").alias("_tbx_k"))
    b = scores.select(F.struct(F.lit(True), *[F.col(f"`{c}`") for c in values]).alias("_tbx_b"),
                      F.col(f"`{key}`").alias("_tbx_k"))
    a = a.withColumn("_tbx_i", F.row_number().over(order)).alias("a")
    b = b.withColumn("_tbx_j", F.row_number().over(order)).alias("b")
    ka, kb = F.col("a._tbx_k"), F.col("b._tbx_k")
    once = F.col("_tbx_i").eqNullSafe(F.lit(1)) & F.col("_tbx_j").eqNullSafe(F.lit(1))
    met = a.join(b, ka == kb, "full").where(F.when(once, F.lit(True)).otherwise(
        _fail(f"attach_scores: not one row and one score for {key} ", F.coalesce(ka, kb))))
    return met.select(*[F.col("_tbx_a")[c].alias(c) for c in df.columns],
                      *[F.col("_tbx_b")[c].alias(c) for c in values])


def blend_colocated(scores: DataFrame, weights: Mapping[str, float], part: str = "model",
                    id_col: str = "id", p: str = "p", each: int | None = 1) -> DataFrame:
    """G9-G11 of one long table of scores ``bucketed`` by ``id_col`` with a row per id, part and
    model of that part: per id the weighted sum of the parts' mean scores, in one aggregation.

    Every id needs ``each`` scores of every part (None: any number above 0); a missing or extra
    one, or a null score, ends the job.  Parts without a weight are an error too."""
    if not weights:
        raise ValueError("no parts to blend")
    of = {m: F.col(f"`{part}`") == F.lit(m) for m in weights}
    sums = {m: F.sum(F.when(of[m], F.col(f"`{p}`"))) for m in weights}
    counts = {m: F.count(F.when(of[m], F.col(f"`{p}`"))) for m in weights}
    names = list(weights)
    per = scores.groupBy(F.col(f"`{id_col}`").alias("_tbx_k")).agg(
        F.count(F.lit(1)).alias("_tbx_n"),
        *[sums[m].alias(f"_tbx_s{i}") for i, m in enumerate(names)],
        *[counts[m].alias(f"_tbx_c{i}") for i, m in enumerate(names)])
    held = [F.col(f"_tbx_c{i}") for i in range(len(names))]
    whole = sum(held, F.lit(0)) == F.col("_tbx_n")
    for c in held:
        whole = whole & ((c == each) if each is not None else (c > 0))
    value = sum((F.col(f"_tbx_s{i}") / held[i] * F.lit(float(weights[m]))
                 for i, m in enumerate(names)), F.lit(0.0))
    ok = F.when(whole & F.col("_tbx_k").isNotNull(), F.lit(True)).otherwise(
        _fail(f"blend: scores are missing, null or too many for {id_col} ", F.col("_tbx_k")))
    return per.where(ok).select(F.col("_tbx_k").alias(id_col), value.alias(p))
