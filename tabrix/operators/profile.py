"""P1-P5 profiling.  Each is one aggregation pass; many columns are unpivoted so that a
single scan serves them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, value, n) for many columns in one pass; NULL values excluded.
    Order by n desc for display; counts are exact."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("s")).select("s.*")
    return (long.where(F.col("value").isNotNull()).groupBy("feature", "value")
                .agg(F.count(F.lit(1)).alias("n")))


def positive_rate(df: DataFrame, y: str = "y") -> DataFrame:
    """P3."""
    return df.agg(F.avg(F.col(y).cast("double")).alias("positive_rate"))


def profile(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null) for every column, one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"),
                              F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                              F.col(f"c{i}").alias("non_null"))
                     for i, c in enumerate(df.columns)])
    return counts.select(F.inline(rows))


def class_counts(df: DataFrame, y: str = "y") -> DataFrame:
    """P5."""
    return df.groupBy(y).agg(F.count(F.lit(1)).alias("n"))
