"""Inputs shared by the registered queries: campaign view, its seeded train/test split."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.sources.fixture import campaign, table_state

R6 = 6  # float outputs are rounded to 6 decimals in both engines before comparison


def rnd(c, name: str | None = None):
    col = F.round(F.col(c) if isinstance(c, str) else c, R6)
    return col.alias(name) if name else col


def camp(spark: SparkSession, sf: str) -> DataFrame:
    return campaign(spark, sf)


_splits: dict[tuple, str] = {}
_split_lock = threading.Lock()


def train_test(spark: SparkSession, sf: str, frac: float = 0.2, seed: int = 42):
    """X4 holdout on the campaign view: test = exact ceil(frac*n) rows in seeded order,
    without ``y``; train = the rest.  Like the view itself, the flagged rows are written
    once per application as parquet in the shared checkpoint folder and read back."""
    import hashlib

    from tabrix.operators.sampling import holdout
    from tabrix.session import checkpoint_dir
    key = (spark.sparkContext.applicationId, sf, table_state(spark, sf), frac, seed)
    d = camp(spark, sf)
    with _split_lock:
        if key not in _splits:
            tag = hashlib.md5(repr(key).encode()).hexdigest()[:12]
            path = f"{checkpoint_dir(spark).rstrip('/')}/split-{tag}"
            holdout(d, frac=frac, seed=seed).write.mode("overwrite").parquet(path)
            _splits[key] = path
    parts = spark.read.parquet(_splits[key])
    train = parts.where(~F.col("is_holdout")).drop("is_holdout")
    test = parts.where(F.col("is_holdout")).drop("is_holdout", "y")
    return train, test


# DuckDB twin of train_test (tables `train`, `test`)
SPLIT_SQL = """
sp AS (SELECT c.*, row_number() OVER (ORDER BY md5(concat(CAST(id AS VARCHAR), ':', '42')), id) AS _rk,
              count(*) OVER () AS _n FROM campaign c),
train AS (SELECT * EXCLUDE (_rk, _n) FROM sp WHERE _rk > ceil(0.2 * _n)),
test AS (SELECT * EXCLUDE (_rk, _n, y) FROM sp WHERE _rk <= ceil(0.2 * _n))
"""


def round_fast(x: Column) -> Column:
    """``round(x, 6)`` of a double, the same value by floating-point arithmetic (Spark's goes through
    decimals).  Values next to a tie, large ones, infinities and NaN are left to Spark's."""
    s = x * 1e6
    whole = F.rint(s)
    clear = (F.abs(s - whole) < 0.499) & (F.abs(s) < 1e12)
    return F.when(clear, whole / 1e6 + 0.0).otherwise(F.round(x, R6))


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column to 6 decimals (comparison form of feature tables).  The doubles are
    rounded as one array: code for each of dozens of columns made one method too long
    for the JVM to compile, which ran the whole last stage interpreted."""
    names = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    if not names:
        return df
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    array = F.transform(F.array(*[F.col(f"`{c}`") for c in names]), round_fast)
    at = {c: i for i, c in enumerate(names)}
    return df.select(*rest, array.alias("_tbx_rounded")).select(
        *[F.col("_tbx_rounded")[at[c]].alias(c) if c in at else F.col(f"`{c}`")
          for c in df.columns])
