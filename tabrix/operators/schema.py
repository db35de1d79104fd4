"""R1-R7 projection/filter/schema operators and U1-U3 stacking."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORIGIN = "is_train"


def tag_origin(train: DataFrame, test: DataFrame, y: str = "y", flag: str = ORIGIN
               ) -> DataFrame:
    """R3 + U1: tag rows with their origin (1 train / 0 test), NULL target on test, and
    stack them by name."""
    ytype = train.schema[y].dataType if y in train.columns else "double"
    t = train.withColumn(flag, F.lit(1))
    s = test.withColumn(flag, F.lit(0))
    if y not in s.columns:
        s = s.withColumn(y, F.lit(None).cast(ytype))
    return t.unionByName(s, allowMissingColumns=True)


def split_origin(df: DataFrame, y: str = "y", flag: str = ORIGIN,
                 drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split a tagged union back into (train, test); test loses ``y``."""
    tr = df.where(F.col(flag) == 1).drop(flag, *drop)
    te = df.where(F.col(flag) == 0).drop(flag, y, *drop)
    return tr, te


def align_columns(b: DataFrame, a: DataFrame, exclude: Sequence[str] = ("y",)) -> DataFrame:
    """Give ``b`` exactly ``a``'s columns (minus ``exclude``) in ``a``'s order: missing
    ones are added as 0, extra ones dropped."""
    have = set(b.columns)
    sel = [F.col(f"`{c}`") if c in have else F.lit(0).alias(c)
           for c in a.columns if c not in set(exclude)]
    return b.select(*sel)


# fixed value: characters not allowed in model feature names
SPECIAL_CHARS = r'[\(\)\[\]\{\}\:\"\,\.\s]'


def clean_name(name: str) -> str:
    n = re.sub(SPECIAL_CHARS, "_", name)
    n = re.sub(r"_+", "_", n)
    return n.strip("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Special characters -> '_', runs collapsed, ends stripped.  Raises when two
    names collide (compared case-insensitively, as Spark resolves names)."""
    new = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        k = n.lower()
        if k in seen:
            raise ValueError(f"column names collide after cleaning: {seen[k]!r}, {old!r} -> {n!r}")
        seen[k] = old
    return df.toDF(*new)


def cast_columns(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """Cast columns; ``safe`` uses try_cast (dirty input -> NULL instead of an error)."""
    sel = []
    for c in df.columns:
        if c in types:
            col = F.col(f"`{c}`")
            sel.append((col.try_cast(types[c]) if safe else col.cast(types[c])).alias(c))
        else:
            sel.append(F.col(f"`{c}`"))
    return df.select(*sel)


def stack(*frames: DataFrame) -> DataFrame:
    """Union all by name, missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
