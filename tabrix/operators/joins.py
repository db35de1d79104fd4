"""Lookups, anti-joins and keyed score attachment.

Lookups are fitted tables (one row per key).  They are broadcast only when their row
count -- measured when they were fitted -- is under a bound; above it the join is left to
Catalyst/AQE (sort-merge with skew-join splitting of a hot key on the row side).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.session import broadcast_max_rows


def sized_broadcast(table: DataFrame, rows: int | None, max_rows: int | None = None
                    ) -> DataFrame:
    """Broadcast hint only behind a known row count (bound: ``max_rows`` or the session's
    ``spark.tabrix.broadcastMaxRows``); otherwise the join is left to Catalyst / AQE."""
    bound = max_rows if max_rows is not None else broadcast_max_rows(table.sparkSession)
    if rows is not None and rows <= bound:
        return F.broadcast(table)
    return table


def lookup(df: DataFrame, table: DataFrame, key: str | Sequence[str], values: Sequence[str],
           default: Mapping[str, object] | None = None, rows: int | None = None,
           table_key: str | Sequence[str] | None = None) -> DataFrame:
    """Add ``values`` from ``table`` matched on ``key`` (unmatched -> NULL, or the
    per-column ``default``).  ``table`` must be unique on its key.  NULL keys never match."""
    keys = [key] if isinstance(key, str) else list(key)
    tkeys = keys if table_key is None else ([table_key] if isinstance(table_key, str)
                                            else list(table_key))
    t = table.select(*[F.col(k).alias(f"_tbx_k{i}") for i, k in enumerate(tkeys)],
                     *[F.col(v) for v in values])
    t = sized_broadcast(t, rows)
    cond = [df[k] == t[f"_tbx_k{i}"] for i, k in enumerate(keys)]
    j = df.join(t, cond, "left")
    default = default or {}
    outs = []
    for v in values:
        c = t[v]
        if v in default and default[v] is not None:
            d = default[v]
            c = F.coalesce(c, d if isinstance(d, Column) else F.lit(d))
        outs.append(c.alias(v))
    return j.select(*[df[c] for c in df.columns], *outs)


def exclude(df: DataFrame, other: DataFrame, keys: str | Sequence[str] = "id") -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other`` (left anti-join)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(other.select(*keys), keys, "left_anti")


def attach_scores(df: DataFrame, scores: DataFrame, key: str = "id",
                  check: bool = True) -> DataFrame:
    """Attach per-row scores by key.

    ``check`` raises unless every key occurs exactly once on both sides: one pass over the keys
    alone, counted per key and side.  A null key counts as a key that does not match."""
    if check:
        sides = (df.select(F.col(key).alias("k"), F.lit(1).alias("a"), F.lit(0).alias("b"))
                 .unionByName(scores.select(F.col(key).alias("k"), F.lit(0).alias("a"),
                                            F.lit(1).alias("b"))))
        per = sides.groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        wrong = {"null_keys": "k is null", "repeated": "a > 1", "scored_twice": "b > 1",
                 "without_score": "b = 0", "without_row": "a = 0"}
        r = per.agg(*[F.count_if(F.expr(c)).alias(n) for n, c in wrong.items()]).first().asDict()
        if any(r.values()):
            raise ValueError(f"attach_scores: {key} is no one-to-one match: {r}")
    return df.join(scores, key, "inner")
