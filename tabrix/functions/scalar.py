"""Scalar feature expressions.  Each returns a ``Column``.

Missing values follow the reference's pandas behaviour where it is observable: a
comparison with a missing value is false (flags are 0, never NULL); arithmetic on a missing
value stays missing; a zero denominator gives NULL (pandas gives inf/NaN).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference for identical results) ----------------------
EPS = 1e-5                                   # ratio epsilon
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun",
          "jul", "aug", "sep", "oct", "nov", "dec"]  # month names -> 1..12
AGE_EDGES = [0, 25, 35, 45, 55, 65, 100]     # fixed age cut, right-closed
AGE_LABELS = ["0-25", "26-35", "36-45", "46-55", "56-65", "65+"]
NAME_CHARS_B = r'[\(\)\[\]\{\}\:\"\,\.\s]'   # characters replaced by '_' (one-hot notebook B)
NAME_CHARS_O = r'[(),.\[\] ]'                # characters replaced by '_' (one-hot notebook O)
CUT_PRECISION = 3                            # interval label precision of equal-width cuts
CUT_EXTEND = 0.001                           # lowest edge lowered by 0.1% of the range
# ---------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def sentinel_flag(c, sentinel: int = -1) -> Column:
    """M1: 1 where the column equals the sentinel (never-contacted)."""
    return _flag(_c(c) == sentinel)


def has_contact(c, sentinel: int = -1) -> Column:
    """M1: 1 where the column differs from the sentinel (missing counts as different)."""
    return (~_c(c).eqNullSafe(F.lit(sentinel))).cast("int")


def ratio_eps(a, b, eps: float = EPS) -> Column:
    """M2: a / (b + eps); zero denominator -> NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double") + F.lit(eps))


def ratio_plus_one(a, b) -> Column:
    """M3: a / (b + 1); zero denominator -> NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double") + F.lit(1.0))


def log1p(c) -> Column:
    """M4: ln(1 + x) (NULL for x <= -1)."""
    return F.log1p(_c(c).cast("double"))


def shifted_log(c, minimum) -> Column:
    """M5: log1p(x - min + 1); ``minimum`` is a fitted value or scalar-subquery Column."""
    m = minimum if isinstance(minimum, Column) else F.lit(float(minimum))
    return F.log1p(_c(c).cast("double") - m + F.lit(1.0))


def positive_flag(c) -> Column:
    """M6."""
    return _flag(_c(c) > 0)


def negative_flag(c) -> Column:
    """M6."""
    return _flag(_c(c) < 0)


def replace_value(c, old, new) -> Column:
    """M7: replace one sentinel value by another."""
    col = _c(c)
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def sentinel_safe_ratio(num, pdays, sentinel: int = -1, replacement: int = 1) -> Column:
    """M8: num / (replace(pdays, sentinel -> replacement) + 1); zero denominator -> NULL."""
    return ratio_plus_one(num, replace_value(pdays, sentinel, replacement))


def month_number(c) -> Column:
    """M9: month name -> 1..12 (case-insensitive), anything else -> NULL."""
    m = F.create_map(*[x for i, name in enumerate(MONTHS)
                       for x in (F.lit(name), F.lit(i + 1))])
    return F.element_at(m, F.lower(_c(c)))  # NULL for unknown keys (ANSI-safe in maps)


def cyclic(c, period: float) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*v/period."""
    a = F.lit(2 * math.pi) * _c(c).cast("double") / F.lit(float(period))
    return F.sin(a), F.cos(a)


def yes_no(c) -> Column:
    """M11: 'yes' -> 1, 'no' -> 0, else NULL."""
    col = _c(c)
    return F.when(col == "yes", 1).when(col == "no", 0).cast("int")


def count_yes(cols: Sequence) -> Column:
    """Number of columns equal to 'yes'."""
    return sum((_flag(_c(x) == "yes") for x in cols), F.lit(0)).cast("int")


def any_flag(total) -> Column:
    """1 if the count is positive."""
    return _flag(_c(total) > 0)


def text_of(c) -> Column:
    """Text form of a value, missing -> 'nan' (what a string cast of NaN prints)."""
    return F.coalesce(_c(c).cast("string"), F.lit("nan"))


def interaction(*cols, sep: str = "_") -> Column:
    """Combined category 'a_b' (missing parts are 'nan')."""
    return F.concat_ws(sep, *[text_of(x) for x in cols])


def fingerprint(cols: Sequence, sep: str = "") -> Column:
    """Profile key, text forms concatenated (no separator by default, as the
    reference does -- different profiles can collide; pass ``sep`` to avoid that)."""
    return F.concat_ws(sep, *[text_of(x) for x in cols])


def clean_label(c, pattern: str = NAME_CHARS_B, repl: str = "_") -> Column:
    """Replace every character of ``pattern`` by ``repl``."""
    return F.regexp_replace(_c(c), pattern, repl)


def fixed_cut(c, edges: Sequence[float] = AGE_EDGES,
              labels: Sequence[str] = AGE_LABELS) -> Column:
    """Right-closed cut on fixed edges; x <= first edge or > last edge -> NULL."""
    col = _c(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (col > F.lit(lo)) & (col <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


class WidthCut:
    """K equal-width, right-closed bins.

    ``fit`` reads one row (min, max) and computes the k+1 edges on the driver exactly as
    ``linspace(min, max, k+1)`` with the lowest edge lowered by 0.1% of the range (a
    constant column is widened by 0.1% of its magnitude, 0.001 at zero).  Labels are the
    interval texts '(lo, hi]' with edges rounded to ``precision`` decimals (significant
    decimals below 1), precision raised until the rounded edges are distinct.
    Per row: bin = (number of edges strictly below x) - 1, outside -> NULL."""

    def __init__(self, k: int, precision: int = CUT_PRECISION):
        self.k, self.precision = int(k), int(precision)
        self.edges: list[float] = []
        self.labels: list[str] = []

    def fit(self, df: DataFrame, c: str) -> "WidthCut":
        r = df.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
        return self.fit_range(r["lo"], r["hi"])

    def fit_range(self, lo, hi) -> "WidthCut":
        lo, hi = float(lo), float(hi)
        if lo == hi:  # a constant column lies in the middle of a small range
            margin = CUT_EXTEND * (abs(lo) or 1.0)
            lo, hi = lowest, _ = lo - margin, hi + margin
        else:
            lowest = lo - CUT_EXTEND * (hi - lo)
        step = (hi - lo) / self.k
        self.edges = [lowest, *(i * step + lo for i in range(1, self.k)), hi]
        shown = _shown_edges(self.edges, self.precision)
        self.labels = [f"({a}, {b}]" for a, b in pairwise(shown)]
        return self

    def index(self, c) -> Column:
        col = _c(c).cast("double")
        below = sum((F.when(col > F.lit(e), 1).otherwise(0) for e in self.edges), F.lit(0)) - 1
        return F.when(col.isNull() | (below < 0) | (below >= self.k), F.lit(None))\
                .otherwise(below).cast("int")

    def label(self, c) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in self.labels]), self.index(c) + 1)


def _shown_edges(edges: list[float], decimals: int, most: int = 19) -> list[float]:
    """Edges as labels show them: rounded half to even to ``decimals`` places, not counting
    zeros right after the point of an edge below one; more places until all differ."""
    def shown(e: float) -> float:
        zeros = -math.floor(math.log10(abs(e))) - 1 if 0 < abs(e) < 1 else 0
        scale = 10.0 ** (decimals + zeros)
        return round(e * scale) / scale

    texts = [shown(e) for e in edges]
    if len(set(texts)) == len(edges) or decimals >= most:
        return texts
    return _shown_edges(edges, decimals + 1, most)


def fitted_min_max(df: DataFrame, c: str) -> tuple[Column, Column]:
    """A4 as scalar subqueries (evaluated once by the engine, no driver round trip)."""
    return (df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar())


def equals_flag(c, value: str) -> Column:
    """1 where the category equals ``value``."""
    return _flag(_c(c) == F.lit(value))


def binarize(c, threshold) -> Column:
    """Hard label with strict ``>``."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return _flag(_c(c) > t)
