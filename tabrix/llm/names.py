"""Column names that the operators add for their own use or are given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def own(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no column of ``frames`` has it in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(name: str) -> Column:
    """The column called ``name``, whatever signs are in the name."""
    return F.col("`" + name.replace("`", "``") + "`")
