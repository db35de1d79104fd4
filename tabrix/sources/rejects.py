"""S1/R7 with a reject table: rows that do not parse are set aside instead of ending the job.

One scan gives both tables: every row is parsed once and written once to the shared folder,
accepted and rejected rows under folders of their own, while ``DataFrame.observe`` counts what
did not parse per column.  ``io.read_table`` and a plain cast stay the way to fail at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.sources.io import _read_as, scratch_path

_ERROR = "struct<column:string,value:string,type:string>"


@dataclass
class Parsed:
    """``rows``: accepted rows.  ``rejects``: ``errors`` (column, value, wanted type; the column
    is null where a line has too few or too many fields) and ``record`` (the line, or the row as
    JSON).  ``counts``: all rows, rejected rows, malformed lines; ``by_column``: values that did
    not parse."""
    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    by_column: dict[str, int]


def _free_name(name: str, taken: Sequence[str]) -> str:
    low = {t.lower() for t in taken}
    while name in low:
        name += "_"
    return name


def _split(raw: DataFrame, fields: Sequence[tuple[str, T.DataType, Column, Column]],
           record: Column, malformed: Column, max_share: float) -> Parsed:
    """Parse, count and write ``raw`` once.  ``fields``: name, type, value, whether it is wrong."""
    spark = raw.sparkSession
    errors = F.filter(F.array(
        F.when(malformed, F.struct(F.lit(None).cast("string").alias("column"),
                                   F.lit(None).cast("string").alias("value"),
                                   F.lit("record").alias("type")).cast(_ERROR)),
        *[F.when(wrong, F.struct(F.lit(n).alias("column"),
                                 F.col(f"`{n}`").cast("string").alias("value"),
                                 F.lit(t.simpleString()).alias("type")).cast(_ERROR))
          for n, t, _, wrong in fields]), lambda e: e.isNotNull())
    taken = [n for n, *_ in fields]
    e, r, flag = (_free_name(x, taken) for x in ("_tbx_errors", "_tbx_record", "_tbx_rejected"))
    parsed = raw.select(*[v.cast(t).alias(n) for n, t, v, _ in fields], errors.alias(e),
                        F.when(F.size(errors) > 0, record).alias(r))
    seen = Observation()
    bad = F.size(F.col(e)) > 0

    def hits(n: str | None) -> Column:
        return F.count_if(F.exists(F.col(e), lambda x: x["column"].eqNullSafe(F.lit(n))))

    watched = parsed.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"),
        hits(None).alias("malformed"),
        *[hits(n).alias(f"c{i}") for i, n in enumerate(taken)])
    path = scratch_path(spark, "parsed")
    marked = watched.withColumn(flag, bad.cast("int"))
    marked.write.partitionBy(flag).parquet(path)
    got = seen.get
    if got["rejected"] > max_share * got["rows"]:
        raise ValueError(f"{got['rejected']} of {got['rows']} rows do not parse")
    both = spark.read.schema(marked.schema).parquet(path)
    return Parsed(
        both.where(F.col(flag) == 0).select(*[F.col(f"`{n}`") for n in taken]),
        both.where(F.col(flag) == 1).select(F.col(e).alias("errors"), F.col(r).alias("record")),
        {k: got[k] for k in ("rows", "rejected", "malformed")},
        {n: got[f"c{i}"] for i, n in enumerate(taken)})


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType | str,
                      header: bool = True, max_share: float = 1.0) -> Parsed:
    """A CSV file or folder by the rules of ``io.read_table`` (columns by name, or by place
    without header; missing texts and NaN are NULL), except that a line with a value that does
    not fit, or with too few or too many fields, goes to the rejects.  A column that the file
    lacks is an error, and so is a share of rejected rows above ``max_share``."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    # only the first line is read here
    found = spark.read.option("header", header).csv(path).columns
    names = found if header else [f.name for f in schema][:len(found)] + found[len(schema):]
    lost = [f.name for f in schema if f.name.lower() not in {n.lower() for n in names}]
    if lost:
        raise ValueError(f"columns not in the file: {lost}")
    whole = _free_name("_tbx_line", names)
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, whole]])
    raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", whole).csv(path))
    fields = []
    for f in schema:
        value, wrong = _read_as(f)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None).cast(f.dataType))
        fields.append((f.name, f.dataType, value, wrong))
    row = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]))
    return _split(raw, fields, F.coalesce(F.col(whole), row), F.col(whole).isNotNull(), max_share)


def cast_with_rejects(df: DataFrame, types: Mapping[str, str | T.DataType],
                      max_share: float = 1.0) -> Parsed:
    """``df`` with the columns of ``types`` cast; rows with a value that has no such form go
    to the rejects, and a share of them above ``max_share`` is an error.  Nulls stay."""
    fields = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if f.name not in types:
            fields.append((f.name, f.dataType, col, F.lit(False)))
            continue
        to = types[f.name]
        to = T.DataType.fromDDL(to) if isinstance(to, str) else to
        value = col.try_cast(to)
        fields.append((f.name, to, value, col.isNotNull() & value.isNull()))
    lost = [c for c in types if c not in df.columns]
    if lost:
        raise ValueError(f"no such columns: {lost}")
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    return _split(df, fields, row, F.lit(False), max_share)
