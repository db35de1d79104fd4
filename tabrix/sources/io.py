"""S1-S6 readers, writers and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared campaign schema (no inference in production reads).
CAMPAIGN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("age", T.IntegerType()),
    T.StructField("job", T.StringType()), T.StructField("marital", T.StringType()),
    T.StructField("education", T.StringType()), T.StructField("default", T.StringType()),
    T.StructField("balance", T.DoubleType()), T.StructField("housing", T.StringType()),
    T.StructField("loan", T.StringType()), T.StructField("contact", T.StringType()),
    T.StructField("day", T.IntegerType()), T.StructField("month", T.StringType()),
    T.StructField("duration", T.IntegerType()), T.StructField("campaign", T.IntegerType()),
    T.StructField("pdays", T.IntegerType()), T.StructField("previous", T.IntegerType()),
    T.StructField("poutcome", T.StringType()), T.StructField("y", T.IntegerType()),
])


# Texts that the usual CSV readers take as missing.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                 "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _read_as(field: T.StructField) -> tuple[Column, Column]:
    """A text column as the field's type, and whether its text does not fit; missing texts are
    NULL and a whole number may be written as ``30.0``."""
    raw = F.col(f"`{field.name}`")
    text = F.trim(raw)
    missing = text.isNull() | text.isin(*MISSING_TEXTS)
    if isinstance(field.dataType, T.StringType):
        return F.when(missing, None).otherwise(raw), F.lit(False)
    if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = text.try_cast("double")
        value = F.coalesce(text.try_cast(field.dataType),
                           F.when(number == F.floor(number), number.try_cast(field.dataType)))
    else:
        value = text.try_cast(field.dataType)
    return F.when(missing, None).otherwise(value), ~missing & value.isNull()


def _parsed(field: T.StructField) -> Column:
    """A text column as the field's type; a value that does not fit is an error naming column
    and value."""
    value, wrong = _read_as(field)
    if isinstance(field.dataType, T.StringType):
        return value
    error = F.raise_error(F.concat(F.lit(f"column {field.name}: cannot read '"),
                                   F.trim(F.col(f"`{field.name}`")), F.lit(
        f"' as {field.dataType.simpleString()}"))).cast(field.dataType)
    return F.when(wrong, error).otherwise(value)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "csv", header: bool = True) -> DataFrame:
    """Read CSV or parquet; NaN is NULL in any format.

    With ``schema``, columns are taken by name (by place in a CSV without header), cast and
    put in the schema's order; extra columns are left out and a missing one is an error."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if schema is not None:
            df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    elif schema is None:
        df = (spark.read.option("header", header).option("nanValue", "NaN")
              .option("nullValue", "").option("inferSchema", True).csv(path))
    else:
        df = spark.read.option("header", header).csv(path)
        if not header:
            df = df.toDF(*[f.name for f in schema][:len(df.columns)])
        df = df.select(*[_parsed(f).alias(f.name) for f in schema])
    # every operator is specified on NULL
    return df.select(*[F.nanvl(F.col(f"`{f.name}`"), F.lit(None)).cast(f.dataType).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem of the path (works for shared FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_or_holdout(spark: SparkSession, train: DataFrame, test_path: str | None, n: int,
                    seed: int, id_base: int, schema=None, fmt: str = "csv"):
    """Read the test table if it exists, else carve a pseudo-test of ``n`` rows from
    train (S3).  Returns (train, test)."""
    from tabrix.operators.sampling import carve_holdout
    if test_path and path_exists(spark, test_path):
        return train, read_table(spark, test_path, schema, fmt)
    return carve_holdout(train, n, seed, id_base)


def write_submission(df: DataFrame, path: str, header: bool = False,
                     single_file: bool = False, id_col: str = "id") -> None:
    """Id-ordered CSV (a directory of part files; one file only on request)."""
    out = df.orderBy(id_col)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", header).csv(path)


def head(df: DataFrame, n: int = 5, by: str = "id") -> DataFrame:
    """First n rows in ``by`` order."""
    return df.orderBy(by).limit(n)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (unique per call, so a lazily read
    result can never be overwritten by a later call)."""
    import uuid

    from tabrix.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
