"""Tables of large rows (blocks): written and read a few rows at a time."""

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tabrix import session as S
from tabrix.operators import boosting as B
from tabrix.operators import forest as T


def test_row_groups_of_large_rows_are_small_and_read_in_small_splits(spark, tmp_path):
    size = 2 << 20  # bytes that do not compress
    d = spark.range(0, 24, 1, 1).select("id", F.expr(
        f"unhex(array_join(transform(sequence(1, {size // 32}), "
        "i -> sha2(concat(id, ':', i), 256)), ''))").alias("x"))
    out = S.materialize(d, large=True)
    files = [f for p in out.inputFiles() for f in glob.glob(p.removeprefix("file://"))]
    assert len(files) == 1 and os.path.exists(files[0])
    meta = pq.ParquetFile(files[0]).metadata
    groups = [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sum(groups) == 24 and max(groups) <= 10
    got = out.agg(F.count("id"), F.sum(F.length("x"))).first()
    assert tuple(got) == (24, 24 * size)


def test_settings_are_those_of_before_afterwards(spark):
    names = list(S._FEW_ROWS)
    before = [spark.conf.get(c) for c in names]
    try:
        with S.few_rows_at_once(spark):
            assert spark.conf.get("spark.sql.parquet.columnarReaderBatchSize") == "4"
            raise InterruptedError
    except InterruptedError:
        pass
    assert [spark.conf.get(c) for c in names] == before


def test_bytes_of_a_forest_task_are_bounded(spark):
    df, nf = spark.range(1), 29
    cores = spark.sparkContext.defaultParallelism
    most = T.PART_BYTES // (8 * nf)
    rows = 40 * cores * most
    assert B.tasks(df, rows, T.BLOCK_ROWS, T.TASK_ROWS, most) == 40 * cores
