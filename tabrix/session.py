"""Session construction and cluster-safety helpers."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Largest lookup (rows) handed to a broadcast join.  Lookups are one row per category level
# or bucket (a few doubles and a short string, well under 100 bytes a row), so this bounds
# the broadcast to tens of MB whatever the data size.  Override per session with
# spark.tabrix.broadcastMaxRows.
DEFAULT_BROADCAST_ROWS = 500_000
_ckpt_lock = threading.Lock()
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def broadcast_max_rows(spark: SparkSession | None = None) -> int:
    if spark is None:
        spark = SparkSession.getActiveSession()
    if spark is not None:
        v = spark.conf.get("spark.tabrix.broadcastMaxRows", None)
        if v:
            return int(v)
    return DEFAULT_BROADCAST_ROWS


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tabrix") -> SparkSession:
    """Build (or reuse) a session configured for the library.

    On a cluster the submitter's configuration wins: we only fill values that are unset.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", "8g")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (shared storage, survives executor loss).  Only when it is unset --
    local tests -- do we create one under the local temp folder.
    """
    with _ckpt_lock:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and "
                                 "all executors share")
            d = tempfile.mkdtemp(prefix="tabrix-ckpt-")
            spark.conf.set("spark.checkpoint.dir", d)
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(d)
    return d


# rows of some MB each: pages and row groups, which readers hold whole, end after a few rows
_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
               "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
               "parquet.block.size": str(1 << 24), "parquet.enable.dictionary": "false"}
# and read a few at a time
_FEW_ROWS = {"spark.sql.parquet.columnarReaderBatchSize": "4",
             "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
             "spark.sql.files.maxPartitionBytes": "16m"}


@contextmanager
def few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Jobs in here read tables of large rows (blocks), and hand them to Python, a few rows at a
    time in place of thousands, in tasks of 16 MB of a file in place of 128."""
    before = {c: spark.conf.get(c) for c in _FEW_ROWS}
    for c, v in _FEW_ROWS.items():
        spark.conf.set(c, v)
    try:
        yield
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def materialize(df: DataFrame, free: bool = False, large: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` once as a parquet table in the shared checkpoint folder and
    read it back.  One job (an eager ``checkpoint()`` computes the plan twice), columnar
    reads with pruning afterwards, and the files survive the loss of any executor.  With ``free``
    the write's shuffle files go when it ends, not when the driver next collects garbage;
    ``large``: rows have some MB each."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/mat-{uuid.uuid4().hex}"
    before = spark.conf.get(_FREE, "false")
    if free:
        spark.conf.set(_FREE, "true")
    try:
        write = df.write.mode("overwrite")
        (write.options(**_LARGE_ROWS) if large else write).parquet(path)
    finally:
        if free:
            spark.conf.set(_FREE, before)
    return spark.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Rows per task targeted by the exact-rank building block (narrow rows, ~100 MB a task).
DEFAULT_ROWS_PER_TASK = 2_000_000


def rows_per_task(spark: SparkSession) -> int:
    v = spark.conf.get("spark.tabrix.rowsPerTask", None)
    return int(v) if v else DEFAULT_ROWS_PER_TASK
