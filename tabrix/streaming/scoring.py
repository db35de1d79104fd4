"""Apply fitted feature state (and optionally a model) to a Structured Streaming source.

Fitted lookups are static DataFrames, so every encoder join is a stream-static left join
(broadcast behind the fitted row count); no state is kept across micro-batches, so there
is nothing to watermark.  The sink is a file table with its own checkpoint in the shared
checkpoint folder, so a restarted query resumes exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tabrix.session import checkpoint_dir


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def run_available(stream: DataFrame, sink_path: str, fmt: str = "parquet",
                  checkpoint: str | None = None, timeout_s: float | None = None) -> str:
    """Process everything currently available (``availableNow`` trigger) into a file sink
    and stop.  ``timeout_s``: give up after that time (default: never).  Returns the sink path."""
    spark = stream.sparkSession
    ck = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"
    q = (stream.writeStream.format(fmt).option("path", sink_path)
         .option("checkpointLocation", ck).outputMode("append")
         .trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return sink_path


def score_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a fitted transform (e.g. ``FittedL.transform`` or a model's scoring) to a
    streaming DataFrame.  The transform must be row-local plus static joins."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return transform(stream)
