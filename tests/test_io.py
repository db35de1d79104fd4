"""Sources and sinks: CSV read with declared schema and NaN -> NULL, submissions, S2."""

import os
import tempfile

from pyspark.sql import functions as F

from tabrix.sources import io


def test_csv_nan_to_null(spark):
    d = tempfile.mkdtemp(prefix="tbx-io-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("id,balance,job\n1,NaN,a\n2,3.5,\n")
    df = io.read_table(spark, p, schema=None)
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["balance"] is None and rows[2]["balance"] == 3.5 and rows[2]["job"] is None


def test_submission_roundtrip_and_single_file(spark):
    d = tempfile.mkdtemp(prefix="tbx-io-")
    sub = spark.range(0, 50).select(F.col("id"), (F.col("id") % 2).cast("int").alias("y"))
    io.write_submission(sub, os.path.join(d, "a"), header=False, single_file=True)
    parts = [x for x in os.listdir(os.path.join(d, "a")) if x.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(d, "a", parts[0])) as f:
        lines = f.read().splitlines()
    assert lines[0] == "0,0" and lines[-1] == "49,1" and len(lines) == 50  # id order, no header
    io.write_submission(sub, os.path.join(d, "b"), header=True)
    back = spark.read.option("header", True).schema("id long, y int").csv(os.path.join(d, "b"))
    assert back.count() == 50


def test_read_or_holdout_prefers_existing_test(spark):
    d = tempfile.mkdtemp(prefix="tbx-io-")
    tr = spark.range(0, 20).select("id", (F.col("id") % 2).cast("int").alias("y"))
    te_path = os.path.join(d, "test.csv")
    tr.drop("y").write.option("header", True).csv(te_path)
    a, b = io.read_or_holdout(spark, tr, te_path, 5, 1, 1000, schema="id long")
    assert a.count() == 20 and b.count() == 20
    a2, b2 = io.read_or_holdout(spark, tr, os.path.join(d, "missing.csv"), 5, 1, 1000)
    assert a2.count() == 15 and b2.count() == 5 and "y" not in b2.columns
