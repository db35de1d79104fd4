"""Rows that do not parse go to a reject table, counted per column, from one scan."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tabrix.sources import io
from tabrix.sources.rejects import cast_with_rejects, read_with_rejects

SCHEMA = "id long, age int, balance double, job string"


def _file(text):
    p = os.path.join(tempfile.mkdtemp(prefix="tbx-rej-"), "t.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


DIRTY = ("job,id,balance,age,extra\n"
         "a,1,2.5,30,x\n"
         "b,2,NaN,31.0,x\n"
         "c,three,1.0,old,x\n"      # two wrong values
         ",4,,,\n"
         "d,5,1.0,3.5,x\n"          # no whole number
         "e,6,1.0\n"                # too few fields
         "f,7,1.0,40,x,y\n"         # too many
         "g,8,1e400x,41,x\n")


def test_dirty_csv_gives_both_tables(spark):
    got = read_with_rejects(spark, _file(DIRTY), SCHEMA)
    rows = [tuple(r) for r in got.rows.orderBy("id").collect()]
    assert rows == [(1, 30, 2.5, "a"), (2, 31, None, "b"), (4, None, None, None)]
    assert got.counts == {"rows": 8, "rejected": 5, "malformed": 2}
    assert got.by_column == {"id": 1, "age": 2, "balance": 1, "job": 0}
    errors = sorted(tuple((e["column"], e["value"], e["type"]) for e in r["errors"])
                    for r in got.rejects.where("errors[0].column is not null").collect())
    assert errors == [(("age", "3.5", "int"),), (("balance", "1e400x", "double"),),
                      (("id", "three", "bigint"), ("age", "old", "int"))]
    lines = {r["record"] for r in got.rejects.where("errors[0].type = 'record'").collect()}
    assert lines == {"e,6,1.0", "f,7,1.0,40,x,y"}


def test_failing_stays_an_option(spark):
    with pytest.raises(Exception, match="cannot read"):
        io.read_table(spark, _file(DIRTY), SCHEMA).collect()
    with pytest.raises(ValueError, match="5 of 8"):
        read_with_rejects(spark, _file(DIRTY), SCHEMA, max_share=0.5)
    with pytest.raises(ValueError, match="not in the file"):
        read_with_rejects(spark, _file(DIRTY), SCHEMA + ", more int")


def test_clean_file_equals_read_table_and_empty_file(spark):
    p = _file("id,age,balance,job\n1,2,3,a\n2,,4.5,\n")
    got = read_with_rejects(spark, p, SCHEMA)
    assert got.rows.schema == io.read_table(spark, p, SCHEMA).schema
    assert sorted(got.rows.collect()) == sorted(io.read_table(spark, p, SCHEMA).collect())
    assert got.rejects.count() == 0 and got.counts["rejected"] == 0
    none = read_with_rejects(spark, _file("id,age,balance,job\n"), SCHEMA)
    assert none.rows.count() == 0 and none.rejects.count() == 0 and none.counts["rows"] == 0
    places = read_with_rejects(spark, _file("1,2,3,a\nx,2,3,b\n"), SCHEMA, header=False)
    assert places.rows.count() == 1 and places.by_column["id"] == 1


def test_clashing_names(spark):
    p = _file("_tbx_line,_tbx_errors,_tbx_rejected,a.b\n1,2,3,4\nx,2,3,4\n")
    got = read_with_rejects(spark, p, "_tbx_line int, _tbx_errors int, _tbx_rejected int, `a.b` int")
    assert [tuple(r) for r in got.rows.collect()] == [(1, 2, 3, 4)]
    assert got.by_column["_tbx_line"] == 1 and got.rejects.count() == 1


def test_one_evaluation_and_cast(spark):
    hits = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        hits.add(1)
        return "bad" if i % 10 == 0 else str(i)

    df = spark.range(1000).select("id", text("id").alias("v"), F.lit(None).cast("string").alias("w"))
    got = cast_with_rejects(df, {"v": "int", "w": "date"})
    assert got.rows.count() == 900 and got.rejects.count() == 100
    assert hits.value == 1000
    assert got.by_column == {"id": 0, "v": 100, "w": 0}
    assert got.rows.schema.simpleString() == "struct<id:bigint,v:int,w:date>"
    assert got.rejects.first()["errors"][0]["value"] == "bad"
    with pytest.raises(ValueError):
        cast_with_rejects(df, {"nope": "int"})
