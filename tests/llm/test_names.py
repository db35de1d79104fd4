"""Extra columns with the operators' own names, text ids and labels, odd column names."""

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabrix.llm import decontamination as D
from tabrix.llm.bpe import encode_documents
from tabrix.llm.lattice_dedup import near_duplicates
from tabrix.llm.line_dedup import dedup_lines
from tabrix.llm.pii_semicrf import find_pii
from tabrix.llm.simhash import dedup
from tabrix.llm.substring_dedup import removed_words
from tabrix.llm.token_count import count_tokens
from tests.llm import common

OWN = ["_keep_id", "_leaking_id", "_line_doc", "_line_gone", "_pii", "_bpe", "doc", "line", "id",
       "fp", "t", "i", "k1", "X", "_KEEP_ID_", "a.b", "shard", "label"]


@pytest.fixture(scope="module")
def docs(spark):
    return common.awkward(spark).select("doc_id", "text", *[F.lit(c).alias(c) for c in OWN])


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "same text here with a few words", "x")],
                                 "item_id long, text string, _leaking_id string")


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("stage", [
    lambda d, i: dedup(d), lambda d, i: dedup_lines(d), D.decontaminate,
    lambda d, i: find_pii(d), lambda d, i: encode_documents(
        d, public_tokenizers.path("byte_bpe_50k.json"))],
    ids=["dedup", "dedup_lines", "decontaminate", "find_pii", "encode_documents"])
def test_own_names_as_extra_columns(docs, items, stage):
    got, plain = stage(docs, items), stage(docs.select("doc_id", "text"), items)
    assert [c for c in got.columns if c in docs.columns] == docs.columns
    assert _rows(got.select(*plain.columns)) == _rows(plain)
    assert got.filter("`a.b` <> 'a.b' or _keep_id <> '_keep_id'").count() == 0


def test_stages_with_own_names(spark, docs):
    for name, stage in corpus_pipeline.STAGES[1:3]:
        assert stage(spark, docs.withColumn("n_chars", F.lit(0).cast("long")),
                     common.SF_SMALL).columns == [*docs.columns, "n_chars"], name


def test_text_columns_with_signs(spark, docs):
    odd = docs.select(F.col("doc_id").alias("d.id"), F.col("text").alias("te.xt"))
    n = count_tokens(odd, public_tokenizers.path("word_bpe_49k.json"), text_col="te.xt")
    assert n.count() == docs.count()
    assert dedup_lines(odd, "d.id", "te.xt").columns == ["d.id", "te.xt"]
    assert dedup(odd, "d.id", "te.xt").count() == dedup(docs).count()
    assert removed_words(odd, "d.id", "te.xt").count() == docs.count()


def test_text_ids_and_labels(spark):
    words = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([("b", words), ("a", "x " + words), (None, None), ("c", "y")],
                              "doc_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in removed_words(d).collect()}
    assert got == {"a": (31, 0), "b": (30, 30), "c": (1, 0), None: (0, 0)}
    items = spark.createDataFrame([("it", words)], "item_id string, text string")
    found = {(r["doc_id"], r["item_id"]) for r in D.leaks(d, items).collect()}
    assert found == {("a", "it"), ("b", "it")}
    assert {r["doc_id"] for r in D.decontaminate(d, items).collect()} == {None, "c"}
    v = spark.createDataFrame([(1, "p", [1.0, 0.1]), (2, "p", [1.0, 0.1]), (3, "q", [1.0, 0.1]),
                               (4, None, [1.0, 0.1])], "vec_id long, label string, embedding array<double>")
    got = {r["vec_id"]: r["component_id"] for r in near_duplicates(v).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    half = v.withColumn("label", F.when(F.col("vec_id") == 2, 1.5).otherwise(1.0))
    got = {r["vec_id"]: r["component_id"] for r in near_duplicates(half).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 1}  # a fraction is not cut off
