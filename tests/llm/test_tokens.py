"""Token counts and BPE against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabrix.llm import bpe, token_count
from tests.llm import common

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    docs = common.documents(spark).select("doc_id", "text").unionByName(
        common.awkward(spark).select("doc_id", "text"))
    rows = token_count.count_tokens(docs, WORD).collect()
    assert len(rows) == docs.count()
    want = library(WORD, [r["text"] or "" for r in rows])
    assert [r["n_tokens"] for r in rows] == [len(w) for w in want]
    assert [r["n_bytes"] for r in rows] == [len((r["text"] or "").encode()) for r in rows]
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in rows)


def test_long_texts_are_cut_where_counts_add_up():
    rng = random.Random(1)
    text = "".join(rng.choice(["ab", "é", " ", "\n", "!", "7", "\x1c", "don't"])
                   for _ in range(3000)).encode()
    for limit in (10, 50, 1000):
        parts = list(token_count.safe_parts(text, limit))
        assert b"".join(parts) == text
        assert all(len(p) <= limit or not p[1:limit].strip(b"\n ") == b"" for p in parts)
        assert sum(len(x) for x in library(WORD, [p.decode() for p in parts])) == len(
            library(WORD, [text.decode()])[0])


def test_names_are_replaced_and_empty_tables_pass(spark):
    df = common.awkward(spark, "N_Tokens int")
    out = token_count.count_tokens(df, WORD)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert token_count.count_tokens(common.empty(spark), WORD).count() == 0
    assert bpe.encode_documents(common.empty(spark, "ids_sha256 string"), BYTE).count() == 0


def test_bpe_round_trip_equals_the_library(spark):
    docs = common.documents(spark).select("doc_id", "text").unionByName(
        common.awkward(spark).select("doc_id", "text"))
    rows = bpe.encode_documents(docs, BYTE).collect()
    for r, ids in zip(rows, library(BYTE, [r["text"] or "" for r in rows])):
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_ids_and_text_columns(spark):
    df = common.awkward(spark).select("text", bpe.encode(F.col("text"), BYTE).alias("ids"))
    rows = df.select("text", "ids", bpe.decode(F.col("ids"), BYTE).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "") for r in rows)
    assert [list(r["ids"]) for r in rows] == library(BYTE, [r["text"] or "" for r in rows])


@pytest.fixture(scope="module")
def codec():
    return bpe.ByteBPE(BYTE), Tokenizer.from_file(BYTE)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t'sdé漢a1!.<|\x1c\x85\xa0endoftext>"), max_size=60))
def test_any_text(codec, text):
    ours, theirs = codec
    ids = ours.encode(text)
    assert ids == theirs.encode(text, add_special_tokens=False).ids
    assert ours.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids_decode_as_the_library_does(codec, ids):
    ours, theirs = codec
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
