"""Substring dedup against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tabrix.llm import substring_dedup as S
from tests.llm import common


def brute(rows, window):
    """rows: (id, text) -> sorted list of (id, n_words, n_removed, sha)."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            key, at = tuple(w[s:s + window]), (i is not None, i or 0, s)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] != (i is not None, i or 0, s):
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df, **options):
    return sorted((tuple(r) for r in S.removed_words(df, **options).collect()), key=repr)


def repeated_texts(rng, n):
    pool = [common.words(rng, 50, 60) for _ in range(8)]
    out = []
    for i in range(n):
        parts = [rng.choice(pool).split()[rng.randrange(20):][:rng.randint(5, 50)]
                 if rng.random() < 0.5 else common.words(rng, 500, rng.randint(0, 40)).split()
                 for _ in range(rng.randint(0, 5))]
        parts.append(["again"] * rng.choice([0, 0, 5, 60]))
        out.append((i, " ".join(sum(parts, []))))
    return out


@pytest.mark.parametrize("group, flush", [(100_000, 100_000), (50, 100_000), (50, 7)])
def test_random_texts(spark, monkeypatch, group, flush):
    monkeypatch.setattr(S, "GROUP", group)
    monkeypatch.setattr(S, "FLUSH", flush)
    rows = repeated_texts(random.Random(6), 120)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df) == brute(rows, 20)


def test_awkward_rows(spark):
    df = common.awkward(spark, "gone int")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert result(df) == brute(rows, 20)
    assert result(df, window=9) == brute(rows, 9)
    assert result(common.empty(spark)) == []
    assert result(spark.createDataFrame([(1, None)], "doc_id long, text string")) == brute(
        [(1, None)], 20)


def test_kept_text(spark):
    rows = [(1, "a b c d e f g h i j k l"), (2, "x a b c d e f g h i y")]
    got = S.removed_words(spark.createDataFrame(rows, "doc_id long, text string"), window=9,
                          keep_text=True).orderBy("doc_id").collect()
    assert [r["kept_text"] for r in got] == ["a b c d e f g h i j k l", "x y"]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    texts = [common.words(rng, 5, 80).encode().split() for _ in range(20)]
    text, h, p, lo, hi = S.anchors(texts)
    seen, windows = {}, 0
    for t, x, q, a, b in zip(text, h, p, lo, hi):
        for d in range(a, b + 1):
            key = tuple(texts[t][q - d:q - d + 20])
            assert len(key) == 20 and seen.setdefault(key, (x, d)) == (x, d)
            windows += 1
    assert windows == sum(len(t) - 19 for t in texts)


def test_tree_nodes_are_equal_windows():
    words = [b"a b a b a b a b", b"b a b a b", b"c"]
    row, offset, node = S.deep_repeats(words, np.array([5, 2, 0]), 4)
    of = {}
    for r, o, n in zip(row, offset, node):
        of.setdefault(n, set()).add(tuple(words[r].split()[o:o + 4]))
    assert all(len(v) == 1 for v in of.values()) and len(of) == 2


def test_a_full_group_fits_a_worker():
    rng = np.random.default_rng(4)
    pool = np.array([f"word{i}" for i in range(30_000)])
    words = [" ".join(w).encode() for w in pool[rng.integers(0, len(pool), (S.GROUP, 26))]]
    table = pa.table({"words": pa.array(words, pa.binary()), "doc": np.arange(S.GROUP),
                      "at": np.full(S.GROUP, 6 << 16 | 6), "mask": pa.nulls(S.GROUP, pa.int64())})
    tracemalloc.start()
    try:
        assert S._tree(table, 20).num_rows == 0  # no window twice
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()


def test_registered_query_equals_brute_force(spark):
    from tabrix.llm.queries import QUERIES
    got = sorted((tuple(r) for r in QUERIES["op6_substring_dedup"](
        spark, common.SF_SMALL).collect()), key=repr)
    assert got == brute(list(common.texts_of(common.documents(spark)).items()), 20)
