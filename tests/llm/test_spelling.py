"""Spelling variants: brute force over the registered query and over small word lists."""

import collections
import itertools
import random
import re
import zlib

from tabrix.llm import queries as Q
from tabrix.llm import spelling as S
from tests.conftest import SF_SMALL
from tests.llm import common


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    """{word: n} -> result rows, with neighbours by deletions in a dictionary."""
    meet = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            meet[w[:i] + w[i + 1:]].add(w)
        meet[w].add(w)
    nb = collections.defaultdict(set)
    for group in meet.values():
        for a, b in itertools.combinations(group, 2):
            if near(a, b):
                nb[a].add(b)
                nb[b].add(a)
    form = {}
    for w, n in words.items():
        best = min(nb[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(nb[w]), words.get(form[w])))
    return sorted(out)


def counted(rows, mod=97):
    c = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            if doc is not None:
                h = zlib.crc32(f"{doc}:{run}".encode())
                if h % mod == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def forms(spark, words, **options):
    df = spark.createDataFrame([(w, n, 1) for w, n in words.items()],
                               "word string, n long, wid int")
    return sorted(tuple(r) for r in S.spelling_forms(df, **options).collect())


def test_query_equals_brute_force(spark):
    got = Q.QUERIES["op12_spelling_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    docs = [(r["doc_id"], r["text"]) for r in common.documents(spark).collect()]
    want = brute(counted(docs))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(r[1] is not None for r in want) > 20


def test_dense_words_equal_all_pairs(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 7))): rng.choice(
        [1, 2, 3, 4, 8, 16, 40]) for _ in range(500)}
    want = brute(words)
    assert {w: sum(near(w, v) for v in words) for w in words} == {r[0]: r[4] for r in want}
    assert forms(spark, words) == want


def test_chains_and_ties(spark):
    words = {"abcde": 100, "abcdef": 50, "abcdefg": 25, "abcdefgh": 12, "abcdefghi": 6,
             "xxxxx": 4, "xxxxxx": 8, "xxxxxxx": 8, "xxxx": 8, "y" * 3000: 9, "y" * 3001: 3,
             "tied": 2, "tieb": 4, "tiea": 4, "alone": 7}
    got = forms(spark, words)
    assert got == brute(words)
    by = {r[0]: r for r in got}
    assert by["abcdefghi"][2] == "abcde" and by["tied"][1] == "tiea" and by["xxxxx"][4] == 2


def test_awkward_documents(spark):
    docs = common.awkward(spark, "run int")
    got = {r["word"]: r["n"] for r in S.word_counts(docs, min_count=1).collect()}
    rows = [(None, r["text"]) for r in docs.collect()]
    c = collections.Counter()
    for _, t in rows:
        c.update(re.findall("[a-zÀ-ÿ]+", (t or "").translate(
            str.maketrans(S.UPPER, S.LOWER))))
    assert got == {w: n for w, n in c.items() if len(w) >= 5}
    assert S.spelling_forms(S.word_counts(common.empty(spark))).collect() == []
