"""Benchmark decontamination against brute force."""

import random

from tabrix.llm import decontamination as D
from tests.llm import common


def brute(texts, items, threshold=D.THRESHOLD, overlap=D.OVERLAP):
    """Every passage against every item, scored and verified without index or bounds."""
    index = D.Index(items)
    out = set()
    for i, text in texts:
        w = D.words(text or "")
        for step, b0, b1 in index.classes:
            for s in range(0, max(1, len(w) - step) + step, step):
                part = w[s:s + 2 * step]
                terms = {index.term[x] for x in part if x in index.term}
                runs = {k: {tuple(part[j:j + k]) for j in range(len(part) - k + 1)}
                        for k in range(1, D.SHINGLE + 1)}
                for doc in range(index.block_range[b0][0], index.block_range[b1 - 1][1]):
                    score = sum(x for t in terms for d, x in zip(index.docs[t], index.impacts[t])
                                if d == doc)
                    shared = [sum(g in runs[len(g)] for g in p) / len(p) if p else 1.0
                              for p in index.parts[doc]]
                    if score >= threshold and min(shared) >= overlap:
                        out.add((i, index.ids[doc]))
    return out


def test_search_finds_all_above_threshold():
    rng = random.Random(2)
    items = [(i, common.words(rng, 60, rng.randint(1, 40))) for i in range(150)]
    index = D.Index(items)
    for _ in range(200):
        terms = rng.sample(range(1, len(index.docs)), rng.randint(1, 25))
        need = rng.choice([0.05, 0.2, 0.5, 0.9])
        score = {}
        for t in terms:
            for d, x in zip(index.docs[t], index.impacts[t]):
                score[d] = score.get(d, 0.0) + x
        assert {d for d, _ in index.search(terms, need)} == {
            d for d, x in score.items() if x >= need - 1e-9}


def test_planted_items_are_found_and_clean_ones_left(spark):
    rng = random.Random(3)
    items = [(i, ". ".join(common.words(rng, 400, rng.randint(4, 25)) for _ in range(3)) + ".")
             for i in range(40)] + [(50, ""), (51, None), (None, "a b c d e f"), (52, "single")]
    texts = []
    for i in range(120):
        body = [common.words(rng, 3000, rng.randint(0, 300)) for _ in range(2)]
        leak = items[rng.randrange(40)][1] if i % 4 == 0 else ""
        if i % 8 == 0 and leak:
            w = leak.split()
            w[3] = "changed"
            leak = " ".join(w)
        texts.append((i, f"{body[0]} {leak.upper() if i % 3 else leak} {body[1]}"))
    docs = spark.createDataFrame([(i, t, 0.0) for i, t in texts],
                                 "doc_id long, text string, score double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.leaks(docs, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert got == brute(texts, [(i, t) for i, t in items if i is not None and t is not None])
    assert {i for i in range(0, 120, 4) if i % 8} <= {i for i, _ in got}
    kept = {r["doc_id"] for r in D.decontaminate(docs, bench).collect()}
    assert kept == {i for i, _ in texts} - {i for i, _ in got}


def test_several_shards_and_awkward_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}")
                                   for i in range(30)], "item_id long, text string")
    docs = common.awkward(spark).unionByName(spark.createDataFrame(
        [(77, "so alpha7 beta7 gamma7 delta7 eps7 zeta7 it is", 1)], common.awkward(spark).schema))
    monkeypatch.setattr(D, "SHARD_BYTES", 400)
    assert {(r[0], r[1]) for r in D.leaks(docs, bench).collect()} == {(77, 7)}
    assert D.decontaminate(docs, bench).count() == docs.count() - 1


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(common.awkward(spark), bench).count() == 0
    some = spark.createDataFrame([(1, "a b c d e")], bench.schema)
    assert D.leaks(common.empty(spark), some).count() == 0


def test_registered_query_equals_brute_force(spark):
    from tabrix.llm.queries import QUERIES
    docs = common.documents(spark, 60)
    items = [tuple(r) for r in spark.read.parquet(f"{common.SF_SMALL}/benchmark.parquet").collect()]
    want = brute(common.texts_of(docs).items(), items)
    got = {(r[0], r[1]) for r in QUERIES["op4_benchmark_leaks"](spark, common.SF_SMALL).collect()}
    assert {p for p in got if p[0] < 60} == want


def test_one_altered_word_in_any_position_is_found():
    rng = random.Random(5)
    items = [(n * 40 + m, ". ".join(common.words(rng, 5000, k) for k in (n, m)) + ".")
             for n in (4, 5, 9, 14, 31) for m in (1, 2, 3, 5, 8, 12, 20, 35)]
    index = D.Index(items)
    texts, want = [], []
    for i, text in items:
        w = D.words(text)
        for at in range(len(w)):
            copy = [*w[:at], b"altered", *w[at + 1:]]
            texts.append(D.words(common.words(rng, 9000, at)) + copy + [b"end"] * 40)
            want.append(i)
    assert {(o, index.ids[d]) for o, d in index.leaks(texts)} >= set(enumerate(want))


def test_other_questions_and_answers_are_no_leak():
    rng = random.Random(6)
    q, a, other = (common.words(rng, 10 ** 6, n) for n in (30, 12, 12))
    index = D.Index([(1, f"{q}. {a}.")])
    assert len(index.leaks([D.words(f"{q}. {a}.")])) == 1
    assert not index.leaks([D.words(f"{q}. {other}."), D.words(f"{q}."), D.words(f"{a}.")])


def test_inserted_words_at_any_place_of_the_text():
    rng = random.Random(7)
    w = D.words(common.words(rng, 10 ** 6, 60))
    index = D.Index([(1, " ".join(x.decode() for x in w[:30]) + ". "
                      + " ".join(x.decode() for x in w[30:]))])
    copy = w[:10] + [b"more"] * 7 + w[10:45] + [b"words"] * 8 + w[45:]
    texts = [[b"x"] * k + copy + [b"y"] * 90 for k in range(150)]
    assert len(index.leaks(texts)) == len(texts)


def test_shards_do_not_change_a_score(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, f"{common.words(rng, 400, rng.randrange(6, 40))}. {common.words(rng, 400, 9)}.")
             for i in range(80)]
    texts = []
    for i, t in items:
        w = t.replace(".", "").split()
        w[rng.randrange(len(w))] = "altered"
        texts.append((i, " ".join([common.words(rng, 400, 50), *w, common.words(rng, 400, 30)])))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")

    def rows():
        return sorted((r[0], r[1], *[round(x, 9) for x in r[2:]])
                      for r in D.leaks(docs, bench).collect())

    one = rows()
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    assert len(one) > 60 and rows() == one
