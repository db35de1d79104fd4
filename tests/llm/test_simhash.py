"""SimHash components against brute force."""

import itertools
import random

import pytest
import xxhash

from tabrix.llm import simhash
from tabrix.llm.components import connected_components
from tests.llm import common


def slow_fingerprint(text: str, k: int = 3) -> int:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    if not w:
        return 0
    runs = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(nodes, near):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_choice_of_bits(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for bits in itertools.combinations(range(64), radius):
        assert any(all(not m >> b & 1 for b in bits) for m in masks)


def test_fingerprints(spark):
    docs = common.documents(spark).select("doc_id", "text").unionByName(
        common.awkward(spark).select("doc_id", "text").filter("doc_id is not null"))
    rows = simhash.simhash_components(docs).collect()
    want = sorted((r["doc_id"], f"{slow_fingerprint(r['text']):016x}") for r in docs.collect())
    assert sorted((r["doc_id"], r["fingerprint"]) for r in rows) == want


@pytest.mark.parametrize("bucket", [2, 64])
def test_components_of_dense_fingerprints(spark, bucket):
    rng = random.Random(8)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >> 63 else x)
    near = [(a, b) for a, b in itertools.combinations(sorted(fps), 2)
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {r["node"]: r["root"] for r in connected_components(
        simhash.links(df, bucket_pairs=bucket)).collect()}
    want = roots(fps, near)
    alone = {x for x in fps if not any(x in p for p in near)}
    assert got == {k: v for k, v in want.items() if k not in alone}


def test_registered_query_equals_brute_force(spark):
    from tabrix.llm.queries import QUERIES
    rows = QUERIES["op8_simhash_components"](spark, common.SF_SMALL).collect()
    fp = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    near = [(a, b) for a, b in itertools.combinations(sorted(fp), 2)
            if (fp[a] ^ fp[b]).bit_count() <= 2]
    assert {r["doc_id"]: r["component_id"] for r in rows} == roots(fp, near)


def test_awkward_rows_and_dedup(spark):
    docs = common.awkward(spark, "fp int")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(docs).collect()}
    assert {(None, 0), (None, 8), (0, 0), (1, 0), (9, 8), (1000, 4)} <= got
    kept = [r["doc_id"] for r in simhash.dedup(docs).collect()]
    assert sorted(i for i in kept if i in (0, 1, 2, 3, 4, 8, 9, 1000)) == [0, 4, 8, 8]
    assert None not in kept
    assert simhash.simhash_components(common.empty(spark)).count() == 0
    only = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert simhash.simhash_components(only).first()["component_id"] is None
    assert simhash.dedup(only).count() == 1


def test_components_of_graphs(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(200)] + [(500, i) for i in range(501, 560)]
    pairs += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(150)]
    nodes = {x for a, b in pairs if a != b for x in (a, b)}
    want = roots(nodes, [p for p in pairs if p[0] != p[1]])
    df = spark.createDataFrame([*pairs, (None, 1), (7, 7)], "a long, b long").repartition(5)
    assert {r["node"]: r["root"] for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).count() == 0
