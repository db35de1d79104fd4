"""Embedding near-dedup: lattice decoding, recall against all pairs, awkward vectors."""

import itertools
import math

import numpy as np
import pytest

from tabrix.llm import lattice_dedup as L
from tests.llm import common


def brute(rows, cosine=0.93):
    """(id, label, vector) rows -> links and components over all pairs."""
    def usable(x):
        return (x[1] is not None and x[2] and all(v is not None and math.isfinite(v) for v in x[2])
                and any(x[2]))

    near = [[] for _ in rows]
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i], rows[j]
        if usable(a) and usable(b) and a[1] == b[1] and len(a[2]) == len(b[2]):
            u, v = (np.array(x[2], float) / max(map(abs, x[2])) for x in (a, b))
            if u @ v / math.sqrt((u @ u) * (v @ v)) >= cosine:
                near[i].append(j)
                near[j].append(i)
    out, done = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in done:
            continue
        todo, comp = [i], {i}
        while todo:
            for k in near[todo.pop()]:
                if k not in comp:
                    comp.add(k)
                    todo.append(k)
        done |= comp
        low = min((rows[k][0] for k in comp if rows[k][0] is not None), default=None)
        for k in comp:
            out[k] = (rows[k][0], len(near[k]), low, rows[k][0] == low)
    return sorted(out, key=repr)


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "vec_id long, label int, embedding array<double>, w int")
    return sorted((tuple(r) for r in L.near_duplicates(df, **options).collect()), key=repr)


def clusters(rng, n, size, spread, dim=32):
    out = []
    for c in range(n):
        base = rng.normal(size=dim)
        for _ in range(size):
            out.append((len(out), c % 3, (base + spread * rng.normal(size=dim)).tolist()))
    return out


def test_nearest_lattice_point():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * 2
    p = L.nearest_e8(x)
    twice = np.rint(2 * p).astype(int)
    assert (abs(2 * p - twice) < 1e-9).all()
    assert ((twice % 2 == twice[:, :1] % 2).all(1)).all() and (p.sum(1) % 2 == 0).all()
    gap = ((x - p) ** 2).sum(1)
    other = ((x[:, None] - (p[:, None] + L.minimal_vectors())) ** 2).sum(2).min(1)
    assert (gap <= other + 1e-9).all() and len(L.minimal_vectors()) == 240


def test_recall_at_the_threshold():
    rng = np.random.default_rng(2)
    n, dim, cosine = 4000, 64, 0.93
    x = L.unit_rows(rng.normal(size=(n, dim)))
    z = rng.normal(size=(n, dim))
    z = L.unit_rows(z - (z * x).sum(1, keepdims=True) * x)
    a, b = L.cells(x), L.cells(cosine * x + math.sqrt(1 - cosine ** 2) * z)
    met = ((a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)).any(1)
    assert met.mean() > 0.99


@pytest.mark.parametrize("chunk", [1500, 7])
def test_links_and_components(spark, monkeypatch, chunk):
    monkeypatch.setattr(L, "CHUNK", chunk)
    rows = clusters(np.random.default_rng(3), 12, 25, 0.17)
    rows += [(1000 + i, r[1], r[2]) for i, r in enumerate(rows[:40])]
    got, want = result(spark, rows), brute(rows)
    links = sum(r[1] for r in got) / sum(r[1] for r in want)
    assert 0.99 <= links <= 1 and [r[0] for r in got] == [r[0] for r in want]
    assert sum(a == b for a, b in zip(got, want)) >= 0.9 * len(want)


def test_awkward_vectors(spark):
    v = [1.0, 2.0, 3.0]
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, v), (2, 1, [2.0, 4.0, 6.0]), (3, 2, v), (4, None, v), (5, 1, None), (6, 1, []),
            (7, 1, [0.0, 0.0, 0.0]), (8, 1, [1.0, None, 3.0]), (9, 1, [1.0, nan, 3.0]),
            (10, 1, [inf, 1.0, 1.0]), (11, 1, [1.0, 2.0]), (None, 1, v), (1, 1, v),
            (12, 1, [1e200, 2e200, 3e200]), (13, 1, [1e-200, 2e-200, 3e-200]), (None, 9, v)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows[4:6]) == brute(rows[4:6])
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert L.near_duplicates(df).count() == 0


def test_registered_query_has_full_recall_here(spark):
    from tabrix.llm.queries import QUERIES
    rows = [tuple(r) for r in spark.read.parquet(f"{common.SF_SMALL}/embeddings.parquet").select(
        "vec_id", "label", "embedding").collect()][:200]
    got = QUERIES["op5_lattice_near_dedup"](spark, common.SF_SMALL).collect()
    assert len(got) >= len(rows)
    want = {r[0]: r for r in brute(rows)}
    assert all(r["n_links"] >= want[r["vec_id"]][1] for r in got if r["vec_id"] in want)
