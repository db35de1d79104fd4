"""Embedding near-dedup by lattice hashing.

Each table projects unit vectors at random to eight dimensions and decodes them to the nearest
point of the E8 lattice, the vector's home cell.  Every vector also probes the neighbouring
lattice points (of the 240 nearest to its home) that lie closest to its projection.  Two
vectors are compared if one's home is the other's home or probe in some table; comparison is the
cosine in double precision.  At the defaults a pair at cosine 0.93 meets with probability above
0.999 (``tests/llm`` measure recall against all pairs).

Equal vectors form one class and only classes are compared.  A cell's members are cut into
chunks of ``CHUNK``, and every pair of chunks is one block of at most 2 * CHUNK vectors, compared
by matrix product.  A linked pair counts in the first table where it meets, so links are exact
sums; blocks return per class its number of links and one edge, never the pairs.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.components import connected_components
from tabrix.llm.names import column
from tabrix.session import materialize

TABLES = 4
PROBES = 8
SCALE = 1.5  # length of a projected unit vector, in units of half the lattice's norm
CHUNK = 1500
SEED = 5


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or all +-1/2 with an even number
    of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = s
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8)
            if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


_NEIGHBOURS = minimal_vectors()
_MIX = np.random.default_rng(SEED).integers(1, 1 << 62, 8, dtype=np.int64) | 1


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer entries of even sum."""
    near = np.rint(x)
    gap = x - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(gap[odd]).argmax(1)
    near[odd, worst] += np.where(gap[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 for each row: the better of D8 and D8 shifted by one half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@functools.lru_cache(maxsize=8)
def _projections(dim: int, tables: int) -> np.ndarray:
    rng = np.random.default_rng([SEED, dim])
    return rng.normal(0, SCALE / np.sqrt(8), (tables, dim, 8))


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Keys of the home (first) and the probed cells: (vectors, tables, 1 + probes).  A key
    hashes the cell's lattice point; equal keys of different cells only add comparisons."""
    out = np.empty((len(unit), tables, 1 + probes), np.int64)
    for t, r in enumerate(_projections(unit.shape[1], tables)):
        x = unit @ r
        home = nearest_e8(x)
        out[:, t, 0] = (2 * home).astype(np.int64) @ _MIX
        if probes:
            rank = (x - home) @ _NEIGHBOURS.T
            best = np.argpartition(-rank, probes - 1, axis=1)[:, :probes]
            point = home[:, None, :] + _NEIGHBOURS[best]
            out[:, t, 1:] = (2 * point).astype(np.int64) @ _MIX
    return out


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows divided by their length, safe for very large and very small entries."""
    x = x.astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array, rows: np.ndarray | None = None) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _cell_rows(classes: DataFrame, tables: int, probes: int) -> DataFrame:
    """(cid, label, dim, t, cell, home) for the home and every probed cell of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy()
            for dim in np.unique(dims):
                part = b.filter(pa.array(dims == dim))
                for k in range(0, part.num_rows, 2048):
                    p = part.slice(k, 2048)
                    n, m = p.num_rows, tables * (1 + probes)
                    key = cells(unit_rows(_matrix(p.column(3))), tables, probes)
                    at = pa.array(np.repeat(np.arange(n), m))
                    yield pa.RecordBatch.from_arrays(
                        [p.column(0).take(at), p.column(1).take(at), p.column(2).take(at),
                         pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32),
                                                    1 + probes), n)),
                         pa.array(key.reshape(-1)),
                         pa.array(np.tile(np.arange(1 + probes) == 0, n * tables))],
                        ["cid", "label", "dim", "t", "cell", "home"])

    return classes.select("cid", "label", "dim", "v").mapInArrow(
        run, "cid long, label long, dim int, t int, cell long, home boolean")


def linked_pairs(unit: np.ndarray, left: np.ndarray, right: np.ndarray, home: np.ndarray, t: int,
                 cosine: float, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i in left, j in right, i != j once) with cosine >= ``cosine`` that first
    meet in table t.  Of a pair that meets in both homes' cells of t, the block of the cell
    with the smaller key counts."""
    sim = unit[left] @ unit[right].T
    i, j = np.nonzero(sim >= cosine)
    i, j = left[i], right[j]
    ok = home[i] | home[j]
    if left is right:
        ok &= i < j
    i, j = i[ok], j[ok]
    if not len(i):
        return i, j
    used, inv = np.unique(np.concatenate((i, j)), return_inverse=True)
    key = cells(unit[used], tables, probes)
    a, b = key[inv[:len(i)]], key[inv[len(i):]]
    before = np.zeros(len(i), bool)
    for u in range(t):
        before |= (a[:, u] == b[:, u, :1]).any(1) | (b[:, u] == a[:, u, :1]).any(1)
    ha, hb = a[:, t, 0], b[:, t, 0]
    both = (a[:, t] == hb[:, None]).any(1) & (b[:, t] == ha[:, None]).any(1) & (ha != hb)
    here = np.where(home[i], ha, hb)  # this block's cell
    keep = ~before & (~both | (here == np.minimum(ha, hb)))
    return i[keep], j[keep]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable over the pairs, for each of n indices."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _blocks(rows: DataFrame, cosine: float, tables: int, probes: int) -> DataFrame:
    """Per block and linked class: (cid, links found here, class of the block it is linked to)."""
    keys = ["label", "dim", "t", "cell", "ca", "cb"]

    def solve(b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = {k: b[k][0].as_py() for k in ("t", "ca", "cb")}
        cid, w = b["cid"].to_numpy(), b["w"].to_numpy()
        chunk, home = b["chunk"].to_numpy(), b["home"].to_numpy(zero_copy_only=False)
        unit = unit_rows(_matrix(b["v"].combine_chunks()))
        left = np.flatnonzero(chunk == first["ca"])
        right = left if first["ca"] == first["cb"] else np.flatnonzero(chunk == first["cb"])
        i, j = linked_pairs(unit, left, right, home, first["t"], cosine, tables, probes)
        n = np.bincount(i, w[j], len(cid)) + np.bincount(j, w[i], len(cid))
        hit = np.flatnonzero(n > 0)
        return cid[hit], n[hit].astype(np.int64), cid[_roots(len(cid), i, j)[hit]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for b in itertools.chain(batches, [None]):
            if b is not None:
                rest.append(b)
                # a block ends where its key changes; the last one may go on in the next batch
                if _same_key(rest[0], 0, b, b.num_rows - 1, keys):
                    continue
            if not rest:
                return
            table = pa.Table.from_batches(rest)
            cut = _cuts(table, keys)
            out = [solve(table.slice(s, e - s)) for s, e in itertools.pairwise(cut)
                   if e - s > 1 and (b is None or e < table.num_rows)]
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["cid", "n", "root"])
            if b is None:
                return
            rest = table.slice(cut[-2]).combine_chunks().to_batches()

    part = rows.repartition(*keys).sortWithinPartitions(*keys)
    return part.mapInArrow(run, "cid long, n long, root long")


def _same_key(a: pa.RecordBatch, i: int, b: pa.RecordBatch, j: int, keys: list[str]) -> bool:
    return all(a.column(k)[i].as_py() == b.column(k)[j].as_py() for k in keys)


def _cuts(table: pa.Table, keys: list[str]) -> list[int]:
    new = np.zeros(max(0, table.num_rows - 1), bool)
    for k in keys:
        c = table[k].to_numpy()
        new |= c[1:] != c[:-1]
    return [0, *(np.flatnonzero(new) + 1).tolist(), table.num_rows]


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with labels as longs: whole numbers as they are, others by a table of numbers."""
    if isinstance(rows.schema["label"].dataType, T.IntegralType):
        return rows.withColumn("label", F.col("label").cast("long"))
    known = materialize(rows.filter("label is not null").select("label").distinct()
                        .withColumn("number", F.monotonically_increasing_id()))
    return rows.join(known, "label", "left").select("id", F.col("number").alias("label"), "v", "ok")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", cosine: float = 0.93, tables: int = TABLES,
                    probes: int = PROBES) -> DataFrame:
    """One row per vector: id, n_links (other vectors linked directly), component_id (smallest
    id reachable) and kept (the id is its component's).

    Only vectors of equal non-null label (of any type that can be grouped) and equal dimension
    are compared.  Null, empty and
    zero vectors and those with null or non-finite entries link with nothing.  Rows that
    repeat an id are vectors of their own; null ids are never a component's id unless it has
    no other, which gives a null component_id.  Other columns are not read."""
    v = F.col("v")
    usable = (F.col("label").isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0))
    rows = vectors.select(column(id_col).alias("id"), column(label_col).alias("label"),
                          column(vec_col).alias("v")).withColumn(
        "ok", F.coalesce(usable, F.lit(False)))
    rows = _numbered(rows)
    keyed = rows.select("*", F.xxhash64("label", "v").alias("k1"),
                        F.xxhash64(F.lit(SEED), "v", "label").alias("k2"))
    classes = materialize(
        keyed.filter("ok").groupBy("k1", "k2")
        .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("low"),
             F.count(F.lit(1)).alias("w"))
        .select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("cid")))
    keys = ["label", "dim", "t", "cell"]
    at = materialize(_cell_rows(classes, tables, probes))
    sizes = (at.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.count_if("home").alias("homes"))
             .filter("m > 1 and homes > 0").withColumn("nb", F.ceil(F.col("m") / CHUNK)))
    member = (at.join(sizes, keys)
              .withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("nb")))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
              .select("cid", *keys, "home", "chunk", F.least("chunk", "other").alias("ca"),
                      F.greatest("chunk", "other").alias("cb")))
    found = materialize(_blocks(member.join(classes.select("cid", "w", "v"), "cid"), cosine,
                                tables, probes))
    comp = connected_components(found, "cid", "root")
    links = found.groupBy(F.col("cid").alias("node")).agg(F.sum("n").alias("n"))
    part = (classes.select("k1", "k2", "cid", "low", "w")
            .join(comp, F.col("cid") == F.col("node"), "left").drop("node")
            .join(links, F.col("cid") == F.col("node"), "left")
            .select("k1", "k2", "low", F.coalesce("root", "cid").alias("root"),
                    (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links")))
    lowest = part.groupBy("root").agg(F.min("low").alias("component_id"))
    decided = part.join(lowest, "root").select("k1", "k2", "n_links", "component_id")
    good = (keyed.filter("ok").select("id", "k1", "k2").join(decided, ["k1", "k2"])
            .select("id", "n_links", "component_id"))
    bad = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"),
                                       F.col("id").alias("component_id"))
    return good.unionByName(bad).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
