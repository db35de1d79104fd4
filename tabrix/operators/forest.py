"""Forests of extremely randomised trees (Geurts et al., 2006), all trees level by level.

In every node the features that are not constant there are taken in an order drawn by hash, and
each of the first few gets one cut drawn by hash between the node's least and largest value.  The
cut that lowers the Gini impurity most splits the node; no threshold is searched.  Draws depend
on the seed, the tree and the node's path only, so a forest is the same whatever the
partitions.

A table that fits a task is sent to all of them, and each grows some of the trees.  On a larger one
a level takes two passes over blocks of rows cached on the executors: ranges of the features in the
open nodes, then counts left of the cuts.  Rows carry the node they are in, for a group of
trees whose columns fit a bound; a pass takes open nodes up to another bound.  Partial sums are merged on
the executors; the driver holds the trees and one pass's nodes.  Nodes with few rows are left
aside: in the end their rows are shuffled by node, each once a tree, and a task grows the
subtree of one node at a time, with the same draws.  Fold models are trees with a role column
of their own and grow in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabrix.operators.boosting import batch_columns, doubles, spread, tasks
from tabrix.session import few_rows_at_once, materialize

BLOCK_ROWS = 16_384
TASK_ROWS = 1_024  # rows of a task at least
PART_BYTES = 1 << 26  # rows of a task at most, where there are more than a block for every core
GROUP_TREES = 128  # trees whose nodes the rows carry at a time
GROUP_BYTES = 1 << 33  # rows of these trees, all of which are shuffled once, or copies of a table
FINISH_BYTES = 1 << 24  # rows of a node whose subtree one task grows
SHUFFLE_BYTES = 1 << 26  # rows of such a task
PASS_BYTES = 1 << 25  # ranges of the open nodes of one pass
WHOLE_TIMES = 12  # FINISH_BYTES of a table that every task holds, to grow whole trees
SLICE = 256  # nodes of a row of partial sums
SHARD_BYTES = 1 << 26  # trees that a scoring task holds at a time
CUT_LEVELS = 8  # levels after which the cached blocks are written


@dataclass
class RandomTree:
    """Nodes as arrays; leaves have feature -1.  Values below ``cut`` go left.  ``p`` is the
    share of class 1 among the training rows of a node, ``cover`` their number."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    p: np.ndarray
    cover: np.ndarray

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row of x (rows x features); right children follow left ones."""
        node = np.zeros(len(x), np.int64)
        live = np.arange(len(x))
        while len(live := live[self.feature[node[live]] >= 0]):
            at = node[live]
            right = x[live, self.feature[at]] >= self.cut[at]
            node[live] = self.left[at] + right
        return node

    def nbytes(self) -> int:
        return sum(v.nbytes for v in vars(self).values())


@dataclass
class Forest:
    features: list[str]
    trees: list[RandomTree]


def mix(*parts) -> np.ndarray:
    """64-bit hash of whole numbers (arrays that broadcast)."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = np.asarray(p, np.uint64) + h * np.uint64(0xD6E8FEB86659FD93)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
            h = h ^ (h >> np.uint64(31))
    return h


def draw_cuts(seed: np.ndarray, path: np.ndarray, low: np.ndarray, high: np.ndarray, take: int
              ) -> tuple[np.ndarray, np.ndarray]:
    """(features, cuts), both (nodes x take): for each node the first ``take`` features that
    are not constant, in hash order, and a cut above the least and up to the largest value.  Where
    there are fewer, the feature is -1."""
    n, nf = low.shape
    f = np.arange(nf)
    order = mix(seed[:, None], path[:, None], f[None], 0)
    flat = ~(high > low)
    at = np.lexsort((np.broadcast_to(order, flat.shape), flat), axis=1)[:, :take]
    rows = np.arange(n)[:, None]
    feature = np.where(flat[rows, at], -1, at)
    cut = _cut_between(seed[:, None], path[:, None], at, low[rows, at], high[rows, at])
    return feature, cut


def gini_gain(left: np.ndarray, left1: np.ndarray, n: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Rows times the drop of the Gini impurity of class 1 by a cut (a constant left out)."""
    right, right1 = n - left, n1 - left1
    with np.errstate(divide="ignore", invalid="ignore"):
        return (left1 ** 2 + (left - left1) ** 2) / left + (right1 ** 2 + (right - right1) ** 2) / right


# ---- blocks --------------------------------------------------------------------------
_SCHEMA = "n int, x binary, y binary, roles binary, nodes binary"


def _pack(df: DataFrame, features: list[str], label: str, roles: Sequence[Column], rows: int
          ) -> DataFrame:
    nf, nr = len(features), len(roles)
    used = [F.coalesce(r.cast("int"), F.lit(0)).alias(f"r{i}") for i, r in enumerate(roles)]
    data = df.select(*doubles(df, features), F.col(f"`{label}`").cast("double").alias("y"), *used)
    data = data.where(F.col("y").isNotNull() & (F.greatest(
        *[F.col(f"r{i}") for i in range(nr)], F.lit(0)) > 0))
    data = spread(data, rows, BLOCK_ROWS, TASK_ROWS, PART_BYTES // (8 * nf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                x = np.nan_to_num(np.stack(batch_columns(part, nf), axis=1), nan=-np.inf)
                role = np.stack([part.column(nf + 1 + i).to_numpy().astype(np.uint8)
                                 for i in range(nr)])
                y = (part.column(nf).to_numpy() > 0.5).astype(np.uint8)
                yield _batch([(part.num_rows, x.tobytes(), y.tobytes(), role.tobytes(), b"")])

    return data.mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]],
        ["n", "x", "y", "roles", "nodes"])


def _read(batches: Iterator[pa.RecordBatch], nf: int) -> Iterator[tuple]:
    """(row, x, y, roles, nodes) of every block; nodes (trees x rows) are open positions."""
    for r in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
        n = r["n"]
        yield (r, np.frombuffer(r["x"], float).reshape(n, nf), np.frombuffer(r["y"], np.uint8),
               np.frombuffer(r["roles"], np.uint8).reshape(-1, n),
               np.frombuffer(r["nodes"], np.int32).reshape(-1, n))


def _merged(blocks: DataFrame, partial, combine, partitions: int) -> dict[int, np.ndarray]:
    """{slice number: combined array}: partial arrays of the tasks, merged on the executors."""
    schema = "slice int, v binary"

    def batch(found: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int32()),
             pa.array([v.tobytes() for v in found.values()], pa.binary())], ["slice", "v"])

    def add(total: dict[int, np.ndarray], rows) -> None:
        for r in rows:
            v = np.frombuffer(r["v"], float)
            total[r["slice"]] = combine(total[r["slice"]], v) if r["slice"] in total else v

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for v in partial(batches):
            whole = v if whole is None else combine(whole, v)
        if whole is not None:
            flat = whole.reshape(len(whole), -1)
            yield batch({i: flat[s:s + SLICE].reshape(-1)
                         for i, s in enumerate(range(0, len(flat), SLICE))})

    part = blocks.mapInArrow(run, schema)
    if partitions > 16:

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                add(total, b.to_pylist())
            yield batch(total)

        part = part.repartition("slice").mapInArrow(merge, schema)
    total: dict[int, np.ndarray] = {}
    add(total, part.collect())
    return total


def _joined(total: dict[int, np.ndarray], shape: tuple[int, ...], empty: np.ndarray) -> np.ndarray:
    out = np.broadcast_to(empty, shape).copy()
    for i, v in total.items():
        out[i * SLICE:(i + 1) * SLICE] = v.reshape(-1, *shape[1:])
    return out


def _order(number: np.ndarray, below: int) -> np.ndarray:
    """Stable order of whole numbers from 0; short ones are sorted by their digits."""
    return np.argsort(number.astype(np.uint16) if below <= 1 << 16 else number, kind="stable")


def _grouped(nodes: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, first row of each group, node of each group) of the rows in nodes lo..hi-1."""
    rows = np.flatnonzero((nodes >= lo) & (nodes < hi))
    rows = rows[_order(nodes[rows] - lo, hi - lo)]
    at = nodes[rows]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
    return rows, first, at[first] - lo if len(at) else at


def _ranges(blocks: DataFrame, nf: int, lo: int, hi: int, partitions: int) -> np.ndarray:
    """(nodes, features, 2): negated minimum and maximum; nodes are numbered over all trees."""
    def partial(batches):
        for _, x, _, _, nodes in _read(batches, nf):
            out = np.full((hi - lo, nf, 2), -np.inf)
            for t in nodes:
                rows, first, group = _grouped(t, lo, hi)
                if len(rows):
                    v = x[rows]
                    out[group, :, 0] = np.maximum(out[group, :, 0],
                                                  -np.minimum.reduceat(v, first, axis=0))
                    out[group, :, 1] = np.maximum(out[group, :, 1],
                                                  np.maximum.reduceat(v, first, axis=0))
            yield out

    return _joined(_merged(blocks, partial, np.maximum, partitions), (hi - lo, nf, 2),
                   np.array(-np.inf))


def _counts(blocks: DataFrame, nf: int, lo: int, hi: int, feature: np.ndarray, cut: np.ndarray,
            partitions: int) -> np.ndarray:
    """(nodes, cuts, 2): rows left of each cut, and those of class 1."""
    take = feature.shape[1]

    def partial(batches):
        for _, x, y, _, nodes in _read(batches, nf):
            out = np.zeros((hi - lo, take, 2))
            for t in nodes:
                rows, first, group = _grouped(t, lo, hi)
                if len(rows):
                    at = t[rows] - lo
                    left = x[rows[:, None], np.maximum(feature[at], 0)] < cut[at]
                    both = np.stack((left, left & (y[rows] == 1)[:, None]), axis=2)
                    out[group] += np.add.reduceat(both.astype(float), first, axis=0)
            yield out

    return _joined(_merged(blocks, partial, np.add, partitions), (hi - lo, take, 2), np.array(0.0))


def _start(blocks: DataFrame, nf: int, roles: list[int], roots: list[int]) -> DataFrame:
    """Rows at the roots (numbers ``roots``) of the trees that they train, -1 elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, _, role, _ in _read(batches, nf):
            nodes = np.stack([np.where(role[k] == 1, i, -1) for i, k in zip(roots, roles)])
            yield _batch([(r["n"], r["x"], r["y"], r["roles"],
                           nodes.astype(np.int32).tobytes())])

    return blocks.mapInArrow(run, _SCHEMA)


def _moved(blocks: DataFrame, nf: int, feature: np.ndarray, cut: np.ndarray,
           child: np.ndarray) -> DataFrame:
    """Rows moved to the children of their nodes: numbers of open ones, -1 for leaves; below
    that are nodes left aside (-2 - their number), whose rows stay there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, x, _, _, nodes in _read(batches, nf):
            new = np.where(nodes < -1, nodes, np.int32(-1))
            for i, t in enumerate(nodes):
                rows = np.flatnonzero(t >= 0)
                at = t[rows]
                right = x[rows, np.maximum(feature[at], 0)] >= cut[at]
                new[i, rows] = child[at, right.astype(int)]
            yield _batch([(r["n"], r["x"], r["y"], r["roles"], new.tobytes())])

    return blocks.mapInArrow(run, _SCHEMA)


# ---- subtrees ------------------------------------------------------------------------
def _subtree(x: np.ndarray, y: np.ndarray, rows: np.ndarray, seed: int, path: int, depth: int,
             max_depth: int, least: int, take: int) -> list[np.ndarray]:
    """(feature, cut, left, rows, rows of class 1) of the nodes below and with one node whose
    ``rows``, columns of ``x``, are all here, by level."""
    nf, width = x.shape
    flat, one = x.reshape(-1), y == 1
    levels: list[list[np.ndarray]] = []
    n, n1 = np.array([float(len(rows))]), np.array([float(np.count_nonzero(one[rows]))])
    paths = np.array([path], np.uint64)
    base = 0
    while True:
        feature, cut = np.full(len(n), -1, np.int32), np.zeros(len(n))
        below = np.full(len(n), -1, np.int32)
        levels.append([feature, cut, below, n, n1])
        # rows holds those of the open nodes, one node after the other
        at = np.flatnonzero((n >= 2 * least) & (n1 > 0) & (n1 < n))
        if depth >= max_depth or not len(at):
            break
        size = n[at].astype(int)
        f, c, left, left1 = _drawn(flat, width, one, rows, size, seed, paths[at], nf, take)
        best, has = _best(f, left, left1, n[at], n1[at], least)
        pick = np.arange(len(at)), best
        feature[at], cut[at] = np.where(has, f[pick], -1), c[pick]
        split = at[has]
        if not len(split):
            break
        below[split] = base + len(n) + 2 * np.arange(len(split))
        base += len(n)
        l, l1 = left[pick][has], left1[pick][has]
        n, n1 = (np.stack((a, t[split] - a), axis=1).reshape(-1) for a, t in ((l, n), (l1, n1)))
        paths = np.stack([mix(paths[split], side + 2) for side in (0, 1)], axis=1).reshape(-1)
        depth += 1
        rows = rows[np.repeat(has, size)]
        size = size[has]
        right = (flat[np.repeat(f[pick][has] * width, size) + rows]
                 >= np.repeat(c[pick][has], size))
        place = np.repeat(2 * np.arange(len(size)), size) + right
        on = np.flatnonzero(((n >= 2 * least) & (n1 > 0) & (n1 < n))[place])
        rows = rows[on[_order(place[on], len(n))]]
    return [np.concatenate(v) for v in zip(*levels)]


def _drawn(flat: np.ndarray, width: int, one: np.ndarray, rows: np.ndarray, size: np.ndarray,
           seed: int, path: np.ndarray, nf: int, take: int) -> tuple[np.ndarray, ...]:
    """(features, cuts, rows left, those of class 1), (nodes x take) each: the cuts of
    :func:`draw_cuts` and their counts.  Features are looked at in their order, in each node until
    ``take`` are not constant, so that most are never read."""
    nodes = len(size)
    feature, cut = np.full((nodes, take), -1), np.zeros((nodes, take))
    left, left1 = np.zeros((nodes, take)), np.zeros((nodes, take))
    hashed = mix(np.uint64(seed), path[:, None], np.arange(nf)[None], 0)
    order = np.argsort(hashed, axis=1, kind="stable")
    got = np.zeros(nodes, int)
    todo, mine, ones = np.arange(nodes), rows, one[rows]
    first = np.cumsum(size) - size
    for j in range(nf):
        f = order[todo, j]
        v = flat[np.repeat(f * width, size) + mine]
        low = np.maximum(np.minimum.reduceat(v, first), -np.finfo(float).max)
        high = np.maximum.reduceat(v, first)
        varies = high > low
        c = _cut_between(np.uint64(seed), path[todo], f, low, high)
        goes = v < np.repeat(c, size)
        at = todo[varies], got[todo[varies]]
        feature[at], cut[at] = f[varies], c[varies]
        left[at] = np.add.reduceat(goes, first, dtype=np.int64)[varies]
        left1[at] = np.add.reduceat(goes & ones, first, dtype=np.int64)[varies]
        got[todo] += varies
        more = got[todo] < take
        if not more.any():
            break
        if not more.all():
            keep = np.repeat(more, size)
            todo, mine, ones, size = todo[more], mine[keep], ones[keep], size[more]
            first = np.cumsum(size) - size
    return feature, cut, left, left1


def _cut_between(seed: np.ndarray, path: np.ndarray, feature: np.ndarray, low: np.ndarray,
                 high: np.ndarray) -> np.ndarray:
    """The cut drawn for a feature of a node, above ``low`` and up to ``high``."""
    u = (mix(seed, path, feature, 1) >> np.uint64(11)).astype(float) / (1 << 53)
    with np.errstate(invalid="ignore"):
        cut = low + u * (high - low)
        return np.where(cut <= low, np.nextafter(low, np.inf), np.minimum(cut, high))


def _best(f: np.ndarray, left: np.ndarray, left1: np.ndarray, n: np.ndarray, n1: np.ndarray,
          least: int) -> tuple[np.ndarray, np.ndarray]:
    """(which cut of each node is best, whether there is one); equal gains: the lower feature."""
    ok = (f >= 0) & (np.minimum(left, n[:, None] - left) >= least)
    gain = np.where(ok, gini_gain(left, left1, n[:, None], n1[:, None]), -np.inf)
    best = np.lexsort((f, -gain), axis=1)[:, 0]
    return best, gain[np.arange(len(f)), best] > -np.inf


@dataclass
class _Aside:
    """A node left aside: its tree, its place there and where it is."""
    tree: int
    node: int
    path: int
    depth: int
    rows: float


def _finished(blocks: DataFrame, nf: int, aside: list[_Aside], seeds: list[int], max_depth: int,
              least: int, take: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(number, subtree) of the nodes left aside."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, y, _, nodes in _read(batches, nf):
            short = (x.astype(np.float32) == x).all(axis=0)  # half the room and nothing lost
            x4, x8 = x[:, short].astype(np.float32), np.ascontiguousarray(x[:, ~short])
            for t in nodes:
                rows = np.flatnonzero(t < -1)
                rows = rows[_order(-2 - t[rows], len(aside))]
                if len(rows):
                    at = np.flatnonzero(np.diff(t[rows], prepend=0))
                    cuts = list(zip(at.tolist(), [*at[1:].tolist(), len(rows)]))
                    cols = [[v[i:j].tobytes() for i, j in cuts]
                            for v in (x4[rows], x8[rows], y[rows])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(-2 - t[rows[at]], pa.int32()),
                         pa.array([short.tobytes()] * len(at), pa.binary()),
                         *[pa.array(c, pa.binary()) for c in cols]], ["k", "short", "x4", "x8", "y"])

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[int, list[dict]] = {}
        for b in batches:
            for r in b.to_pylist():
                of.setdefault(r["k"], []).append(r)
        while of:
            k, pieces = of.popitem()
            y = np.concatenate([np.frombuffer(p["y"], np.uint8) for p in pieces])
            x, lo = np.empty((nf, len(y))), 0
            for p in pieces:
                hi, short = lo + len(p["y"]), np.frombuffer(p["short"], bool)
                x[short, lo:hi] = np.frombuffer(p["x4"], np.float32).reshape(hi - lo, -1).T
                x[~short, lo:hi] = np.frombuffer(p["x8"], float).reshape(hi - lo, -1).T
                lo = hi
            a = aside[k]
            found = _subtree(x, y, np.arange(len(y)), seeds[a.tree], a.path, a.depth, max_depth,
                             least, take)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in found]],
                ["k", *(c for c, _ in _SUBTREE)])

    size = sum(a.rows for a in aside) * (8 * nf + 1)
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    parts = min(len(aside), max(cores, math.ceil(size / SHUFFLE_BYTES)))
    rows = blocks.mapInArrow(sent, "k int, short binary, x4 binary, x8 binary, y binary")
    trees = rows.repartition(parts, "k").mapInArrow(
        grown, ", ".join(["k int", *(f"{c} binary" for c, _ in _SUBTREE)]))
    for b in trees.toArrow().to_batches():
        for r in b.to_pylist():
            yield r["k"], [np.frombuffer(r[c], kind) for c, kind in _SUBTREE]


def _whole(packed: DataFrame, nf: int, todo: list[tuple[int, int]], seeds: list[int],
           max_depth: int, least: int, take: int, parts: int) -> list[RandomTree]:
    """A tree for each (role, number) and seed; ``parts`` tasks get all rows each and grow some
    of the trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, xs, ys, rs = -1, [], [], []
        for r, x, y, role, _ in _read(batches, nf):
            part = r["part"]
            xs.append(np.ascontiguousarray(x.T))
            ys.append(y)
            rs.append(role)
        if part < 0:
            return
        x, y, role = np.empty((nf, sum(map(len, ys)))), np.concatenate(ys), np.concatenate(rs, 1)
        for lo in np.cumsum([0, *map(len, ys[:-1])]).tolist():
            v = xs.pop(0)
            x[:, lo:lo + v.shape[1]] = v
        for i in range(part, len(todo), parts):
            found = _subtree(x, y, np.flatnonzero(role[todo[i][0]] == 1), seeds[i], 1, 0,
                             max_depth, least, take)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in found]],
                ["k", *(c for c, _ in _SUBTREE)])

    copies = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    trees = materialize(copies.repartitionById(parts, F.col("part")).mapInArrow(
        run, ", ".join(["k int", *(f"{c} binary" for c, _ in _SUBTREE)])))
    out: list[RandomTree | None] = [None] * len(todo)
    for r in trees.toLocalIterator():
        f, c, left, n, n1 = (np.frombuffer(r[name], kind) for name, kind in _SUBTREE)
        out[r["k"]] = RandomTree(f, c, left, n1 / np.maximum(n, 1), n.astype(np.int64))
    return out


_SUBTREE = (("feature", np.int32), ("cut", float), ("below", np.int32), ("n", float), ("n1", float))


# ---- growing -------------------------------------------------------------------------
@dataclass
class _Growing:
    """A tree as lists while it grows."""
    seed: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    n: list[float] = field(default_factory=list)
    n1: list[float] = field(default_factory=list)

    def done(self) -> RandomTree:
        n = np.array(self.n)
        return RandomTree(np.array(self.feature, np.int32), np.array(self.cut),
                          np.array(self.left, np.int32),
                          np.array(self.n1) / np.maximum(n, 1), n.astype(np.int64))


def fit_forests(df: DataFrame, features: Sequence[str], roles: Sequence[Column], trees: int = 500,
                max_depth: int = 20, min_rows: int = 10, take: int | None = None,
                seeds: Sequence[int] = (42,), label: str = "y") -> list[Forest]:
    """One forest per role column (rows with 1 train it), ``trees`` trees each, seeded by
    ``seeds`` (one for all, or one per role).  ``take``: features with a cut in a node, the square root
    of their number by default.

    Missing values lie below all others.  Rows without label are left out.  A forest without
    training rows gives one half everywhere."""
    features = list(features)
    nf = len(features)
    take = take or max(1, math.isqrt(nf))
    seeds = list(seeds) * len(roles) if len(seeds) == 1 else list(seeds)
    y = F.col(f"`{label}`").cast("double")
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[e for i, r in enumerate(roles) for e in (
        F.count_if((r == 1) & y.isNotNull()).alias(f"n{i}"),
        F.count_if((r == 1) & (y > 0.5)).alias(f"p{i}"))]).first()
    packed = materialize(_pack(df, features, label, roles, stats["n"]), large=True)
    partitions = tasks(df, stats["n"], BLOCK_ROWS, TASK_ROWS, PART_BYTES // (8 * nf))
    grown: list[list[RandomTree]] = [[] for _ in roles]
    todo = [(k, t) for k in range(len(roles)) for t in range(trees) if stats[f"n{k}"]]
    copies = min(len(todo), 2 * df.sparkSession.sparkContext.defaultParallelism)
    size = 8 * nf * stats["n"]
    whole = size <= WHOLE_TIMES * FINISH_BYTES and copies * size <= GROUP_BYTES
    at_once = max(1, min(GROUP_TREES, GROUP_BYTES // (8 * nf * max(1, stats["n"]))))
    all_seeds = [int(mix(seeds[k], t)) for k, t in todo]
    with few_rows_at_once(df.sparkSession):
        if whole and todo:
            made = _whole(packed, nf, todo, all_seeds, max_depth, max(1, min_rows), take, copies)
            for (k, _), tree in zip(todo, made):
                grown[k].append(tree)
            return [Forest(features, g) for g in grown]
        packed = packed.persist(StorageLevel.DISK_ONLY)
        try:
            for s in range(0, len(todo), at_once):
                group = todo[s:s + at_once]
                made = _grow(packed, nf, [k for k, _ in group], all_seeds[s:s + at_once],
                             [(stats[f"n{k}"], stats[f"p{k}"]) for k, _ in group], max_depth,
                             min_rows, take, partitions)
                for (k, _), tree in zip(group, made):
                    grown[k].append(tree)
        finally:
            packed.unpersist()
    return [Forest(features, g) for g in grown]


def _grow(packed: DataFrame, nf: int, roles: list[int], seeds: list[int],
          roots: list[tuple[int, int]], max_depth: int, min_rows: int, take: int,
          partitions: int) -> list[RandomTree]:
    trees = [_Growing(s) for s in seeds]
    for t, (n, n1) in zip(trees, roots):
        t.n.append(float(n))
        t.n1.append(float(n1))
    least = max(1, min_rows)
    few = FINISH_BYTES // (8 * nf)
    aside: list[_Aside] = []

    def number(new: list, t: int, k: int, path: np.uint64, depth: int) -> int:
        """The node's number among the open ones or, where it has few rows, those left aside."""
        if trees[t].n[k] <= few:
            aside.append(_Aside(t, k, int(path), depth, trees[t].n[k]))
            return -1 - len(aside)
        new.append((t, k, path))
        return len(new) - 1

    # open nodes over all trees: tree, node in the tree, path (a hash of the turns)
    new: list[tuple[int, int, np.uint64]] = []
    first = [number(new, t, 0, np.uint64(1), 0) for t in range(len(trees))]
    blocks = _start(packed, nf, roles, first).persist(StorageLevel.DISK_ONLY)
    held = [blocks]
    per_pass = max(SLICE, PASS_BYTES // (16 * nf))
    all_seeds = np.array(seeds, np.uint64)
    try:
        for depth in range(max_depth):
            if not new:
                break
            tree = np.array([t for t, _, _ in new])
            node = np.array([k for _, k, _ in new])
            path = np.array([p for _, _, p in new], np.uint64)
            total = np.array([trees[t].n[i] for t, i in zip(tree, node)])
            ones = np.array([trees[t].n1[i] for t, i in zip(tree, node)])
            splittable = (total >= 2 * least) & (ones > 0) & (ones < total)
            if not splittable.any():
                break
            feature = np.full(len(tree), -1, np.int64)
            cut, left, left1 = np.zeros(len(tree)), np.zeros(len(tree)), np.zeros(len(tree))
            for lo in range(0, len(tree), per_pass):
                hi = min(lo + per_pass, len(tree))
                r = _ranges(blocks, nf, lo, hi, partitions)
                # a missing value has no number to cut at: ranges are those of the others
                f, c = draw_cuts(all_seeds[tree[lo:hi]], path[lo:hi],
                                 np.maximum(-r[..., 0], -np.finfo(float).max), r[..., 1], take)
                got = _counts(blocks, nf, lo, hi, f, c, partitions)
                best, has = _best(f, got[..., 0], got[..., 1], total[lo:hi], ones[lo:hi], least)
                at = np.arange(hi - lo)
                feature[lo:hi] = np.where(has & splittable[lo:hi], f[at, best], -1)
                cut[lo:hi] = c[at, best]
                left[lo:hi], left1[lo:hi] = got[at, best, 0], got[at, best, 1]
            child = np.full((len(tree), 2), -1, np.int64)
            new = []
            paths = np.stack([mix(path, side + 2) for side in (0, 1)], axis=1)
            for i in np.flatnonzero(feature >= 0).tolist():
                t, k = trees[tree[i]], int(node[i])
                t.feature[k], t.cut[k], t.left[k] = int(feature[i]), float(cut[i]), len(t.n)
                sides = ((left[i], left1[i]), (total[i] - left[i], ones[i] - left1[i]))
                for side, (n, n1) in enumerate(sides):
                    t.feature.append(-1)
                    t.cut.append(0.0)
                    t.left.append(-1)
                    t.n.append(float(n))
                    t.n1.append(float(n1))
                    if n >= 2 * least and 0 < n1 < n and depth + 1 < max_depth:
                        child[i, side] = number(new, int(tree[i]), len(t.n) - 1, paths[i, side],
                                                depth + 1)
            blocks = _moved(blocks, nf, feature, cut, child)
            if depth % CUT_LEVELS == CUT_LEVELS - 1:
                blocks = materialize(blocks, large=True)
            blocks = blocks.persist(StorageLevel.DISK_ONLY)
            held.append(blocks)
            while len(held) > 2:
                held.pop(0).unpersist()
        done = [t.done() for t in trees]
        if aside:
            below: dict[int, list] = {}
            for k, sub in _finished(blocks, nf, aside, seeds, max_depth, least, take):
                below.setdefault(aside[k].tree, []).append((aside[k].node, sub))
            for t, subs in below.items():
                done[t] = _hung(done[t], sorted(subs, key=lambda v: v[0]))
    finally:
        for b in held:
            b.unpersist()
    return done


def _hung(tree: RandomTree, subs: list[tuple[int, list[np.ndarray]]]) -> RandomTree:
    """The tree with subtrees at some of its leaves."""
    feature, cut, left = tree.feature.copy(), tree.cut.copy(), tree.left.copy()
    more = []
    size = len(feature)
    for node, (f, c, l, n, n1) in subs:
        # the subtree's node 0 is the leaf; the others follow the nodes that are there
        l = np.where(l >= 0, l + size - 1, -1).astype(np.int32)
        feature[node], cut[node], left[node] = f[0], c[0], l[0]
        more.append((f[1:], c[1:], l[1:], (n1 / np.maximum(n, 1))[1:], n[1:].astype(np.int64)))
        size += len(f) - 1
    return RandomTree(*(np.concatenate((a, *b)) for a, b in zip(
        (feature, cut, left, tree.p, tree.cover), zip(*more))))


# ---- scoring -------------------------------------------------------------------------
def score(forests: Sequence[Forest], df: DataFrame, keep: Sequence[str],
          which: Column | None = None, out: str = "p") -> DataFrame:
    """``keep`` and the mean share of class 1 over a forest's trees: an array with one value per
    forest, or with ``which`` (an index) one value, by the forest named, null where there is none.  One
    scan; the trees pass by in shards, so that a task holds one of them at a time."""
    forests = list(forests)
    nf, nk = len(forests[0].features), len(keep)
    width = 1 if which is not None else len(forests)
    own = F.coalesce(which.cast("int"), F.lit(-1)) if which is not None else F.lit(0)
    kinds = ", ".join([*[f"k{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)],
                       *[f"f{i} double" for i in range(nf)], "own int", "p array<double>"])
    data = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                     *doubles(df, forests[0].features), own.alias("own"),
                     F.array_repeat(F.lit(0.0), width).alias("p"))
    for shard in _shards(forests):
        data = data.mapInArrow(_add_shard(shard, nf, nk, width, which is not None), kinds)
    trees = F.array(*[F.lit(len(f.trees)) for f in forests])

    def mean(v: Column, n: Column) -> Column:
        return F.when(n > 0, v / n).otherwise(F.when(n == 0, F.lit(0.5)))

    if which is not None:
        p = mean(F.col("p")[0], F.get(trees, F.when(F.col("own") >= 0, F.col("own"))))
    else:
        p = F.zip_with("p", trees, mean)
    return data.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], p.alias(out))


def _shards(forests: list[Forest]) -> list[list[tuple[int, RandomTree]]]:
    out: list[list[tuple[int, RandomTree]]] = []
    size = 0
    for k, f in enumerate(forests):
        for t in f.trees:
            if not out or size + t.nbytes() > SHARD_BYTES:
                out.append([])
                size = 0
            out[-1].append((k, t))
            size += t.nbytes()
    return out


def _add_shard(shard: list[tuple[int, RandomTree]], nf: int, nk: int, width: int, single: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x = np.nan_to_num(np.stack(batch_columns(b, nf, nk), axis=1), nan=-np.inf)
            own = b.column(nk + nf).to_numpy()
            p = b.column(nk + nf + 1).flatten().to_numpy().reshape(n, width).copy()
            rows_of = {k: np.flatnonzero(own == k) if single else np.arange(n)
                       for k in {k for k, _ in shard}}
            for k, t in shard:
                rows = rows_of[k]
                if len(rows):
                    p[rows, 0 if single else k] += t.p[t.route(x[rows])]
            ends = pa.array(np.arange(0, n * width + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(p.reshape(-1)))],
                b.schema.names)

    return run
