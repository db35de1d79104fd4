"""Boosted trees from gradient histograms, many models in one scan.

The rows are binned once (quantile bins, bin 0 for missing values; category codes are bins of their own)
and packed into blocks of rows, cached on the executors.  A tree grows leaf by leaf, the leaf of
largest gain first.  One pass over the blocks sums the gradient histograms of all leaves whose
children could still be chosen; a child's sibling follows by subtraction.  Which leaves are split
in which order is decided on the driver, which holds one histogram per open leaf and never a row.
Several models (folds, seeds, trials) grow in lock-step, so that a pass serves all of them.

Gradients are rounded to fixed point before they are summed: sums are exact integers and a
model does not depend on partitions or the order of rows.

A table of few rows is sent to one task for each model, which grows all of its trees there from the
same sums; only then does a driver's round trip cost more than the sums themselves.

Early stopping follows a named metric: every few rounds the margins that the validation rows had
after each round give the exact metric of each round, and a model ends with its best round
once ``patience`` rounds have brought nothing better.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tabrix.session import checkpoint_dir, materialize

BLOCK_ROWS = 65_536  # rows of a block at most; bounds the exactness of packed sums
TASK_ROWS = 8_192  # rows of a task at least
PART_ROWS = 1 << 20  # rows of a task at most, where there are more than a block for every core
ALONE_BYTES = 1 << 23  # bins of a table (a copy for each task) whose models grow in a task each
SLICE_ROWS = 1 << 18  # validation rows of a slice of the margin, about
FEW_ROWS = 8_192  # rows of a pass that are counted for all features at once
JOINT_BINS = 256, 4_096  # joint bins of features counted together, fewer where rows are few
UNIT = 1 << 20  # fixed-point steps of the largest gradient
COUNT = float(1 << 36)  # a row's count in a packed (count, hessian) sum
CATEGORY_SMOOTHING = 10.0  # added to the hessian when categories are put in order
MAXIMISE = {"auc": True, "logloss": False, "rmse": False}


@dataclass(frozen=True)
class BoostConfig:
    """``leaves`` 0 and ``max_depth`` 0: no limit; ``patience`` 0: no early stopping."""
    rounds: int = 1000
    learning_rate: float = 0.1
    leaves: int = 31
    max_depth: int = 0
    min_rows: int = 20
    min_hessian: float = 1e-3
    l1: float = 0.0
    l2: float = 0.0
    min_gain: float = 0.0
    row_fraction: float = 1.0
    column_fraction: float = 1.0
    patience: int = 0
    metric: str = "auc"
    seed: int = 42


@dataclass(frozen=True)
class Job:
    """One model of a fit: its configuration, the role column that says which rows it trains
    (1) and validates (2) on, and whether classes are weighted to equal sums."""
    config: BoostConfig
    role: int = 0
    balanced: bool = False


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` is -1 at leaves.  Numbers go left if their bin is at
    most ``threshold``, missing ones if ``missing_left``; categories if their bit of
    ``sets[category]`` is set."""
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    category: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray
    sets: np.ndarray

    def left_bins(self, node: int) -> np.ndarray:
        """Whether each bin goes left in an inner node."""
        if self.category[node] >= 0:
            return self.sets[self.category[node]]
        out = np.arange(self.sets.shape[1]) <= self.threshold[node]
        out[0] &= self.missing_left[node]
        return out

    def parts(self, bins: np.ndarray, rows: np.ndarray, wanted: np.ndarray | None = None
              ) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves (with ``wanted``, a flag for each node, only those) and the rows, columns of
        ``bins``, that end in them.  Rows are parted node by node; branches without a wanted leaf
        are left aside."""
        need = self.feature < 0 if wanted is None else wanted.copy()
        for n in np.flatnonzero(self.feature >= 0)[::-1].tolist():  # children follow parents
            need[n] = need[self.left[n]] or need[self.right[n]]
        todo = [(0, rows)] if need[0] else []
        while todo:
            n, r = todo.pop()
            f = self.feature[n]
            if f < 0:
                yield n, r
            elif len(r):
                left = self.left_bins(n)[bins[f][r]]
                a, b = int(self.left[n]), int(self.right[n])
                if need[a]:
                    todo.append((a, r[left]))
                if need[b]:
                    todo.append((b, r[~left]))

    def add_to(self, margin: np.ndarray, bins: np.ndarray) -> None:
        """Add the tree's value to the margin of every column of ``bins``."""
        for n, rows in self.parts(bins, np.arange(bins.shape[1])):
            margin[rows] += self.value[n]


@dataclass
class BoostedModel:
    features: list[str]
    categorical: dict[str, int]
    edges: list[np.ndarray]  # upper edges of the bins of numbers; empty for categories
    init: float
    trees: list[Tree]
    history: list[float] = field(default_factory=list)  # metric after each round tried

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return bin_columns(columns, self.features, self.categorical, self.edges)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(bins.shape[1], self.init)
        for t in self.trees:
            t.add_to(out, bins)
        return out


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(m, -700, 700)))


# ---- bins ----------------------------------------------------------------------------
Summary = tuple[np.ndarray, np.ndarray]  # ascending distinct values, rows of each

HELD_ROWS = 1 << 17  # rows that a task sorts at a time
HELD_VALUES = 1 << 18  # distinct values of a column that a task holds
SENT_VALUES = 1 << 15  # distinct values of a column that leave a task
MERGED_TASKS = 64  # tasks whose summaries are merged at a time


def merged(parts: Sequence[Summary]) -> Summary:
    """One summary of the rows of all ``parts``."""
    v = np.concatenate([p[0] for p in parts] or [np.zeros(0)])
    n = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
    at = np.argsort(v, kind="stable")
    v, n = v[at], n[at]
    first = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, int)
    return v[first], np.add.reduceat(n, first) if len(v) else n


def thinned(s: Summary, most: int) -> Summary:
    """``s`` with at most ``most`` values: those at even steps of the rows, each with the rows
    since the one before.  No rank moves by more than a step; fewer values stay as they are."""
    v, n = s
    if len(v) <= most:
        return s
    upto = np.cumsum(n)
    step = (upto * most - 1) // int(upto[-1])
    last = np.flatnonzero(np.append(step[1:] != step[:-1], True))
    return v[last], np.diff(upto[last], prepend=0)


def quantiles(s: Summary, share: Sequence[float]) -> np.ndarray:
    """The value of rank ceil(q n) for every q of ``share``."""
    v, n = s
    upto = np.cumsum(n)
    if not len(v):
        return np.zeros(0)
    rank = np.ceil(np.array(share) * float(upto[-1]))
    return v[np.minimum(np.searchsorted(upto, rank, "left"), len(v) - 1)]


def bin_edges(df: DataFrame, features: Sequence[str], categorical: dict[str, int],
              max_bins: int) -> list[np.ndarray]:
    """Distinct quantiles of each number as upper edges, at most ``max_bins`` - 1 bins.

    One scan: every task sorts its rows and counts the distinct values of each column; the counts
    meet column by column.  Exact as long as no task finds more than SENT_VALUES values in a
    column; beyond, ranks are off by about a ten-thousandth of the rows."""
    numbers = [c for c in features if c not in categorical]
    none: np.ndarray = np.zeros(0)
    if not numbers:
        return [none for _ in features]
    share = [i / (max_bins - 1) for i in range(1, max_bins - 1)]
    k = len(numbers)
    schema = "c int, part int, v binary, n binary"

    def row(c: int, part: int, s: Summary) -> dict:
        return dict(c=c, part=part, v=s[0].tobytes(), n=s[1].tobytes())

    def batch(rows: list[dict]) -> pa.Table:
        kinds = pa.schema([("c", pa.int32()), ("part", pa.int32()), ("v", pa.binary()),
                           ("n", pa.binary())])
        return pa.Table.from_pylist(rows, kinds)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Summary] = [merged([])] * k
        rows: list[list[np.ndarray]] = [[] for _ in range(k)]
        size = 0

        def take() -> None:
            for i in range(k):
                x = np.concatenate(rows[i])
                x = np.sort(x[~np.isnan(x)]) + 0.0
                first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else []
                new = x[first], np.diff(np.append(first, len(x))).astype(np.int64)
                held[i] = thinned(merged([held[i], new]) if len(held[i][0]) else new, HELD_VALUES)
                rows[i] = []

        for b in batches:
            for i, x in enumerate(batch_columns(b, k)):
                rows[i].append(x)
            size += b.num_rows
            if size >= HELD_ROWS:
                take()
                size = 0
        if size:
            take()
        part = TaskContext.get().partitionId()
        for i in range(k):
            if len(held[i][0]):
                yield from batch([row(i, part, thinned(held[i], SENT_VALUES))]).to_batches()

    def together(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["part"])
        s = merged([(np.frombuffer(r["v"], float), np.frombuffer(r["n"], np.int64))
                    for r in rows])
        return batch([row(rows[0]["c"], rows[0]["part"], thinned(s, SENT_VALUES))])

    def last(t: pa.Table) -> pa.Table:
        r = together(t).to_pylist()[0]
        s = np.frombuffer(r["v"], float), np.frombuffer(r["n"], np.int64)
        return pa.table({"c": pa.array([r["c"]], pa.int32()),
                         "q": pa.array([quantiles(s, share).tolist()], pa.list_(pa.float64()))})

    counts = df.select(*doubles(df, numbers)).mapInArrow(count, schema)
    some = counts.groupBy("c", F.floor(F.col("part") / MERGED_TASKS)).applyInArrow(together, schema)
    got = {r["c"]: r["q"] for r in some.groupBy("c").applyInArrow(
        last, "c int, q array<double>").collect()}
    found = {c: np.unique(np.array(got.get(i, []), float)) for i, c in enumerate(numbers)}
    return [found.get(c, none) for c in features]


def bin_counts(features: Sequence[str], categorical: dict[str, int],
               edges: Sequence[np.ndarray]) -> list[int]:
    return [categorical[c] + 1 if c in categorical else len(e) + 2
            for c, e in zip(features, edges)]


def bin_columns(columns: Sequence[np.ndarray], features: Sequence[str],
                categorical: dict[str, int], edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins (features x rows) of columns of doubles; missing numbers, and missing, negative or
    unknown codes, are bin 0."""
    counts = bin_counts(features, categorical, edges)
    out = np.zeros((len(features), len(columns[0]) if columns else 0),
                   np.uint8 if max(counts, default=0) <= 256 else np.uint16)
    for i, (x, c) in enumerate(zip(columns, features)):
        missing = np.isnan(x)
        if c in categorical:
            missing |= (x < 0) | (x >= categorical[c])
            out[i] = np.where(missing, 0, np.where(missing, 0, x).astype(int) + 1)
        else:
            out[i] = np.where(missing, 0, np.searchsorted(edges[i], x, "left") + 1)
    return out


def doubles(df: DataFrame, features: Sequence[str]) -> list[Column]:
    """Feature columns as doubles, under names that clash with nothing: f0, f1, ..."""
    return [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)]


def batch_columns(b: pa.RecordBatch, n: int, first: int = 0) -> list[np.ndarray]:
    return [b.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)]


# ---- blocks of rows ------------------------------------------------------------------
_BLOCK_COLUMNS = ("n", "wide", "bins", "y", "w", "uid", "roles", "margins")
_BLOCK_SCHEMA = ("n int, wide boolean, bins binary, y binary, w binary, uid binary, roles binary, "
                 "margins binary")


class _Block:
    """One packed block; margins are (models x rows)."""

    def __init__(self, r: dict, models: int):
        n = self.n = r["n"]
        self.bins = np.frombuffer(r["bins"], np.uint16 if r["wide"] else np.uint8).reshape(-1, n)
        self.y = np.frombuffer(r["y"], np.uint8)
        self.w = np.frombuffer(r["w"], float)
        self.uid = np.frombuffer(r["uid"], np.uint64)
        self.roles = np.frombuffer(r["roles"], np.uint8).reshape(-1, n)
        m = np.frombuffer(r["margins"], float)
        self.margins = m.reshape(models, n) if len(m) else np.zeros((models, n))


def _row_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"n": pa.int32(), "wide": pa.bool_()}
    names = list(_BLOCK_COLUMNS)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in names], names)


def _pack(df: DataFrame, features: list[str], categorical: dict[str, int],
          edges: list[np.ndarray], label: str, weight: str | None, id_col: str,
          roles: Sequence[Column], unit_weight: float, rows: int) -> DataFrame:
    nf, nr = len(features), len(roles)
    cols = [*doubles(df, features), F.col(f"`{label}`").cast("double").alias("y"),
            (F.col(f"`{weight}`").cast("double") / unit_weight if weight else F.lit(1.0)).alias("w"),
            F.xxhash64(F.col(f"`{id_col}`")).alias("uid"),
            *[F.coalesce(r.cast("int"), F.lit(0)).alias(f"r{i}") for i, r in enumerate(roles)]]
    used = F.greatest(*[F.col(f"r{i}") for i in range(nr)], F.lit(0)) > 0
    data = df.select(*cols).where(F.col("y").isNotNull() & used)
    data = spread(data, rows, BLOCK_ROWS, TASK_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _regrouped(batches):
            x = bin_columns(batch_columns(b, nf), features, categorical, edges)
            role = np.stack([b.column(nf + 3 + i).to_numpy().astype(np.uint8) for i in range(nr)])
            yield _row_batch([dict(
                n=b.num_rows, wide=x.dtype == np.uint16, bins=x.tobytes(),
                y=(b.column(nf).to_numpy() > 0.5).astype(np.uint8).tobytes(),
                w=b.column(nf + 1).to_numpy(zero_copy_only=False).astype(float).tobytes(),
                uid=b.column(nf + 2).to_numpy().tobytes(), roles=role.tobytes(), margins=b"")])

    return data.mapInArrow(run, _BLOCK_SCHEMA)


def tasks(df: DataFrame, rows: int, block: int, least: int, most: int | None = None) -> int:
    """Partitions of the cached blocks: one a core as far as each gets ``least`` rows, more
    where that would be above ``most`` (PART_ROWS) rows.  Each sends one partial sum a pass, so
    there are no more of these on a larger table until then."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(math.ceil(rows / block), max(cores, math.ceil(rows / (most or PART_ROWS)))),
               min(cores, rows // least))


def spread(df: DataFrame, rows: int, block: int, least: int, most: int | None = None) -> DataFrame:
    """``df`` in that many partitions of about equal size."""
    n = tasks(df, rows, block, least, most)
    return df.repartition(n) if n > 1 else df.coalesce(1)


def _regrouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of BLOCK_ROWS rows, the last one of a partition shorter."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        while b.num_rows:
            part = b.slice(0, BLOCK_ROWS - size)
            held.append(part)
            size += part.num_rows
            b = b.slice(part.num_rows)
            if size == BLOCK_ROWS:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# ---- passes over the blocks ----------------------------------------------------------
@dataclass
class _Request:
    """Histograms wanted by one model: of ``nodes`` of the tree as it stands."""
    model: int
    role: int
    init: float
    weights: tuple[float, float]
    tree: Tree
    slot: np.ndarray  # node -> row of the result, -1 where nothing is wanted
    features: np.ndarray
    bag: int  # rows whose hash is below take part
    salt: int


def _in_bag(uid: np.ndarray, salt: int, bag: int) -> np.ndarray:
    """Whether a row belongs to a round's sample: a mixed hash of id and round below ``bag``."""
    with np.errstate(over="ignore"):
        x = uid + np.uint64(salt)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x ^ (x >> np.uint64(31))) < np.uint64(bag)


def gradients(y: np.ndarray, margin: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point gradient and hessian of the log loss (whole numbers as doubles)."""
    p = sigmoid(margin)
    return np.rint((p - y) * w * UNIT), np.rint(p * (1 - p) * w * UNIT)


def _histogram(blk: _Block, q: _Request, offset: np.ndarray, slots: int) -> np.ndarray:
    """(slots, bins of all features, 3): sums of gradient, hessian and rows."""
    out = np.zeros((slots, int(offset[-1]), 3), np.int64)
    rows = np.flatnonzero(blk.roles[q.role] == 1)
    if q.bag < (1 << 64) - 1:
        rows = rows[_in_bag(blk.uid[rows], q.salt, q.bag)]
    ends = [(q.slot[n], r) for n, r in q.tree.parts(blk.bins, rows, q.slot >= 0)]
    if not any(len(r) for _, r in ends):
        return out
    rows = np.concatenate([r for _, r in ends])
    slot = np.repeat([s for s, _ in ends], [len(r) for _, r in ends])
    y = blk.y[rows]
    w = np.where(y == 1, q.weights[1], q.weights[0]) * blk.w[rows]
    g, h = gradients(y, blk.margins[q.model][rows] + q.init, w)
    _add_sums(out, blk.bins, rows, slot, g, h, q.features, offset)
    return out


def _add_sums(out: np.ndarray, bins: np.ndarray, rows: np.ndarray, slot: np.ndarray, g: np.ndarray,
              h: np.ndarray, features: np.ndarray, offset: np.ndarray) -> None:
    """Add to the histograms ``out`` the gradients and hessians of at most BLOCK_ROWS rows, in
    the order of their slots.  A pass over many rows counts several features by their joint bins,
    one over few rows all features by their places in the histogram."""
    slots, width = len(out), int(offset[-1])
    h = h + COUNT
    some = bins[:, rows] if len(features) == len(bins) else bins[np.ix_(features, rows)]
    if len(rows) < FEW_ROWS:
        key = (some + (offset[features, None] + slot * width)).reshape(-1)
        k = len(features)
        both = [np.bincount(key, np.tile(v, k), slots * width).reshape(slots, width)
                for v in (g, h)]
        _unpack(out, *both)
        return
    sizes = (offset[1:] - offset[:-1])[features]
    for part in _bundles(sizes, max(JOINT_BINS[0], min(JOINT_BINS[1], len(rows) // (8 * slots)))):
        shape = (slots, *sizes[part])
        key = slot.astype(np.int64) if slots > 1 else np.zeros(1, np.int64)
        for i in part:
            key = key * sizes[i] + some[i]
        both = [np.bincount(key, v, math.prod(shape)).reshape(shape) for v in (g, h)]
        if len(part) > 1:  # packed sums stay below 2**53
            both = [np.stack([v]) for v in both]
        for j, i in enumerate(part):
            others = tuple(a for a in range(2, len(part) + 2) if a != j + 2)
            one = [v.sum(axis=others)[0] for v in both] if others else both
            a = int(offset[features[i]])
            _unpack(out[:, a:a + sizes[i]], *one)


def _bundles(sizes: np.ndarray, most: int) -> list[list[int]]:
    """Features in groups with at most ``most`` joint bins (one feature may have more)."""
    out: list[list[int]] = []
    for i in np.argsort(sizes, kind="stable").tolist():
        if out and math.prod(sizes[out[-1]].tolist()) * int(sizes[i]) <= most:
            out[-1].append(i)
        else:
            out.append([i])
    return out


def _unpack(out: np.ndarray, g: np.ndarray, packed: np.ndarray) -> None:
    count = np.floor(packed / COUNT)
    out[..., 0] += g.astype(np.int64)
    out[..., 1] += (packed - count * COUNT).astype(np.int64)
    out[..., 2] += count.astype(np.int64)


def _sum_histograms(blocks: RDD, requests: list[_Request], offset: np.ndarray, models: int,
                    partitions: int) -> dict[tuple[int, int], np.ndarray]:
    """{(model, slot): histogram}, one each at the driver whatever the number of blocks."""
    slots = [int(q.slot.max()) + 1 for q in requests]

    def run(rows: Iterator[dict]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        total: list[np.ndarray | None] = [None] * len(requests)
        for r in rows:
            blk = _Block(r, models)
            for i, q in enumerate(requests):
                h = _histogram(blk, q, offset, slots[i])
                total[i] = h if total[i] is None else total[i] + h
        for q, h in zip(requests, total):
            if h is not None:
                yield from (((q.model, s), x) for s, x in enumerate(h))

    part = blocks.mapPartitions(run)
    if partitions > 16:  # sum up on the executors first
        part = part.reduceByKey(np.add, min(partitions, sum(slots)))
    total: dict[tuple[int, int], np.ndarray] = {}
    for k, h in part.collect():
        total[k] = total[k] + h if k in total else h
    return total


def _with_trees(blocks: RDD, trees: dict[int, Tree], models: int) -> RDD:
    """Blocks with the margins of some models moved by one more tree."""
    def move(r: dict) -> dict:
        blk = _Block(r, models)
        m = blk.margins.copy()
        for k, t in trees.items():
            t.add_to(m[k], blk.bins)
        return r | {"margins": m.tobytes()}

    return blocks.map(move)


def _staged(blocks: Iterator[_Block], jobs: dict[int, tuple[int, float, list[Tree]]]
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(model, round, y, margin) of the validation rows of blocks after each of the given trees."""
    for blk in blocks:
        for k, (role, init, trees) in jobs.items():
            rows = np.flatnonzero(blk.roles[role] == 2)
            m = blk.margins[k][rows] + init
            bins, y = blk.bins[:, rows], blk.y[rows]
            for i, t in enumerate(trees if len(rows) else []):
                t.add_to(m, bins)
                yield k, i, y, m


Counted = tuple[np.ndarray, np.ndarray, np.ndarray]  # ascending margins, rows of class 1 and 0


def _counted(margin: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> Counted:
    v, at = np.unique(margin, return_inverse=True)
    return v, np.bincount(at, pos, len(v)), np.bincount(at, neg, len(v))


def _area(c: Counted) -> tuple[int, int, int]:
    """Rows of class 1 and 0, and twice the pairs in which class 1 is above (ties one half)."""
    _, pos, neg = c
    twice = pos * (2 * np.cumsum(neg) - neg)
    return int(pos.sum()), int(neg.sum()), int(twice.astype(np.int64).sum())


def _auc_of(areas: Sequence[tuple[int, int, int]]) -> float | None:
    """Exact AUC from the areas of ascending slices of the margin."""
    below = ones = twice = 0
    for pos, neg, area in areas:
        twice += area + 2 * pos * below
        below, ones = below + neg, ones + pos
    return twice / (2 * ones * below) if ones and below else None


def _loss(name: str, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if name == "rmse":
        return (sigmoid(margin) - y) ** 2
    # log(1 + exp(-x)) without overflow, x the margin towards the row's class
    x = np.where(y == 1, margin, -margin)
    return np.log1p(np.exp(-np.abs(x))) + np.maximum(-x, 0.0)


def _of_loss(name: str, total: float, rows: int) -> float | None:
    if not rows:
        return None
    return math.sqrt(total / rows) if name == "rmse" else total / rows


def _metric(blocks: RDD, jobs: dict[int, tuple[int, float, list[Tree]]], models: int, name: str,
            rows: int) -> dict[tuple[int, int], float | None]:
    """{(model, round): metric} of the given trees, ``rows`` validation rows a model at most; None
    where there is none (a single class).  For the AUC, tasks count margins and slices of them
    meet, a model, round and slice at a time."""
    if name != "auc":

        def lost(rows: Iterator[dict]) -> Iterator[tuple[tuple[int, int], tuple[float, int]]]:
            total: dict[tuple[int, int], tuple[float, int]] = {}
            for k, i, y, m in _staged((_Block(r, models) for r in rows), jobs):
                t, n = total.get((k, i), (0.0, 0))
                total[k, i] = t + float(_loss(name, y, m).sum()), n + len(y)
            yield from total.items()

        found: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for key, v in blocks.mapPartitions(lost).collect():
            found.setdefault(key, []).append(v)
        return {key: _of_loss(name, math.fsum(t for t, _ in v), sum(n for _, n in v))
                for key, v in found.items()}

    # slices of a unit of the margin, most of which lie between -4 and 4
    step = 0 if rows <= SLICE_ROWS else 2 ** math.ceil(math.log2(rows / SLICE_ROWS / 8 + 1))

    def count(rows: Iterator[dict]) -> Iterator[tuple[tuple[int, int, int], Counted]]:
        for k, i, y, m in _staged((_Block(r, models) for r in rows), jobs):
            c = _counted(m, y, 1 - y)
            cut = np.floor(np.clip(c[0], -16, 16) * step).astype(int)
            at = np.flatnonzero(np.diff(cut, prepend=cut[0] - 1))
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(cut)]):
                yield (k, i, int(cut[a])), tuple(x[a:b] for x in c)

    def meet(pieces) -> tuple[int, int, int]:
        return _area(_counted(*(np.concatenate(v) for v in zip(*pieces))))

    pairs = sum(len(t) for _, _, t in jobs.values()) * rows
    parts = max(blocks.context.defaultParallelism, math.ceil(pairs / PART_ROWS))
    areas: dict[tuple[int, int], list] = {}
    for (k, i, cut), a in sorted(blocks.mapPartitions(count).groupByKey(parts).mapValues(
            meet).collect()):
        areas.setdefault((k, i), []).append(a)
    return {key: _auc_of(a) for key, a in areas.items()}


# ---- splits --------------------------------------------------------------------------
@dataclass(frozen=True)
class Split:
    gain: float
    feature: int
    threshold: int
    missing_left: bool
    members: tuple[int, ...] | None  # bins of the left categories
    left: tuple[int, int, int]  # gradient, hessian, rows
    right: tuple[int, int, int]

    def left_bins(self, width: int) -> np.ndarray:
        """Whether each of ``width`` bins goes left."""
        if self.members is not None:
            out = np.zeros(width, bool)
            out[list(self.members)] = True
            return out
        out = np.arange(width) <= self.threshold
        out[0] &= self.missing_left
        return out


def leaf_score(g, h, cfg: BoostConfig):
    t = np.maximum(np.abs(g) - cfg.l1, 0.0) if cfg.l1 else g
    return t * t / (h + cfg.l2 + 1e-12)


def leaf_value(g: float, h: float, cfg: BoostConfig) -> float:
    t = math.copysign(max(abs(g) - cfg.l1, 0.0), g)
    return -cfg.learning_rate * t / (h + cfg.l2 + 1e-12)


class _Finder:
    """Best split of a node from its histogram, over all features at once."""

    def __init__(self, counts: list[int], is_category: np.ndarray, unit: float):
        self.offset = np.concatenate(([0], np.cumsum(counts))).astype(int)
        self.unit = unit  # of a fixed-point step
        self.width = max(counts)
        at = self.offset[:-1, None] + np.arange(self.width)
        self.at = np.where(np.arange(self.width) < np.array(counts)[:, None], at, self.offset[-1])
        self.counts = np.array(counts)
        self.number = np.flatnonzero(~is_category)
        self.category = np.flatnonzero(is_category)

    def best(self, h: np.ndarray, use: np.ndarray, cfg: BoostConfig) -> list[Split | None]:
        """Best split of each node; ``h`` is (nodes, bins of all features, 3)."""
        sums = np.zeros((3, len(h), h.shape[1] + 1))  # whole numbers below 2**53
        sums[:, :, :-1] = np.moveaxis(h, 2, 0)
        number, category = (np.intersect1d(x, use) for x in (self.number, self.category))
        # missing values have a direction to learn where there are any
        some = sums[2][:, self.at[number, 0]].any(axis=0)
        found = [*self._numbers(sums, number, False, cfg),
                 *self._numbers(sums, number[some], True, cfg),
                 *self._categories(sums, category, cfg)]
        out: list[Split | None] = [None] * len(h)
        for node, s in found:
            t = out[node]
            if t is None or (-s.gain, s.feature, s.threshold) < (-t.gain, t.feature, t.threshold):
                out[node] = s
        return out

    def _of(self, sums: np.ndarray, use: np.ndarray) -> np.ndarray:
        """(3, nodes, features, bins) of some features, those of fewer bins filled up with zeros."""
        return np.take(sums, self.at[use, :self.counts[use].max()], axis=2)

    def _cuts(self, low: np.ndarray, total: np.ndarray, cfg: BoostConfig
              ) -> tuple[np.ndarray, np.ndarray]:
        """(gain, position) of the best cut of each node, -inf where none is allowed.  ``low``:
        sums left of each cut, (3, nodes, features, cuts); total: (3, nodes)."""
        u = self.unit
        g, h, c = low
        whole = total[:, :, None, None]
        rg, rh, rc = whole - low
        ok = np.minimum(c, rc) >= max(1, cfg.min_rows)
        ok &= np.minimum(h, rh) * u >= cfg.min_hessian
        gain = leaf_score(g * u, h * u, cfg) + leaf_score(rg * u, rh * u, cfg)
        gain -= leaf_score(whole[0] * u, whole[1] * u, cfg)
        ok &= gain > max(cfg.min_gain, 1e-9)
        gain = np.where(ok, gain, -np.inf).reshape(total.shape[1], -1)
        at = gain.argmax(1)
        return gain[np.arange(len(gain)), at], at

    def _numbers(self, sums: np.ndarray, use: np.ndarray, missing_left: bool, cfg: BoostConfig
                 ) -> Iterator[tuple[int, Split]]:
        if not len(use):
            return
        x = self._of(sums, use)
        total = x[:, :, 0].sum(-1)
        low = np.cumsum(x[..., 1:], axis=-1)
        if missing_left:
            low += x[..., :1]
        gain, at = self._cuts(low, total, cfg)
        for n in np.flatnonzero(gain > -np.inf).tolist():
            i, b = divmod(int(at[n]), low.shape[3])
            left, right = _sides(low[:, n, i, b], total[:, n])
            # without missing values here, later ones go with the larger part
            go = missing_left if x[2, n, i, 0] else left[2] >= right[2]
            yield n, Split(float(gain[n]), int(use[i]), b + 1, go, None, left, right)

    def _categories(self, sums: np.ndarray, use: np.ndarray, cfg: BoostConfig
                    ) -> Iterator[tuple[int, Split]]:
        if not len(use):
            return
        x = self._of(sums, use)
        total = x[:, :, 0].sum(-1)
        rate = x[0] * self.unit / (x[1] * self.unit + CATEGORY_SMOOTHING)
        order = np.argsort(np.where(x[2] > 0, rate, np.inf), axis=2, kind="stable")
        low = np.cumsum(np.take_along_axis(x, order[None], 3), axis=-1)
        gain, at = self._cuts(low, total, cfg)
        for n in np.flatnonzero(gain > -np.inf).tolist():
            i, b = divmod(int(at[n]), low.shape[3])
            left, right = _sides(low[:, n, i, b], total[:, n])
            yield n, Split(float(gain[n]), int(use[i]), -1, False,
                           tuple(sorted(order[n, i, :b + 1].tolist())), left, right)


def _sides(low: np.ndarray, total: np.ndarray) -> tuple[tuple, tuple]:
    return tuple(map(int, low)), tuple(map(int, total - low))


# ---- growing -------------------------------------------------------------------------
class _Growing:
    """One tree while it grows.  ``path`` numbers nodes from the root (1; children 2p, 2p+1);
    equal gains are split in the order of paths."""

    def __init__(self, cfg: BoostConfig, finder: _Finder, use: np.ndarray):
        self.cfg, self.finder, self.use = cfg, finder, use
        self.path, self.sums, self.children = [1], [(0, 0, 0)], [None]
        self.split: list[Split | None] = [None]
        self.hist: dict[int, np.ndarray] = {}
        self.ready = [False]  # whether the node's best split is known
        self.wanted: dict[int, tuple[int, int]] = {0: (-1, -1)}  # node -> parent, sibling
        self.order: list[int] = []  # nodes split for good
        self.heap: list[tuple[float, int, int]] = []

    def _can_split(self, node: int) -> bool:
        deep = self.cfg.max_depth and self.path[node].bit_length() > self.cfg.max_depth
        return not deep and self.sums[node][2] >= 2 * max(1, self.cfg.min_rows)

    def _know(self, found: list[tuple[int, np.ndarray | None]]) -> None:
        """Best splits of nodes from their histograms."""
        able = [(n, h) for n, h in found if h is not None and self._can_split(n)]
        for n, _ in found:
            self.ready[n] = True
        if able:
            best = self.finder.best(np.stack([h for _, h in able]), self.use, self.cfg)
            for (n, h), s in zip(able, best):
                self.split[n] = s
                if s is not None:
                    self.hist[n] = h

    def receive(self, got: dict[int, np.ndarray]) -> None:
        """Histograms of all wanted nodes."""
        found = []
        for node, h in got.items():
            parent, sibling = self.wanted.pop(node)
            if parent < 0:
                f = int(self.use[0])
                a, b = self.finder.offset[f], self.finder.offset[f + 1]
                self.sums[0] = tuple(h[a:b].sum(0).tolist())
                found.append((0, h))
            else:
                found += [(node, h), (sibling, self.hist.pop(parent) - h)]
        self._know(found)
        if got.keys() == {0}:
            self._offer(0)

    def _offer(self, node: int) -> None:
        if self.split[node] is not None:
            heapq.heappush(self.heap, (-self.split[node].gain, self.path[node], node))

    def _expand(self, node: int) -> None:
        """Make the children of a node; ask for the smaller one's histogram if either may split."""
        s = self.split[node]
        pair = []
        for side, sums in enumerate((s.left, s.right)):
            pair.append(len(self.path))
            self.path.append(2 * self.path[node] + side)
            self.sums.append(sums)
            self.children.append(None)
            self.split.append(None)
            self.ready.append(False)
        self.children[node] = tuple(pair)
        if any(map(self._can_split, pair)):
            small, large = sorted(pair, key=lambda n: (self.sums[n][2], n))
            self.wanted[small] = (node, large)
        else:
            self._know([(n, None) for n in pair])
            del self.hist[node]

    def advance(self) -> bool:
        """Split leaves in order of gain as far as histograms are known; ask for what may be
        needed next.  True when the tree is done."""
        limit = self.cfg.leaves or 1 << 60
        while True:
            while self.heap and len(self.order) + 1 < limit:
                node = self.heap[0][2]
                pair = self.children[node]
                if pair is None or not all(self.ready[n] for n in pair):
                    break
                heapq.heappop(self.heap)
                self.order.append(node)
                for n in pair:
                    self._offer(n)
            if not self.heap or len(self.order) + 1 >= limit:
                return True
            room = limit - 1 - len(self.order)
            open_ = sorted((-s.gain, self.path[n], n) for n, s in enumerate(self.split)
                           if s is not None and self.children[n] is None)
            chosen = [n for _, _, n in open_[:room]]
            if self.children[self.heap[0][2]] is None and self.heap[0][2] not in chosen:
                chosen.append(self.heap[0][2])
            for n in chosen:
                self._expand(n)
            if self.wanted:
                return False

    def arrays(self, final: bool) -> Tree:
        """The tree with all nodes made so far or, in the end, those split for good."""
        inner = set(self.order) if final else {n for n, c in enumerate(self.children) if c}
        keep = [0]
        for n in keep:  # grows while it is read
            if n in inner:
                keep += self.children[n]
        at = {n: i for i, n in enumerate(keep)}
        s = [self.split[n] if n in inner else None for n in keep]
        sets = [x.members for x in s if x is not None and x.members is not None]
        width = self.finder.width
        table = np.zeros((len(sets), width), bool)
        for i, m in enumerate(sets):
            table[i, list(m)] = True
        number = iter(range(len(sets)))
        u = self.finder.unit

        def column(fn, empty, kind):
            return np.array([empty if x is None else fn(x) for x in s], kind)

        return Tree(
            column(lambda x: x.feature, -1, np.int32), column(lambda x: x.threshold, -1, np.int32),
            column(lambda x: x.missing_left, False, bool),
            column(lambda x: -1 if x.members is None else next(number), -1, np.int32),
            np.array([at[self.children[n][0]] if n in inner else -1 for n in keep], np.int32),
            np.array([at[self.children[n][1]] if n in inner else -1 for n in keep], np.int32),
            np.array([leaf_value(self.sums[n][0] * u, self.sums[n][1] * u, self.cfg)
                      for n in keep]),
            np.array([self.sums[n][2] for n in keep], np.int64),
            column(lambda x: x.gain, 0.0, float), table)


class _Model:
    """One job of a fit on the driver: its trees, its metric's history, its tree in the making."""

    def __init__(self, job: Job, number: int, init: float, weights: tuple[float, float],
                 validates: bool):
        self.job, self.cfg, self.number = job, job.config, number
        self.init, self.weights, self.validates = init, weights, validates
        self.trees: list[Tree] = []
        self.history: list[float] = []
        self.no_metric = False
        self.growing: _Growing | None = None
        self.done = False

    def best_round(self) -> int:
        """Rounds kept: all of them without a metric, else the first best one."""
        if not self.history:
            return len(self.trees)
        pick = max if MAXIMISE[self.cfg.metric] else min
        return self.history.index(pick(self.history)) + 1

    def take(self, values: list[float | None]) -> None:
        """Metric of further rounds; ends at the first round that exhausts the patience."""
        for v in values:
            if v is None:
                self.no_metric, self.history = True, []
                return
            self.history.append(v)
            if len(self.history) - self.best_round() >= self.cfg.patience:
                self.done = True
                return

    def start(self, finder: _Finder, features: int) -> None:
        take = max(1, math.ceil(self.cfg.column_fraction * features - 1e-9))
        rng = np.random.default_rng([self.cfg.seed, len(self.trees)])
        use = np.arange(features)
        if take < features:
            use = np.sort(rng.choice(features, take, replace=False))
        self.growing = _Growing(self.cfg, finder, use)

    def request(self) -> tuple[_Request, list[int]]:
        tree = self.growing.arrays(final=False)
        # nodes are renumbered breadth first by arrays(); find the wanted ones there by path
        order = [0]
        for n in order:
            if self.growing.children[n]:
                order += self.growing.children[n]
        slot = np.full(len(order), -1, np.int64)
        wanted = list(self.growing.wanted)
        where = {n: i for i, n in enumerate(order)}
        for i, n in enumerate(wanted):
            slot[where[n]] = i
        return _Request(self.number, self.job.role, self.init, self.weights, tree, slot,
                        self.growing.use, *self.sample()), wanted

    def sample(self) -> tuple[int, int]:
        """(bag, salt) of the next round: rows whose hash with the salt is below take part."""
        full = (1 << 64) - 1
        bag = full if self.cfg.row_fraction >= 1 else int(self.cfg.row_fraction * full)
        salt = (self.cfg.seed * 0x9E3779B97F4A7C15 + len(self.trees) * 0xD1B54A32D192ED03) & full
        return bag, salt

    def end_round(self) -> Tree | None:
        """The tree grown, kept as the model's next; None, and the end, if nothing was split."""
        tree = self.growing.arrays(final=True)
        self.growing = None
        if len(tree.feature) == 1:
            self.done = True
            return None
        self.trees.append(tree)
        return tree

    def open(self) -> bool:
        return not self.done and len(self.trees) < self.cfg.rounds

    def watching(self) -> bool:
        return bool(self.cfg.patience) and self.validates and not self.no_metric


def fit_many(df: DataFrame, features: Sequence[str], jobs: Sequence[Job], roles: Sequence[Column],
             label: str = "y", weight: str | None = None, id_col: str = "id",
             categorical: dict[str, int] | None = None, max_bins: int = 64,
             edges: list[np.ndarray] | None = None) -> list[BoostedModel]:
    """One model per job, grown together.  ``roles``: integer columns, 1 where a row is trained
    on, 2 where it validates, else 0 or null.

    Missing values are bins of their own and learn their direction; category codes outside 0 to
    n-1 count as missing.  Rows without label are left out; weights must not be negative.  A
    model without training rows of both classes has no trees; a model whose metric does not exist
    (validation rows of one class, or none) is not stopped early."""
    features, categorical = list(features), dict(categorical or {})
    if not features or not jobs:
        raise ValueError("features and jobs must not be empty")
    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    y = F.col(f"`{label}`").cast("double")
    parts = []
    for i, r in enumerate(roles):
        for c in (0, 1):
            mine = (r == 1) & ((y > 0.5) == F.lit(bool(c)))
            parts.append(F.sum(F.when(mine, w)).alias(f"w{i}_{c}"))
        parts.append(F.count_if((r == 2) & y.isNotNull()).alias(f"v{i}"))
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.max(w).alias("top"), F.min(w).alias("low"),
                   *parts).first()
    if (stats["low"] or 0.0) < 0:
        raise ValueError("weights must not be negative")
    if edges is None:
        edges = bin_edges(df, features, categorical, max_bins)

    models: list[_Model] = []
    top = stats["top"] or 1.0
    scale: list[float] = []
    for k, job in enumerate(jobs):
        w0, w1 = (stats[f"w{job.role}_{c}"] or 0.0 for c in (0, 1))
        cw = ((w0 + w1) / (2 * w0), (w0 + w1) / (2 * w1)) if job.balanced and w0 and w1 else (1.0,
                                                                                             1.0)
        # one unit for all rows of a model: no weighted gradient is above UNIT steps
        biggest = max(cw)
        scale.append(biggest * top)
        init = math.log(w1 * cw[1] / (w0 * cw[0])) if w0 and w1 else 0.0
        m = _Model(job, k, init, (cw[0] / biggest, cw[1] / biggest), stats[f"v{job.role}"] > 0)
        m.done = not (w0 and w1)
        models.append(m)
    counts = bin_counts(features, categorical, edges)
    kinds = np.array([c in categorical for c in features])
    finders = [_Finder(counts, kinds, s / UNIT) for s in scale]
    offset = finders[0].offset
    packed = _pack(df, features, categorical, edges, label, weight, id_col, roles, top, stats["n"])
    if stats["n"] * len(features) * (2 if max(counts) > 256 else 1) <= ALONE_BYTES:
        models = _grown_alone(packed, models, finders)
        return [BoostedModel(features, categorical, edges, m.init, m.trees[:m.best_round()],
                             m.history) for m in models]
    blocks = _written(packed.rdd.map(lambda r: r.asDict()))
    partitions = tasks(df, stats["n"], BLOCK_ROWS, TASK_ROWS)
    base, held, since = blocks, [blocks], 0
    n, most = len(models), max(stats[f"v{i}"] for i in range(len(roles)))
    watched = [m for m in models if m.cfg.patience and m.validates]
    every = max(10, min((m.cfg.patience for m in watched), default=20) // 2)
    try:
        while live := [m for m in models if m.open()]:
            for m in live:
                m.start(finders[m.number], len(features))
            growing = list(live)
            while growing:
                asked = [m.request() for m in growing]
                got = _sum_histograms(blocks, [q for q, _ in asked], offset, n, partitions)
                zero = np.zeros((int(offset[-1]), 3), np.int64)
                for m, (q, nodes) in zip(growing, asked):
                    m.growing.receive({node: got.get((m.number, i), zero)
                                       for i, node in enumerate(nodes)})
                growing = [m for m in growing if not m.growing.advance()]
            new = {}
            for m in live:
                tree = m.end_round()
                if tree is not None:
                    new[m.number] = tree
            since += 1
            more = any(m.open() for m in models)
            if new and more:
                blocks = _with_trees(blocks, new, n).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(blocks)
            if since >= every or not more:
                _evaluate(base, models, most)
                if any(m.open() for m in models):
                    # cut the lineage: the blocks with their margins, written and read back
                    blocks = _written(blocks)
                    for b in held:
                        if b is not blocks:
                            b.unpersist()
                    base, held, since = blocks, [blocks], 0
            while len(held) > 3:  # the base stays, and what the last blocks are made from
                held.pop(1).unpersist()
    finally:
        for b in held:
            b.unpersist()
    return [BoostedModel(features, categorical, edges, m.init, m.trees[:m.best_round()], m.history)
            for m in models]


def _written(blocks: RDD) -> RDD:
    """Blocks kept on the executors, and written to the shared checkpoint folder to cut their
    lineage."""
    checkpoint_dir(SparkSession.builder.getOrCreate())
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    blocks.checkpoint()
    blocks.count()
    return blocks


def _evaluate(base: RDD, models: list[_Model], rows: int) -> None:
    """Exact metric of the rounds since ``base`` for the models that watch one."""
    todo = [m for m in models if m.watching() and len(m.history) < len(m.trees)
            and not _ended(m)]
    for name in sorted({m.cfg.metric for m in todo}):
        mine = [m for m in todo if m.cfg.metric == name]
        late = {m.number: (m.job.role, m.init, m.trees[len(m.history):]) for m in mine}
        got = _metric(base, late, len(models), name, rows)
        for m in mine:
            m.take([got.get((m.number, i)) for i in range(len(late[m.number][2]))])


def _ended(m: _Model) -> bool:
    return bool(m.history) and len(m.history) - m.best_round() >= m.cfg.patience


# ---- models that grow in a task each -------------------------------------------------
def _grown_alone(packed: DataFrame, models: list[_Model], finders: list[_Finder]) -> list[_Model]:
    """The models, each grown by a task of its own that gets all blocks."""
    todo = [m for m in models if m.open()]
    if not todo:
        return models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[_Block] = []
        k = -1
        for r in (r for b in batches for r in b.to_pylist()):
            k = r["k"]
            blocks.append(_Block(r, 0))
        if k >= 0:
            m = todo[k]
            _grow_alone(m, finders[m.number], blocks)
            yield pa.RecordBatch.from_arrays(
                [pa.array([pickle.dumps(m)], pa.binary())], ["model"])

    spark = packed.sparkSession
    number = spark.range(0, len(todo), 1, len(todo)).select(F.col("id").cast("int").alias("k"))
    pairs = number.crossJoin(F.broadcast(materialize(packed)))
    grown = materialize(pairs.mapInArrow(run, "model binary"))  # all at once; read one by one
    done = {m.number: m for m in (pickle.loads(r["model"]) for r in grown.toLocalIterator())}
    return [done.get(m.number, m) for m in models]


def _grow_alone(m: _Model, finder: _Finder, blocks: list[_Block]) -> None:
    """All rounds of a model whose rows are all in ``blocks``."""
    role = np.concatenate([b.roles[m.job.role] for b in blocks])
    bins = np.concatenate([b.bins for b in blocks], axis=1)
    y, w, uid = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "w", "uid"))
    trains, checks = np.flatnonzero(role == 1), np.flatnonzero(role == 2)
    x, later, y_later = bins[:, trains], bins[:, checks], y[checks]
    y, uid = y[trains], uid[trains]
    w = np.where(y == 1, m.weights[1], m.weights[0]) * w[trains]
    margin, margin_later = np.zeros(len(trains)), np.zeros(len(checks))
    full = (1 << 64) - 1
    while m.open():
        g, h = gradients(y, margin + m.init, w)
        bag, salt = m.sample()
        rows = np.arange(len(trains))
        m.start(finder, len(x))
        _grow_tree(m.growing, x, rows if bag == full else rows[_in_bag(uid, salt, bag)], g, h)
        tree = m.end_round()
        if tree is not None:
            tree.add_to(margin, x)
            if m.watching():
                tree.add_to(margin_later, later)
                m.take([_whole_metric(m.cfg.metric, y_later, margin_later + m.init)])


def _whole_metric(name: str, y: np.ndarray, margin: np.ndarray) -> float | None:
    if name == "auc":
        return _auc_of([_area(_counted(margin, y, 1 - y))])
    return _of_loss(name, float(_loss(name, y, margin).sum()), len(y))


def _grow_tree(growing: _Growing, x: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray
               ) -> None:
    """Grow one tree from columns ``rows`` of ``x``."""
    offset = growing.finder.offset
    width = growing.finder.width
    rows_of = {0: rows}
    while True:
        wanted = list(growing.wanted.items())
        for _, (parent, _) in wanted:
            if parent >= 0:
                r, s = rows_of.pop(parent), growing.split[parent]
                left = s.left_bins(width)[x[s.feature][r]]
                a, b = growing.children[parent]
                rows_of[a], rows_of[b] = r[left], r[~left]
        out = np.zeros((len(wanted), int(offset[-1]), 3), np.int64)
        mine = [rows_of[n] for n, _ in wanted]
        all_rows = np.concatenate(mine)
        slot = np.repeat(np.arange(len(mine)), [len(r) for r in mine])
        for lo in range(0, len(all_rows), BLOCK_ROWS):
            r, sl = all_rows[lo:lo + BLOCK_ROWS], slot[lo:lo + BLOCK_ROWS]
            first, last = int(sl[0]), int(sl[-1]) + 1
            _add_sums(out[first:last], x, r, sl - first, g[r], h[r], growing.use, offset)
        growing.receive({n: out[i] for i, (n, _) in enumerate(wanted)})
        if growing.advance():
            return


def score_all(models: Sequence[BoostedModel], df: DataFrame, keep: Sequence[str],
              out: str = "p") -> DataFrame:
    """``keep`` and an array of the models' probabilities, in one scan.  The models share
    features and bins, as those of one :func:`fit_many` do."""
    first = models[0]
    nf, nk = len(first.features), len(keep)
    data = df.select(*[F.col(f"`{c}`") for c in keep], *doubles(df, first.features))
    models = list(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = first.bins(batch_columns(b, nf, nk))
            p = np.stack([sigmoid(m.margin(x)) for m in models], axis=1)
            flat = pa.array(p.reshape(-1))
            ends = pa.array(np.arange(0, p.size + 1, len(models), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(nk)), pa.ListArray.from_arrays(ends, flat)],
                [*keep, out])

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return data.mapInArrow(run, ", ".join([*kinds, f"`{out}` array<double>"]))


def score_own(models: Sequence[BoostedModel], df: DataFrame, keep: Sequence[str],
              which: Sequence[Column], out: str = "p") -> DataFrame:
    """``keep`` and an array with the probability by each model that ``which`` (indexes) names
    for the row, null where there is none; one scan."""
    first = models[0]
    nf, nk, nw = len(first.features), len(keep), len(which)
    data = df.select(*[F.col(f"`{c}`") for c in keep], *doubles(df, first.features),
                     *[F.coalesce(w.cast("int"), F.lit(-1)).alias(f"which{i}")
                       for i, w in enumerate(which)])
    models = list(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = first.bins(batch_columns(b, nf, nk))
            p = np.full((b.num_rows, nw), np.nan)
            for i in range(nw):
                own = b.column(nk + nf + i).to_numpy()
                for k in np.unique(own[(own >= 0) & (own < len(models))]).tolist():
                    at = np.flatnonzero(own == k)
                    p[at, i] = sigmoid(models[k].margin(x[:, at]))
            flat = p.reshape(-1)
            ends = pa.array(np.arange(0, p.size + 1, nw, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(nk)),
                 pa.ListArray.from_arrays(ends, pa.array(flat, mask=np.isnan(flat)))], [*keep, out])

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return data.mapInArrow(run, ", ".join([*kinds, f"`{out}` array<double>"]))
