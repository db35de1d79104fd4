"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  Each positive opens a window of scores,
``low`` to ``high`` percent of its own score, from which the best rows of other labels are its
negatives.  The windows of one anchor overlap, but their upper limits cut the scores into
disjoint slots: slot i lies above the upper limit of window i+1 and up to that of window i.  Tasks keep
the best k rows of each slot, and the best rows below the upper limit of window i are a merge
of slots i, i+1, ...: one pass from the last slot to the first answers all windows; the lower
limit only cuts the end of each answer.

Anchors and rows meet in a grid of (anchor block, row group).  Both are bounded in bytes, whatever
the data: a task holds one block of anchors with their slots and streams its row group past it in
order of id.  Vectors travel as packed integers.  Scores are integer inner products, exact in
double precision while they stay below 2**53 and by Python integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.session import materialize, shuffle_partitions

BLOCK_BYTES = 1 << 26  # anchors of a block, as doubles
GROUP_ROWS = 1 << 17  # rows of a row group at most, on average
MIN_GROUP = 2048  # rows of a row group at least, where there are enough of them
SUB = 4096  # anchors multiplied at once
STEP = 1024  # rows multiplied at once
LIMIT = 1 << 62  # components and scores beyond count as this


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles as 64-bit integers, within +-LIMIT."""
    y = np.floor(scale * x)
    return np.where(y >= LIMIT, LIMIT, np.where(y <= -LIMIT, -LIMIT, y)).astype(np.int64)


def _packed(rows: DataFrame, scale: int) -> DataFrame:
    """(key, id, label, anchor, dim, q): q holds the components as 16, 32 or 64 bit integers,
    the narrowest that fits the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b["v"].flatten().to_numpy(zero_copy_only=False)
            dim = b["dim"].to_numpy()
            q = quantise(flat, scale)
            ends = np.cumsum(dim)
            out = []
            for e, d in zip(ends.tolist(), dim.tolist()):
                r = q[e - d:e]
                top = max(int(r.max()), -int(r.min())) if d else 0
                out.append(r.astype(np.int16 if top < 1 << 15 else
                                    np.int32 if top < 1 << 31 else np.int64).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b["key"], b["id"], b["label"], b["anchor"], b["dim"], pa.array(out, pa.binary())],
                ["key", "id", "label", "anchor", "dim", "q"])

    return rows.mapInArrow(run, "key long, id long, label string, anchor boolean, dim int, "
                                "q binary")


def _unpack(column: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim), np.int64)
    if dim:
        for i, b in enumerate(column.to_pylist()):
            out[i] = np.frombuffer(b, {2: np.int16, 4: np.int32, 8: np.int64}[len(b) // dim])
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b (64-bit integers), within +-LIMIT."""
    top = [max(int(x.max()), -int(x.min())) if x.size else 0 for x in (a, b)]
    if top[0] * top[1] * a.shape[1] < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    s = a.astype(object) @ b.astype(object).T
    return np.maximum(np.minimum(s, LIMIT), -LIMIT).astype(np.int64)


class Best:
    """The best ``keep`` rows of every (anchor, slot): highest scores, ties by smallest id.
    Rows have to come in ascending order of id."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, keep: int):
        self.lo, self.hi, self.keep = lo, hi, keep
        shape = (*lo.shape, keep)
        self.score = np.full(shape, -LIMIT - 1, np.int64)
        self.id = np.zeros(shape, np.int64)
        self.n = np.zeros(lo.shape, np.int64)

    def add(self, rows: slice, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Offer rows ``ids`` to the anchors ``rows`` (score and allowed: anchors x rows)."""
        for s in range(self.lo.shape[1]):
            least = np.maximum(self.lo[rows, s], self.score[rows, s, -1] + 1)
            hit = (score >= least[:, None]) & (score <= self.hi[rows, s][:, None]) & allowed
            a, r = np.nonzero(hit)
            if not len(a):
                continue
            a_all, v_all, i_all = a, score[a, r], ids[r]
            touched = np.unique(a)
            at = rows.start + touched
            held = np.arange(self.keep) < self.n[at, s][:, None]
            a_all = np.concatenate((np.repeat(touched, held.sum(1)), a_all))
            v_all = np.concatenate((self.score[at, s][held], v_all))
            i_all = np.concatenate((self.id[at, s][held], i_all))
            order = np.lexsort((i_all, -v_all, a_all))
            a_all, v_all, i_all = a_all[order], v_all[order], i_all[order]
            first = np.searchsorted(a_all, a_all)
            rank = np.arange(len(a_all)) - first
            ok = rank < self.keep
            a_all, v_all, i_all, rank = a_all[ok], v_all[ok], i_all[ok], rank[ok]
            self.score[rows.start + a_all, s, rank] = v_all
            self.id[rows.start + a_all, s, rank] = i_all
            self.n[at, s] = np.bincount(a_all, minlength=touched[-1] + 1)[touched]


class _Block:
    """One cell of the grid: a block of anchors, then its row group as a stream."""

    def __init__(self, dim: int, keep: int, same: bool):
        self.dim, self.keep, self.same = dim, keep, same
        self.anchors: list[pa.RecordBatch] = []
        self.best: Best | None = None
        self.step = 64  # grows to STEP: the first rows fill the slots

    def _close(self) -> None:
        t = pa.Table.from_batches(self.anchors).combine_chunks().to_batches()[0]
        self.anchors = []
        self.key, self.id = t["key"].to_numpy(), t["id"].to_numpy()
        self.label = t["label"].to_numpy(zero_copy_only=False)
        self.q = _unpack(t["q"], self.dim)
        lo, hi = (np.array(t[c].to_pylist(), np.int64).reshape(t.num_rows, -1)
                  for c in ("lo", "hi"))
        self.best = Best(lo, hi, self.keep)

    def add(self, b: pa.RecordBatch) -> None:
        kind = b["kind"].to_numpy()
        cut = int(np.searchsorted(kind, 1))
        if cut:
            self.anchors.append(b.slice(0, cut))
        if cut == b.num_rows or (self.best is None and not self.anchors):
            return
        if self.best is None:
            self._close()
        b = b.slice(cut)
        ids, q = b["id"].to_numpy(), _unpack(b["q"], self.dim)
        codes, label = np.unique(np.concatenate(
            (self.label, b["label"].to_numpy(zero_copy_only=False))), return_inverse=True)
        mine, other = label[:len(self.label)], label[len(self.label):]
        k = 0
        while k < len(ids):
            part = slice(k, min(k + self.step, len(ids)))
            for s in range(0, len(self.id), SUB):
                rows = slice(s, min(s + SUB, len(self.id)))
                allowed = (mine[rows, None] == other[None, part]) == self.same
                allowed &= self.id[rows, None] != ids[None, part]
                self.best.add(rows, products(self.q[rows], q[part]), ids[part], allowed)
            k = part.stop
            self.step = min(STEP, 2 * self.step)

    def result(self) -> pa.RecordBatch | None:
        if self.best is None:
            return None
        held = np.arange(self.keep) < self.best.n[..., None]
        a, s, _ = np.nonzero(held)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.key[a]), pa.array(s.astype(np.int32)),
             pa.array(-self.best.score[held]), pa.array(self.best.id[held])],
            ["key", "slot", "worse", "id"])


def _grid(rows: DataFrame, anchors: DataFrame, within: list[str], keep: int,
          same: bool) -> DataFrame:
    """(key, slot, worse, id): the best ``keep`` rows of every slot of every anchor, found by each
    row group; ``worse`` is the negated score.  ``anchors``: rows with the limits lo and hi
    of their slots.  Only rows that agree in ``within`` meet."""
    spark = rows.sparkSession
    per_block = F.greatest(F.lit(1024), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim") + 8)))
    wide = F.least(F.lit(shuffle_partitions(spark)), F.ceil(F.col("n") / MIN_GROUP))
    sizes = (anchors.groupBy(*within).agg(F.count(F.lit(1)).alias("anchors"))
             .join(rows.groupBy(*within).agg(F.count(F.lit(1)).alias("n")), within)
             .withColumn("na", F.ceil(F.col("anchors") / per_block))
             .withColumn("nr", F.greatest(F.ceil(F.col("n") / GROUP_ROWS),
                                          F.ceil(wide / F.col("na"))))
             .select(*within, "na", "nr"))
    side = F.xxhash64("key")
    every = {c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
             for c, n in (("a", "na"), ("g", "nr"))}
    none = F.lit(None).cast("array<long>")
    cols = ["dim", "label", "id", "key", "q"]
    left = (anchors.join(sizes, within)
            .select(*cols, "lo", "hi", F.pmod(side, "na").alias("a"), every["g"].alias("g"))
            .withColumn("kind", F.lit(0)))
    right = (rows.join(sizes, within)
             .select(*cols, none.alias("lo"), none.alias("hi"), F.pmod(side, "nr").alias("g"),
                     every["a"].alias("a")).withColumn("kind", F.lit(1)))
    keys = [*within, "a", "g"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                c = b[k].to_numpy(zero_copy_only=False)
                new[1:] |= c[1:] != c[:-1]
            cut = [0, *np.flatnonzero(new).tolist(), b.num_rows]
            for s, e in zip(cut, cut[1:]):
                key = [b[k][s].as_py() for k in keys]
                if key != now:
                    if block and (out := block.result()):
                        yield out
                    now, block = key, _Block(b["dim"][s].as_py(), keep, same)
                block.add(b.slice(s, e - s))
        if block and (out := block.result()):
            yield out

    cells = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "kind", "id")
    return cells.mapInArrow(run, "key long, slot int, worse long, id long")


def _top(column: Column, k: int) -> Column:
    return F.slice(F.array_sort(column), 1, k)


def _in_slot(i: int):
    return lambda x: x["slot"] == i


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id",
                   vec_col: str = "embedding", label: Column | str = "label",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Scores are inner products of floor(``scale`` * x); higher come first, ties by smaller id.  For each
    row with ``is_anchor`` and each of its best ``positives`` other rows of equal label: the
    best ``negatives`` rows of another label with low/100 * positive_score <= score <=
    high/100 * positive_score, all of them if fewer; a positive without any gives no row.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part.  Vectors of different dimension do not meet.  Rows that repeat an id are rows of their
    own but no positives or negatives of each other; a repeated anchor is answered once for each
    row.  Labels are compared as text.  Components and scores beyond +-2**62 count as that.
    Other columns are not read, and an empty table gives no row."""
    v = F.col("v")
    label = F.col(label) if isinstance(label, str) else label
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"),
                           label.cast("string").alias("label"),
                           F.col(vec_col).cast("array<double>").alias("v"),
                           F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite)
            .select(F.monotonically_increasing_id().alias("key"), "*",
                    F.size("v").alias("dim")))
    rows = materialize(_packed(rows, scale))
    anchors = rows.filter("anchor")
    whole = [F.array(F.lit(x).cast("long")).alias(c) for c, x in (("lo", -LIMIT), ("hi", LIMIT))]
    near = _grid(rows, anchors.select("*", *whole), ["label", "dim"], positives, True)
    near = (near.groupBy("key")
            .agg(F.collect_list(F.struct("worse", "id")).alias("c"))
            .select("key", _top(F.col("c"), positives).alias("pos")))

    # window i: limits[i].l <= score <= limits[i].u; slot i: above u of window i+1
    limits = F.transform("pos", lambda p: F.struct(
        _whole(F.ceil, -p["worse"], low).alias("l"), _whole(F.floor, -p["worse"], high).alias("u")))
    found = near.select("*", limits.alias("w"))
    least = F.expr("transform(sequence(1, size(w)), i -> array_min(transform(slice(w, 1, i), "
                   "x -> x.l)))")
    above = F.expr("transform(sequence(1, size(w)), i -> if(i < size(w), w[i].u + 1, "
                   f"{-LIMIT}L))")
    pad = F.expr(f"array_repeat({LIMIT}L, {positives} - size(w))")  # slots of missing positives
    none = F.expr(f"array_repeat({-LIMIT}L, {positives} - size(w))")
    found = materialize(found.select(
        "key", "pos", "w",
        F.concat(F.zip_with(least, above, lambda x, y: F.greatest(x, y)), pad).alias("lo"),
        F.concat(F.transform("w", lambda x: x["u"]), none).alias("hi")))
    best = _grid(rows, anchors.join(found.select("key", "lo", "hi"), "key"), ["dim"],
                 negatives, False)
    best = best.groupBy("key").agg(F.collect_list(F.struct("slot", "worse", "id")).alias("c"))
    answer = found.join(best, "key").select("key", "pos", "w", "c")
    suffix = F.array().cast("array<struct<worse:bigint,id:bigint>>")
    for i in reversed(range(positives)):
        own = F.transform(F.filter("c", _in_slot(i)), lambda x: F.struct(
            x["worse"].alias("worse"), x["id"].alias("id")))
        answer = answer.withColumn(f"s{i}", _top(F.concat(own, suffix), negatives))
        suffix = F.col(f"s{i}")
    answer = (answer.select("key", "w", F.array(*[f"s{i}" for i in range(positives)]).alias("s"),
                            F.posexplode("pos").alias("i", "p"))
              .select("key", "p", F.posexplode(F.filter(
                  F.element_at("s", F.col("i") + 1),
                  lambda x: -x["worse"] >= F.element_at("w", F.col("i") + 1)["l"]))
                  .alias("r", "n")))
    return answer.join(anchors.select("key", F.col("id").alias("anchor_id")), "key").select(
        "anchor_id", F.col("p.id").alias("positive_id"),
        (F.col("r") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        (-F.col("p.worse")).alias("positive_score"), (-F.col("n.worse")).alias("negative_score"))


def _whole(rounding, score: Column, percent: int) -> Column:
    """score * percent / 100, rounded up or down, without overflow."""
    exact = score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)")
    return rounding(exact / F.lit(100).cast("decimal(3,0)")).cast("long")
