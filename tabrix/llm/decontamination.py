"""Benchmark decontamination: a BM25 inverted index of the test items, queried by every
passage of the training documents with block-max WAND.

Items are ordered by length and put into classes of similar length and blocks of a few items.
A class's passages are overlapping windows of two steps, one per step.  A step is the longest
item's words and a margin of a quarter, so that any occurrence of an item, also one with that
many words inserted, lies within one passage.  Impacts are divided
by the item's score against itself, so scores lie between 0 and 1 and one threshold serves
items of any length.  Block maxima bound the scores of a block's items for all passages of a
batch at once; a block that may reach the threshold is searched document at a time.  All items
at or above the threshold are retrieved and verified: at least ``overlap`` of the shingles of
the item's question and of its answer must occur in the passage.  The question is the text
before its last sentence and the answer that sentence; a text of one sentence is halved.
Shingles have five words, in short parts as many fewer as it takes that no single altered word
costs the part more than it may lose.  Where one word of a part is too much even word by word,
the shingles of both parts are judged together; where it is too much for the whole item (fewer
than five words), all of it must occur.

The items are indexed in shards of at most ``SHARD_BYTES`` of text; a shard's text is bounded and
goes to every task of one pass over the documents.  Item count, mean length, document frequencies
and the classes' steps are those of all items, so that shards do not change a score.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, repeat
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.names import column, own
from tabrix.session import materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.7
OVERLAP = 0.8
SHINGLE = 5
BLOCK_ITEMS = 4
SHARD_BYTES = 512 << 10
BATCH_WORDS = 1 << 18

_SEPARATORS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()),
                              b" " * sum(not chr(c).isalnum() for c in range(128)))
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def words(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return text.lower().encode("utf-8").translate(_SEPARATORS).split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """Words of an item's question and answer."""
    parts = [w for s in _SENTENCE_END.split(text) if (w := words(s))]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    both = parts[0] if parts else []
    return both[:(len(both) + 1) // 2], both[(len(both) + 1) // 2:]


def shingles(w: list[bytes], k: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """Distinct runs of k words; a shorter text is one shingle, an empty one has none."""
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def tolerant_shingles(parts: list[list[bytes]], overlap: float) -> set[tuple[bytes, ...]] | None:
    """Shingles of all parts, at the greatest length up to SHINGLE at which any one altered word
    leaves ``overlap`` of them; None if there is no such length."""
    for k in range(SHINGLE, 0, -1):
        seen: dict[tuple[bytes, ...], tuple[int, int]] = {}  # last start, first end
        at = 0
        for w in parts:
            for i in range(max(1, len(w) - k + 1) if w else 0):
                g = tuple(w[i:i + k])
                seen[g] = at + i, seen.get(g, (0, at + i + len(g)))[1]
            at += len(w)
        lost = [0] * (at + 1)  # shingles that every occurrence of has this word in
        for last, end in seen.values():
            if last < end:
                lost[last] += 1
                lost[end] -= 1
        if max(accumulate(lost)) <= (1 - overlap) * len(seen) + 1e-9:
            return set(seen)
    return None


def judged(q: list[bytes], a: list[bytes], overlap: float
           ) -> tuple[set[tuple[bytes, ...]], set[tuple[bytes, ...]]]:
    """The two sets of shingles of which ``overlap`` must occur."""
    parts = tolerant_shingles([q], overlap), tolerant_shingles([a], overlap)
    if parts[0] is not None and parts[1] is not None:
        return parts
    whole = tolerant_shingles([q, a], overlap)
    return (shingles(q), shingles(a)) if whole is None else (whole, whole)


class Statistics(NamedTuple):
    """Of all items with words: their number and mean length, the smallest length of each class
    and the number of items that have a term (here of the terms of one shard)."""
    items: int
    mean: float
    least: dict[int, int]
    df: dict[bytes, int]


def _class(n: int) -> int:
    return (n - 1).bit_length()


class Index:
    """BM25 inverted index with block maxima over items (item_id, text), by their own statistics
    or those of the larger table that they are a shard of."""

    def __init__(self, items: Iterable[tuple[Any, str]], block: int = BLOCK_ITEMS,
                 overlap: float = OVERLAP, stats: Statistics | None = None):
        known = [(len(q) + len(a), i, q, a) for i, text in items
                 for q, a in [question_answer(text)] if q or a]
        known.sort()
        self.ids = [i for _, i, _, _ in known]
        self.parts = [judged(q, a, overlap) for _, _, q, a in known]
        docs = [Counter(q + a) for _, _, q, a in known]
        if stats is None:
            least: dict[int, int] = {}
            for n, *_ in known:
                least.setdefault(_class(n), n)
            stats = Statistics(len(docs), sum(n for n, *_ in known) / max(len(docs), 1), least,
                               Counter(t for d in docs for t in d))
        df, mean = stats.df, stats.mean
        idf = {t: math.log(1 + (stats.items - n + 0.5) / (n + 0.5)) for t, n in df.items()}
        self.term = {t: i for i, t in enumerate(sorted(df), 1)}  # 0: not in the index
        self.docs: list[list[int]] = [[] for _ in range(len(df) + 1)]
        self.impacts: list[list[float]] = [[] for _ in range(len(df) + 1)]
        # blocks never cross a class; a class's items are at most twice as long as each other
        self.block_of, self.block_range = [], []
        self.classes: list[tuple[int, int, int]] = []  # step, first and last block
        for i, (d, (n, *_)) in enumerate(zip(docs, known)):
            new_class = i == 0 or _class(n) != _class(known[i - 1][0])
            if new_class or i - self.block_range[-1][0] == block:
                self.block_range.append((i, i + 1))
            else:
                self.block_range[-1] = (self.block_range[-1][0], i + 1)
            k = len(self.block_range) - 1
            self.block_of.append(k)
            if new_class:
                self.classes.append((stats.least[_class(n)], k, k + 1))
            else:
                self.classes[-1] = (n, self.classes[-1][1], k + 1)
            norm = K1 * (1 - B + B * n / mean)
            impact = {t: idf[t] * c * (K1 + 1) / (c + norm) for t, c in d.items()}
            own = sum(impact.values())
            for t, x in impact.items():
                self.docs[self.term[t]].append(i)
                self.impacts[self.term[t]].append(x / own)
        self.classes = [(n + max(SHINGLE, -(-n // 4)), b0, b1) for n, b0, b1 in self.classes]
        self.block_max = np.zeros((len(df) + 1, len(self.block_range)), np.float32)
        for t, (where, xs) in enumerate(zip(self.docs, self.impacts)):
            for i, x in zip(where, xs):
                k = self.block_of[i]
                # rounded up, so that a bound never falls below a score
                self.block_max[t, k] = max(self.block_max[t, k], np.nextafter(
                    np.float32(x), np.float32(2)))
        self.upper = self.block_max.max(1, initial=0.0).astype(float)

    def search(self, terms: Iterable[int], threshold: float, first: int = 0,
               last: int | None = None) -> list[tuple[int, float]]:
        """Items of [first, last) with score >= threshold for a set of terms, by block-max
        WAND.  A tiny slack absorbs rounding in sums."""
        need = threshold - 1e-9
        docs, impacts, block_of = self.docs, self.impacts, self.block_of
        last = len(self.ids) if last is None else last
        cursors = []
        for t in terms:
            at = bisect_left(docs[t], first)
            if at < len(docs[t]) and docs[t][at] < last:
                cursors.append([docs[t][at], t, at])
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                bound += self.upper[t]
                if bound >= need:
                    pivot = k
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            head = cursors[:pivot + 1]
            block = block_of[doc]
            target = doc + 1
            if sum(float(self.block_max[t, block]) for _, t, _ in head) >= need:
                score = 0.0
                for _, t, at in head:
                    at = bisect_left(docs[t], doc, at)
                    if at < len(docs[t]) and docs[t][at] == doc:
                        score += impacts[t][at]
                if score >= need:
                    found.append((doc, score))
            else:  # nothing up to the block's end or the next cursor can reach the threshold
                target = self.block_range[block][1]
                if pivot + 1 < len(cursors):
                    target = max(doc + 1, min(target, cursors[pivot + 1][0]))
            rest = cursors[pivot + 1:]
            for c in head:
                c[2] = bisect_left(docs[c[1]], target, c[2])
                if c[2] < len(docs[c[1]]) and docs[c[1]][c[2]] < last:
                    c[0] = docs[c[1]][c[2]]
                    rest.append(c)
            cursors = rest
        return found

    def leaks(self, texts: list[list[bytes]], threshold: float = THRESHOLD,
              overlap: float = OVERLAP) -> dict[tuple[int, int], tuple[float, float, float]]:
        """(text, item) -> best (score, question overlap, answer overlap) in a passage, for a
        batch of texts' words."""
        out: dict[tuple[int, int], tuple[float, float, float]] = {}
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        n = int(size.sum())
        if not n or not self.ids:
            return out
        begin = np.concatenate(([0], size.cumsum()[:-1]))
        terms = np.fromiter(map(self.term.get, chain.from_iterable(texts), repeat(0)), np.int64, n)
        for step, b0, b1 in self.classes:
            steps = -(-size // step)
            own = np.repeat(np.arange(len(texts)), steps)
            nth = np.arange(len(own)) - np.repeat(steps.cumsum() - steps, steps)
            start = begin[own] + nth * step
            bound = np.add.reduceat(self.block_max[terms, b0:b1], start, axis=0)
            bound[:-1] += bound[1:] * (own[1:] == own[:-1])[:, None]  # a passage is two steps
            for w, k in zip(*np.nonzero(bound >= threshold - 1e-3)):
                o = int(own[w])
                i = int(nth[w]) * step
                j = min(i + 2 * step, len(texts[o]))
                distinct = np.unique(terms[begin[o] + i:begin[o] + j])
                distinct = distinct[self.block_max[distinct, b0 + k] > 0]
                if self.block_max[distinct, b0 + k].sum() < threshold - 1e-3:
                    continue  # the bound counted repeated words
                inside = None
                for doc, score in self.search(distinct.tolist(), threshold,
                                              *self.block_range[b0 + k]):
                    inside = inside or self._inside(texts[o][i:j])
                    q, a = (len(s & inside) / len(s) if s else 1.0
                            for s in self.parts[doc])
                    if q >= overlap and a >= overlap:
                        out[o, doc] = max(out.get((o, doc), (0.0, 0.0, 0.0)), (score, q, a))
        return out

    @staticmethod
    def _inside(w: list[bytes]) -> set[tuple[bytes, ...]]:
        """Runs of 1 to SHINGLE words of a passage."""
        return {tuple(w[i:i + k]) for k in range(1, SHINGLE + 1) for i in range(len(w) - k + 1)}


Shard = tuple[tuple[tuple[Any, str], ...], Statistics | None]
_built: list[tuple[str, float, Index]] = []


def _index(name: str, shard: Shard, overlap: float) -> Index:
    """One index per Python worker and shard; the last two are kept."""
    for known, o, index in _built:
        if (known, o) == (name, overlap):
            return index
    index = Index(shard[0], overlap=overlap, stats=shard[1])
    _built.append((name, overlap, index))
    del _built[:-2]
    return index


def _terms(rows: DataFrame) -> DataFrame:
    """(shard, n, term) of every item with words: its length and, once each, its terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, n, terms = [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                q, a = question_answer(t)
                if q or a:
                    shard.append(k)
                    n.append(len(q) + len(a))
                    terms.append(sorted(set(q + a)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(terms, pa.list_(pa.binary()))], ["shard", "n", "terms"])

    return rows.select("shard", "t").mapInArrow(run, "shard long, n long, terms array<binary>")


def _shards(items: DataFrame, id_col: str, text_col: str) -> Iterator[Shard]:
    """The items in shards of about SHARD_BYTES with the statistics of all items; each shard is
    bounded, and read on its own."""
    rows = items.select(column(id_col).alias("i"), column(text_col).alias("t")).filter(
        "i is not null and t is not null").distinct()
    size = rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = -(-size // SHARD_BYTES)
    if n <= 1:
        if n:
            yield tuple(sorted((r["i"], r["t"]) for r in rows.collect())), None
        return
    rows = materialize(rows.withColumn("shard", F.pmod(F.xxhash64("i", "t"), F.lit(n))))
    terms = materialize(_terms(rows))
    # one row per class of lengths, of which there are at most 64
    least = {_class(r["n"]): r["n"] for r in terms.groupBy(
        F.ceil(F.log2("n")).alias("class")).agg(F.min("n").alias("n")).collect()}
    total = terms.agg(F.count(F.lit(1)).alias("items"), F.avg("n").alias("mean")).first()
    each = terms.select("shard", F.explode("terms").alias("term"))
    df = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    frequency = materialize(each.distinct().join(df, "term"))
    for k in range(n):
        own_df = {bytes(r["term"]): r["df"] for r in frequency.filter(F.col("shard") == k).collect()}
        shard = tuple(sorted((r["i"], r["t"]) for r in rows.filter(F.col("shard") == k).collect()))
        yield shard, Statistics(total["items"] or 0, total["mean"] or 0.0, least, own_df)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text",
          threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap) of every leaked item of every
    row of ``docs``, best passage first by score.  Ids keep their types; item ids need an order.

    Null and empty texts leak nothing; items with a null id, a null text or no words are left
    out; items with one id and different texts count on their own.  Repeated documents and
    null document ids give their rows as often as they occur.  Other columns are not read."""
    src = docs.select(column(id_col).alias("i"), column(text_col).alias("t")).filter(
        "t is not null")
    names = [id_col, item_id_col, "score", "question_overlap", "answer_overlap"]
    given = [src.schema["i"].dataType, items.select(column(item_id_col)).schema[0].dataType]
    schema = T.StructType([T.StructField(n, t) for n, t in zip(
        names, [*given, *[T.DoubleType()] * 3])])
    types = docs.sparkSession.createDataFrame([], schema).toArrow().schema.types

    def search(shard: Shard) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(name, shard, overlap)
            for b in batches:
                ids, texts = b.column(0).to_pylist(), b.column(1)
                out, at, n, group = [], 0, 0, []
                for k, t in enumerate(texts):
                    group.append(words(t.as_py()))
                    n += len(group[-1])
                    if n >= BATCH_WORDS or k + 1 == len(texts):
                        out += [(ids[at + o], index.ids[doc], *best) for (o, doc), best in
                                index.leaks(group, threshold, overlap).items()]
                        at, n, group = k + 1, 0, []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], types[k]) for k in range(len(names))], names)

        return src.mapInArrow(run, schema)

    found = [search(s) for s in _shards(items, item_id_col, item_text_col)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return functools.reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that leak an item, all columns unchanged.  Rows with a
    null id are kept: the decision is made by id (copies of one id go together)."""
    leaking = own("_leaking_id", docs)
    found = leaks(docs, items, id_col, text_col, **options).select(
        column(id_col).alias(leaking)).filter(F.col(leaking).isNotNull()).distinct()
    return docs.join(found, column(id_col) == F.col(leaking), "left_anti")
