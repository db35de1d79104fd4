"""Substring dedup by prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one document; a window goes if its words also start
earlier.  Only suffixes at anchors enter the trees: of a window's k-word runs the one with the
smallest hash (leftmost on ties) is its anchor, so equal windows have their anchors at the same
place and every window belongs to exactly one.  An anchor's k words are the prefix that deals
suffixes to groups; prefixes that occur once have no inner node and end there.

Prefixes are dealt to groups of about ``GROUP`` suffixes.  A prefix with more than three fourths
of that is lengthened to the whole window, and each task first keeps only the earliest of its
equal windows, so no group holds more than one suffix of such a window per task flush.  In each
group the suffixes are sorted word by word (by doubling); neighbours with a common prefix of
``window`` words lie below one inner node of that depth, whose leaves are the occurrences of a
repeat: all but the earliest are removed.  Words are compared as they are, not by hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.names import column
from tabrix.operators.ranking import exact_rank
from tabrix.session import materialize

WINDOW = 20
ANCHOR = 8
GROUP = 40_000  # one group is a task's arrays: about 100 MB
BATCH_BYTES = 4 << 20
FLUSH = 100_000
NULL_ID = -(1 << 63)  # stands for a null id: before all others


class _Hashes(dict):
    """XXH64 of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest
        got = xxh64_intdigest(word)
        if len(self) < 600_000:
            self[word] = got
        return got


_hash = _Hashes()


def anchors(texts: list[list[bytes]], window: int = WINDOW, k: int = ANCHOR
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a batch of texts' words: text, hash, position, and the smallest and largest
    distance back to the windows' starts (all between lie in the text too)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(size.sum())
    none = np.zeros(0, np.int64)
    if total < window:
        return none, none, none, none, none
    word = np.fromiter((_hash[w] for t in texts for w in t), np.uint64, total)
    end = size.cumsum()
    own = np.repeat(np.arange(len(texts)), size)
    run = np.zeros(total - k + 1, np.uint64)
    for i in range(k):
        run = run * np.uint64(0x9E3779B97F4A7C15) + word[i:total - k + 1 + i]
    run = (run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    run ^= run >> np.uint64(32)
    span = window - k + 1
    starts = np.arange(total - window + 1)
    low, at = run[:len(starts)].copy(), np.zeros(len(starts), np.int64)
    for i in range(1, span):
        less = run[i:i + len(starts)] < low
        low[less] = run[i:i + len(starts)][less]
        at[less] = i
    inside = starts + window <= end[own[:len(starts)]]
    starts, at = starts[inside], (starts + at)[inside]
    if not len(starts):
        return none, none, none, none, none
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1])
                                           | (own[starts[1:]] != own[starts[:-1]]))))
    last = np.concatenate((first[1:], [len(at)])) - 1
    p = at[first]
    text = own[p]
    return (text, run[p].view(np.int64), p - (end - size)[text], p - starts[last],
            p - starts[first])


def _pack(p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return p << 16 | lo << 8 | hi


def _grouped(batches: Iterable[pa.RecordBatch], n_text: int = 1) -> Iterator[tuple]:
    """(rows, words) in parts of about BATCH_BYTES of text; column n_text holds the texts."""
    for b in batches:
        at, size, part = 0, 0, []
        for i, t in enumerate(b.column(n_text)):
            raw = t.as_buffer().to_pybytes() if t.is_valid else b""
            part.append(raw.split())
            size += len(raw)
            if size >= BATCH_BYTES or i + 1 == b.num_rows:
                yield b.slice(at, i + 1 - at), part
                at, size, part = i + 1, 0, []


def anchor_table(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h, doc, at) per document and distinct anchor hash; ``at`` lists its packed places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part in _grouped(batches):
            text, h, p, lo, hi = anchors(part, window)
            order = np.lexsort((p, h, text))
            text, h, packed = text[order], h[order], _pack(p, lo, hi)[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1])
                                                 | (text[1:] != text[:-1])))[:len(h)])
            doc = rows.column(0).to_numpy(zero_copy_only=False)[text[new]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[new]), pa.array(doc.astype(np.int64)), pa.ListArray.from_arrays(
                    pa.array(np.append(new, len(h)).astype(np.int32)), pa.array(packed))],
                ["h", "doc", "at"])

    return docs.select("doc", "text").mapInArrow(run, "h long, doc long, at array<long>")


_SUFFIX = "grp int, doc long, at long, mask long, words binary"


def _suffixes(docs: DataFrame, groups: int, window: int) -> DataFrame:
    """Suffixes of the repeated anchors: packed place and the words of its windows.  Windows of
    long prefixes found later than another in the same task come out with null words: ``at`` is
    then a start and ``mask`` tells which of the 32 windows from there are late."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int | None, bytes | None]] = []
        first: dict[bytes, tuple[int, int]] = {}
        late: dict[tuple[int, int], int] = {}

        def batch() -> pa.RecordBatch:
            cols = zip(*out) if out else [[]] * 5
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["grp", "doc", "at", "mask", "words"])
            out.clear()
            return got

        def flush() -> None:
            for w, (doc, start) in first.items():
                d = int.from_bytes(hashlib.blake2b(w, digest_size=7).digest())
                out.append((d % groups, doc, start << 16, None, w))
            first.clear()

        def flush_late() -> None:
            for (doc, block), mask in late.items():
                out.append(((doc + block) % groups, doc, block << 5, mask, None))
            late.clear()

        for rows, part in _grouped(batches):
            for doc, found, words in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(),
                                         part):
                if not words:
                    continue
                text = b" ".join(words)
                end = (np.fromiter(map(len, words), np.int64, len(words)) + 1).cumsum() - 1
                begin = [0, *(end[:-1] + 1).tolist()]
                end = end.tolist()
                for f in found:
                    for x in f["at"]:
                        p, lo, hi = x >> 16, x >> 8 & 255, x & 255
                        if not f["big"]:
                            out.append((f["grp"], doc, x, None,
                                        text[begin[p - hi]:end[p - lo + window - 1]]))
                            continue
                        for s in range(p - hi, p - lo + 1):
                            w = text[begin[s]:end[s + window - 1]]
                            old = first.get(w)
                            if old is None or (doc, s) < old:
                                first[w] = (doc, s)
                            if old is not None and old != (doc, s):
                                i, at = max(old, (doc, s))
                                late[i, at >> 5] = late.get((i, at >> 5), 0) | 1 << (at & 31)
                    if len(first) >= FLUSH:
                        flush()
                if len(out) >= 50_000:
                    yield batch()
            flush_late()
        flush()
        yield batch()

    return docs.select("doc", "text", "found").mapInArrow(run, _SUFFIX)


def _word_numbers(words: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word of each row, words of each row): equal words have equal numbers."""
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    split = pa.compute.split_pattern(words.cast(pa.large_string()), " ")
    if not len(split):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    flat = split.flatten().dictionary_encode()
    return (flat.indices.to_numpy().astype(np.int32),
            pa.compute.list_value_length(split).to_numpy().astype(np.int64))


def deep_repeats(words: list[bytes] | pa.ChunkedArray, count: np.ndarray, window: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix tree of the windows in ``words``: per suffix row i, ``count[i]`` windows start at
    its first words.  Returns (row, offset, leaf interval) of every window, in the order of
    the leaves; windows of one interval are below one inner node of depth ``window``."""
    if isinstance(words, list):
        words = pa.array(words, pa.binary())
    name, size = _word_numbers(words)
    names, depth = {1: name}, 1
    while depth * 2 <= window:  # names of runs of 2, 4, 8, 16 ... words, by first occurrence
        a = names[depth]
        pair = a[:max(0, len(a) - depth)].astype(np.int64) << 32 | a[depth:]
        names[depth * 2] = pd.factorize(pair)[0].astype(np.int32)
        depth *= 2
    base = size.cumsum() - size
    row = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(row)) - np.repeat(count.cumsum() - count, count)
    start = base[row] + offset
    keys, at = [], 0
    for d in sorted(names, reverse=True):
        while at + d <= window:
            keys.append(names[d][start + at])
            at += d
    key = keys[0].astype(np.int64)
    for more in keys[1:]:  # one name for all words of a window
        key = pd.factorize(key << 32 | more)[0]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    node = np.concatenate(([0], np.cumsum(~same))) if len(order) else np.zeros(0, np.int64)
    return row[order], offset[order], node


def _tree(table: pa.Table, window: int) -> pa.Table:
    """(doc, start, mask): bit i of mask says that the window at start + i is removed."""
    done = table.filter(pa.compute.is_null(table["words"]))
    live = table.filter(pa.compute.is_valid(table["words"]))
    doc, at = live["doc"].to_numpy(), live["at"].to_numpy()
    p, lo, hi = at >> 16, at >> 8 & 255, at & 255
    row, offset, node = deep_repeats(live["words"], hi - lo + 1, window)
    d, s = doc[row], (p - hi)[row] + offset
    order = np.lexsort((s, d, node))
    node, d, s, row, offset = node[order], d[order], s[order], row[order], offset[order]
    new = np.concatenate(([True], node[1:] != node[:-1]))[:len(node)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(node)), 0))
    late = (d != d[first]) | (s != s[first])
    mask = np.zeros(len(doc), np.int64)
    np.bitwise_or.at(mask, row[late], np.int64(1) << offset[late])
    hit = mask != 0
    return pa.table({
        "doc": pa.array(np.concatenate((doc[hit], done["doc"].to_numpy()))),
        "start": pa.array(np.concatenate(((p - hi)[hit], done["at"].to_numpy()))),
        "mask": pa.array(np.concatenate((mask[hit], done["mask"].to_numpy())))})


_RESULT = "n_words long, n_removed long, kept_sha256 string"


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space) and, if asked for, those words as ``kept_text``.

    Null and short texts have no window.  Rows that repeat an id are one document: windows at
    one start do not remove each other.  Ids may be of any type with an order; null ids come
    before all others.  Other columns of ``docs`` are not read."""
    if not ANCHOR < window <= 60:
        raise ValueError(f"window must be above {ANCHOR} and at most 60")
    src = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    if isinstance(src.schema["id"].dataType, T.IntegralType):
        out = _removed(src.select(F.coalesce(F.col("id").cast("long"), F.lit(NULL_ID)).alias("doc"),
                                  "text"), window, keep_text)
        return out.withColumn("doc", F.nullif("doc", F.lit(NULL_ID))).withColumnRenamed("doc", id_col)
    # other ids by their place in the order of all ids
    place = materialize(exact_rank(src.select("id").filter("id is not null").distinct(), ["id"],
                                   name="doc"))
    out = _removed(src.join(place, "id", "left").select(
        F.coalesce("doc", F.lit(NULL_ID)).alias("doc"), "text"), window, keep_text)
    return out.join(place, "doc", "left").select(
        F.col("id").alias(id_col), *[c for c in out.columns if c != "doc"])


def _removed(src: DataFrame, window: int, keep_text: bool) -> DataFrame:
    table = materialize(anchor_table(src, window))
    # one narrow row per repeated prefix
    prefixes = materialize(table.groupBy("h").agg(F.sum(F.size("at")).alias("n")).filter("n > 1"))
    total = prefixes.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // GROUP))
    found = (table.join(prefixes, "h")
             .groupBy("doc").agg(F.collect_list(F.struct(
                 F.pmod("h", F.lit(groups)).cast("int").alias("grp"), "at", (F.col("n") > GROUP * 3 // 4).alias("big"))).alias("found")))
    suffixes = _suffixes(src.join(found, "doc"), groups, window)
    gone = (suffixes.groupBy("grp").applyInArrow(
                lambda t: _tree(t, window), "doc long, start long, mask long")
            .groupBy("doc").agg(F.collect_list(F.struct("start", "mask")).alias("gone")))
    return _kept(src.join(gone, "doc", "left"), window, keep_text)


def _kept(rows: DataFrame, window: int, keep_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, part in _grouped(batches):
            n, removed, sha, kept = [], [], [], []
            gone = b.column(2)
            for words, g in zip(part, gone):
                n.append(len(words))
                if g.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    start = g.values.field(0).to_numpy()
                    mask = g.values.field(1).to_numpy()
                    for i in range(int(mask.max()).bit_length()):
                        s = start[mask >> i & 1 == 1] + i
                        np.add.at(edge, s, 1)
                        np.add.at(edge, s + window, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    words = [w for w, k in zip(words, stay.tolist()) if k]
                removed.append(n[-1] - len(words))
                text = b" ".join(words)
                sha.append(hashlib.sha256(text).hexdigest())
                if keep_text:
                    kept.append(text.decode("utf-8"))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(sha, pa.string())]
            names = ["doc", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                cols.append(pa.array(kept, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names)

    return rows.select("doc", "text", "gone").mapInArrow(
        run, "doc long, " + _RESULT + (", kept_text string" if keep_text else ""))
