"""BPE encoding and decoding.

A pre-token's symbols form a doubly linked list; a priority queue holds the merge rank of every
adjacent pair.  The lowest rank (leftmost on ties) is merged first, which links the neighbours
anew and queues the two new pairs; entries whose symbols have changed meanwhile are stale and
skipped.  Decoding concatenates the vocabulary's byte strings.  Only the vocabulary, merges
and special strings are read from the tokenizers file: the splitting pattern is that of
byte-level BPE files with ``use_regex`` and without a prefix space.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.names import column, own

# Fixed value: the public byte-level BPE splitting pattern.
SPLIT_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                 r"|\s+(?!\S)|\s+")
# A single space between two visible characters always starts a new pre-token.
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
CACHE_CHARS = 16 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: visible
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class _Chunks(dict):
    """Ids of the chunks met so far, each without the space before it."""

    def __init__(self, codec: ByteBPE):
        self._codec = codec

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        ids = self[chunk] = self._codec._chunk(" " + chunk)
        self._codec._size += len(chunk)
        return ids


class ByteBPE:
    """Encoder and decoder for one byte-level BPE tokenizers file."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex")
                or pre.get("add_prefix_space") or spec["normalizer"]):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        self._first = [vocab[c] for c in alphabet]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # a pair is one integer; a rank gives the pair's symbols and what they become
        self._rank = {vocab[a] << 32 | vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self._parts = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self._byte_rank = {(x, y): self._rank[p] for x, a in enumerate(self._first)
                           for y, b in enumerate(self._first)
                           if (p := a << 32 | b) in self._rank}.get
        as_byte = {c: b for b, c in enumerate(alphabet)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self._bytes = [b""] * size
        for token, i in vocab.items():
            self._bytes[i] = bytes(as_byte[c] for c in token) if token not in added else b""
        for token, i in added.items():
            self._bytes[i] = token.encode("utf-8")
        self._text = [str(i) for i in range(size)]
        self._ids = list(range(size))
        self._added = added
        self._added_split = (regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")
            if added else None)
        self._split = regex.compile(SPLIT_PATTERN)
        self._known = _Chunks(self)
        self._words: dict[str, tuple[int, ...]] = {}
        self._size = 0

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        first = self._first
        symbol = [first[b] for b in word]
        n = len(symbol)
        if n == 1:
            return (symbol[0],)
        rank_of, parts = self._rank.get, self._parts
        # a queue entry is rank * n + position: lowest rank first, leftmost on ties
        queue = [r * n + i for i, r in enumerate(map(self._byte_rank, pairwise(word)))
                 if r is not None]
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            i = heappop(queue)
            left, right, joined = parts[i // n]
            i %= n
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # stale: one of the two has been merged since
            symbol[i], symbol[j] = joined, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(joined << 32 | symbol[k])) is not None:
                    heappush(queue, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank_of(symbol[h] << 32 | joined)) is not None:
                heappush(queue, r * n + h)
        ids = self._ids
        return tuple([ids[s] for s in symbol if s >= 0])

    def _plain(self, text: str) -> list[int]:
        out: list[int] = []
        known = self._words
        for w in self._split.findall(text):
            got = known.get(w)
            if got is None:
                got = known[w] = self.merge(w.encode("utf-8"))
                self._size += len(w)
            out.extend(got)
        return out

    def _chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a chunk between safe cuts; special strings are found before splitting."""
        for t in self._added:
            if t in text:
                break
        else:
            return tuple(self._plain(text))
        added = self._added
        return tuple(chain.from_iterable(
            (added[p],) if i % 2 else self._plain(p)
            for i, p in enumerate(self._added_split.split(text))))

    def encode(self, text: str) -> list[int]:
        if self._size > CACHE_CHARS:
            self._known.clear()
            self._words.clear()
            self._size = 0
        first, *rest = _SAFE_CUT.split(text)
        out = list(self._chunk(first))
        out.extend(chain.from_iterable(map(self._known.__getitem__, rest)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", errors="replace")

    def ids_text(self, ids: Iterable[int]) -> str:
        return ",".join(map(self._text.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def _codec(path: str) -> ByteBPE:
    """One codec per Python worker, so that its cache serves all tasks the worker runs."""
    return ByteBPE(path)


def encode(text: Column, path: str) -> Column:
    """Token ids (array<int>) of ``text``; null gives the empty array."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for arr in batches:
            yield pa.array([codec.encode(v.as_py() or "") for v in arr], pa.list_(pa.int32()))

    return ids(F.coalesce(text, F.lit("")))


def decode(ids: Column, path: str) -> Column:
    """Text of an array of token ids, special tokens included; null gives the empty text.
    Bytes that are no UTF-8 become U+FFFD.  An id outside the vocabulary raises."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for arr in batches:
            yield pa.array([codec.decode(v.as_py() or ()) for v in arr], pa.string())

    return text(ids)


_DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()),
                        T.StructField("ids_sha256", T.StringType()),
                        T.StructField("decoded_sha256", T.StringType())])


def round_trip_digest(text: Column, path: str) -> Column:
    """Struct of token count, SHA-256 of the ids (decimal, joined by commas) and SHA-256 of the
    text decoded from them, in one pass that keeps one text's ids in memory at a time."""

    @F.arrow_udf(_DIGEST)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(path)
        for arr in batches:
            n, a, b = [], [], []
            for v in arr:
                ids = codec.encode(v.as_py() or "")
                n.append(len(ids))
                a.append(hashlib.sha256(codec.ids_text(ids).encode("ascii")).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids).encode("utf-8")).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(F.coalesce(text, F.lit("")))


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of its texts.

    Null texts count as empty.  Repeated rows stay; columns of ``docs`` with one of the three
    names (in any case) are replaced, all others pass unchanged."""
    new = [f.name for f in _DIGEST.fields]
    keep = [column(c) for c in docs.columns if c.lower() not in new]
    digest = own("_bpe", docs)
    return (docs.select(*keep, round_trip_digest(column(text_col), path).alias(digest))
                .select(*keep, *[F.col(digest)[c].alias(c) for c in new]))
