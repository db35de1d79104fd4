"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at ASCII white space, where the tokenizer's normaliser and pre-tokenizer can
never join two pieces, so the count of a text is the sum of the counts of its pieces.  Each
distinct piece is encoded once per cache life; the pieces to encode are handed to the library
in batches of about equal bytes, whatever the number or length of the texts.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text handled together, bytes handed to one library call, bytes of cached pieces.
GROUP_BYTES = 4 << 20
BATCH_BYTES = 1 << 20
CACHE_BYTES = 12 << 20

from tabrix.llm.names import column


class PieceCounter:
    """Token counts of texts (UTF-8 bytes) from a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.no_truncation()
        self._tok.no_padding()
        self._known: dict[bytes, int] = {}
        self._size = 0

    def _learn(self, pieces: Iterable[bytes]) -> None:
        batch: list[bytes] = []
        size = 0
        for p in pieces:
            batch.append(p)
            size += len(p)
            if size >= BATCH_BYTES:
                self._encode(batch)
                batch, size = [], 0
        if batch:
            self._encode(batch)

    def _encode(self, batch: list[bytes]) -> None:
        got = self._tok.encode_batch_fast([p.decode("utf-8") for p in batch],
                                          add_special_tokens=False)
        for p, e in zip(batch, got):
            self._known[p] = len(e)
            self._size += len(p)

    def counts(self, parts: list[list[bytes]]) -> list[int]:
        """The summed counts of each list of pieces."""
        if self._size > CACHE_BYTES:
            self._known.clear()
            self._size = 0
        new: set[bytes] = set()
        for pieces in parts:
            new.update(pieces)
        new.difference_update(self._known)
        self._learn(new)
        one = self._known.__getitem__
        return [sum(map(one, pieces)) for pieces in parts]


def safe_parts(text: bytes, limit: int = GROUP_BYTES) -> Iterator[bytes]:
    """``text`` in parts of at most ``limit`` bytes that end at white space; a longer run
    without white space stays whole."""
    start, n = 0, len(text)
    while n - start > limit:
        cut = max(text.rfind(s, start, start + limit) for s in (b" ", b"\n", b"\t", b"\r"))
        if cut <= start:
            after = [c for c in (text.find(s, start + limit) for s in (b" ", b"\n", b"\t", b"\r"))
                     if c >= 0]
            if not after:
                break
            cut = min(after)
        yield text[start:cut]
        start = cut
    yield text[start:]


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    """One counter per Python worker, so that its cache serves all tasks the worker runs."""
    return PieceCounter(path)


def _count_batches(path: str, batches: Iterable[pa.Array]) -> Iterator[pa.Array]:
    counter = _counter(path)
    for arr in batches:
        total = [0] * len(arr)
        owner: list[int] = []
        parts: list[list[bytes]] = []
        size = 0

        def flush() -> None:
            for i, n in zip(owner, counter.counts(parts)):
                total[i] += n
            owner.clear()
            parts.clear()

        for i, value in enumerate(arr):
            if not value.is_valid:
                continue
            for part in safe_parts(value.as_buffer().to_pybytes()):
                owner.append(i)
                parts.append(part.split())
                size += len(part)
                if size >= GROUP_BYTES:
                    flush()
                    size = 0
        flush()
        yield pa.array(total, pa.int64())


def token_count(text: Column, path: str) -> Column:
    """Number of tokens (long) that the tokenizers file at ``path`` gives for ``text``; null
    and empty texts have 0.  ``path`` must exist on every executor."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _count_batches(path, batches)

    return count(F.coalesce(text, F.lit("")))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 2048,
                 names: tuple[str, str, str] = ("n_bytes", "n_tokens", "over_limit")) -> DataFrame:
    """``docs`` with UTF-8 length, token count and whether the count exceeds ``limit``.

    Null or empty text: 0, 0, false.  Repeated rows stay.  Columns of ``docs`` that have one
    of the three ``names`` are replaced, all others pass unchanged (also null ids)."""
    b, n, over = names
    keep = [column(c) for c in docs.columns if c.lower() not in {x.lower() for x in names}]
    return (docs.select(*keep, F.coalesce(F.octet_length(column(text_col)), F.lit(0)).cast("long").alias(b),
                        token_count(column(text_col), path).alias(n))
                .withColumn(over, column(n) > F.lit(limit)))
