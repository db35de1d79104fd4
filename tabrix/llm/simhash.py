"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position i of a fingerprint gets a nonzero vector m(i) of r + 1 bits.  For each of
the 2^(r+1) - 1 nonzero vectors v there is a table whose mask keeps the bits with an odd inner
product of m(i) and v.  For any r differing bits some v is orthogonal to all their vectors, so
its mask drops them: every pair within the radius meets in some table, none can be missed.

Documents with one fingerprint form a class; only classes are compared.  Pairs of small buckets
are verified directly.  In a bucket of more members than a fingerprint has neighbours, the
members meet at the fingerprints one bit away instead (for radius 2: within two bits exactly if
they share one), which is linear in the bucket's size and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.llm.components import connected_components
from tabrix.llm.names import column, own
from tabrix.session import materialize

SEED = 42  # of the shingles' XXH64
BITS = 64
_LOWER = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_BLOCK = 1 << 16


def simhash(text: bytes, shingle: int = 3) -> int:
    """64-bit fingerprint of one text: a bit is 1 if set in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _BLOCK):
        j = min(n, i + _BLOCK)
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in
                      zip(start[i:j].tolist(), end[i + k - 1:j + k - 1].tolist())], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash (long, two's complement) of ``text``; null and texts without words give 0."""

    @F.arrow_udf("long")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            got = [simhash(v.as_buffer().to_pybytes(), shingle) if v.is_valid else 0 for v in arr]
            yield pa.array(np.array(got, np.uint64).view(np.int64))

    return fp(F.coalesce(text, F.lit("")))


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """Masks of which, for any ``radius`` bit positions, at least one keeps none of them."""
    size = 1 << (radius + 1)
    vec = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vec[i] & v).bit_count() & 1)
            for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def links(classes: DataFrame, max_bits: int = 2, fp: str = "fp",
          bucket_pairs: int = 64) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints of ``classes`` linked at
    ``max_bits`` or fewer differing bits: every linked pair of a bucket of up to
    ``bucket_pairs`` members, and for larger buckets (radius 2) a star per fingerprint one bit
    away, whose members are all within two bits of each other.  For other radii all buckets
    are joined pairwise."""
    masks = covering_masks(max_bits)
    one = classes.select(F.col(fp).alias("a")).filter("a is not null").distinct()
    rows = one.select("a", F.posexplode(F.array(*[
        F.col("a").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("t", "key"))
    sizes = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = rows.join(sizes, ["t", "key"])
    few = met.filter(F.col("n") <= bucket_pairs) if max_bits == 2 else met
    left, right = few.select("t", "key", "a"), few.select("t", "key", F.col("a").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = left.join(right, ["t", "key"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")
    if max_bits != 2:
        return pairs.distinct()
    many = met.filter(F.col("n") > bucket_pairs).select("a").distinct()
    # a fingerprint one bit away has at most 65 members: a bounded set
    stars = (many.select("a", F.explode(F.array(F.col("a"), *[
                 F.col("a").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(BITS)])).alias("m"))
             .groupBy("m").agg(F.collect_set("a").alias("s")).filter(F.size("s") > 1)
             .select(F.array_min("s").alias("a"), F.explode("s").alias("b")).filter("a <> b"))
    return pairs.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of ``max_bits`` or fewer bits.

    Null and empty texts have fingerprint zero and link like any other.  Rows with a null id
    stay; ids are compared without nulls, so a component of only null ids has a null
    component_id.  Other columns of ``docs`` are not read.  Texts are read once; the narrow
    fingerprint table is written to the shared folder."""
    rows = materialize(docs.select(column(id_col).alias("id"),
                                   fingerprint(column(text_col), shingle).alias("fp")))
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("low")))
    comp = connected_components(links(classes, max_bits))
    member = classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    final = member.join(lowest, "root").select("fp", "component_id")
    return rows.join(final, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
          max_bits: int = 2) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id.  Rows that
    repeat that id stay; rows with a null id stay if their component has no other id."""
    comp = simhash_components(docs, id_col, text_col, shingle, max_bits)
    kept = own("_keep_id", docs)
    keep = comp.filter(column(id_col).eqNullSafe(F.col("component_id"))).select(
        column(id_col).alias(kept)).distinct()
    return docs.join(keep, column(id_col).eqNullSafe(F.col(kept)), "left_semi")
