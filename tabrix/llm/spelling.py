"""Spelling variant grouping by a dictionary of trie-node pairs.

Every prefix of a word is a node of the forward trie and every suffix one of the reversed trie.
Cutting a word before position i gives the pair (node of w[:i], node of w[i:]), skipping position
i the pair (node of w[:i], node of w[i+1:]).  Two words differ by one replaced code point if
they share a skipping pair, and by one inserted or deleted code point if a skipping pair of the
longer is a cutting pair of the shorter; nothing else is at distance one.  In a run of equal letters
only the first is skipped for the latter, so every two neighbours meet in exactly one pair.

Nodes are numbered without a common counter: the number is a 61-bit fingerprint of the node's path,
computed letter by letter.  Rows that share a pair also agree on a third fingerprint, of the
whole text without the skipped position, under another base.

All words of one pair differ in a single code point, so a pair holds at most one word for each letter and
one more.  Each learns its best neighbour there and how many it has; pairs of words are not formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.operators.ranking import exact_rank
from tabrix.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PRIME = (1 << 61) - 1
BASES = (0x1A2B3C4D5E6F7081 % PRIME, 0x0F1E2D3C4B5A6978 % PRIME, 0x13579BDF2468ACE0 % PRIME)
SKIP, SKIP_AGAIN, CUT = 0, 1, 2  # kinds of pairs; SKIP_AGAIN: not the first of equal letters
FLUSH = 100_000


def node_numbers(codes: list[int], base: int) -> list[int]:
    """Numbers of the trie nodes on the path of ``codes``, from the root (0)."""
    out, h = [0], 0
    for c in codes:
        h = (h * base + c + 1) % PRIME
        out.append(h)
    return out


def pairs(word: str) -> tuple[list[int], list[int], list[int], list[int]]:
    """(prefix node, suffix node, fingerprint of the rest, kind) of every pair of a word."""
    codes = list(map(ord, word))
    size = len(codes)
    fore = node_numbers(codes, BASES[0])
    back = node_numbers(codes[::-1], BASES[1])[::-1]
    head = node_numbers(codes, BASES[2])
    # the rest's fingerprint: head, moved up by the letters behind it, and the tail
    tail, power = [0] * (size + 1), [1] * (size + 1)
    for i in range(size - 1, -1, -1):
        tail[i] = (tail[i + 1] + (codes[i] + 1) * power[i + 1]) % PRIME
        power[i] = power[i + 1] * BASES[2] % PRIME
    rest = [(head[i] * power[i + 1] + tail[i + 1]) % PRIME for i in range(size)]
    kind = [SKIP_AGAIN if i and codes[i] == codes[i - 1] else SKIP for i in range(size)]
    return (fore[:size] + fore, back[1:] + back, rest + [head[size]] * (size + 1),
            kind + [CUT] * (size + 1))


def _pair_rows(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(6)]
            number = b.num_rows
            for k, (wid, word, n) in enumerate(zip(*(b[c].to_pylist()
                                                     for c in ("wid", "word", "n")))):
                p = pairs(word)
                for have, new in zip(rows, (*p, [wid] * len(p[0]), [-n] * len(p[0]))):
                    have += new
                if len(rows[0]) > FLUSH or k == number - 1:
                    for s in range(0, len(rows[0]), FLUSH):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.array(r[s:s + FLUSH], np.int64)) for r in rows],
                            ["prefix", "suffix", "rest", "kind", "wid", "neg"])
                    rows = [[] for _ in range(6)]

    return words.select("wid", "word", "n").mapInArrow(
        run, "prefix long, suffix long, rest long, kind long, wid long, neg long")


def neighbours(words: DataFrame) -> DataFrame:
    """(wid, n_near, best): the number of words at distance one and the first of them by
    (largest n, smallest wid) for each word of (wid, word, n) that has any."""
    met = (_pair_rows(words).groupBy("prefix", "suffix", "rest")
           .agg(F.array_sort(F.collect_list(F.struct("neg", "wid", "kind"))).alias("m"))
           .filter(F.size("m") > 1)
           .select(F.filter("m", lambda x: x["kind"] != CUT).alias("skips"),
                   F.filter("m", lambda x: x["kind"] == SKIP).alias("firsts"),
                   F.get(F.filter("m", lambda x: x["kind"] == CUT), F.lit(0)).alias("cut")))

    def key(x: Column) -> Column:
        return F.when(x.isNotNull(), F.struct(x["neg"].alias("neg"), x["wid"].alias("wid")))

    first, second = (F.get("skips", F.lit(i)) for i in (0, 1))

    def of_skip(x: Column) -> Column:
        other = F.when(x["wid"] == first["wid"], key(second)).otherwise(key(first))
        cut = F.when(x["kind"] == SKIP, key(F.col("cut")))
        return F.struct(x["wid"].alias("wid"),
                        (F.size("skips") - 1 + cut.isNotNull().cast("int")).alias("near"),
                        F.least(other, cut).alias("best"))

    of_cut = F.struct(F.col("cut")["wid"].alias("wid"), F.size("firsts").alias("near"),
                      key(F.get("firsts", F.lit(0))).alias("best"))
    each = F.concat(F.transform("skips", of_skip),
                    F.when(F.col("cut").isNotNull(), F.array(of_cut)).otherwise(F.array()))
    return (met.select(F.inline(each)).filter("near > 0").groupBy("wid")
            .agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def _roots(links: DataFrame) -> DataFrame:
    """(wid, root) from (wid, to): the last word reached.  A step at least doubles n, so paths
    have no circle and at most 63 steps; each round doubles the steps taken."""
    links = materialize(links.select("wid", "to", F.lit(True).alias("open")))
    while links.filter("open").limit(1).count():
        further = links.select(F.col("wid").alias("to"), F.col("to").alias("next"))
        links = materialize(links.join(further, "to", "left").select(
            "wid", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("open")))
    return links.select("wid", F.col("to").alias("root"))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                variant: Callable[[Column, Column], Column] | None = None, min_length: int = 5,
                min_count: int = 3) -> DataFrame:
    """(word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z in lower case,
    with their occurrences.  ``variant`` (id, run) may rewrite a run before it is counted; a null
    keeps it.  Words shorter than ``min_length`` code points or rarer than ``min_count``
    are left out.  Null texts have no words; rows that repeat an id all count."""
    text = F.translate(F.col(text_col), UPPER, LOWER)
    run = docs.select(F.col(id_col).alias("id"), F.explode(
        F.regexp_extract_all(text, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    word = F.col("run")
    if variant is not None:
        word = F.coalesce(variant(F.col("id"), word), word)
    return (run.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def spelling_forms(words: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced code point.  A word's
    form is its near word of largest n (ties: smallest in code-point order) if that n is at
    least ``ratio`` times its own, else null; its root is the last word that forms lead to,
    itself if it has none.  ``ratio`` has to be 2 or more.  Null words take no part; an
    empty table gives no row."""
    if ratio < 2:
        raise ValueError("ratio has to be at least 2")
    ranked = materialize(exact_rank(
        words.filter(F.col("word").isNotNull()).select("word", "n"), ["word"], name="wid"))
    near = ranked.join(neighbours(ranked), "wid", "left").select(
        "wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.neg") >= ratio * F.col("n"), F.col("best.wid")).alias("to"))
    near = materialize(near)
    roots = _roots(near.filter("to is not null"))
    names = ranked.select("wid", "word", "n")
    form = names.select(F.col("wid").alias("to"), F.col("word").alias("form"),
                        F.col("n").alias("form_n"))
    root = names.select(F.col("wid").alias("root"), F.col("word").alias("root_word"))
    named = (near.filter("to is not null").join(form, "to").join(roots, "wid")
             .join(root, "root").select("wid", "form", "form_n", "root_word"))
    return near.join(named, "wid", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
