"""Quality classifier: a factorisation machine on hashed words, structure statistics and
metadata.

score(x) = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairwise sum is
taken in linear time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 per factor.  The model
is fitted by Adagrad on a bounded sample of labelled rows (``max_rows``, smallest hashes of the
id first) in one task; its size is fixed by ``hash_bits`` and ``factors``, so it is sent to
every task.  Features come from whole texts; labels, language, source and id are no inputs.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 15
FACTORS = 8
MAX_ROWS = 6000
EPOCHS = 8
RATE = 0.1
L2 = 1e-5
SEED = 7
STATS = ("log_bytes", "log_chars", "log_words", "word_length", "distinct_words", "line_words",
         "distinct_lines", "upper", "digits", "marks", "sentence_marks", "non_ascii", "spaces",
         "marked_words", "top_word", "repeat_bigrams")

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
_SENTENCE = b".,;:?!'\"-()"
_MARKS = bytes(c for c in range(33, 127)
               if not chr(c).isalnum() and c not in _SENTENCE)


class _Buckets(dict):
    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> int:
        got = zlib.crc32(word) & self.mask
        if len(self) < 500_000:
            self[word] = got
        return got


def features(text: bytes, n_chars: int, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray,
                                                                    np.ndarray]:
    """Word buckets in use, their values (log counts of unit length) and the statistics."""
    n = len(text)
    low = text.translate(_LOWER)
    words = low.split()
    ids = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    at, count = np.unique(ids, return_counts=True)
    value = np.log1p(count)
    if len(value):
        value /= np.sqrt(value @ value)
    lines = [x for x in text.split(b"\n") if x.strip()]
    m, size = max(len(words), 1), max(n, 1)

    def share(chars: bytes) -> float:
        return (n - len(text.translate(None, chars))) / size

    pairs = np.unique(ids[:-1] << 20 | ids[1:]).size if len(ids) > 1 else 0
    high = n - len(text.translate(None, bytes(range(128, 256))))
    marked = sum(map(len, words)) - sum(map(len, low.translate(None, _MARKS).split()))
    stats = np.array([
        np.log1p(n), np.log1p(max(n_chars, 0)), np.log1p(len(words)), n / m, len(set(words)) / m,
        np.log1p(m / max(len(lines), 1)), len(set(lines)) / max(len(lines), 1), share(_UPPER),
        share(b"0123456789"), share(_MARKS), share(_SENTENCE), high / size, share(b" \t\r\n"),
        marked / size, (count.max() if len(count) else 0) / m,
        1 - pairs / max(len(ids) - 1, 1)])
    return at, value, stats


class FM:
    """Weights of a fitted machine and the scale of its statistics."""

    def __init__(self, bits: int = HASH_BITS, factors: int = FACTORS):
        n = (1 << bits) + len(STATS)
        rng = np.random.default_rng(SEED)
        self.bits, self.b = bits, 0.0
        self.w = np.zeros(n)
        self.v = rng.normal(0, 0.05, (n, factors))
        self.mean, self.std = np.zeros(len(STATS)), np.ones(len(STATS))
        self.buckets = _Buckets(bits)

    def row(self, text: bytes, n_chars: int) -> tuple[np.ndarray, np.ndarray]:
        at, value, stats = features(text, n_chars, self.buckets)
        scaled = np.clip((stats - self.mean) / self.std, -4, 4) / 2
        return (np.concatenate((at, (1 << self.bits) + np.arange(len(STATS)))),
                np.concatenate((value, scaled)))

    def margin(self, at: np.ndarray, value: np.ndarray) -> float:
        xv = self.v[at] * value[:, None]
        s = xv.sum(0)
        return float(self.b + self.w[at] @ value + 0.5 * (s @ s - (xv * xv).sum()))

    def score(self, text: bytes, n_chars: int) -> float:
        z = self.margin(*self.row(text, n_chars))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows: list[tuple[bytes, int, int]], epochs: int = EPOCHS,
            rate: float = RATE) -> FM:
        """Fit on (text, n_chars, label) rows; no row leaves the weights that score 0.5."""
        if not rows:
            self.v[:] = 0
            return self
        raw = [features(t, c, self.buckets) for t, c, _ in rows]
        stats = np.array([r[2] for r in raw])
        self.mean, self.std = stats.mean(0), stats.std(0) + 1e-6
        xs = []
        for at, value, st in raw:
            scaled = np.clip((st - self.mean) / self.std, -4, 4) / 2
            xs.append((np.concatenate((at, (1 << self.bits) + np.arange(len(STATS)))),
                       np.concatenate((value, scaled))))
        y = np.array([r[2] for r in rows], float)
        rng = np.random.default_rng(SEED)
        gw, gv, gb = np.full_like(self.w, 1e-2), np.full_like(self.v, 1e-2), 1e-2
        for _ in range(epochs):
            order = rng.permutation(len(xs))
            for k in range(0, len(order), 32):
                pick = order[k:k + 32]
                at = np.concatenate([xs[i][0] for i in pick])
                x = np.concatenate([xs[i][1] for i in pick])
                size = np.array([len(xs[i][0]) for i in pick])
                start = np.concatenate(([0], size.cumsum()[:-1]))
                own = np.repeat(np.arange(len(pick)), size)
                xv = self.v[at] * x[:, None]
                s = np.add.reduceat(xv, start)
                z = (self.b + np.add.reduceat(self.w[at] * x, start)
                     + 0.5 * ((s * s).sum(1) - np.add.reduceat((xv * xv).sum(1), start)))
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
                used, inv = np.unique(at, return_inverse=True)
                dw = np.bincount(inv, g[own] * x, len(used)) + L2 * self.w[used]
                part = (g[own] * x)[:, None] * (s[own] - xv)
                dv = np.stack([np.bincount(inv, part[:, f], len(used))
                               for f in range(part.shape[1])], 1) + L2 * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * 0.3 * dv / np.sqrt(gv[used])
                db = g.sum()
                gb += db * db
                self.b -= rate * db / np.sqrt(gb)
        return self

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bits=self.bits, b=self.b, w=self.w.astype("f4"), v=self.v.astype("f4"),
                 mean=self.mean, std=self.std)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> FM:
        z = np.load(io.BytesIO(data))
        fm = cls.__new__(cls)
        fm.bits, fm.b = int(z["bits"]), float(z["b"])
        fm.w, fm.v = z["w"].astype(float), z["v"].astype(float)
        fm.mean, fm.std = z["mean"], z["std"]
        fm.buckets = _Buckets(fm.bits)
        return fm


def in_training(id_col: str = "doc_id") -> Column:
    """Whether a row may be learnt from: crc32 of the id as text modulo 3 is not 1."""
    return F.crc32(F.col(id_col).cast("string")) % 3 != 1


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                max_rows: int = MAX_ROWS, hash_bits: int = HASH_BITS,
                factors: int = FACTORS) -> bytes:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1 and that are in training.

    Labels null or other than 0 and 1 and null ids are ignored; an id labelled both ways
    counts once per label.  At most ``max_rows`` labelled ids are used."""
    sample = (labels.select(F.col(id_col).alias("_i"), F.col(label_col).cast("int").alias("_y"))
              .filter("_i is not null and _y in (0, 1)").distinct()
              .filter(F.crc32(F.col("_i").cast("string")) % 3 != 1)
              .orderBy(F.xxhash64("_i"), "_i", "_y").limit(max_rows))
    chars = F.col(chars_col).cast("long") if chars_col and chars_col in docs.columns else None
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_i"), text.alias("_t"), F.coalesce(
        *([chars] if chars is not None else []), F.length(text).cast("long")).alias("_c"))
    # the labelled sample is bounded by max_rows narrow rows; copies of an id count once
    rows = (rows.join(F.broadcast(sample), "_i").groupBy("_i", "_y")
            .agg(F.min(F.struct("_t", "_c")).alias("_x"))
            .select("_i", "_y", F.col("_x._t").alias("_t"), F.col("_x._c").alias("_c")))

    def train(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((i.as_py(), y.as_py(), t.as_py(), c.as_py())
                     for b in it for i, y, t, c in zip(*(b.column(k) for k in range(4))))
        fm = FM(hash_bits, factors).fit([(t.encode("utf-8"), c, y) for _, y, t, c in got])
        yield pa.RecordBatch.from_arrays([pa.array([fm.dump()], pa.binary())], ["model"])

    got = rows.coalesce(1).mapInArrow(train, "model binary").first()
    return bytes(got["model"]) if got else FM(hash_bits, factors).fit([]).dump()


def score(text: Column, n_chars: Column, model: bytes) -> Column:
    """Score (0 to 1) of a text; null texts score as empty ones."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        fm = FM.load(model)
        for texts, chars in batches:
            yield pa.array([fm.score(t.as_buffer().to_pybytes(), c.as_py())
                            for t, c in zip(texts, chars)], pa.float64())

    return scored(F.coalesce(text, F.lit("")), n_chars)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             chars_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with score (double) and predicted (1 if score >= 0.5, else 0).

    Every row is scored, also with null id or text; columns of ``docs`` named score or
    predicted are replaced, others pass unchanged.  Without any usable label all score 0.5."""
    model = fit_quality(docs, labels, id_col=id_col, text_col=text_col, chars_col=chars_col,
                        **options)
    text = F.coalesce(F.col(text_col), F.lit(""))
    has = chars_col and chars_col in docs.columns
    chars = F.coalesce(*([F.col(chars_col).cast("long")] if has else []),
                       F.length(text).cast("long"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    return (docs.select(*keep, score(text, chars, model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
