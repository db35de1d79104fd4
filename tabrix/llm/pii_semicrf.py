"""Personal data by base patterns and a semi-Markov conditional random field.

The base patterns (email, ip, card, phone) give spans that always stay.  Around characters that
can start personal data a semi-Markov CRF then segments the text: candidate segments of up to
``MAX_ATOMS`` atoms (runs of letters or digits, single marks) are scored as whole spans (digit
counts and grouping, separators, checksums, neighbours, context word), all else one atom at a
time, and a dynamic programme chooses boundaries and types jointly.  Segments whose marginal
probability reaches ``min_confidence`` and that overlap no base span are added.

The model is trained on stretches of all texts: at most ``MAX_REGIONS`` different ones for each
kind of base span and as many without any, those of the smallest hashes, and at most
``PER_TEXT`` of each from one text.  Base spans, written variants of them (other separators,
spelt-out marks, no country prefix) and numbers that are no personal data are learnt by gradient
ascent on the log-likelihood.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import random
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.llm.names import column, own

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 26
REACH = 48
MAX_REGIONS = 240
PER_TEXT = 3
MAX_STRETCH = 600
PIECE = 8000  # characters of a lattice; features are held for no more at a time
MARGIN = 1200
MIN_CONFIDENCE = 0.95

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a start inside a run of digits fails or matches as the run's start does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind's index, start, end (code points, end exclusive)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def ip_parts_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255
               for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The base patterns' spans, by kind, then start; linear in the text's length."""
    out: list[Span] = []
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = at = m.end()
        else:
            done = at = at + 1
    if _DIGIT.search(text):
        out += [(1, *m.span()) for m in _IP.finditer(text) if ip_parts_ok(m.group())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = _NO_DIGIT.sub("", m.group())
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text)
                    if 8 <= len(_NO_DIGIT.sub("", m.group())) <= 15]
    return out


_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9]+|@|[\[(](?:at|dot)[\])]", re.I)
_AT = re.compile(r"\s?(?:[\[(]at[\])]|@)\s?", re.I)
_DOT = re.compile(r"\s?(?:[\[(]dot[\])]|\[\.\]|\.)\s?", re.I)
_MAIL_LIKE = re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)*\.[A-Za-z]{2,10}", re.A)
_CONTEXT = {  # context words that often come before personal data
    "email", "mail", "contact", "tel", "phone", "call", "fax", "mobile", "ip", "host", "server",
    "address", "card", "visa", "mastercard", "payment", "account", "cell"}


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches of text around triggers, merged where they meet and ended at white space."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    for r in out:
        while r[0] > 0 and r[0] < r[1] and not text[r[0] - 1].isspace() and text[r[0]].isalpha():
            r[0] += 1
    return [(a, b) for a, b in out if a < b]


def _size(n: int) -> str:
    return str(n) if n < 20 else "20+"


def _neighbour(c: str) -> str:
    return ("edge" if not c else "space" if c.isspace() else "digit" if c.isdigit() else
            "letter" if c.isalpha() else "stop" if c in ".,;:!?)\"'" else "mark")


def span_features(text: str, a: int, b: int, kind: int, before: str) -> list[str] | None:
    """Features of the whole span text[a:b] as ``kind``; None if it can't be one at all."""
    span, k = text[a:b], KINDS[kind]
    f = [k, f"{k}<{_neighbour(text[a - 1:a])}", f"{k}>{_neighbour(text[b:b + 1])}"]
    if before in _CONTEXT:
        f.append(f"{k}~{before}")
    if kind == 0:
        plain = _DOT.sub(".", _AT.sub("@", span))
        if plain.count("@") != 1:
            return None
        f.append(f"{k}like={bool(_MAIL_LIKE.fullmatch(plain))}")
        f.append(f"{k}plain={plain == span}")
        return f
    digits = _NO_DIGIT.sub("", span)
    if kind == 1:
        parts = span.replace("[.]", ".").split(".")
        if len(parts) != 4 or not all(p.isdigit() and p.isascii() for p in parts):
            return None
        f.append(f"{k}ok={ip_parts_ok('.'.join(parts))}")
        f.append(f"{k}short={all(len(p) <= 3 for p in parts)}")
        return f
    groups = [len(g) for g in re.split(r"[^0-9]+", span) if g]
    marks = "".join(sorted(set(_DIGIT.sub("", span))))
    if kind == 2:
        if not 13 <= len(digits) <= 19 or set(marks) - set(" -./"):
            return None
        f.append(f"{k}luhn={luhn(digits)}&16+={len(digits) >= 16}&one={len(marks) < 2}")
        f.append(f"{k}groups={'4s' if groups[:-1] == [4] * (len(groups) - 1) else 'odd'}")
        return f
    if not 7 <= len(digits) <= 15 or set(marks) - set("+ -.()"):
        return None
    f += [f"{k}n={_size(len(digits))}", f"{k}marks={marks}",
          f"{k}groups={'-'.join(map(str, groups[-3:]))}", f"{k}plus={span[0] == '+'}",
          f"{k}pairs={span.count('(') == span.count(')')}"]
    return f


class Lattice:
    """Candidate segments of one region: (from atom, to atom, kind, features)."""

    def __init__(self, text: str, a: int, b: int):
        atoms = [m.span() for m in _ATOM.finditer(text, a, b)]
        self.n = len(atoms)
        self.atoms = atoms
        words = [text[x:y] for x, y in atoms]
        digit = [w[0] in "0123456789" for w in words]
        alpha = [w[0].isalpha() for w in words]
        self.by_end: list[list[tuple[int, int, list[str]]]] = [[] for _ in range(self.n + 1)]
        before, last = [""] * self.n, ""
        for i, w in enumerate(words):
            before[i] = last
            if alpha[i]:
                last = w.lower()
        for i in range(self.n):
            if not (digit[i] or alpha[i] or words[i] in "+("):
                continue
            letters = at = 0
            n_digits = len(words[i]) if digit[i] else 0
            for j in range(i, min(self.n, i + MAX_ATOMS)):
                if j > i:
                    n_digits += len(words[j]) if digit[j] else 0
                if "\n" in words[j] or n_digits > 40:
                    break
                letters += alpha[j]
                at += words[j] == "@" or words[j].lower() == "at"
                if at > 1 or not (digit[j] or alpha[j]):
                    continue
                x, y = atoms[i][0], atoms[j][1]
                if at and j > i + 1 and (digit[i] or alpha[i]):
                    kinds: tuple[int, ...] = (0,)
                elif not letters and n_digits >= 4:
                    kinds = (1, 2, 3)
                else:
                    continue
                for k in kinds:
                    if f := span_features(text, x, y, k, before[i]):
                        self.by_end[j + 1].append((i, k, f))

    def scored(self, w: dict[str, float]) -> list[list[tuple[int, int, float]]]:
        return [[(i, k, sum(w.get(x, 0.0) for x in f)) for i, k, f in s] for s in self.by_end]

    def forward(self, s: list[list[tuple[int, int, float]]]) -> list[float]:
        z = [0.0] * (self.n + 1)
        for j in range(1, self.n + 1):
            z[j] = _logsum([z[j - 1], *(z[i] + v for i, _, v in s[j])])
        return z

    def backward(self, s: list[list[tuple[int, int, float]]]) -> list[float]:
        by_start: list[list[tuple[int, float]]] = [[] for _ in range(self.n + 1)]
        for j, seg in enumerate(s):
            for i, _, v in seg:
                by_start[i].append((j, v))
        z = [0.0] * (self.n + 1)
        for i in range(self.n - 1, -1, -1):
            z[i] = _logsum([z[i + 1], *(z[j] + v for j, v in by_start[i])])
        return z

    def marginals(self, w: dict[str, float]) -> Iterator[tuple[int, int, int, list[str], float]]:
        s = self.scored(w)
        f, b = self.forward(s), self.backward(s)
        for j, seg in enumerate(s):
            for (i, k, feats), (_, _, v) in zip(self.by_end[j], seg):
                yield i, j, k, feats, math.exp(min(0.0, f[i] + v + b[j] - f[self.n]))

    def decode(self, w: dict[str, float], min_confidence: float) -> list[Span]:
        """Segments of the best path whose marginal reaches ``min_confidence``."""
        if not any(self.by_end):
            return []
        s = self.scored(w)
        best, back = [0.0] * (self.n + 1), [(0, -1)] * (self.n + 1)
        for j in range(1, self.n + 1):
            best[j], back[j] = best[j - 1], (j - 1, -1)
            for i, k, v in s[j]:
                if best[i] + v > best[j]:
                    best[j], back[j] = best[i] + v, (i, k)
        sure = {(i, j, k): p for i, j, k, _, p in self.marginals(w)}
        out, j = [], self.n
        while j > 0:
            i, k = back[j]
            if k >= 0 and sure[i, j, k] >= min_confidence:
                out.append((k, self.atoms[i][0], self.atoms[j - 1][1]))
            j = i
        return out[::-1]


def _logsum(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x)) if len(x) > 1 else m


def variants(kind: int, span: str, rng: random.Random) -> list[str]:
    """Other ways to write a base span, for training."""
    if kind == 0:
        user, _, host = span.partition("@")
        return [f"{user} [at] {host.replace('.', ' [dot] ')}", f"{user}(at){host}",
                f"{user} @ {host}"]
    if kind == 1:
        return [span.replace(".", "[.]")]
    digits = _NO_DIGIT.sub("", span)
    if kind == 2:
        return [s.join(digits[i:i + 4] for i in range(0, len(digits), 4)) for s in ("./"[
            rng.randrange(2)], " ", "-")]
    if len(digits) < 10:
        return []
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}"]


def others(rng: random.Random) -> list[str]:
    """Numbers that are no personal data, for training."""
    r = rng.randrange
    return [f"{r(1900, 2100)}-{r(10, 13)}-{r(10, 29)}", f"{r(10, 29)}.{r(10, 13)}.{r(1900, 2100)}",
            str(r(10 ** 15, 10 ** 16) * 10 + 1), f"{r(1, 99)}.{r(1, 99)}.{r(1, 99)}",
            f"{r(1, 999)},{r(100, 999)}.{r(10, 99)}", str(r(10 ** 6, 10 ** 11)),
            f"{r(1900, 2000)}-{r(2000, 2100)}", f"{r(300, 999)}.{r(300, 999)}.{r(1, 99)}.{r(1, 99)}",
            f"{r(10, 24)}:{r(10, 60)}:{r(10, 60)}", f"ISBN 978-{r(1, 9)}-{r(10, 99)}-{r(100000, 999999)}-{r(1, 9)}",
            f"#{r(1000, 99999)} {r(1, 999)} {r(1, 999)} {r(1, 999)}", f"{r(1, 99)} @ {r(1, 99)}"]


Example = tuple[str, tuple[Span, ...]]


def _order(example: Example) -> int:
    """Place of a stretch in the order of choice: a hash of its content."""
    return int.from_bytes(hashlib.blake2b(repr(example).encode("utf-8", "surrogatepass"),
                                          digest_size=8).digest(), "big", signed=True)


def stretches(text: str) -> Iterator[Example]:
    """Regions with their base spans; those beyond ``MAX_STRETCH`` characters in pieces that
    cut no base span.  Of overlapping base spans the first counts."""
    gold: list[Span] = []
    for s in sorted(base_spans(text), key=lambda s: (s[1], s[0])):
        if not gold or s[1] >= gold[-1][2]:
            gold.append(s)
    at = 0
    for a, end in regions(text):
        while a < end:
            b = min(end, a + MAX_STRETCH)
            if b < end and (space := text.rfind(" ", a + MAX_STRETCH // 2, b)) >= 0:
                b = space
            while at < len(gold) and gold[at][1] < a:
                at += 1
            last = at
            while last < len(gold) and gold[last][1] < b:
                b = max(b, gold[last][2])
                last += 1
            # a cut at an earlier region's span or a very long span: no example
            if b - a <= 2 * MAX_STRETCH and not (at and gold[at - 1][2] > a):
                yield text[a:b], tuple((k, x - a, y - a) for k, x, y in gold[at:last])
            a = b


class Choice:
    """The ``n`` different stretches of the smallest hashes for each kind of span that is in
    them, and for those without any (kind -1)."""

    def __init__(self, n: int):
        self.n = n
        self.best: dict[int, dict[int, Example]] = {}
        self.heap: dict[int, list[int]] = {}

    def add(self, kind: int, order: int, example: Example) -> None:
        best, heap = self.best.setdefault(kind, {}), self.heap.setdefault(kind, [])
        if order in best or len(best) >= self.n and order > -heap[0]:
            return
        best[order] = example
        heapq.heappush(heap, -order)
        if len(heap) > self.n:
            del best[-heapq.heappop(heap)]

    def add_text(self, text: str) -> None:
        own = Choice(PER_TEXT)
        for example in stretches(text):
            order = _order(example)
            for k in {k for k, *_ in example[1]} or {-1}:
                own.add(k, order, example)
        for k, order, e in own.rows():
            self.add(k, order, e)

    def rows(self) -> Iterator[tuple[int, int, Example]]:
        for k in sorted(self.best):
            for order in sorted(self.best[k]):
                yield k, order, self.best[k][order]


def train(texts: list[str], max_regions: int = MAX_REGIONS, **options) -> dict[str, float]:
    """Weights of the field from at most ``max_regions`` stretches of ``texts`` for each kind
    and as many without a base span."""
    choice = Choice(max_regions)
    for t in texts:
        choice.add_text(t)
    return train_on({order: e for _, order, e in choice.rows()}.values(), **options)


def train_on(chosen: Iterable[Example], epochs: int = 4, rate: float = 0.5,
             l2: float = 1e-3) -> dict[str, float]:
    """Weights of the field from stretches and their variants; without any base span in them
    the weights are empty and nothing is added."""
    rng = random.Random(11)
    examples: list[tuple[str, list[Span]]] = []
    for part, gold in chosen:
        examples.append((part, list(gold)))
        for k, x, y in gold[:1] if len(gold) == 1 else ():
            choice = [(v, True) for v in variants(k, part[x:y], rng)]
            choice += [(v, False) for v in rng.sample(others(rng), 3)]
            for v, good in choice:
                examples.append((part[:x] + v + part[y:], [(k, x, x + len(v))] if good else []))
    rng.shuffle(examples)
    kinds = {k for _, g in examples for k, *_ in g}
    if not kinds:
        return {}
    data = []
    for part, gold in examples:
        lat = Lattice(part, 0, len(part))
        data.append((lat, {(k, x, y) for k, x, y in gold}))
    w: dict[str, float] = {}
    total: dict[str, float] = {}
    for _ in range(epochs):
        rng.shuffle(data)
        for lat, gold in data:
            step: dict[str, float] = {}
            for i, j, k, feats, p in lat.marginals(w):
                g = ((k, lat.atoms[i][0], lat.atoms[j - 1][1]) in gold) - p
                if abs(g) > 1e-4:
                    for x in feats:
                        step[x] = step.get(x, 0.0) + g
            for x, g in step.items():
                g -= l2 * w.get(x, 0.0)
                total[x] = total.get(x, 1e-2) + g * g
                w[x] = w.get(x, 0.0) + rate * g / math.sqrt(total[x])
    return w


def find_spans(text: str, w: dict[str, float], min_confidence: float = MIN_CONFIDENCE
               ) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans, both by kind, then start."""
    base = sorted(base_spans(text))
    found = list(base)
    if w:
        taken = sorted((a, b) for _, a, b in base)
        at = 0
        for a, b in regions(text):
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            for k, x, y in _decoded(text, a, b, w, min_confidence):
                if not any(x < q and p < y for p, q in _near(taken, at, b)):
                    found.append((k, x, y))
    return base, sorted(found)


def pieces(text: str, a: int, b: int) -> Iterator[tuple[int, int, int, int]]:
    """A region in pieces of bounded length: (from, to) of the field's lattice and (first, last)
    of the starts that count there.  Pieces end at a line end, which no segment crosses, else at
    white space, and have ``MARGIN`` characters of their neighbours at both ends."""
    first = a
    while b - first > PIECE:
        last = _gap(text, first + PIECE // 2, first + PIECE)
        yield (max(a, _gap(text, first - MARGIN, first - MARGIN // 2)),
               min(b, _gap(text, last + MARGIN // 2, last + MARGIN)), first, last)
        first = last
    yield max(a, _gap(text, first - MARGIN, first - MARGIN // 2)) if first > a else a, b, first, b


def _gap(text: str, x: int, y: int) -> int:
    """The place after the last line end of text[x:y], else after its last white space, else y."""
    x, y = max(x, 0), max(y, 0)
    if (at := text.rfind("\n", x, y)) >= 0:
        return at + 1
    for at in range(min(y, len(text)) - 1, x - 1, -1):
        if text[at].isspace():
            return at + 1
    return y


def _decoded(text: str, a: int, b: int, w: dict[str, float], min_confidence: float
             ) -> Iterator[Span]:
    """The field's spans of a region.  Regions of up to ``PIECE`` characters are decoded at
    once; in longer ones a span counts in the piece that it starts in, unless one found before
    reaches into it."""
    end = a
    for lo, hi, first, last in pieces(text, a, b):
        for k, x, y in Lattice(text, lo, hi).decode(w, min_confidence):
            if first <= x < last and x >= end:
                yield k, x, y
                end = y


def _near(taken: list[tuple[int, int]], at: int, end: int) -> Iterator[tuple[int, int]]:
    while at < len(taken) and taken[at][0] < end:
        yield taken[at]
        at += 1


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


_EXAMPLE = "kind int, place long, part string, gold string"


def fit_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            max_regions: int = MAX_REGIONS) -> dict[str, float]:
    """Train on stretches of all texts, at most ``max_regions`` for each kind of base span and as
    many without any; each task passes on no more than that, and the choice depends on the
    texts' content only (ids are not read).  Null texts have none."""
    names = [f.split()[0] for f in _EXAMPLE.split(", ")]
    types = [pa.int32(), pa.int64(), pa.string(), pa.string()]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        choice = Choice(max_regions)
        for b in batches:
            for t in b.column(0):
                choice.add_text(t.as_py())
        rows = [(k, order, part, json.dumps(gold)) for k, order, (part, gold) in choice.rows()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], types[i]) for i in range(len(types))], names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted(tuple(x.as_py() for x in r) for b in it for r in zip(*b.columns))
        w = train_on({order: (part, tuple(tuple(g) for g in json.loads(gold)))
                      for _, order, part, gold in got}.values())
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(w)])], ["model"])

    chosen = (docs.select(column(text_col).cast("string").alias("t")).filter("t is not null")
              .mapInArrow(choose, _EXAMPLE).dropDuplicates(["kind", "place"])
              .withColumn("n", F.row_number().over(Window.partitionBy("kind").orderBy("place")))
              .filter(F.col("n") <= max_regions).drop("n"))
    got = chosen.coalesce(1).mapInArrow(run, "model string").first()
    return json.loads(got["model"]) if got else {}


_FOUND = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                       T.StructField("base_sha256", T.StringType()),
                       T.StructField("spans", T.StringType())])


def pii_columns(text: Column, w: dict[str, float],
                min_confidence: float = MIN_CONFIDENCE) -> Column:
    """Struct of the number of spans of each kind (base and added), SHA-256 of the base spans
    and all spans as text; null and empty texts have none."""

    @F.arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            n: list[list[int]] = [[] for _ in KINDS]
            sha, text = [], []
            for v in arr:
                base, spans = find_spans(v.as_py() or "", w, min_confidence)
                for k in range(len(KINDS)):
                    n[k].append(sum(s[0] == k for s in spans))
                sha.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
                text.append(spans_text(spans))
            yield pa.StructArray.from_arrays(
                [*[pa.array(x, pa.int64()) for x in n], pa.array(sha, pa.string()),
                 pa.array(text, pa.string())], names=[f.name for f in _FOUND.fields])

    return found(F.coalesce(text, F.lit("")))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_regions: int = MAX_REGIONS, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    Every row is searched whole, repeated rows and null ids too; columns of ``docs`` with one
    of these names (in any case) are replaced, all others pass unchanged."""
    w = fit_pii(docs, id_col, text_col, max_regions)
    new = [f.name for f in _FOUND.fields]
    keep = [column(c) for c in docs.columns if c.lower() not in new]
    pii = own("_pii", docs)
    return (docs.select(*keep, pii_columns(column(text_col), w, min_confidence).alias(pii))
            .select(*keep, *[F.col(pii)[c].alias(c) for c in new]))
