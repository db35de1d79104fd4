"""Personal data: base patterns against plain regular expressions, the field's additions."""

import hashlib
import itertools
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabrix.llm import pii_semicrf as S
from tests.llm import common


def plain(t):
    out = [(0, *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]

    def digits(m):
        return re.sub(r"[^0-9]", "", m.group())

    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in digits(m)]
        total = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 8 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("aZ0123456789..@@+-+- ()%é\n4"), max_size=70))
def test_base_spans(text):
    assert S.base_spans(text) == plain(text)


def test_base_spans_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "@" * 300_000):
        assert S.base_spans(text) is not None


@pytest.fixture(scope="module")
def weights(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = docs.filter("doc_id < 2500").orderBy("doc_id").select("text").collect()
    return S.train([r["text"] for r in rows])


def test_field_adds_written_variants_and_leaves_other_numbers(weights):
    def added(t):
        base, spans = S.find_spans(t, weights)
        assert set(base) <= set(spans)
        return [(S.KINDS[k], t[a:b]) for k, a, b in spans if (k, a, b) not in base]

    assert added("write to john.doe [at] example [dot] com today") == [
        ("email", "john.doe [at] example [dot] com")]
    assert added("write to john.doe [AT] example [DOT] com today") == [
        ("email", "john.doe [AT] example [DOT] com")]
    assert ("ip", "10[.]0[.]0[.]1") in added("the host 10[.]0[.]0[.]1 is up")
    for t in ("on 2021-05-17 and 12.05.2021", "version 3.11.2 of 2024", "ISBN 978-3-16-148410-0",
              "order 1234567 of 99", "a@b", 'token = "f33e61083db5dbdf4b"', "1,234.56 and 7%"):
        assert added(t) == []


def test_marginals_and_best_path_equal_enumeration(weights):
    text = "x +1 (521) 555-6210 y"
    lat = S.Lattice(text, 0, len(text))
    seg = [(i, j + 0, k, sum(weights.get(f, 0) for f in feats))
           for j in range(lat.n + 1) for i, k, feats in lat.by_end[j]]
    paths = {}
    for r in range(3):
        for choice in itertools.combinations(seg, r):
            s = sorted(choice)
            if all(a[1] <= b[0] for a, b in itertools.pairwise(s)):
                paths[tuple(x[:3] for x in s)] = sum(x[3] for x in s)
    z = math.log(sum(math.exp(v) for v in paths.values()))
    for i, j, k, _, p in lat.marginals(weights):
        want = sum(math.exp(v - z) for path, v in paths.items() if (i, j, k) in path)
        assert p == pytest.approx(want, abs=1e-6)
    best = max(paths, key=paths.get)
    assert lat.decode(weights, 0.0) == [(k, lat.atoms[i][0], lat.atoms[j - 1][1])
                                        for i, j, k in best]


def test_query_on_whole_texts(spark):
    from tabrix.llm.queries import QUERIES
    rows = QUERIES["op9_personal_data"](spark, common.SF_SMALL).collect()
    texts = common.texts_of(common.documents(spark))
    assert len(rows) == len(texts)
    for r in rows:
        base = ",".join(f"{S.KINDS[k]}:{a}:{b}" for k, a, b in sorted(plain(texts[r["doc_id"]])))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(filter(None, base.split(","))) <= set(spans)
        for kind in S.KINDS:
            assert r[f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)


def test_awkward_rows(spark):
    docs = common.awkward(spark, "Spans int").unionByName(spark.createDataFrame(
        [(60, "mail a@b.co " * 3, 1)], "doc_id long, text string, Spans int"))
    rows = S.find_pii(docs).collect()
    assert len(rows) == docs.count()
    assert [r["n_email"] for r in rows if r["doc_id"] == 60] == [3]
    assert S.find_pii(common.empty(spark)).count() == 0


def planted(rng):
    """One base span of each kind."""
    def n(k):
        return "".join(str(rng.randrange(10)) for _ in range(k))
    card = next(c for c in iter(lambda: "4" + n(15), None) if S.luhn(c))
    return (f"ann.{rng.choice(("lee", "day", "fox"))}{n(2)}@host.com", ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
            card, f"+1 {rng.randrange(200, 999)} {rng.randrange(200, 999)} {n(4)}")


def test_registered_query_learns_from_all_texts(spark, tmp_path):
    from tabrix.llm.queries import QUERIES
    rng = random.Random(4)
    filler = "nothing of note is said in this place " * 4
    texts = ["".join(f"{filler}{rng.randrange(10 ** 6)} " for _ in range(150)) for _ in range(12)]
    texts += [f"{filler}see {s} there" for _ in range(60) for s in planted(rng)]
    new = ["ann.lee [at] example [dot] com", "10[.]20[.]30[.]40", "4111/1111/1111/1111",
           "(521) 555-6210"]
    texts += [f"{filler}see {s} there" for s in new]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["spans"] for r in QUERIES["op9_personal_data"](
        spark, str(tmp_path)).collect()}
    at = len(filler) + 4
    assert [got[len(texts) - 4 + k] for k in range(4)] == [
        f"{S.KINDS[k]}:{at}:{at + len(new[k])}" for k in range(4)]


def test_choice_is_bounded_and_independent_of_order():
    rng = random.Random(8)
    texts = [f"see {s} " + "and so on " * 12 + str(i) for i in range(40) for s in planted(rng)]
    texts += ["1 " * 5000, "no " * 60 + "2@ " + "a b " * 9, "\ud800 3"]
    long = "".join(f"{'so it is ' * 12}{i} " for i in range(500))
    some = []
    for order in (texts + [long], [long] + texts[::-1]):
        choice = S.Choice(9)
        for t in order:
            choice.add_text(t)
        some.append(list(choice.rows()))
    assert some[0] == some[1]
    assert [sum(k == x for k, *_ in some[0]) for x in range(-1, 4)] == [9] * 5
    one = S.Choice(100)
    one.add_text(long)
    assert len(list(one.rows())) == S.PER_TEXT
    for t in texts:
        for part, gold in S.stretches(t):
            assert len(part) <= 2 * S.MAX_STRETCH
            assert set(gold) <= set(S.base_spans(part))


def test_number_dense_text_is_cut_into_bounded_pieces(monkeypatch):
    import random
    from tabrix.llm import pii_semicrf as P
    rng = random.Random(3)
    text = " ".join(str(rng.randrange(10 ** rng.randrange(1, 6))) for _ in range(9000))
    text = text[:15000] + " mail ann [at] site [dot] org now " + text[15000:]
    longest = []
    real = P.Lattice

    class Watched(real):
        def __init__(self, t, a, b):
            longest.append(b - a)
            super().__init__(t, a, b)

    monkeypatch.setattr(P, "Lattice", Watched)
    (a, b), *more = P.regions(text)
    assert not more and b - a > 3 * P.PIECE
    cut = list(P.pieces(text, a, b))
    assert cut[0][2] == a and cut[-1][3] == b
    assert all(x[3] == y[2] for x, y in zip(cut, cut[1:]))
    w = {"email": -3.0, "emaillike=True": 9.0, "phone": -1.0, "card": -1.0, "ip": -1.0}
    got = list(P._decoded(text, a, b, w, 0.9))
    assert max(longest) <= P.PIECE + 2 * P.MARGIN
    assert got == real(text, a, b).decode(w, 0.9)
    assert any(text[x:y].startswith("ann [at] site") for _, x, y in got)
