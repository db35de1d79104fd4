"""The pipeline: stages in order, their decisions, agreement with the operators."""

import corpus_pipeline as P
from tabrix.llm.queries import ORACLES, QUERIES
from tests.llm import common


def test_stages_and_registration():
    assert [n for n, _ in P.STAGES] == [
        "quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination",
        "bpe encoding and decoding"]
    assert QUERIES["pipeline"] is P.run
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_each_stage_on_its_own_input(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tests.llm.test_decontamination import brute
    from tests.llm.test_lines import brute as brute_lines
    from tests.llm.test_simhash import roots, slow_fingerprint
    docs = common.documents(spark)
    names = docs.columns
    kept = P.quality(spark, docs, common.SF_SMALL).cache()
    assert kept.columns == names and 0 < kept.count() <= docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(
        f"{common.SF_SMALL}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) > 0.95 * len(good)

    lines = P.line_dedup(spark, kept, common.SF_SMALL).cache()
    assert lines.columns == names
    before, after = common.texts_of(kept), common.texts_of(lines)
    gone = {(i, n) for i, n, g in brute_lines(sorted(before.items())) if g}
    assert after == {i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
                     for i, t in before.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    single = P.near_dedup(spark, lines, common.SF_SMALL).cache()
    fp = {i: slow_fingerprint(t) for i, t in after.items()}
    near = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 2]
    assert set(common.texts_of(single)) == {i for i, r in roots(fp, near).items() if i == r}

    clean = P.decontamination(spark, single, common.SF_SMALL).cache()
    assert clean.columns == names
    items = [tuple(r) for r in spark.read.parquet(f"{common.SF_SMALL}/benchmark.parquet").collect()]
    leaking = {i for i, _ in brute(common.texts_of(single).items(), items)}
    assert set(common.texts_of(clean)) == set(common.texts_of(single)) - leaking

    out = {r["doc_id"]: r["n_tokens"] for r in P.bpe_encoding(
        spark, clean, common.SF_SMALL).collect()}
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert out == {i: len(tok.encode(t, add_special_tokens=False).ids)
                   for i, t in common.texts_of(clean).items()}
