"""WARC archives: exact round trips."""

import glob
import gzip
import hashlib
import random

import pytest

from tabrix.llm import warc


def expected(rows):
    payload = [(i, (h or "").encode()) for i, h in rows]
    first = {}
    for i, p in payload:
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in payload:
        ref = first.get(p) if len(p) >= 100 else None
        revisit = ref is not None and ref != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(),
                    "revisit" if revisit else "response", ref if revisit else None))
    return sorted(out, key=repr)


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}\r\nA: b", h, "clash") for i, h in rows],
                                 "page_id long, url string, html string, digest string")


def test_round_trip_of_awkward_pages(spark, tmp_path):
    rng = random.Random(4)
    tricky = ["".join(rng.choice("\r\n\r\nab0é") for _ in range(rng.randint(0, 400)))
              for _ in range(40)]
    rows = list(enumerate([None, "", "x" * 99, "x" * 100, "x" * 100, "y" * 99, "y" * 99,
                           "WARC/1.1\r\n\r\n" * 30, "z" * 200_000, "z" * 200_000, *tricky]))
    rows += [(None, "x" * 100), (None, "n" * 150), (None, "n" * 150), (3, "x" * 100), (None, None)]
    got = warc.round_trip(pages(spark, rows), str(tmp_path / "a"), segment_bytes=500)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_archives_are_plain_warc_files(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "q" * 3000)]), str(tmp_path / "b"), segment_bytes=1000)
    data = b"".join(gzip.open(f).read() for f in glob.glob(str(tmp_path / "b" / "*.gz")))
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
    assert data.count(b"WARC-Type: continuation") >= 3
    assert data.count(b"WARC-Segment-Total-Length") == 1


def test_missing_segment_fails(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "q" * 3000)]), str(tmp_path / "c"), segment_bytes=1000)
    records = warc.read_records(spark, str(tmp_path / "c"))
    with pytest.raises(Exception, match="not complete"):
        warc.reassemble(records.filter("segment is null or segment <> 2")).collect()


def test_no_pages(spark, tmp_path):
    assert warc.round_trip(pages(spark, []).limit(0), str(tmp_path / "d")).count() == 0


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 9000):
        p = bytes(i % 251 for i in range(n))
        assert warc.dechunked(warc.chunked(p)) == p
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nT: v\r\n\r\n") == b"abc"
    for bad in (b"3\r\nab\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"1\r\na\r\n0\r\n\r\nmore"):
        with pytest.raises(ValueError):
            warc.dechunked(bad)
