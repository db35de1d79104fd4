"""WARC archives: writing pages as records and reassembling them from segments.

Writing.  Every page becomes one logical record.  Of pages with equal payloads of at least
``min_revisit`` bytes the one with the smallest id is a ``response`` and the others are
``revisit`` records that refer to it; smaller payloads are all responses.  A response's block
is an HTTP head and the payload in chunked transfer framing; a block longer than
``segment_bytes`` is split into a first record and ``continuation`` records.  The archives are
gzip files written by Spark's text writer (each record ends with two line ends, which is the
writer's row separator), so they go to any store that Spark can write.

Reading.  Spark's text reader cuts the files at double line ends; a stream parser in each task
puts records together again by their Content-Length (payloads may hold double line ends).
Continuations are grouped by the origin's identifier, ordered by segment number, checked
against the total length, and the chunked framing is decoded.  Only segmented records are
shuffled; a group is one page's payload.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.session import checkpoint_dir

EOL = b"\r\n"
GAP = "\r\n\r\n"
VERSION = b"WARC/1.1"
HTTP_HEAD = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n")
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"
MIN_REVISIT = 100
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i:i + size]
        parts += [b"%x" % len(part), EOL, part, EOL]
    return b"".join([*parts, b"0", EOL, EOL])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped.  Raises
    ValueError on a body that is cut short or wrongly framed."""
    parts, at = [], 0
    while True:
        end = body.index(EOL, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            break
        parts.append(body[at:at + size])
        if len(parts[-1]) != size or body[at + size:at + size + 2] != EOL:
            raise ValueError("chunk does not end where its size says")
        at += size + 2
    while (end := body.index(EOL, at)) != at:  # trailer lines, then the empty line
        at = end + 2
    if at + 2 != len(body):
        raise ValueError("bytes after the last chunk")
    return b"".join(parts)


def http_payload(block: bytes) -> bytes:
    """Payload of an HTTP response block, dechunked if its head says so."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("HTTP head without end")
    names = dict(_field(line) for line in head.split(EOL)[1:])
    return dechunked(body) if names.get(b"transfer-encoding", b"").lower() == b"chunked" else body


def _field(line: bytes) -> tuple[bytes, bytes]:
    name, _, value = line.partition(b":")
    return name.strip().lower(), value.strip()


def record(fields: Iterable[tuple[bytes, bytes]], block: bytes) -> bytes:
    """One record without the double line end that follows it."""
    lines = [VERSION, *(n + b": " + v for n, v in fields), b"Content-Length: %d" % len(block)]
    return EOL.join(lines) + b"\r\n\r\n" + block


def record_id(*parts: object) -> bytes:
    name = "\x1f".join("" if p is None else str(p) for p in parts)
    return b"<urn:uuid:%s>" % str(uuid.UUID(hashlib.md5(name.encode("utf-8")).hexdigest())).encode()


def page_records(page_id: int | None, url: str | None, payload: bytes, digest: str,
                 refers_to: int | None, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page; ``refers_to`` is the response's id for a revisit."""
    origin = record_id(page_id, digest, refers_to)
    uri = (url or "").translate(str.maketrans("", "", "\r\n")).encode("utf-8")
    common = [(b"WARC-Date", DATE), (b"WARC-Target-URI", uri),
              (b"WARC-Payload-Digest", b"sha256:" + digest.encode())]
    if page_id is not None:
        common.append((b"X-Page-Id", b"%d" % page_id))
    http = (b"Content-Type", b"application/http; msgtype=response")
    if refers_to is not None:
        yield record([(b"WARC-Type", b"revisit"), (b"WARC-Record-ID", origin), *common,
                      (b"WARC-Profile", PROFILE),
                      (b"WARC-Refers-To", record_id(refers_to, digest, None)), http],
                     HTTP_HEAD.replace(b"Transfer-Encoding: chunked\r\n", b""))
        return
    block = HTTP_HEAD + chunked(payload)
    cut = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = [(b"WARC-Type", b"response"), (b"WARC-Record-ID", origin), *common, http]
    if len(cut) == 1:
        yield record(first, block)
        return
    yield record([*first, (b"WARC-Segment-Number", b"1")], cut[0])
    for n, part in enumerate(cut[1:], 2):
        last = [(b"WARC-Segment-Total-Length", b"%d" % len(block))] if n == len(cut) else []
        yield record([(b"WARC-Type", b"continuation"), (b"WARC-Record-ID", record_id(origin, n)),
                      (b"WARC-Segment-Origin-ID", origin), (b"WARC-Segment-Number", b"%d" % n),
                      (b"WARC-Date", DATE), *last], part)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_revisit: int = MIN_REVISIT,
                   segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write ``pages`` as gzip WARC files under ``path``.

    A null payload is empty, a null url an empty target.  Of equal payloads the smallest
    non-null id is the response; rows that repeat that id and payload are responses too.
    If all ids of a payload are null, all are responses (there is no id to refer to).
    Columns other than the three named are not read, whatever their names."""
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    src = src.withColumn("digest", F.sha2("html", 256))
    # one narrow row per repeated payload; the join's hot digest is split by skew handling
    first = (src.filter(F.octet_length("html") >= min_revisit).groupBy("digest")
             .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("digest", "first_id"))
    rows = src.join(first, "digest", "left").select(
        "id", "url", "html", "digest",
        F.when(F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id")),
               F.col("first_id")).alias("refers_to"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out, size = [], 0
            for i, url, html, digest, ref in zip(*(b.column(k) for k in range(5))):
                for r in page_records(i.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8"),
                                      digest.as_py(), ref.as_py(), segment_bytes):
                    out.append(r)
                    size += len(r)
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    # the writer copies a string's bytes as they are, so records need not be valid UTF-8
    (rows.mapInArrow(batches, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", GAP).option("compression", "gzip").text(path))


_RECORD = ("type string, record_id string, origin_id string, segment int, total long, "
           "page_id long, digest string, refers_to string, block binary")
_RECORD_ARROW = pa.schema([
    ("type", pa.string()), ("record_id", pa.string()), ("origin_id", pa.string()),
    ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()),
    ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary())])


def _parsed(pieces: Iterable[bytes]) -> Iterator[dict]:
    """Records from the pieces between double line ends, in file order.  The separators are
    put back, as a block may hold some or end in half of one."""
    gap = GAP.encode()
    it = iter(pieces)
    buf = b""
    while True:
        while gap not in buf:
            part = next(it, None)
            if part is None:
                if buf:
                    raise ValueError("the archive ends inside a record's head")
                return
            # a file's last piece may be half a separator, put back whole; heads start with W
            buf = (buf + part + gap).lstrip(EOL)
        head, _, buf = buf.partition(gap)
        if not head.startswith(VERSION):
            raise ValueError("no record starts where one should")
        f = dict(_field(line) for line in head.split(EOL)[1:])
        need = int(f[b"content-length"])
        parts, size = [buf], len(buf)
        while size < need + len(gap):
            part = next(it, None)
            if part is None:
                raise ValueError("the archive ends inside a record")
            parts += [part, gap]
            size += len(part) + len(gap)
        buf = b"".join(parts)
        block, buf = buf[:need], buf[need:]
        if not buf.startswith(gap):
            raise ValueError("a record is longer than its Content-Length")
        buf = buf[len(gap):].lstrip(EOL)

        def text(name):
            return f[name].decode("utf-8") if name in f else None

        def number(name):
            return int(f[name]) if name in f else None

        yield {"type": text(b"warc-type"), "record_id": text(b"warc-record-id"),
               "origin_id": text(b"warc-segment-origin-id"),
               "segment": number(b"warc-segment-number"),
               "total": number(b"warc-segment-total-length"), "page_id": number(b"x-page-id"),
               "digest": (text(b"warc-payload-digest") or "").rpartition(":")[2] or None,
               "refers_to": text(b"warc-refers-to"), "block": block}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path`` (an empty folder gives no row)."""
    rows = (spark.read.schema("value string").option("lineSep", GAP)
            .option("recursiveFileLookup", "true").text(path)
            .select(F.col("value").cast("binary")))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for r in _parsed(v.as_py() for b in it for v in b.column(0)):
            out.append(r)
            size += len(r["block"])
            if size >= 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_RECORD_ARROW)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema=_RECORD_ARROW)

    return rows.mapInArrow(batches, _RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: ``records`` without segments, and one row per segmented record with its
    blocks joined.  Fails if a segment is missing or the total length is not met.  Records
    written twice (same origin, segment and block) come out as often as their first segment."""
    whole = records.filter("segment is null").select(
        "type", "record_id", "page_id", "digest", "refers_to", "block")
    parts = records.filter("segment is not null").select(
        F.coalesce("origin_id", "record_id").alias("record_id"), "segment", "total", "block",
        *[F.when(F.col("segment") == 1, F.col(c)).alias(c) for c in ("type", "page_id", "digest")])
    joined = parts.groupBy("record_id").agg(
        F.first("type", True).alias("type"), F.first("page_id", True).alias("page_id"),
        F.first("digest", True).alias("digest"), F.max("total").alias("total"),
        F.count_if(F.col("segment") == 1).alias("copies"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("s"))

    ok = ((F.size("s") == F.element_at("s", -1)["segment"]) & F.col("total").isNotNull()
          & (F.octet_length("block") == F.col("total")) & (F.col("copies") > 0))
    joined = (joined.withColumn("block", F.concat(F.lit(b""), F.array_join(F.transform(
                  "s", lambda x: F.hex(x["block"])), "")))
              .withColumn("block", F.unhex(F.col("block").cast("string")))
              .withColumn("ok", F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(
                  F.lit("segments of "), "record_id", F.lit(" are not complete")))))
              .filter("ok")
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))))
    return whole.unionByName(joined.select(
        "type", "record_id", "page_id", "digest", F.lit(None).cast("string").alias("refers_to"),
        "block"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Payload length and digest of a response come from its reassembled and decoded block and
    the digest must equal the header's; a revisit takes them from the response it refers to."""
    records = reassemble(read_records(spark, path))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n, digest = [], []
            for kind, said, block in zip(b.column("type"), b.column("digest"), b.column("block")):
                if kind.as_py() == "revisit":
                    n.append(None)
                    digest.append(said.as_py())
                    continue
                payload = http_payload(block.as_py())
                n.append(len(payload))
                digest.append(hashlib.sha256(payload).hexdigest())
                if said.as_py() not in (None, digest[-1]):
                    raise ValueError("payload digest differs from the record's header")
            yield pa.RecordBatch.from_arrays(
                [b.column("type"), b.column("record_id"), b.column("page_id"),
                 b.column("refers_to"), pa.array(n, pa.int64()), pa.array(digest, pa.string())],
                ["type", "record_id", "page_id", "refers_to", "n", "digest"])

    from tabrix.session import materialize
    # narrow rows, written once: the archives are read and decoded a single time
    rows = materialize(records.mapInArrow(
        batches, "type string, record_id string, page_id long, refers_to string, n long, "
                 "digest string"))
    origin = (rows.filter("type = 'response'").groupBy("record_id")
              .agg(F.min("page_id").alias("o_page"), F.min("n").alias("o_n"),
                   F.min("digest").alias("o_digest"))
              .withColumnRenamed("record_id", "refers_to"))
    back = rows.filter("type = 'revisit'").join(origin, "refers_to", "left")
    sound = F.col("o_digest") == F.col("digest")
    back = back.select(
        "page_id", F.when(sound, F.col("o_n")).otherwise(F.raise_error(F.concat(
            F.lit("no response with this payload for revisit "), "record_id")).cast("long"))
        .alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("o_page").alias("refers_to"))
    return rows.filter("type = 'response'").select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to")).unionByName(back)


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives under ``path`` (default: a new folder in the shared
    checkpoint folder) and read them back with :func:`read_pages`."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **options)
    return read_pages(spark, path)
