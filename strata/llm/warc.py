"""WARC archives (operator 7): writing records, reading them back, putting segments together.

Writing: one record per page, a ``response`` with an HTTP head and the payload in chunked transfer
framing. Of pages with equal payloads of at least ``MIN_SHARED`` bytes, the one with the smallest
page_id is the response; the others become ``revisit`` records that refer to it and hold no
payload. A block longer than ``segment`` bytes is cut: the first part stays in the response
(WARC-Segment-Number 1), the rest goes to ``continuation`` records that name its record id as
their origin, the last of which states the total length. Records are gzipped text files written by
Spark's own writer, one a task, so archives can lie in any store Spark writes to.

Reading: each archive is one row of Spark's binary reader and is parsed record by record from its
Content-Length fields, without a search for separators. Whole records are decoded where they are
read. Only parts of segmented records are shuffled: they are grouped by origin id, ordered by
segment number, checked (numbers without a gap, stated total length) and then decoded from their
chunked framing. Revisits take payload length and digest from the response they refer to.

Bounds: an archive has at most ``ARCHIVE_RECORDS`` records, none much longer than ``segment``, so
its size is bounded and a Python worker can hold it. The parts of one record are one page and must
fit one too.

Cases: NULL html is an empty payload. Short and empty payloads are always responses. Record ids
are made from page_id and payload, so rows that share a page_id keep apart; if several rows share
the smallest page_id of a payload, each of them is a response. A NULL page_id never is the
smallest; it is written as an empty id and read back as NULL. A record that breaks a rule, or whose
payload differs from its stated digest, raises ``WarcError`` with its id. An empty table reads back empty.
Only page_id, url and html are read, so other columns clash with nothing.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

from .common import stored, table

MIN_SHARED = 100                                            # bytes of a payload that may be revisited
SEGMENT = 16 << 10
CHUNK = 4 << 10                                             # bytes of a transfer chunk
ARCHIVE_RECORDS = 8000
VERSION = b"WARC/1.1"
#: The end of a line, of a head and of a record.
EOL, HEAD_END, RECORD_END = b"\r\n", b"\r\n\r\n", b"\r\n\r\n"
#: The HTTP head of a response and of a revisit.
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n")
#: The name space of record ids and the profile of revisits.
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2000-01-01T00:00:00Z"
PARTS = ("record_id string, page_id long, kind string, refers_to string, url string, segment int, "
         "origin string, total long, block binary, stated string, payload_bytes long, payload_digest string, "
         "payload binary")


class WarcError(ValueError):
    """A record that breaks the format."""


def chunked(payload: bytes) -> bytes:
    """``payload`` in chunked transfer framing."""
    cuts = (payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK))
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in cuts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload behind chunked transfer framing (extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        end = body.find(EOL, at)
        if end < 0:
            raise WarcError("a chunk has no size line")
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            raise WarcError("a chunk size is no number") from None
        at = end + 2
        if not size:
            break
        if body[at + size:at + size + 2] != EOL:
            raise WarcError("a chunk is shorter than its size")
        out.append(body[at:at + size])
        at += size + 2
    while (end := body.find(EOL, at)) > at:
        at = end + 2
    if end < 0:
        raise WarcError("the last chunk is not closed")
    return b"".join(out)


def decode_http(block: bytes) -> bytes:
    """The payload of an HTTP response with its transfer framing taken off."""
    head, found, body = block.partition(HEAD_END)
    if not found:
        raise WarcError("the HTTP head has no end")
    fields = _fields(head.split(EOL)[1:])
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        return unchunked(body)
    return body


def _fields(lines: list[bytes]) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def _record(kind: bytes, record_id: str, block: bytes, extra: list[tuple[bytes, bytes]]) -> bytes:
    head = [(b"WARC-Type", kind), (b"WARC-Record-ID", b"<" + record_id.encode() + b">"), (b"WARC-Date", DATE), *extra,
            (b"Content-Length", b"%d" % len(block))]
    return VERSION + EOL + b"".join(b"%b: %b\r\n" % h for h in head) + EOL + block


def record_name(page: int | None, digest: str) -> str:
    return uuid.uuid5(SPACE, f"page:{'' if page is None else page}:{digest}").urn


def records(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None,
            segment: int) -> list[bytes]:
    """The records of one page. ``first`` is the page whose response this one revisits, or None."""
    own = record_name(page, digest)
    uri = b"".join((url or "").encode().split()) or b"urn:page"
    common = [(b"WARC-Target-URI", uri), (b"X-Page-ID", b"" if page is None else b"%d" % page),
              (b"WARC-Payload-Digest", b"sha256:" + digest.encode())]
    if first is not None:
        extra = [*common, (b"WARC-Refers-To", b"<" + record_name(first, digest).encode() + b">"),
                 (b"WARC-Profile", PROFILE), (b"Content-Type", b"application/http; msgtype=response")]
        return [_record(b"revisit", own, HTTP, extra)]
    block = HTTP + chunked(payload)
    common.append((b"Content-Type", b"application/http; msgtype=response"))
    if len(block) <= segment:
        return [_record(b"response", own, block, common)]
    cuts = [block[i:i + segment] for i in range(0, len(block), segment)]
    out = [_record(b"response", own, cuts[0], [*common, (b"WARC-Segment-Number", b"1")])]
    for i, cut in enumerate(cuts[1:], 2):
        extra = [(b"WARC-Segment-Number", b"%d" % i), (b"WARC-Segment-Origin-ID", b"<" + own.encode() + b">")]
        if i == len(cuts):
            extra.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
        out.append(_record(b"continuation", f"{own}:{i}", cut, extra))
    return out


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(fields, block) of each record of an archive's bytes."""
    at = 0
    while at < len(data):
        end = data.find(HEAD_END, at)
        head = data[at:end].split(EOL)
        if end < 0 or head[0] != VERSION:
            raise WarcError(f"no record starts at byte {at}")
        fields = _fields(head[1:])
        at = end + len(HEAD_END)
        size = int(fields[b"content-length"])
        block = data[at:at + size]
        at += size
        if len(block) != size or data[at:at + len(RECORD_END)] != RECORD_END:
            raise WarcError(f"{fields.get(b'warc-record-id', b'?').decode()} is shorter than its Content-Length")
        at += len(RECORD_END)
        yield fields, block


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is NULL for responses."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                       F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    own = own.withColumn("digest", F.sha2("payload", 256))
    shared = stored(own.filter(F.octet_length("payload") >= MIN_SHARED).groupBy("digest")
                    .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
                    .filter((F.col("n") > 1) & F.col("first").isNotNull()).drop("n"))
    held = own.join(shared, "digest", "left")
    return held.withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))


def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Writes (page_id, url, html) rows as gzipped WARC files below ``path``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = (b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "first"))
            out: list[bytes] = []
            for row in zip(*cols):
                out += records(*row, segment)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})
                    out = []
            if out:
                yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    (plan_records(pages).mapInArrow(emit, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", RECORD_END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", archive_records).text(path))


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record below ``path``. Length and digest of the payload, and the payload itself if
    asked for, are there for whole responses; parts of segmented ones come with their block."""
    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                rows = []
                for fields, block in parse(gzip.decompress(content.as_py())):
                    rows.append(_row(fields, block, payloads))
                    if len(rows) == 256:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(load, PARTS)


def _checked(payload: bytes, stated: str | None) -> str:
    digest = hashlib.sha256(payload).hexdigest()
    if stated not in (None, digest):
        raise WarcError("its payload differs from its stated digest")
    return digest


def _row(fields: dict[bytes, bytes], block: bytes, payloads: bool) -> tuple:
    def text(name: bytes) -> str | None:
        v = fields.get(name)
        return None if v is None else v.decode().strip("<>")

    kind, record_id = text(b"warc-type"), text(b"warc-record-id")
    page, number, total = text(b"x-page-id"), text(b"warc-segment-number"), text(b"warc-segment-total-length")
    stated = (text(b"warc-payload-digest") or "").removeprefix("sha256:") or None
    whole = kind == "response" and number is None
    try:
        payload = decode_http(block) if whole else None
        return (record_id, int(page) if page else None, kind, text(b"warc-refers-to"), text(b"warc-target-uri"),
                int(number) if number else None, (text(b"warc-segment-origin-id") or record_id) if number else None,
                int(total) if total else None, block if number else None, stated,
                len(payload) if whole else None, _checked(payload, stated) if whole else None,
                payload if payloads else None)
    except ValueError as e:
        raise WarcError(f"{record_id}: {e}") from e


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(p.split() for p in PARTS.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows), types)], list(names))


def reassemble(parts: DataFrame, payloads: bool = True) -> DataFrame:
    """(record_id, page_id, url, payload_bytes, payload_digest, payload) of segmented responses.

    A record that was written several times (equal rows) gives as many rows.
    """
    def join(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["segment"])
        origin, times = rows[0]["origin"], sum(r["segment"] == 1 for r in rows)
        one = [r for i, r in enumerate(rows) if not i or r["segment"] != rows[i - 1]["segment"]]
        block = b"".join(r["block"] for r in one)
        try:
            if [r["segment"] for r in one] != list(range(1, len(one) + 1)) or len(rows) != times * len(one):
                raise WarcError(f"its segments are not 1 to {len(one)}")
            if one[-1]["total"] != len(block):
                raise WarcError(f"its segments have {len(block)} bytes, not {one[-1]['total']}")
            payload = decode_http(block)
            digest = _checked(payload, one[0]["stated"])
        except WarcError as e:
            raise WarcError(f"{origin}: {e}") from e
        return pa.table({
            "record_id": [origin] * times, "page_id": pa.array([one[0]["page_id"]] * times, pa.int64()),
            "url": pa.array([one[0]["url"]] * times, pa.string()), "payload_bytes": [len(payload)] * times,
            "payload_digest": [digest] * times,
            "payload": pa.array([payload if payloads else None] * times, pa.binary())})

    return (parts.select("origin", "segment", "total", "block", "page_id", "url", "stated").groupBy("origin")
            .applyInArrow(join, "record_id string, page_id long, url string, payload_bytes long, "
                                "payload_digest string, payload binary"))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """(responses, revisits) of the archives below ``path``, parsed once into the shared folder.

    responses: record_id, page_id, url, payload_bytes, payload_digest, payload (NULL if not asked
    for). revisits: page_id, url, refers_to (a response's record_id), stated (digest).
    """
    found = stored(read_records(spark, path, payloads))
    whole = found.filter((F.col("kind") == "response") & F.col("segment").isNull()).select(
        "record_id", "page_id", "url", "payload_bytes", "payload_digest", "payload")
    parts = found.filter(F.col("segment").isNotNull())
    revisits = found.filter(F.col("kind") == "revisit").select("page_id", "url", "refers_to", "stated")
    return whole.unionByName(reassemble(parts, payloads)), revisits


def describe(responses: DataFrame, revisits: DataFrame) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id)."""
    own = stored(responses.select("record_id", "page_id", "payload_bytes", "payload_digest"))
    # only records that are revisited are looked up, and rows that share a record id are equal
    wanted = revisits.groupBy(F.col("refers_to").alias("record_id")).agg(F.count(F.lit(1)).alias("times"))
    target = stored(own.join(wanted, "record_id").groupBy(F.col("record_id").alias("refers_to"))
                    .agg(F.max(F.struct("page_id", "payload_bytes", "payload_digest")).alias("to")))
    again = revisits.select("page_id", "refers_to").join(target, "refers_to", "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (own.withColumn("record_type", F.lit("response")).withColumn("refers_to", F.lit(None).cast("long")).select(cols)
            .unionByName(again.select("page_id", F.col("to.payload_bytes"), F.col("to.payload_digest"),
                                      F.lit("revisit").alias("record_type"), F.col("to.page_id").alias("refers_to"))))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: what the archives written from ``pages`` say when read back."""
    path = shared_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return describe(*read_archives(spark, path, payloads=False))


#: DuckDB twin of op7_warc.
OP7_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_bytes >= 100 AND p.payload_digest = f.payload_digest
"""
