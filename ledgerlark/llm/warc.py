"""WARC archives: written from pages, and read back with segments put together.

A record's HTTP response is sent in chunked transfer framing.  A block longer than
``SEGMENT_BYTES`` is split into a first record and continuation records that name the
first one (WARC-Segment-Origin-ID) and their number; the last one tells the total
length.  Spark's text writer puts the records into files: its line separator is the
CRLF CRLF that ends a WARC record, so a file holds records and nothing else.

Reading parses whole files (their size is bounded by ``FILE_RECORDS``), groups
continuation records by their origin, orders them by number, verifies the total
length, and decodes the chunked framing.

A record is named by its page_id and by a number of its row, written once, so that rows
with one page_id or a null one have segments and revisits of their own.

Defined cases: null html is an empty payload; a null page_id gets a record that no
other refers to; rows with one page_id each get a record (both a response, if theirs is
the smallest id; revisits refer to the first of them); a null url leaves WARC-Target-URI out; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm.common import chunks, stash
from ledgerlark.session import shared_dir

SEGMENT_BYTES = 16 * 1024
CHUNK = 4096
FILE_RECORDS = 4000
_END = b"\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"
_RECORD_ID = "<urn:page:{}>"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[k:k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        parts.append(framed[end + 2:end + 2 + size])
        if len(parts[-1]) != size or framed[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("broken chunk")
        at = end + 4 + size


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n"


def records(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None,
            segment: int) -> Iterator[bytes]:
    """The records of a page, each without the CRLF CRLF behind it."""
    record_id = _RECORD_ID.format(page)
    target = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", target)]
    if refers_to is not None:
        yield _header([
            ("WARC-Type", "revisit"), ("WARC-Record-ID", record_id), *common,
            ("WARC-Refers-To", _RECORD_ID.format(refers_to)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(http)))]) + http
        return
    block = http + chunked(payload)
    pieces = [block[k:k + segment] for k in range(0, len(block), segment)]
    for number, piece in enumerate(pieces, 1):
        numbered = str(number) if len(pieces) > 1 else None
        if number == 1:
            own = [("WARC-Type", "response"), ("WARC-Record-ID", record_id), *common,
                   ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Segment-Number", numbered),
                   ("Content-Type", "application/http; msgtype=response")]
        else:
            own = [("WARC-Type", "continuation"),
                   ("WARC-Record-ID", _RECORD_ID.format(f"{page}:{number}")), *common,
                   ("WARC-Segment-Origin-ID", record_id), ("WARC-Segment-Number", numbered),
                   ("WARC-Segment-Total-Length",
                    str(len(block)) if number == len(pieces) else None)]
        yield _header([*own, ("Content-Length", str(len(piece)))]) + piece


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in chunks(batch, "html"):
            payloads = [t or b"" for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([len(p) for p in payloads], pa.int64()),
                 pa.array([payload_digest(p) for p in payloads])],
                names=[*rows.schema.names, "bytes", "digest"])


def _render(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in chunks(batch, "html"):
                name, url, digest, refers = (
                    rows.column(rows.schema.get_field_index(c)).to_pylist()
                    for c in ("name", "url", "digest", "refers_to"))
                out = [r for k, text in enumerate(texts)
                       for r in records(name[k], url[k], text or b"", digest[k], refers[k], segment)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0,
                   segment: int = SEGMENT_BYTES) -> None:
    """Archives of ``pages`` (page_id, url, html) under ``path``.  Of records with equal
    payloads of at least ``least_revisit`` bytes the one with the smallest page_id is a
    response; the others are revisits of it."""
    rows = pages.select(F.monotonically_increasing_id().alias("row"),
                        F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.col("html").cast("string"))
    # Written, so that a row has one number in all that reads it.
    digested = stash(rows.mapInArrow(
        _digest, "row long, page_id long, url string, html string, bytes long, digest string"),
        "digested")
    firsts = stash(digested.where((F.col("bytes") >= least_revisit) & F.col("page_id").isNotNull()
                                  ).groupBy("digest", "bytes").agg(
        F.min(F.struct("page_id", "row")).alias("first")), "firsts")
    name = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "row")
    refers = F.expr("CASE WHEN page_id <> first.page_id THEN concat_ws(':', first.page_id, first.row) END")
    joined = digested.join(firsts, ["digest", "bytes"], "left").select(
        name.alias("name"), "url", "html", "digest", refers.alias("refers_to"))
    joined.mapInArrow(_render(segment), "record binary").select(
        F.col("record").cast("string").alias("value")
    ).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS).text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields by lower-case name, block) of each record of an archive."""
    at = 0
    while at < len(content):
        end = content.index(_END, at)
        version, *lines = content[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("no WARC record here")
        fields = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        size = int(fields["content-length"])
        block = content[end + 4:end + 4 + size]
        if len(block) != size or content[end + 4 + size:end + 8 + size] != _END:
            raise ValueError("record cut short")
        yield fields, block
        at = end + 8 + size


_PART = ("record_id string, kind string, target string, origin string, number int, total long, "
         "refers_to string, digest string, block binary")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in _PART.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(),
             pa.string(), pa.string(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for content in batch.column(0):
            raw = content.as_py()
            if raw[:2] == b"\x1f\x8b":
                raw = zlib.decompress(raw, wbits=31)
            rows, size = [], 0
            for fields, block in parse(raw):
                whole = fields.get("warc-segment-number") is None
                total = fields.get("warc-segment-total-length")
                rows.append((
                    fields["warc-record-id"], fields["warc-type"], fields.get("warc-target-uri"),
                    None if whole else fields.get("warc-segment-origin-id", fields["warc-record-id"]),
                    int(fields.get("warc-segment-number", 1)),
                    len(block) if whole else None if total is None else int(total),
                    fields.get("warc-refers-to"),
                    fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, block))
                size += len(block)
                if size >= 4 << 20:
                    yield table(rows)
                    rows, size = [], 0
            yield table(rows)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, blocks in chunks(batch, "block"):
            kinds = rows.column(rows.schema.get_field_index("kind")).to_pylist()
            payloads = []
            for kind, block in zip(kinds, blocks):
                head, _, body = block.partition(_END)
                framed = b"transfer-encoding: chunked" in head.lower()
                payloads.append(None if kind == "revisit" else unchunked(body) if framed else body)
            yield pa.RecordBatch.from_arrays(
                [*(c for c, n in zip(rows.columns, rows.schema.names) if n != "block"),
                 pa.array(payloads, pa.binary())],
                names=[*(n for n in rows.schema.names if n != "block"), "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, kind, target, refers_to, digest (as the header has it) and payload
    (null for revisits) of each record under ``path``.  Only records in segments are
    shuffled.  A record whose segments don't add up to the total length is an error."""
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = files.mapInArrow(_parts, _PART)
    single = parts.where("origin IS NULL").select(
        "record_id", "kind", "target", "refers_to", "digest", "block")
    grouped = parts.where("origin IS NOT NULL").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct(
            "number", "kind", "target", "digest", "block"))).alias("s"),
        F.max("total").alias("total"))
    block = F.expr("aggregate(s, CAST('' AS binary), (b, x) -> concat(b, x.block))")
    checked = F.when(
        (F.length("block") == F.col("total"))
        & F.expr("s.number = sequence(1, size(s))"), F.col("block")
    ).otherwise(F.raise_error(F.concat(F.lit("segments missing of "), "origin")))
    rejoined = grouped.withColumn("block", block).select(
        F.col("origin").alias("record_id"), F.col("s")[0]["kind"].alias("kind"),
        F.col("s")[0]["target"].alias("target"), F.lit(None).cast("string").alias("refers_to"),
        F.col("s")[0]["digest"].alias("digest"), checked.alias("block"))
    return single.union(rejoined).mapInArrow(
        _payloads, "record_id string, kind string, target string, refers_to string, "
                   "digest string, payload binary")


def _named(column: str, group: int):
    """The page_id (1) or the row's number (2) in a record's name."""
    return F.regexp_extract(column, "^<urn:page:(-?[0-9]+|null):([0-9]+)>$", group).try_cast("long")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, payloads in chunks(batch, "payload"):
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:6],
                 pa.array([None if p is None else len(p) for p in payloads], pa.int64()),
                 pa.array([None if p is None else payload_digest(p) for p in payloads])],
                names=["page_id", "row", "kind", "refers_to", "first_row", "digest", "size", "own"])


def archive_round_trip(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Write ``pages``, read the archives, and tell of each record what was read.  Of a
    revisit, size and digest come from the response it refers to."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_revisit)
    found = read_archives(spark, path).select(
        _named("record_id", 1).alias("page_id"), _named("record_id", 2).alias("row"), "kind",
        _named("refers_to", 1).alias("refers_to"), _named("refers_to", 2).alias("first_row"),
        "digest", "payload")
    read = stash(found.mapInArrow(
        _measured, "page_id long, row long, kind string, refers_to long, first_row long, "
                   "digest string, size long, own string"), "records")
    responses = read.where("kind = 'response' AND page_id IS NOT NULL").select(
        F.col("row").alias("first_row"), F.col("size").alias("first_size"),
        F.col("own").alias("first_own"))
    responses = stash(responses, "responses")  # plain shuffles in the join: hot keys are split
    return read.join(responses, "first_row", "left").select(
        "page_id", F.coalesce("size", "first_size").alias("payload_bytes"),
        F.when(F.coalesce("own", "first_own") != F.col("digest"), F.raise_error(F.concat(
            F.lit("the digest of a record of page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
            F.lit(" does not hold")))).otherwise(F.coalesce("own", "first_own")).alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to",
        (F.coalesce("own", "first_own") == F.col("digest")).alias("digest_holds"))
