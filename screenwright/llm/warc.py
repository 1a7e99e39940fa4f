"""WARC archives: segmented records, revisits, and their reassembly.

Writing: each page is an HTTP response with chunked transfer framing.  A block
longer than ``segment_bytes`` is cut; the first segment keeps the response's
header, the others are ``continuation`` records that name their origin and
their number, the last one with the total length.  A payload that an earlier
page (the smallest page id) has already is a ``revisit`` without a payload.

Reading: whole records pass straight through; segments are grouped by their
origin's identifier, ordered by number and joined, their total length is
verified, the chunked framing is decoded, and the payload is held against its
digest.  Revisits are resolved by payload digest.

Archives are written by Spark's text sink, so any store will do.  Each record is
a gzip member of its own; the line separator of the sink is an empty member, so
a file is a plain multi-member archive.  Records are packed to rows of about
``pack_bytes``, and a file holds ``rows_per_file`` of them, which bounds a file
by bytes.  Small archives are read whole, large ones by byte ranges, a task each
(``ranges``): a range owns the members that begin in it, found by their magic
and the record behind it, and is decompressed a member at a time.

Record ids follow from the page (id, url, payload digest, number among rows equal
in these), so a rerun writes the same ids.  A revisit names the record that it
refers to.

Defined results: a null or empty html is an empty payload; a null url becomes
``urn:page:<id>``, control characters in a url are escaped; rows equal in page
id and payload are all of the same type; a null page id comes after all others;
an empty table gives no rows; a damaged record (missing segment, wrong length,
bad framing, wrong digest) raises an error; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwright.sources.ranges import RANGE_BYTES, Bytes, scan
from screenwright.llm.tables import with_copies
from screenwright.storage import bounded_broadcast, materialize, new_path

SEGMENT_BYTES, CHUNK_BYTES = 32 << 10, 8 << 10
PACK_BYTES, ROWS_PER_FILE = 1 << 20, 32
BROADCAST_REVISITS = 200_000
END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"
#: Fixed value: a gzip member that holds nothing.
EMPTY = bytes.fromhex("1f8b0800000000000003" "0300" "0000000000000000")
#: A reader looks at so many bytes of a member first, then at twice as many, and so on to the larger number.
FIRST_BYTES, READ_BYTES = 8 << 10, 1 << 20
#: Members are compressed fast: an archive of short records gains little from more.
LEVEL = 1
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Archives are made up of given rows, so all of them bear one fixed date.
DATE = "2000-01-01T00:00:00Z"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk doesn't end where its length says")
        out.append(body[at : at + n])
        at += n + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + END


def record_id(page_id, url: str | None, sha: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{copy}:{page_id}:{sha}:{url}')}>"


def page_records(page_id, url: str | None, payload: bytes, sha: str, copy: int, holder: tuple | None, segment_bytes: int, chunk_bytes: int) -> list[bytes]:
    """The WARC records of one page, each with the blank line that ends it; ``holder`` is the (page_id, url) that a revisit refers to."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page_id}"
    own = record_id(page_id, url, sha, copy)
    fields = [
        ("WARC-Type", "revisit" if holder else "response"), ("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", target),
        ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest32(payload)}")
    ]
    fields += [("X-Page-ID", str(page_id))] if page_id is not None else []
    if holder:
        return [_record([*fields, ("WARC-Refers-To", record_id(*holder, sha, 0)), ("WARC-Profile", PROFILE)], HTTP + b"\r\n")]
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return [_record(fields, block)]
    out = [_record([*fields, ("WARC-Segment-Number", "1")], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        more = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}:{i}')}>"), ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(i))
        ]
        out.append(_record([*more, ("WARC-Segment-Total-Length", str(len(block)))] if i == len(parts) else more, part))
    return out


def _write(segment_bytes: int, chunk_bytes: int, pack_bytes: int, batches):
    """Rows of whole gzip members, about ``pack_bytes`` each."""
    import pyarrow as pa

    held: list[bytes] = []
    size = 0
    for batch in batches:
        for page_id, url, html, sha, copy, holder in zip(
            *(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "copy", "holder")), strict=True
        ):
            for r in page_records(page_id, url, html or b"", sha, copy, (holder["page_id"], holder["url"]) if holder else None, segment_bytes, chunk_bytes):
                held.append(gzip.compress(r, LEVEL, mtime=0))
                size += len(held[-1])
                if size > pack_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], type=pa.binary())], names=["members"])
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], type=pa.binary())], names=["members"])


def write_archives(
    pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, pack_bytes: int = PACK_BYTES,
    rows_per_file: int = ROWS_PER_FILE
) -> None:
    """WARC files of ``pages`` (page_id, url, html) under ``path``, a gzip member for each record."""
    rows = with_copies(pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html")), 2).withColumn("sha", F.sha1("html"))
    # narrow: who holds a payload first
    held = rows.groupBy("sha").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("holder"), F.count("*").alias("n")
    ).where("n > 1 and holder is not null")
    held = bounded_broadcast(materialize(held.select("sha", "holder"), "payload-holders"), BROADCAST_REVISITS)
    holder = F.when(~F.col("page_id").eqNullSafe(F.col("holder.page_id")), F.col("holder"))
    marked = rows.join(held, "sha", "left").select(
        "page_id", "url", "html", "sha", F.col("_sw_copy").alias("copy"), F.when(F.col("holder").isNotNull(), holder).alias("holder")
    )
    out = marked.mapInArrow(partial(_write, segment_bytes, chunk_bytes, pack_bytes), "members binary").select(F.col("members").cast("string").alias("value"))
    out.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY.decode("iso-8859-1")).option("maxRecordsPerFile", rows_per_file).text(path)


FIELDS = "id string, type string, origin string, refers string, segment int, total long, page_id long, url string, digest string, block binary"


def parse(data: bytes):
    """(header, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(END, at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        header = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        n = int(header["content-length"])
        at = end + 4 + n
        if data[at : at + 4] != END:
            raise ValueError("a record doesn't end where its length says")
        yield header, data[end + 4 : at]
        at += 4


def _member(data: Bytes, at: int) -> tuple[bytes, int] | None:
    """(content, end) of the gzip member at ``at``; null if none is there."""
    unzip, out, step = zlib.decompressobj(31), [], FIRST_BYTES
    try:
        while not unzip.eof:
            more = data.read(at, step)
            if not more:
                return None
            out.append(unzip.decompress(more))
            at, step = at + len(more), min(2 * step, READ_BYTES)
            if len(out) == 1 and out[0] and not b"WARC/".startswith(out[0][:5]):
                return None
    except zlib.error:
        return None
    return b"".join(out), at - len(unzip.unused_data)


def members(data: Bytes, start: int, end: int):
    """The contents of the gzip members that begin in [start, end); bytes without their magic at the file's start are one content."""
    if start == 0 and data.read(0, 3) != MAGIC:
        if end < data.size:
            raise ValueError("an archive that isn't compressed has to be read whole")
        yield data.read(0, data.size)
        return
    at, found = start, start == 0
    while at < end:
        got = _member(data, at) if data.read(at, 3) == MAGIC else None
        # within a record's compressed bytes the magic may stand by chance: only what holds a record counts
        if got and (found or got[0].startswith(b"WARC/")):
            found = True
            yield got[0]
            at = got[1]
        elif found:
            raise ValueError(f"no gzip member at byte {at}")
        else:
            near = data.read(at + 1, READ_BYTES + 2).find(MAGIC)
            at += READ_BYTES if near < 0 else near + 1


def _read(name: str, data: Bytes, start: int, end: int):
    import pyarrow as pa

    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in FIELDS.split(", "))])
    number = lambda h, k: int(h[k]) if k in h else None

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows, size = [], 0
    for content in members(data, start, end):
        for h, block in parse(content):
            rows.append(
                (
                    h["warc-record-id"], h["warc-type"], h.get("warc-segment-origin-id"), h.get("warc-refers-to"), number(h, "warc-segment-number"),
                    number(h, "warc-segment-total-length"), number(h, "x-page-id"), h.get("warc-target-uri"),
                    h.get("warc-payload-digest", "").removeprefix("sha1:") or None, block
                )
            )
            size += len(block)
            if size > 1 << 22:
                yield batch(rows)
                rows, size = [], 0
    if rows:
        yield batch(rows)


def read_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of all archives under ``path``, segments as they stand."""
    return scan(spark, path, _read, FIELDS, range_bytes)


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(END)
    chunks = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in head.split(b"\r\n"))
    return dechunked(body) if chunks else body


def _payloads(batches):
    """Joins the segments of each response, verifies them and decodes the payload."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for own, page_id, url, digest, total, segments in zip(
            *(batch.column(c).to_pylist() for c in ("id", "page_id", "url", "digest", "total", "segments")), strict=True
        ):
            if [s["segment"] for s in segments] != list(range(1, len(segments) + 1)):
                raise ValueError(f"page {page_id}: segments are missing or repeated")
            block = b"".join(s["block"] for s in segments)
            if total is not None and total != len(block) or total is None and len(segments) > 1:
                raise ValueError(f"page {page_id}: {len(block)} bytes of {total}")
            payload = payload_of(block)
            if digest is not None and digest32(payload) != digest:
                raise ValueError(f"page {page_id}: the payload doesn't have its digest")
            rows.append((own, page_id, url, payload, len(payload), digest32(payload)))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
            names=["id", "page_id", "url", "payload", "payload_bytes", "payload_digest"]
        )


def responses(records: DataFrame) -> DataFrame:
    """(id, page_id, url, payload, payload_bytes, payload_digest) of each response, its segments put together."""
    own = records.where("type in ('response', 'continuation')")
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "block")
    whole = own.where("segment is null").select("id", "page_id", "url", "digest", "total", F.array(part).alias("segments"))
    grouped = own.where("segment is not null").groupBy(F.coalesce("origin", "id").alias("id")).agg(
        F.max("page_id").alias("page_id"), F.max("url").alias("url"), F.max("digest").alias("digest"), F.max("total").alias("total"), F.array_sort(F.collect_list(part)).alias("segments")
    )
    both = whole.union(grouped.select(*whole.columns))
    return both.mapInArrow(_payloads, "id string, page_id long, url string, payload binary, payload_bytes long, payload_digest string")


def catalogue(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every response and revisit.

    Revisits are resolved by the record that they name, or by digest if they
    name none.
    """
    got = materialize(responses(records).select("id", "page_id", "payload_bytes", "payload_digest"), "responses")
    again = records.where("type = 'revisit'").select("page_id", "digest", "refers")
    named = again.where("refers is not null").select("refers").distinct().join(got, F.col("refers") == F.col("id")).select(
        "refers", F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    )
    named = bounded_broadcast(materialize(named, "referred"), BROADCAST_REVISITS)
    by_name = again.where("refers is not null").join(named, "refers", "left").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "refers_to"
    )
    first = got.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"))
    by_digest = again.where("refers is null").select("page_id", F.col("digest").alias("payload_digest")).join(first, "payload_digest", "left").select(
        "page_id", "payload_bytes", "payload_digest", "refers_to"
    )
    both = by_name.union(by_digest).select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    fresh = got.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return fresh.union(both)


def op8(spark, sf_dir: str) -> DataFrame:
    from screenwright.llm.tables import table

    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return catalogue(read_records(spark, path))


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS holder FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> holder THEN holder END AS refers_to FROM q
"""
