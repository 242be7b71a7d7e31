"""WARC archives: writing pages as segmented, chunk-encoded records, and putting them together again.

Writing. Each page becomes a response record whose block is an HTTP message in chunked transfer framing. A block
over ``segment_bytes`` is cut: the first record has segment number 1, the rest are continuation records that name
it as their origin, and the last of them states the total length. Of pages with equal payloads (of at least
``min_revisit_bytes``) the one with the largest id is kept as response, the others become revisit records that refer
to it. Every record is a gzip member; archives hold about ``ARCHIVE_BYTES`` of records, so a file is never larger
than a task can hold. Spark's own text sink writes them: a gzip member of a small record ends in a zero byte, which
is declared as the line separator.

Reading. Records are read archive by archive. Records that are whole are decoded where they are read; only the parts
of cut ones carry their bytes through the shuffle by origin. There they are ordered by segment number, and one pass
checks that no number is missing and that the lengths add up, then decodes the chunks and checks the digest. What
fails is a row with ``problem`` set, never a lost one. Revisits take their size from the record that they refer to.

Cases: a null page is an empty payload. Rows that repeat an id and payload are all responses if the id is the
largest; rows equal in all columns share a record id and come back as often as they were written. A null id counts as
the smallest and comes back as null; a null address is left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoopline.llm.frames import partitions, slices
from hoopline.session import staging_root

SEGMENT_BYTES = 32_768
CHUNK_BYTES = 8_192
ARCHIVE_BYTES = 8_000_000
READ_BYTES = 8_192

END = b"\r\n"
_RECORDS = (
    "record_id string, page_id string, record_type string, payload_digest string, refers_id string, "
    "segment int, total long, payload_bytes long, problem string, block binary"
)
_PAGES = "record_id string, page_id string, record_type string, payload_digest string, refers_id string, payload_bytes long, problem string"


def record_id(page_id: object, url: object, digest: str) -> str:
    """The id of a page's first record: the same for the same page."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}\x1f{url}\x1f{digest}').urn}>"


def continuation_id(origin: str, number: int) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{origin}\x1f{number}').urn}>"


def base32_digest(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, END]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; ValueError if the framing is broken or bytes are left over."""
    at, parts = 0, []
    while True:
        line = body.index(END, at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if not size:
            if body[at:] != END:
                raise ValueError("bytes after the last chunk")
            return b"".join(parts)
        if body[at + size : at + size + 2] != END:
            raise ValueError("a chunk has another length than stated")
        parts.append(body[at : at + size])
        at += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers if v is not None)]
    raw = END.join([*lines, b"Content-Length: %d" % len(block), b"", block]) + END + END
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _clean(value: str | None) -> str | None:
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def page_records(page_id, url, payload: bytes, hexadecimal: str, refers_id: str | None, segment_bytes: int):
    """The records of one page."""
    own = record_id(page_id, url, hexadecimal)
    head = [
        ("WARC-Record-ID", own),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", _clean(url)),
        ("WARC-Payload-Digest", f"sha1:{base32_digest(hexadecimal)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Page-Id", page_id),
    ]
    if refers_id is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        more = [("WARC-Type", "revisit"), ("WARC-Profile", profile), ("WARC-Refers-To", refers_id)]
        yield record(more + head, b"HTTP/1.1 200 OK\r\n\r\n")
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    block += chunked(payload)
    head.insert(0, ("WARC-Type", "response"))
    if len(block) <= segment_bytes:
        yield record(head, block)
        return
    last = (len(block) - 1) // segment_bytes + 1
    for number in range(1, last + 1):
        part = block[(number - 1) * segment_bytes : number * segment_bytes]
        if number == 1:
            yield record([*head, ("WARC-Segment-Number", 1)], part)
        else:
            yield record(
                [
                    ("WARC-Type", "continuation"),
                    ("WARC-Record-ID", continuation_id(own, number)),
                    ("WARC-Date", "1970-01-01T00:00:00Z"),
                    ("WARC-Segment-Origin-ID", own),
                    ("WARC-Segment-Number", number),
                    ("WARC-Segment-Total-Length", len(block) if number == last else None),
                ],
                part,
            )


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write one record (or its segments) for each row of ``pages`` as archives under ``path``."""
    if not 1 <= segment_bytes < 1 << 22:
        raise ValueError("segments have between 1 byte and 4 MB")
    rows = pages.select(
        pages[page_id].alias("page_id"),
        pages[url].cast("string").alias("url"),
        F.coalesce(pages[html].cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    kept = (
        rows.filter(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("sha1")
        .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count("*").alias("copies"))
        .filter("copies > 1")
        .drop("copies")
    )
    rows = rows.join(kept, "sha1", "left")
    revisits = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    rows = rows.select(
        F.col("page_id").cast("string").alias("page_id"), "url", "payload", "sha1", revisits.alias("revisits"),
        F.col("kept.page_id").cast("string").alias("kept_id"), F.col("kept.url").alias("kept_url"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(parts: list[bytes]) -> pa.RecordBatch:
            # the last byte is the sink's line separator
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1]], pa.binary())], names=["archive"])

        parts, size = [], 0
        for batch in slices(batches):
            for row in batch.to_pylist():
                target = record_id(row["kept_id"], row["kept_url"], row["sha1"]) if row["revisits"] else None
                for made in page_records(
                    row["page_id"], row["url"], row["payload"], row["sha1"], target, segment_bytes
                ):
                    parts.append(made)
                    size += len(made)
                    if size >= ARCHIVE_BYTES:
                        yield archive(parts)
                        parts, size = [], 0
        if parts:
            yield archive(parts)

    archives = rows.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


def members(data: bytes) -> Iterator[bytes]:
    """The gzip members of an archive, unpacked one after the other."""
    at = 0
    while at < len(data):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            window = data[at : at + READ_BYTES]
            if not window:
                raise ValueError("the archive ends inside a record")
            parts.append(unpack.decompress(window))
            at += len(window) - len(unpack.unused_data)
        yield b"".join(parts)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-cased name, and the block."""
    head, _, rest = raw.partition(END + END)
    lines = head.split(END)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC record")
    headers = {k.decode().strip().lower(): v.decode().strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
    size = int(headers["content-length"])
    if rest[size:] != END + END:
        raise ValueError("a record has another length than stated")
    return headers, rest[:size]


def decode(block: bytes, digest: str | None) -> tuple[int | None, str | None]:
    """(payload bytes, problem) of an HTTP message."""
    head, _, body = block.partition(END + END)
    try:
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
    except ValueError:
        return None, "broken chunk framing"
    if digest and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        return len(payload), "digest differs"
    return len(payload), None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _RECORDS.split(", ")]
    types = dict(segment=pa.int32(), total=pa.int64(), payload_bytes=pa.int64(), block=pa.binary())

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, types.get(n, pa.string())) for n, c in zip(names, columns)], names=names
        )

    for batch in batches:
        for content in batch.column(0):
            rows, held = [], 0
            for raw in members(content.as_py()):
                headers, block = parse(raw)
                get = headers.get
                digest = get("warc-payload-digest", "").removeprefix("sha1:") or None
                number, kind = get("warc-segment-number"), headers["warc-type"]
                size = problem = None
                if number is None and kind == "response":
                    size, problem = decode(block, digest)
                origin = get("warc-segment-origin-id") or headers["warc-record-id"]
                total = int(get("warc-segment-total-length")) if get("warc-segment-total-length") else None
                part = block if number is not None else None
                held += len(part or b"")
                rows.append((origin, get("page-id"), kind, digest, get("warc-refers-to"), int(number or 0), total, size, problem, part))
                if held > ARCHIVE_BYTES or len(rows) >= 5000:
                    yield out(rows)
                    rows, held = [], 0
            yield out(rows)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by origin and segment number: one row for each record that was written."""
    names = [f.split()[0] for f in _PAGES.split(", ")]
    done: list[tuple] = []
    group: list[dict] = []

    def finish() -> None:
        first = group[0]
        base = [first[n] for n in names[:5]]
        if first["segment"] != 1:
            done.append((*base, None, "no first segment"))
            return
        copies = sum(x["segment"] == 1 for x in group)
        parts = group[::copies]
        size, problem = None, None
        if [x["segment"] for x in group] != [n for n in range(1, len(parts) + 1) for _ in range(copies)]:
            problem = "a segment is missing"
        elif parts[-1]["total"] != sum(len(x["block"]) for x in parts):
            problem = "total length differs"
        else:
            size, problem = decode(b"".join(x["block"] for x in parts), first["payload_digest"])
        done.extend([(*base, size, problem)] * copies)

    def out() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[] for _ in names]
        kinds = [pa.int64() if n == "payload_bytes" else pa.string() for n in names]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        done.clear()
        return made

    for batch in slices(batches):
        for row in batch.to_pylist():
            if group and group[0]["record_id"] != row["record_id"]:
                finish()
                group.clear()
            if row["segment"]:
                group.append(row)
            else:
                done.append(tuple(row[n] for n in names))
        yield out()
    if group:
        finish()
    yield out()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page that was written: record_id, page_id, record_type, payload_digest, refers_id, payload_bytes,
    problem. Segments are put together; the size of a revisit is not known here (see ``resolve_revisits``)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    records = files.mapInArrow(_records, _RECORDS)
    ordered = records.repartition(partitions(spark), "record_id").sortWithinPartitions("record_id", "segment")
    return ordered.mapInArrow(_reassemble, _PAGES)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits with the size and page of the response that they refer to."""
    targets = (
        records.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_id"))
        .agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("target_bytes"))
    )
    joined = records.join(targets, "refers_id", "left")
    lost = F.when(F.col("refers_id").isNotNull() & F.col("target_bytes").isNull(), F.lit("no such response"))
    return joined.select(
        "record_id", "page_id", "record_type", "payload_digest", "refers_to",
        F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"), F.coalesce("problem", lost).alias("problem"),
    )


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: one row per page."""
    spark = pages.sparkSession
    path = f"{staging_root(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, page_id, url, html)
    kind = dict(pages.dtypes)[page_id]
    return resolve_revisits(read_archives(spark, path)).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"), "problem",
    )
