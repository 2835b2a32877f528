"""WARC archives: payloads written as segmented records with chunked framing, and put together again.

Writing: a payload becomes an HTTP response in chunked transfer framing. A block above ``segment_bytes`` is cut into
a first record and continuation records, named by the origin's record id and their number; the last one tells
the total length. Of equal payloads the one with the least page_id is stored; the others become revisit records. Spark's
text sink commits the files, so a lost executor leaves no torn file; segments bound the records and
``records_per_file`` the files.

Reading: files are parsed whole, one per row and of bounded size. Records without segments are decoded at once;
the others are grouped by origin, ordered by segment number and checked: numbers without gap, total length as
told. The chunked framing is then decoded and the payload's digest compared.

Defined results: null html is an empty payload; a null page_id stays null in the result; equal payloads with the same
page_id are all responses; an empty table gives archives without records. A damaged group has status ``damaged`` and no
payload; nothing raises.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

END = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("record_id string, record_type string, refers_to string, digest string, origin string, segment int, "
          "total long, block binary")
PAGE = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "status string, payload binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at:at + size]
        parts += [b"%x\r\n" % len(piece), piece, END]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked framing; ValueError when the framing is broken."""
    parts, at = [], 0
    while True:
        line_end = body.index(END, at)
        size = int(body[at:line_end].split(b";")[0], 16)
        at = line_end + 2
        if size < 0 or len(body) < at + size + 2 or body[at + size:at + size + 2] != END:
            raise ValueError("broken chunk")
        if not size:
            return b"".join(parts)
        parts.append(body[at:at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """A record but for its last line end, which the text sink adds."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", len(block))])
    return b"WARC/1.1\r\n" + head.encode() + END + block + END


def records(page_id: int | None, row: int, url: str | None, payload: bytes, first: int | None, segment_bytes: int,
            chunk_bytes: int) -> Iterator[bytes]:
    """The records of one page; first: the page whose payload is the same and is stored, if that is another."""
    name = f"<urn:page:{'' if page_id is None else page_id}:{row}>"
    head = [("WARC-Record-ID", name), ("WARC-Target-URI", "".join((url or "").split())),
            ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    if first is not None:
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        yield _record([("WARC-Type", "revisit"), *head, ("WARC-Refers-To", f"<urn:page:{first}>"),
                       ("WARC-Profile", PROFILE)], http)
        return
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
             + chunked(payload, chunk_bytes))
    if len(block) <= segment_bytes:
        yield _record([("WARC-Type", "response"), *head], block)
        return
    count = -(-len(block) // segment_bytes)
    for i in range(count):
        piece = block[i * segment_bytes:(i + 1) * segment_bytes]
        number = ("WARC-Segment-Number", i + 1)
        if not i:
            fields = [("WARC-Type", "response"), *head, number]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{i + 1}>"), number,
                      ("WARC-Segment-Origin-ID", name)]
            fields += [("WARC-Segment-Total-Length", len(block))] * (i + 1 == count)
        yield _record(fields, piece)


def _revisits(pages: DataFrame) -> DataFrame:
    """(page_id, first) of the pages whose payload another page with a lower id has; equal means equal SHA-256.

    Only ids and digests are shuffled. The minimum is combined before the shuffle, and the join is by digest with one
    row per digest on one side, so a much-repeated payload is split at run time.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    narrow = pages.select("page_id", F.unhex(F.sha2(body, 256)).alias("same"))
    first = narrow.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return narrow.join(first, "same").where("page_id > first").groupBy("page_id").agg(F.min("first").alias("first"))


def write_warc(pages: DataFrame, path: str, segment_bytes: int = 16384, chunk_bytes: int = 4096,
               records_per_file: int = 2000, compression: str = "gzip") -> None:
    """Write the page_id, url, html rows of pages as archives below path."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            size = 0
            for page_id, url, html, first, row in zip(*(c.to_pylist() for c in batch.columns)):
                for r in records(page_id, row, url, (html or "").encode(), first, segment_bytes, chunk_bytes):
                    out.append(r)
                    size += len(r)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    rows = pages.join(_revisits(pages), "page_id", "left").select(
        "page_id", "url", "html", "first", F.monotonically_increasing_id().alias("row"))
    (rows.mapInArrow(build, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file)
     .option("compression", compression).text(path))


def parse(content: bytes) -> Iterator[tuple]:
    """Rows as RECORD of one archive file."""
    if content[:2] == b"\x1f\x8b":
        content = zlib.decompress(content, 31)
    at = 0
    while at < len(content):
        head_end = content.index(b"\r\n\r\n", at)
        lines = content[at:head_end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        field = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
        start = head_end + 4
        end = start + int(field["Content-Length"])
        segment, total = field.get("WARC-Segment-Number"), field.get("WARC-Segment-Total-Length")
        yield (field["WARC-Record-ID"], field["WARC-Type"], field.get("WARC-Refers-To"),
               field.get("WARC-Payload-Digest"), field.get("WARC-Segment-Origin-ID", field["WARC-Record-ID"]),
               segment and int(segment), total and int(total), content[start:end])
        at = end + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below path."""
    fields = [c.split() for c in RECORD.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows: list[tuple] = []
                size = 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    size += len(row[-1])
                    if size > 8 << 20:
                        yield _rows(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parsed, RECORD)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _number(name: str | None) -> int | None:
    part = name.split(":")[2].rstrip(">") if name else ""
    return int(part) if part else None


def decoded(name: str, kind: str, refers_to: str | None, digest: str | None, parts: list[tuple],
            payloads: bool) -> tuple:
    """A PAGE row out of a record's segments (number, total, block) in any order."""
    page_id, refers = _number(name), _number(refers_to)
    try:
        parts = sorted(parts, key=lambda p: p[0] or 1)
        block = b"".join(p[2] for p in parts)
        totals = {p[1] for p in parts if p[1] is not None}
        numbers = [p[0] or 1 for p in parts]
        if numbers != list(range(1, len(parts) + 1)) or totals - {len(block)} or not kind \
                or (parts[0][0] is not None and not totals):
            raise ValueError("segments missing or of another length")
        head, _, body = block.partition(b"\r\n\r\n")
        told = digest.removeprefix("sha1:")
        if kind == "revisit":
            length = next(line for line in head.split(END) if line.lower().startswith(b"content-length:"))
            return page_id, int(length.split(b":")[1]), told, kind, refers, "ok", None
        payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        if payload_digest(payload) != told:
            raise ValueError("digest")
        return page_id, len(payload), told, kind, refers, "ok", payload if payloads else None
    except (ValueError, StopIteration, AttributeError, IndexError):
        return page_id, None, None, kind, refers, "damaged", None


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """PAGE rows of the archives below path; payloads=False leaves the payloads out after checking them."""
    fields = [c.split() for c in PAGE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = [decoded(r["record_id"], r["record_type"], r["refers_to"], r["digest"],
                                [(p["segment"], p["total"], p["block"]) for p in r["parts"]], payloads)
                        for r in batch.slice(at, 500).to_pylist()]
                yield _rows(rows, schema)

    all_records = read_records(spark, path)
    part = F.struct("segment", "total", "block")
    names = ["record_id", "record_type", "refers_to", "digest"]
    single = all_records.where("segment IS NULL").select(*names, F.array(part).alias("parts"))
    # one payload's segments: a group as large as one payload
    first = F.col("record_type") != "continuation"
    grouped = all_records.where("segment IS NOT NULL").groupBy("origin").agg(
        *[F.max(F.when(first, F.col(n))).alias(n) for n in names[1:]], F.collect_list(part).alias("parts"))
    grouped = grouped.select(F.col("origin").alias("record_id"), *names[1:], "parts")
    return single.unionByName(grouped).mapInArrow(decode, PAGE)
