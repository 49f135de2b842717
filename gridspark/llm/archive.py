"""Legacy web archives (ARC 1 and 2) to WARC 1.1: write, parse, convert, read back.

An ARC file starts with a version block, whose second line names the version and whose third line names the fields of
all header lines below. Version 1 header lines have five fields, version 2 header lines ten; the last field is the declared
length of what follows. The converter reads exactly that many bytes, then looks for the next header line. It makes a WARC
record identifier from the record's content (so a retried task makes the same one), an ISO time from the 14-digit
date, a type from the content type, and SHA-1 digests of the block and of the payload behind the HTTP header.

Files are written with Spark's text sink, whose line separator is the separator between records, so they lie in any store
that Spark reaches. A row of the sink is a block of records, closed at BLOCK_BYTES or BLOCK_RECORDS, and a file holds
BLOCKS_PER_FILE of them: no file passes 64 MB by more than its blocks' last records, so it can be read back whole with the binary file
source.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm._text import utf8
from gridspark.session import materialize, scratch_path

BLOCK_BYTES, BLOCK_RECORDS, BLOCKS_PER_FILE = 16 << 20, 512, 4
#: Fixed values of the formats: field names of the header lines by version, WARC profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
OUT_BYTES = 16 << 20
ARC_GAP, WARC_GAP = b"\n", b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class ArcRecord:
    version: int
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes
    whole: bool


def version_block(version: int, date: str) -> bytes:
    """The version block as written in front of each file's records, without its closing line feed."""
    body = f"{version} 0 gridspark\n{ARC_FIELDS[version]}\n".encode()
    tail = f"text/plain {len(body)}" if version == 1 else f"text/plain 200 - - 0 records.arc {len(body)}"
    return f"filedesc://records.arc 0.0.0.0 {date} {tail}\n".encode() + body


def arc_record(version: int, url: str, date: str, block: bytes) -> bytes:
    tail = f"text/html {len(block)}" if version == 1 else f"text/html 200 - - 0 records.arc {len(block)}"
    return f"{url} 0.0.0.0 {date} {tail}\n".encode() + block


def http_block(payload: bytes, page_id: int | None) -> bytes:
    name = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{name}Content-Length: {len(payload)}\r\n\r\n"
            ).encode() + payload


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file, version block left out. A record cut off by the file's end has whole=False; lines that
    are no header line are skipped up to the next one that is."""
    at, version = 0, 1
    while at < len(data):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        at = end + 1
        fields = line.rsplit(" ", len(ARC_FIELDS[version].split()) - 1)
        if line.startswith("filedesc:") and line.rsplit(" ", 1)[-1].isdigit():
            body = data[at:at + int(line.rsplit(" ", 1)[-1])]
            at += len(body)
            version = 2 if body[:2] == b"2 " else 1
        elif len(fields) == len(ARC_FIELDS[version].split()) and fields[-1].isdigit() and fields[2].isdigit():
            length = int(fields[-1])
            block = data[at:at + length]
            at += length
            yield ArcRecord(version, fields[0], fields[1], fields[2], fields[3], block, len(block) == length)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(header with its blank line, payload); a block that is no HTTP message is all payload."""
    end = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -1
    return (b"", block) if end < 0 else (block[:end + 4], block[end + 4:])


def header_field(header: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*([^\r\n]*)", header)
    return found[1].decode("utf-8", "replace") if found else None


def iso_time(date: str) -> str:
    """2024-01-02T03:04:05Z of 20240102030405; short dates are filled with the first month, day, midnight."""
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


CONVERTED = ("path string, seq int, version int, url string, warc_date string, record_id string, content_type string, block_digest string, "
             "payload_digest string, payload_bytes long, whole boolean, page_id long")


def convert_record(r: ArcRecord) -> dict:
    header, payload = split_http(r.block)
    page = header_field(header, b"X-Page-Id")
    block_digest = base32_sha1(r.block)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{r.url} {r.date} {block_digest}")
    return {"version": r.version, "url": r.url, "warc_date": iso_time(r.date), "record_id": f"<urn:uuid:{name}>",
            "content_type": "application/http; msgtype=response" if header else r.content_type,
            "block_digest": block_digest, "payload_digest": base32_sha1(payload), "payload_bytes": len(payload),
            "whole": r.whole, "page_id": None if page is None else int(page), "header": header, "block": r.block}


def _inflate(data: bytes) -> bytes:
    """All members of a gzip file, or the bytes as they are."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts = []
    while data:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(parts)


def _batches(rows: Iterator[dict], schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= OUT_BYTES or len(held) == 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    """(the other columns, the inflated bytes) of each file."""
    for batch in batches:
        rest = batch.drop_columns(["content"])
        for i, content in enumerate(batch.column("content")):
            yield {n: rest.column(n)[i].as_py() for n in rest.schema.names}, _inflate(content.as_py())


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _convert(batches: Iterator[pa.RecordBatch], ddl: str) -> Iterator[pa.RecordBatch]:
    schema = _arrow(ddl)
    rows = (convert_record(r) | {"path": file["path"], "seq": i}
            for file, data in _contents(batches) for i, r in enumerate(parse_arc(data)))
    yield from _batches(({k: row[k] for k in schema.names} for row in rows), schema,
                        lambda row: 200 + len(row.get("block", b"")))


def warc_record(row: dict, kept: dict | None) -> bytes:
    """A WARC record without the two line ends behind it; a revisit of `kept` (record_id, url) if that is given."""
    body = row["block"] if kept is None else row["header"]
    fields = [("WARC-Type", "response" if kept is None else "revisit"), ("WARC-Record-ID", row["record_id"]),
              ("WARC-Date", row["warc_date"]), ("WARC-Target-URI", row["url"]),
              ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}")]
    if kept is None:
        fields.append(("WARC-Block-Digest", f"sha1:{row['block_digest']}"))
    else:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", kept["record_id"]),
                   ("WARC-Refers-To-Target-URI", kept["url"])]
    if not row["whole"]:
        fields.append(("WARC-Truncated", "length"))
    fields += [("Content-Type", row["content_type"]), ("Content-Length", str(len(body)))]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode() + body


def _blocks(rows: Iterator, gap: bytes, render, start=None) -> Iterator[pa.RecordBatch]:
    """Records `render(row, file number)` joined to blocks; `start(file number)` gives what opens a file."""
    held, size, n = [], 0, 0

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([gap.join(held)], pa.binary())], ["block"])

    for row in rows:
        file = n // BLOCKS_PER_FILE
        if start and not held and n % BLOCKS_PER_FILE == 0:
            held.append(start(file))
        held.append(render(row, file))
        size += len(held[-1])
        if size >= BLOCK_BYTES or len(held) >= BLOCK_RECORDS:
            yield block()
            held, size, n = [], 0, n + 1
    if held:
        yield block()


def _render_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[tuple[ArcRecord, dict | None]]:
        for file, data in _contents(batches):
            revisits = {x["seq"]: x for x in file["revisits"] or ()}
            for i, r in enumerate(parse_arc(data)):
                yield r, revisits.get(i)

    yield from _blocks(records(), WARC_GAP, lambda row, file: warc_record(convert_record(row[0]), row[1]))


def _render_arc(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    def pages() -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            data, offsets = utf8(batch.column("html"))
            for i, (page, url) in enumerate(zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())):
                url = quote(url, safe=":/?#[]@!$&'()*+,;=%~-._") if url else f"urn:page:{page}"
                yield url, http_block(data[offsets[i]:offsets[i + 1]].tobytes(), page)

    yield from _blocks(pages(), ARC_GAP, lambda row, file: arc_record(1 + file % 2, row[0], date, row[1]),
                       lambda file: version_block(1 + file % 2, date))


def _write(blocks: DataFrame, path: str, gap: bytes) -> None:
    (blocks.select(F.col("block").cast("string").alias("value")).write
     .option("lineSep", gap.decode()).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", BLOCKS_PER_FILE).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """ARC files of (page_id, url, html), versions 1 and 2 in turn; a null html is an empty payload."""
    _write(pages.select("page_id", "url", "html").mapInArrow(partial(_render_arc, date=date), "block binary"), path, ARC_GAP)


def convert(spark: SparkSession, arc_path: str, blocks: bool = True) -> DataFrame:
    """One row per ARC record below a folder: identifiers, time, digests and (with `blocks`) header and block."""
    ddl = CONVERTED + (", header binary, block binary" if blocks else "")
    return _files(spark, arc_path).mapInArrow(partial(_convert, ddl=ddl), ddl)


def write_warc(spark: SparkSession, arc_path: str, warc_path: str, min_payload: int = 0) -> None:
    """Convert all ARC records below a folder into WARC files.

    Of records with equal payloads of at least `min_payload` bytes the one with the largest page_id (null: lowest) becomes a
    response, the others revisits of it; records that tie for the largest id are all responses.
    """
    # the archives are read twice, for these small rows and for the records; payloads are never shuffled
    small = materialize(convert(spark, arc_path, blocks=False).select(
        "path", "seq", "page_id", "payload_digest", "payload_bytes", "record_id", "url"), "arc-records")
    first = (small.where(F.col("payload_bytes") >= min_payload).groupBy("payload_digest")
             .agg(F.count("*").alias("n"), F.max(F.struct("page_id", "record_id", "url")).alias("kept"))
             .where("n > 1").select("payload_digest", "kept"))
    # one list a file, of a bounded number of records: whole files are joined, in compressed form, not their records
    revisits = (small.join(first, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("kept.page_id")))
                .groupBy("path").agg(F.collect_list(F.struct("seq", "kept.record_id", "kept.url")).alias("revisits")))
    rows = _files(spark, arc_path).join(revisits, "path", "left").select("content", "revisits")
    _write(rows.mapInArrow(_render_warc, "block binary"), warc_path, WARC_GAP)


WARC_ROW = ("record_type string, record_id string, refers_to_id string, url string, warc_date string, "
            "payload_digest string, payload_bytes long, page_id long")


def parse_warc(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header, block) of each record by its declared length."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at) + 4
        length = int(header_field(data[at:end], b"Content-Length") or 0)
        yield data[at:end], data[end:end + length]
        at = end + length


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    def rows():
        for _, data in _contents(batches):
            for header, block in parse_warc(data):
                http, payload = split_http(block)
                kind, page = header_field(header, b"WARC-Type"), header_field(http, b"X-Page-Id")
                full = kind == "response"
                stated = header_field(header, b"WARC-Payload-Digest") or ""
                row = {"record_type": kind, "record_id": header_field(header, b"WARC-Record-ID"),
                       "refers_to_id": header_field(header, b"WARC-Refers-To"),
                       "url": header_field(header, b"WARC-Target-URI"), "warc_date": header_field(header, b"WARC-Date"),
                       "payload_digest": base32_sha1(payload) if full else stated.removeprefix("sha1:"),
                       "payload_bytes": len(payload) if full else int(header_field(http, b"Content-Length") or 0),
                       "page_id": None if page is None else int(page)}
                yield row | ({"payload": payload} if payloads else {})

    yield from _batches(rows(), _arrow(WARC_ROW + (", payload binary" if payloads else "")),
                        lambda row: 200 + len(row.get("payload", b"")))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per WARC record below a folder. Responses give the digest of the payload read, revisits the one stated."""
    ddl = WARC_ROW + (", payload binary" if payloads else "")
    return _files(spark, path).mapInArrow(partial(_read, payloads=payloads), ddl)


def archive_pages(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, ...) of every page after pages -> ARC -> WARC
    -> read back. Repeated rows stay; equal page_ids with equal payloads are all responses if theirs is the largest."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    write_warc(spark, arc, warc, min_payload)
    records = materialize(read_warc(spark, warc), "warc-records")
    kept = (records.where("record_type = 'response'").groupBy(F.col("record_id").alias("id"))
            .agg(F.max("page_id").alias("refers_to")))
    responses = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    revisits = records.where("record_type = 'revisit'").join(kept, F.col("refers_to_id") == F.col("id"), "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date"]
    return responses.select(names).unionByName(revisits.select(names))
