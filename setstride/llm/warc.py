"""Legacy archive converter: ARC records become WARC records, written as archives and read back.

* `arc_blocks` lays pages out as ARC files: a version block, then records under a one-line header. Version 1
  headers are "URL IP date type length", version 2 headers add result code, checksum, location, offset and file name before the length.
* `parse_arc` reads a file of either version by its header definition and the declared lengths, never by searching for
  separators, so payloads may hold anything.
* `converted` synthesises what ARC lacks: a record id (name-based UUID of the file, the place in it, origin, date and digest), the WARC-Date of
  the 14-digit date, the type, and block and payload digests. An HTTP head is part of the block and not of the payload.
  Records of any origin are converted; only those that `arc_blocks` wrote carry a page id (as a fragment of their URL), others have none.
* `write_warc` and `read_warc` keep archives as gzip text files: bytes pass through unchanged, one record after another.
  Tasks write archives of at most `RECORDS` records each; a reader task holds one archive compressed and one record plain.

Of records with equal payloads the one with the largest page id is the response, the others revisit it; the digest groups only
exchange digests and ids, not payloads. Null html is an empty payload, null urls an empty origin, null ids are written
as "-" and sort before all others. Repeated rows of one id are records of their own: one is the response, the others revisit it. An empty table gives an empty archive and result.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.llm.tables import folder_for, stored

RECORDS = 4096
BLOCK_BYTES = 4 << 20
#: The header definitions of both ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_ID_MARK = "#x-page-id="
_UNKNOWN_ADDRESS = "0.0.0.0"
_CAPTURED = "20200101000000"  # pages carry no capture time


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _arc_url(url: str) -> str:
    """A URL without blanks, as the header line needs it."""
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) or "-"


def arc_record(version: int, offset: int, name: str, key: str, url: str, payload: bytes) -> bytes:
    fields = [_arc_url(url) + _ID_MARK + key, _UNKNOWN_ADDRESS, _CAPTURED, "text/html"]
    if version == 2:
        fields += ["200", hashlib.md5(payload).hexdigest(), "-", str(offset), name]
    return " ".join([*fields, str(len(payload))]).encode() + b"\n" + payload + b"\n"


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 pages\n{ARC_FIELDS[version]}\n".encode()
    head = ["filedesc://" + name, _UNKNOWN_ADDRESS, _CAPTURED, "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return " ".join([*head, str(len(body))]).encode() + b"\n" + body + b"\n"


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file as dicts of header fields (by the definition in its version block), `payload`, and their `place` (file and offset)."""
    view, at, names, file = memoryview(data), 0, None, ""
    while at < len(data):
        end = data.index(b"\n", at)
        line = data[at:end].decode()
        values = line.split(" ")
        length = int(values[-1])
        body = view[end + 1 : end + 1 + length]
        if len(body) < length:
            raise ValueError(f"record at byte {at} is cut off")
        if names is None:
            version, definition = bytes(body).decode().split("\n")[:2]
            names = definition.split(" ")
            if ARC_FIELDS.get(int(version.split(" ")[0])) != definition:
                raise ValueError(f"unknown ARC version {version!r}")
            file = values[0]
        else:
            # fields are taken from the right, as old URLs may hold blanks
            head = line.rsplit(" ", len(names) - 1)
            yield dict(zip(names, head)) | {"payload": bytes(body), "place": f"{file} {at}"}
        at = end + 1 + length
        while at < len(data) and data[at] == 10:
            at += 1


def arc_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html) as ARC files of some megabytes, versions in turn: column `arc`."""
    number, task = 0, TaskContext.get()
    part = task.partitionId() if task else 0
    for batch in batches:
        block, version, name = bytearray(), 1, ""
        for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
            if not block:
                version = 1 + number % 2
                name = f"block-{part}-{number}.arc"
                number += 1
                block += arc_version_block(version, name)
            block += arc_record(version, len(block), name, "-" if key is None else str(key), url or "", html or b"")
            if len(block) >= BLOCK_BYTES:
                yield pa.record_batch([pa.array([bytes(block)], pa.binary())], ["arc"])
                block = bytearray()
        if block:
            yield pa.record_batch([pa.array([bytes(block)], pa.binary())], ["arc"])


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """The HTTP head of a block, with the blank line that ends it, and what follows; no head where there is none."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [block.find(mark) + len(mark) for mark in (b"\r\n\r\n", b"\n\n") if mark in block]
    cut = min(ends, default=len(block))
    return block[:cut], block[cut:]


def converted(record: dict) -> dict:
    """What a WARC record needs, from an ARC record of either version."""
    head, payload = http_parts(record["payload"])
    digest = sha1_base32(payload)
    date = (record["Archive-date"] + "0" * 14)[:14]
    url, mark, key = record["URL"].rpartition(_ID_MARK)
    if not mark or not re.fullmatch(r"-|-?[0-9]+", key):
        url, key = record["URL"], "-"
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    name = f"{record['place']} {record['URL']} {date} {digest}"
    address = record["IP-address"]
    return {
        "page_id": None if key == "-" else int(key), "url": url, "date": stamp, "record_id": f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
        "content_type": "application/http; msgtype=response" if head else record["Content-type"], "address": None if address == _UNKNOWN_ADDRESS else address,
        "digest": digest, "head": head, "payload": payload,
    }


_CONVERTED = "page_id long, url string, date string, record_id string, content_type string, address string, digest string, head binary, payload binary"


def _columns(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_CONVERTED_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_id", pa.string()), ("content_type", pa.string()), ("address", pa.string()), ("digest", pa.string()), ("head", pa.binary()), ("payload", pa.binary())])


def _convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column(0):
            yield _columns([converted(r) for r in parse_arc(block.as_py())], _CONVERTED_ARROW)


def convert(arcs: DataFrame) -> DataFrame:
    """WARC fields of all records of ARC files in the binary column `arc`."""
    return arcs.select("arc").mapInArrow(_convert, _CONVERTED)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """ARC files of a folder as the input of `convert`."""
    return spark.read.format("binaryFile").load(path).select(F.col("content").alias("arc"))


def _bytes_of(page_id, url, date, record_id, content_type, address, digest, refers, head: bytes, payload: bytes) -> bytes:
    block = head + payload if refers is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}"]
    if address is not None:
        lines.append(f"WARC-IP-Address: {address}")
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers['record_id']}>"]
        lines += [f"X-Refers-To-Page: {refers['page_id']}"]
    lines += [f"X-Page: {'-' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}", f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"  # the writer's line end completes the record


def _values(column: pa.Array) -> Iterator:
    return (v.as_py() for v in column)


def _serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held, size = [], 0
        for row in zip(*(_values(c) for c in batch.columns)):
            held.append(_bytes_of(*row))
            size += len(held[-1])
            if size >= BLOCK_BYTES:
                yield pa.record_batch([pa.array(held, pa.binary())], ["record"])
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(held, pa.binary())], ["record"])


def write_warc(records: DataFrame, path: str) -> None:
    """Write converted records with `refers` (null: a response) as archives of whole records."""
    rows = records.select("page_id", "url", "date", "record_id", "content_type", "address", "digest", "refers", "head", "payload").mapInArrow(_serialise, "record binary")
    rows.select(F.col("record").cast("string").alias("value")).write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", RECORDS).text(path)


_READ = "page_id long, url string, date string, record_id string, type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
_READ_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


class _Stream:
    """Plain bytes of a gzip archive, decompressed as they are asked for."""

    def __init__(self, data: bytes):
        self.data, self.at, self.plain = memoryview(data), 0, bytearray()
        self.unzip = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.unzip.eof:  # a further member of the file
            self.data, self.at, rest = memoryview(self.unzip.unused_data + bytes(self.data[self.at :])), 0, None
            if not len(self.data):
                return False
            self.unzip = zlib.decompressobj(31)
        if self.at >= len(self.data):
            return False
        self.plain += self.unzip.decompress(self.data[self.at : self.at + (1 << 18)])
        self.at += 1 << 18
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (end := self.plain.find(mark, start)) < 0:
            start = max(0, len(self.plain) - len(mark))
            if not self._more():
                if self.plain:
                    raise ValueError("archive is cut off")
                return None
        out = bytes(self.plain[:end])
        del self.plain[: end + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self._more():
                raise ValueError("record is cut off")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        return out


def parse_warc(data: bytes) -> Iterator[dict]:
    stream = _Stream(data)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = stream.take(int(fields["Content-Length"]))
        stream.take(4)
        payload = http_parts(block)[1] if fields["Content-Type"].startswith("application/http") else block
        refers, key = fields.get("X-Refers-To-Page"), fields["X-Page"]
        whole = refers is None
        yield {
            "page_id": None if key == "-" else int(key), "url": fields["WARC-Target-URI"], "date": fields["WARC-Date"],
            "record_id": fields["WARC-Record-ID"].strip("<>"), "type": fields["WARC-Type"], "refers_to": None if whole or refers == "None" else int(refers),
            "payload_bytes": len(payload) if whole else int(fields["X-Payload-Length"]),
            "payload_digest": sha1_base32(payload) if whole else fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload": payload if whole else None,
        }


def _read(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held: list[dict] = []
                for record in parse_warc(content.as_py()):
                    held.append(record if with_payload else record | {"payload": None})
                    if len(held) >= 256:
                        yield _columns(held, _READ_ARROW)
                        held = []
                if held:
                    yield _columns(held, _READ_ARROW)

    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives of a folder; a revisit has no payload of its own but the digest and length of the one it refers to."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read(with_payload), _READ)


def with_references(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`refers` of every converted record: (page_id, record_id) of the response with an equal payload, null for a response."""
    keys = records.select("digest", F.length("payload").alias("bytes"), "page_id", "record_id").where(F.col("bytes") >= least_bytes)
    latest = keys.groupBy("digest").agg(F.max(F.struct("page_id", "record_id")).alias("refers"), F.count("*").alias("copies"))
    latest = latest.where("copies > 1").select("digest", "refers")
    joined = records.join(latest, "digest", "left")
    refers = F.when(~F.col("refers.record_id").eqNullSafe(F.col("record_id")), F.col("refers"))
    return joined.withColumn("refers", refers)


def archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Convert pages (page_id, url, html) by way of ARC and write them as WARC archives to `path`."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string").cast("binary").alias("html"))
    arcs = rows.mapInArrow(arc_blocks, "arc binary")
    write_warc(with_references(convert(arcs), least_bytes), path)


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as the written archives have them."""
    spark = pages.sparkSession
    path = folder_for(spark, "warc")
    archive(pages, path)
    found = read_warc(spark, path, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


__all__ = ["archive", "convert", "page_records", "parse_arc", "parse_warc", "read_arc", "read_warc", "stored", "with_references", "write_warc"]
