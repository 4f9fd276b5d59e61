"""Legacy ARC archives to WARC: records are parsed by declared lengths and written anew with what WARC adds to them.

An ARC file starts with a version block that names the fields of its header lines; version 1 lines have five fields and
version 2 lines ten. `read_arcs` parses both, `convert` synthesises for each record a WARC identifier (from the archive's
name and the record's offset, so a repeated task gives the same one), timestamp (from the 8, 12, 14 or 17 digit date), type
and SHA-1 digests of block and payload, and writes WARC files; `read_warcs` parses them and checks every digest.

Archives are Hadoop files of Spark's text sink: its line separator is the end of a record, and a task begins a new file
after `archive_bytes`, so a reader, which takes one archive at a time and decompresses it as a stream, has a bound too.
Copies: of records with equal payloads of at least `least_bytes`, the one with the largest page_id (then archive, offset)
is the response and the others revisit it. Only digests meet to find that; contents are read a second time instead, and
are shuffled only where the table of repeated digests is too large to broadcast.

Defined cases: a null html is empty, a null url is written as `-` and read as null; white space in an url is percent-coded;
a null page_id is less than any other; equal rows are records of their own; an archive that ends inside a record, or a
digest that does not fit, fails the query with its name; an empty table makes no archive; other columns are left out.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.operators.scale import broadcast_if_small
from tillbook.session import new_folder, pin

ARCHIVE_BYTES = 64 * 1024 * 1024
LEAST_BYTES = 1000
FETCHED = "20000101000000"

# Field names of ARC header lines by version, and names and addresses of the WARC format.
FIELDS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
HEADERS = {
    1: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d+) (?P<kind>.*) (?P<size>\d+)"),
    2: re.compile(rb"(?P<url>.*) (?P<ip>\S+) (?P<date>\d+) (?P<kind>.*) (?P<result>\S+) (?P<sum>\S+) (?P<location>\S+) (?P<offset>\S+) (?P<file>\S+) (?P<size>\d+)"),
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = {"arc": "\n", "warc": "\r\n\r\n"}

# Rows and bytes that leave a task together.
ROWS, BYTES = 1024, 8 * 1024 * 1024

ARC_RECORD = "archive string, offset long, version int, url string, ip string, date string, kind string, page_id long, payload_bytes long, digest string, record_id string"
WARC_RECORD = "record_id string, record_type string, url string, date string, page_id long, payload_bytes long, digest string, refers_to_id string"



class Leaving:
    """Rows on their way out of a task, in batches of bounded bytes."""

    def __init__(self, names: list[str], kinds: list[pa.DataType]):
        self.schema = pa.schema(list(zip(names, kinds, strict=True)))
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, size: int, *row) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= ROWS or self.bytes >= BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.bytes = [], 0


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            yield from batch.slice(at, 64).to_pylist()


# ---------------------------------------------------------------- files of Spark's text sink
def write_archives(rows: DataFrame, folder: str, form: str, lead: Callable, record: Callable, archive_bytes: int) -> None:
    """One record for each row, after a leading record for each file; lead(name, version) and record(row, version, name, offset)."""
    end = END[form]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        out = Leaving(["segment", "number", "value"], [pa.int32(), pa.int64(), pa.binary()])
        segment, number, offset = -1, 0, archive_bytes
        for row in _dicts(batches):
            if offset >= archive_bytes:
                segment, number = segment + 1, 0
                version, name = 1 + (task + segment) % 2, f"{segment}-{task:05d}.{form}"
                value = lead(name, version)
                offset = len(value) + len(end)
                yield from out.add(len(value), segment, number, value)
            number += 1
            value = record(row, version, name, offset)
            offset += len(value) + len(end)
            yield from out.add(len(value), segment, number, value)
        yield from out.rest()

    out = rows.mapInArrow(run, "segment int, number long, value binary").sortWithinPartitions("segment", "number")
    text = out.select("segment", F.col("value").cast("string").alias("value"))
    # Archives of one run are read soon after; the fastest level costs a third of the CPU of the usual one.
    gzip_fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    text.write.partitionBy("segment").options(lineSep=end, **gzip_fast).text(folder)


def open_archives(spark: SparkSession, folder: str) -> DataFrame:
    """archive (the last two parts of its path) and content of every file."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True).load(folder)
    return files.select(F.substring_index("path", "/", -2).alias("archive"), "content")


class Stream:
    """Forward reading of one archive, compressed or not."""

    def __init__(self, content: pa.BinaryScalar, name: str):
        raw = content.as_buffer()
        plain = pa.BufferReader(raw)
        self.file = io.BufferedReader(gzip.GzipFile(fileobj=plain) if raw[:2].to_pybytes() == b"\x1f\x8b" else plain, 1 << 20)
        self.name, self.at = name, 0

    def line(self) -> bytes:
        found = self.file.readline()
        self.at += len(found)
        return found

    def head(self) -> bytes:
        """The next line that is not empty; nothing at the end of the archive."""
        while (found := self.line()) and not found.strip():
            pass
        return found

    def take(self, size: int) -> bytes:
        found = self.file.read(size)
        self.at += len(found)
        if len(found) < size:
            raise ValueError(f"{self.name} ends at {self.at}: {size} bytes were declared, {len(found)} are there")
        return found


# ---------------------------------------------------------------- ARC
def _http(row: dict) -> bytes:
    """The page as a server sends it; page_id travels as a header of its own."""
    body = (row["html"] or "").encode()
    own = b"" if row["page_id"] is None else b"X-Page-Id: %d\r\n" % row["page_id"]
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n%sContent-Length: %d\r\n\r\n%s" % (own, len(body), body)


def _url(text: str | None) -> bytes:
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text or "-").encode()


def arc_lead(name: str, version: int) -> bytes:
    """Version block: a record whose content names the version and the fields of the header lines after it."""
    content = b"%d 0 tillbook\n%s\n" % (version, FIELDS[version])
    tail = b"200 - - 0 %s " % name.encode() if version == 2 else b""
    return b"filedesc://%s 0.0.0.0 %s text/plain %s%d\n%s" % (name.encode(), FETCHED.encode(), tail, len(content), content)


def arc_record(row: dict, version: int, name: str, offset: int) -> bytes:
    block = _http(row)
    tail = b"200 - - %d %s " % (offset, name.encode()) if version == 2 else b""
    return b"%s 0.0.0.0 %s text/html %s%d\n%s" % (_url(row["url"]), FETCHED.encode(), tail, len(block), block)


def write_arcs(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """ARC archives of pages(page_id, url, html), versions 1 and 2 by turns."""
    write_archives(pages.select("page_id", "url", "html"), folder, "arc", arc_lead, arc_record, archive_bytes)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP headers with the empty line after them, and the body; a block without them is all body."""
    found = re.search(rb"\r?\n\r?\n", block) if block.startswith(b"HTTP/") else None
    return (block[: found.end()], block[found.end() :]) if found else (b"", block)


def _header(headers: bytes, name: bytes) -> str | None:
    found = re.search(rb"(?im)^%s:[ \t]*([^\r\n]*)" % re.escape(name), headers)
    return found[1].strip().decode("utf-8", "replace") if found else None


def parse_arc(stream: Stream) -> Iterator[tuple[int, int, dict, bytes]]:
    """(offset, version, header fields, block) of every record after the version block."""
    version = 1
    while line := stream.head():
        offset = stream.at - len(line)
        line = line.rstrip(b"\r\n")
        if offset == 0 or line.startswith(b"filedesc://"):
            block = stream.take(int(line.rsplit(b" ", 1)[1]))
            version = int(block[:1])
            if block.split(b"\n", 2)[1].strip() != FIELDS[version]:
                raise ValueError(f"{stream.name}: unknown header lines {block[:200]!r}")
            continue
        found = HEADERS[version].fullmatch(line)
        if not found:
            raise ValueError(f"{stream.name}: no header line of version {version} at {offset}: {line[:200]!r}")
        yield offset, version, found.groupdict(), stream.take(int(found["size"]))


def warc_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}')}>"


def read_arcs(spark: SparkSession, folder: str, blocks: bool = True) -> DataFrame:
    """One row for each record of the archives in a folder, with its block if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ARC_RECORD.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in ARC_RECORD.split(", ")]
        out = Leaving([*names, "block"], [*kinds, pa.binary()])
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for offset, version, fields, block in parse_arc(Stream(content, archive)):
                    headers, body = split_http(block)
                    own = _header(headers, b"X-Page-Id")
                    row = [fields[f].decode("utf-8", "replace") for f in ("url", "ip", "date", "kind")]
                    row += [int(own) if own else None, len(body), hashlib.sha1(body).hexdigest(), warc_id(archive, offset)]
                    yield from out.add(len(block), archive, offset, version, *row, block if blocks else None)
        yield from out.rest()

    found = open_archives(spark, folder).mapInArrow(run, ARC_RECORD + ", block binary")
    return found if blocks else found.drop("block")


# ---------------------------------------------------------------- WARC
def warc_date(date: str) -> str:
    """W3C date of an ARC date of 8 to 17 digits; another one is the beginning of 1970."""
    parts = re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d\d)?(\d\d)?(\d\d)?(\d{3})?", date)
    if not parts:
        return "1970-01-01T00:00:00Z"
    y, mo, d, h, mi, s, ms = parts.groups()
    return f"{y}-{mo}-{d}T{h or '00'}:{mi or '00'}:{s or '00'}{'.' + ms if ms else ''}Z"


def _sha1(hexed: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexed)).decode()


def _warc(fields: dict[str, str | None], block: bytes) -> bytes:
    fields = fields | {"WARC-Block-Digest": _sha1(hashlib.sha1(block).hexdigest()), "Content-Length": str(len(block))}
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def warc_lead(name: str, version: int) -> bytes:
    block = b"software: tillbook\r\nformat: WARC File Format 1.1\r\n"
    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": warc_id(name, -1), "WARC-Date": warc_date(FETCHED)}
    return _warc(fields | {"WARC-Filename": name, "Content-Type": "application/warc-fields"}, block)


def warc_record(row: dict, version: int, name: str, offset: int) -> bytes:
    """Revisit without its body, response, or (without HTTP headers) resource."""
    headers, _ = split_http(row["block"])
    kind = "revisit" if row["refers_to_id"] else "response" if headers else "resource"
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": row["record_id"],
        "WARC-Date": warc_date(row["date"]),
        "WARC-Target-URI": row["url"],
        "WARC-IP-Address": row["ip"],
        "WARC-Payload-Digest": _sha1(row["digest"]),
        "WARC-Profile": PROFILE if kind == "revisit" else None,
        "WARC-Refers-To": row["refers_to_id"],
        "WARC-Payload-Length": str(row["payload_bytes"]) if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response" if headers else row["kind"],
    }
    return _warc(fields, headers if kind == "revisit" else row["block"])


def owners(records: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """digest and the identifier of its response, for payloads that more than one record holds."""
    best = F.max(F.struct("page_id", "archive", "offset", "record_id")).alias("best")
    found = records.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest").agg(best, F.count(F.lit(1)).alias("copies"))
    return found.filter("copies > 1").select(F.col("digest").alias("of"), F.col("best.record_id").alias("response_id"))


def convert(spark: SparkSession, arcs: str, warcs: str, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """WARC archives of the ARC archives in a folder."""
    repeated = pin(owners(read_arcs(spark, arcs, blocks=False), least_bytes), "payload-owners")
    copy = (F.col("payload_bytes") >= least_bytes) & (F.col("digest") == F.col("of"))
    refers = F.when(F.col("response_id") != F.col("record_id"), F.col("response_id")).alias("refers_to_id")
    records = read_arcs(spark, arcs).join(broadcast_if_small(repeated), copy, "left").drop("of")
    fields = ["record_id", "date", "url", "ip", "kind", "digest", "payload_bytes", "block"]
    write_archives(records.select(*fields, refers), warcs, "warc", warc_lead, warc_record, archive_bytes)


def parse_warc(stream: Stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of every record."""
    while line := stream.head():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{stream.name}: no record at {stream.at - len(line)}: {line[:200]!r}")
        fields = {}
        while (line := stream.line()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.take(int(fields["content-length"]))


def _warc_row(fields: dict[str, str], block: bytes, archive: str) -> tuple:
    headers, body = split_http(block)
    own, digest = _header(headers, b"X-Page-Id"), fields.get("warc-payload-digest")
    revisit = fields["warc-type"] == "revisit"
    found = hashlib.sha1(b"" if revisit else body).hexdigest()
    declared = base64.b32decode(digest.removeprefix("sha1:")).hex() if digest else found
    blocked = fields.get("warc-block-digest")
    if (not revisit and found != declared) or (blocked and blocked != _sha1(hashlib.sha1(block).hexdigest())):
        raise ValueError(f"{archive}: a digest of {fields['warc-record-id']} does not fit its content")
    size = int(fields.get("warc-payload-length") or _header(headers, b"Content-Length") or 0) if revisit else len(body)
    url = fields.get("warc-target-uri")
    return (
        *(fields["warc-record-id"], fields["warc-type"], None if url == "-" else url, fields["warc-date"]),
        *(int(own) if own else None, size, declared, fields.get("warc-refers-to")),
    )


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each record but warcinfo of the WARC archives in a folder; digests are verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64()}
        out = Leaving(*zip(*((c.split()[0], kinds[c.split()[1]]) for c in WARC_RECORD.split(", ")), strict=True))
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for fields, block in parse_warc(Stream(content, archive)):
                    if fields["warc-type"] != "warcinfo":
                        yield from out.add(256, *_warc_row(fields, block, archive))
        yield from out.rest()

    return open_archives(spark, folder).mapInArrow(run, WARC_RECORD)


def round_trip(pages: DataFrame, least_bytes: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as ARC archives, converted to WARC, read back: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    arcs, warcs = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arcs(pages, arcs, archive_bytes)
    convert(spark, arcs, warcs, least_bytes, archive_bytes)
    records = pin(read_warcs(spark, warcs).withColumnRenamed("digest", "payload_digest"), "warc-records")
    referred = records.filter("refers_to_id is not null").select(F.col("refers_to_id").alias("record_id")).distinct()
    responses = records.join(referred, "record_id", "left_semi").select(F.col("record_id").alias("of"), F.col("page_id").alias("refers_to"))
    out = records.join(broadcast_if_small(responses), F.col("refers_to_id") == F.col("of"), "left")
    return out.select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
