"""Legacy ARC archives and their conversion to WARC.

ARC files of version 1 and 2 differ in their record lines; records are cut by the declared
lengths.  Conversion gives every record an identifier, a timestamp, a type and digests;
records with a payload seen before become revisits.  Archives are gzip files with a member
per record, written below a shared folder, and bounded in size.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import files, partitions, read_file, small_batches, stored
from ledgerlens.settings import scratch_path

#: Uncompressed bytes after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
LEVEL = 4
#: Bytes given to the decompressor at a time.
BITE = 16 << 10

#: Names of the fields of a record line, by version of the format.
FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Fixed value: the profile of a revisit with the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
ROW_HEADER = "X-Archived-Row"


@dataclass(frozen=True)
class ArcRecord:
    offset: int
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes

    def split(self) -> tuple[bytes, bytes]:
        """HTTP header (with its blank line) and payload; without a header all is payload."""
        if not self.block.startswith(b"HTTP/"):
            return b"", self.block
        head, blank, payload = self.block.partition(b"\r\n\r\n")
        return head + blank, payload

    def header(self, name: str) -> str | None:
        for line in self.split()[0].decode("latin-1").split("\r\n"):
            key, colon, value = line.partition(":")
            if colon and key.lower() == name.lower():
                return value.strip()
        return None


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        stream, end, parts = zlib.decompressobj(31), at, []
        # Small bites: what follows a member is copied out of the last one.
        while not stream.eof and end < len(data):
            parts.append(stream.decompress(view[end : end + BITE]))
            end = min(end + BITE, len(data))
        if not stream.eof:
            raise ValueError(f"the member at {at} is cut short")
        yield at, b"".join(parts)
        at = end - len(stream.unused_data)


def member(content: bytes) -> bytes:
    stream = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return stream.compress(content) + stream.flush()


class ArchiveWriter:
    """Writes one archive; the file appears under its name when it is whole."""

    def __init__(self, uri: str):
        self.uri, self.size, self.offset, self.records = uri, 0, 0, 0
        self.fs, self.path = files(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".open", compression=None)

    def add(self, content: bytes) -> int:
        at, packed = self.offset, member(content)
        self.out.write(packed)
        self.offset += len(packed)
        self.size += len(content)
        self.records += 1
        return at

    def close(self) -> str:
        self.out.close()
        self.fs.move(self.path + ".open", self.path)
        return self.uri


def arc_start(name: str, version: str, date: str) -> bytes:
    """The version block that opens an ARC file."""
    block = f"{version} 0 archive\n{FIELDS[version]}\n".encode()
    line = [f"filedesc://{name}", "0.0.0.0", date, "text/plain"]
    if version == "2":
        line += ["200", "-", "-", "0", name]
    return (" ".join([*line, str(len(block))]) + "\n").encode() + block + b"\n"


def arc_record(version: str, url: str, date: str, block: bytes, offset: int, name: str) -> bytes:
    line = [quote(url, safe="%/:=&?~#+!$,;'@()*[]") or "-", "0.0.0.0", date, "text/html"]
    if version == "2":
        line += ["200", "-", "-", str(offset), name]
    return (" ".join([*line, str(len(block))]) + "\n").encode() + block + b"\n"


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an ARC file, by the version its first record states.

    Each member may hold several records; a record's content ends by its declared length, and
    blank lines between records are skipped.
    """
    fields: list[str] = []
    for offset, content in members(data):
        at = 0
        while at < len(content):
            if content[at : at + 1] in (b"\n", b"\r"):
                at += 1
                continue
            end = content.find(b"\n", at)
            if end < 0:
                raise ValueError("a record line is cut short")
            line = content[at:end].decode("latin-1").rstrip("\r").split(" ")
            length = int(line[-1])
            block = content[end + 1 : end + 1 + length]
            if len(block) != length:
                raise ValueError(f"{length} bytes are declared and {len(block)} there")
            at = end + 1 + length
            if not fields:
                version = block.decode("latin-1").split(" ", 1)[0]
                if not line[0].startswith("filedesc:") or version not in FIELDS:
                    raise ValueError("no version block at the start")
                fields = FIELDS[version].split(" ")
                continue
            # A URL may hold spaces in old files; the fields after it don't.
            tail = len(fields) - 1
            named = dict(zip(fields[1:], line[-tail:]))
            yield ArcRecord(offset, " ".join(line[:-tail]), named["IP-address"], named["Archive-date"],
                            named["Content-type"], block)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(archive: str, offset: int) -> str:
    """The identifier that a record keeps however often it is converted."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{archive}#{offset}')}>"


def iso_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(r: ArcRecord, own_id: str, refers_to: str | None) -> bytes:
    """The WARC record of an ARC record; a revisit holds the HTTP header only."""
    head, payload = r.split()
    block = r.block if refers_to is None else head
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {own_id}", f"WARC-Date: {iso_date(r.date)}", f"WARC-Target-URI: {r.url}",
        f"WARC-IP-Address: {r.ip}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {refers_to}"]
    kind = "application/http;msgtype=response" if r.block.startswith(b"HTTP/") else r.content_type
    lines += [f"Content-Type: {kind}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("latin-1", "replace") + block + b"\r\n\r\n"


def warc_start(name: str, date: str) -> bytes:
    block = b"software: archive converter\r\nformat: WARC File Format 1.1\r\n"
    lines = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(name, -1)}",
             f"WARC-Date: {iso_date(date)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
             f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Lower-case headers and block of each record; lengths and block digests are verified."""
    for _, content in members(data):
        head, _, rest = content.partition(b"\r\n\r\n")
        first, *lines = head.decode("latin-1").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = int(headers["content-length"])
        block = rest[:length]
        if len(block) != length or rest[length:] != b"\r\n\r\n":
            raise ValueError("the declared length does not hold")
        told = headers.get("warc-block-digest")
        if told and told != f"sha1:{base32_sha1(block)}":
            raise ValueError("the block differs from its digest")
        yield headers, block


def write_arc(pages: DataFrame, folder: str, date: str = "20090704120000") -> DataFrame:
    """Write ``page_id, url, html`` as ARC archives below ``folder``; returns their ``archive`` names.

    Versions 1 and 2 take turns.  A null page is an empty payload, a null URL is ``-``.  Names
    are unique per attempt; the returned table holds those of the attempts that succeeded.
    """
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, version, done = None, "1", []
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if writer is None:
                    version = "2" if version == "1" else "1"
                    writer = ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.arc.gz")
                    name = writer.uri.rsplit("/", 1)[1]
                    writer.add(arc_start(name, version, date))
                payload = (html or "").encode()
                row = "" if page_id is None else f"{ROW_HEADER}: {page_id}\r\n"
                head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{row}"
                        f"Content-Length: {len(payload)}\r\n\r\n").encode()
                writer.add(arc_record(version, url or "-", date, head + payload, writer.offset, name))
                if writer.size >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["archive"])

    return stored(pages.select("page_id", "url", "html").mapInArrow(run, "archive string"), "arc-names")


def scan_arc(archives: DataFrame) -> DataFrame:
    """One row per record of the ``archive`` files: place, row number, payload size and digest."""
    spark = archives.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = []
                for r in parse_arc(read_file(archive)):
                    payload, number = r.split()[1], r.header(ROW_HEADER)
                    rows.append((archive, r.offset, int(number) if number else None, len(payload),
                                 base32_sha1(payload)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["archive", "offset", "page_id", "payload_bytes", "payload_digest"]
    schema = "archive string, offset long, page_id long, payload_bytes long, payload_digest string"
    return archives.select("archive").repartition(partitions(spark)).mapInArrow(run, schema)


def convert(archives: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Convert ARC ``archive`` files to WARC below ``folder``; returns the new ``archive`` names.

    Of records with equal payloads of ``least`` bytes or more, the one with the smallest row
    number (null last, then by place) is a response and the others revisit it.  Payloads are
    compared by digest and size; only these travel.  Groups are combined before the shuffle,
    and the join back is left to the adaptive treatment of skewed joins.
    """
    records = stored(scan_arc(archives), "arc-records")
    place = F.struct(F.col("page_id").isNull(), "page_id", "archive", "offset")
    firsts = (
        records.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min(place).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "payload_bytes", F.col("first.archive").alias("first_archive"),
                F.col("first.offset").alias("first_offset"))
    )
    decided = records.join(firsts, ["payload_digest", "payload_bytes"], "left").select(
        "archive", "offset", "first_archive", "first_offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, source, writer, done = None, None, None, []
        for batch in batches:
            for name, offset, first, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if name != archive:
                    if writer is not None:
                        done.append(writer.close())
                    archive, source = name, parse_arc(read_file(name))
                    new = f"{uuid.uuid4().hex}.warc.gz"
                    writer = ArchiveWriter(f"{folder}/{new}")
                    writer.add(warc_start(new, "20090704120000"))
                r = next(source)
                if r.offset != offset:
                    raise ValueError("records and their places differ")
                same = first is None or (first == name and at == offset)
                writer.add(warc_record(r, record_id(name, offset), None if same else record_id(first, at)))
        if writer is not None:
            done.append(writer.close())
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["archive"])

    turned = (
        decided.repartition(partitions(records.sparkSession), "archive").sortWithinPartitions("archive", "offset")
        .mapInArrow(run, "archive string")
    )
    return stored(turned, "warc-names")


def read_warc(archives: DataFrame) -> DataFrame:
    """One row per response or revisit record of the WARC ``archive`` files.

    The payload of a revisit is stated by its HTTP header and digest; that of a response is
    read and its digest verified.
    """
    spark = archives.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows = []
                for headers, block in parse_warc(read_file(archive)):
                    kind = headers["warc-type"]
                    if kind not in ("response", "revisit"):
                        continue
                    record = ArcRecord(0, "", "", "", "", block)
                    payload, number = record.split()[1], record.header(ROW_HEADER)
                    told = headers["warc-payload-digest"].removeprefix("sha1:")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(record.header("Content-Length"))
                    elif told != base32_sha1(payload):
                        raise ValueError("the payload differs from its digest")
                    rows.append((int(number) if number else None, size, told, kind, headers["warc-record-id"],
                                 headers.get("warc-refers-to"), headers["warc-date"], headers["warc-target-uri"],
                                 archive))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    types = [pa.int64(), pa.int64(), *[pa.string()] * 7]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "refers_to_id",
             "warc_date", "target_uri", "archive"]
    schema = ("page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, "
              "refers_to_id string, warc_date string, target_uri string, archive string")
    return archives.select("archive").repartition(partitions(spark)).mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back, one row per page.

    The archives stay below ``spark.checkpoint.dir`` and are named in the result.
    """
    spark: SparkSession = pages.sparkSession
    folder = scratch_path(spark, "archives")
    old = write_arc(pages, f"{folder}/arc")
    back = stored(read_warc(convert(old, f"{folder}/warc", least)), "warc-records")
    responses = back.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    revisited = back.where("record_type = 'revisit'").join(responses, "refers_to_id")
    alone = back.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id",
               "warc_date", "archive"]
    return alone.select(*columns).unionAll(revisited.select(*columns))
