"""WARC records in ZIP archives: a parallel writer, and a reader that fetches single records by range.

An archive is a ZIP file of stored (uncompressed) members: ``archive/data.warc.gz``, in which
each record is a gzip member of its own, and ``indexes/index.cdxj``, one line for each
record with its place. Stored members can be read in place, so a record is fetched with
the archive's directory, its index, and one range of bytes.

The reader parses the end-of-directory record, the ZIP64 locator and directory where there
are any, and the central directory. It takes all members below ``archive/`` and all indexes
below ``indexes/``: CDXJ lines in any order, plain or in gzip, that name their archive member
(or none, if there is only one), with or without a key and a timestamp before the JSON object.
Any other layout is an error: an index of another kind, a line that names no member or a range outside
of it, and an archive member that no line is about. Records that no line lists are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import time
import uuid
import zipfile
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.llm.batches import quoted
from retailweave.sinks.scratch import written

ARCHIVE_BYTES = 64 * 1024 * 1024  # data of an archive, after which a task begins another
REVISIT_BYTES = 1000  # payloads of fewer bytes are stored every time
TASK_BYTES = 128 * 1024 * 1024  # of archives that a task reads
READ_BYTES = 1024 * 1024  # neighbouring records are fetched together up to so many bytes

_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_DATA_FOLDER, _INDEX_FOLDER = "archive/", "indexes/"
_EPOCH = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- ZIP directories ---------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """A member of an archive; ``offset`` is that of its local header."""

    name: str
    method: int
    size: int
    packed: int
    offset: int


def members(read, size: int) -> list[Member]:
    """The members of an archive of ``size`` bytes, from its directory. ``read(offset, length)`` returns bytes."""
    tail_at = max(0, size - 65_557)  # the longest comment, and the record before it
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + int.from_bytes(tail[at + 20 : at + 22], "little") != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no ZIP directory at the end of the file")
    count, length, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = read(tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator before the ZIP directory")
        record = read(struct.unpack("<Q", locator[8:16])[0], 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 directory where the locator says")
        count, length, offset = struct.unpack("<QQQ", record[32:56])
    return list(_directory(read(offset, length), count))


def _directory(data: bytes, count: int) -> Iterator[Member]:
    at = 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central ZIP directory is broken")
        flags, method = struct.unpack("<HH", data[at + 8 : at + 12])
        packed, size, name_length, extra_length, comment_length = struct.unpack("<IIHHH", data[at + 20 : at + 34])
        offset = int.from_bytes(data[at + 42 : at + 46], "little")
        name = data[at + 46 : at + 46 + name_length].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[at + 46 + name_length : at + 46 + name_length + extra_length]
        # The ZIP64 field holds, in this order, those values that do not fit in their own fields.
        wide = _extra(extra, 1)
        values = []
        for value in (size, packed, offset):
            if value == 0xFFFFFFFF:
                value, wide = int.from_bytes(wide[:8], "little"), wide[8:]
            values.append(value)
        yield Member(name, method, values[0], values[1], values[2])
        at += 46 + name_length + extra_length + comment_length


def _extra(data: bytes, wanted: int) -> bytes:
    while len(data) >= 4:
        kind, length = struct.unpack("<HH", data[:4])
        if kind == wanted:
            return data[4 : 4 + length]
        data = data[4 + length :]
    return b""


def data_offset(read, member: Member) -> int:
    """Where a member's bytes begin: after its local header, whose length is its own."""
    header = read(member.offset, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    return member.offset + 30 + sum(struct.unpack("<HH", header[26:30]))


def stored(read, size: int, name: str) -> tuple[int, int]:
    """Offset and length of a stored member."""
    for member in members(read, size):
        if member.name == name:
            return in_place(read, member)
    raise ValueError(f"no member {name}")


def in_place(read, member: Member) -> tuple[int, int]:
    """Offset and length of a member, which has to be stored."""
    if member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name} is compressed and can't be read in place")
    return data_offset(read, member), member.size


# ---- records -------------------------------------------------------------------


def record_id(uri: str, page_id: int | None, digest: str) -> str:
    """The same for the same page, so that a revisit can name the response before either is written."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{uri}:{digest}')}>"


def record_bytes(
    record_type: str, uri: str, page_id: int | None, payload: bytes, digest: str, refers_to: tuple[int | None, str] | None, date: str = _EPOCH
) -> bytes:
    """A WARC record with an HTTP response. A revisit has the response's head and no payload.

    ``refers_to`` is page id and URI of the response that a revisit is about; it is named by its record id, URI and date.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: {record_id(uri, page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if record_type == "revisit":
        page, target = refers_to
        head += [
            f"WARC-Profile: {_PROFILE}",
            f"WARC-Refers-To: {record_id(target, page, digest)}",
            f"WARC-Refers-To-Target-URI: {target}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-ID: {page}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers and HTTP headers by lower-case name, and the payload. A block that is not HTTP is the payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    if not warc.get("content-type", "application/http").lower().startswith("application/http"):
        return warc, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, _headers(http), payload


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode(errors="replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


# ---- writing ---------------------------------------------------------------------


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that is a URI or a local path."""
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _Archive:
    """An archive that is being written. The index is held until the data is complete."""

    def __init__(self, folder: str, name: str):
        self.system, path = _open(folder)
        self.system.create_dir(path, recursive=True)
        self.path = f"{folder}/{name}"
        self.file = self.system.open_output_stream(f"{path}/{name}")
        self.zip = zipfile.ZipFile(_Sink(self.file), "w", zipfile.ZIP_STORED)
        self.data = self.zip.open(zipfile.ZipInfo(_DATA), "w", force_zip64=True)
        self.index = io.BytesIO()
        self.at = self.n = 0

    def add(self, key: dict, record: bytes) -> None:
        packed = gzip.compress(record, 1, mtime=0)
        self.index.write(json.dumps(key | {"offset": self.at, "length": len(packed)}).encode() + b"\n")
        self.data.write(packed)
        self.at += len(packed)
        self.n += 1

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(_INDEX), "w", force_zip64=True) as member:
            member.write(self.index.getbuffer())
        self.zip.close()
        size = self.file.tell()
        self.file.close()
        return self.path, size, self.n


def _quoted_uri(uri: str) -> str:
    return quote(uri, "/:?&=#+,;@!$'()*~[]")


class _Sink(io.RawIOBase):
    """A stream that only writes on, as object stores take it."""

    def __init__(self, file):
        self.file = file

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.file.write(bytes(data))
        return len(data)

    def flush(self) -> None:
        self.file.flush()


def write_archives(
    df: DataFrame,
    folder: str,
    id_column: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str | None = None,
) -> DataFrame:
    """Writes one record per row and returns the archives: ``path``, ``size`` and ``n_records``.

    ``date`` is the date of all records, as ``2024-01-31T12:00:00Z``; by default that of the call, as the rows tell none.

    Of rows with equal payloads of at least ``revisit_bytes`` the one with the largest id is a response and
    the others revisit it; of rows that share that id, each is a response, and rows without an id are
    never the largest. All other rows are responses. A null payload is empty, and so is a null URI.

    An archive is named after the task attempt that writes it, and only archives of attempts that
    succeeded are in the returned table, which is written before it is returned.
    """
    content = F.coalesce(quoted(payload).cast("string").cast("binary"), F.lit(b""))
    rows = df.select(
        quoted(id_column).cast("long").alias("id"), F.coalesce(quoted(uri).cast("string"), F.lit("")).alias("uri"), content.alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    # Written, so that adaptive execution can split the join on a payload that very many rows have.
    repeated = written(
        rows.where(F.octet_length("payload") >= revisit_bytes)
        .groupBy(F.col("digest").alias("of_digest"), F.octet_length("payload").alias("of_length"))
        .agg(F.max(F.struct("id", F.col("uri").alias("target"))).alias("response"), F.count("*").alias("n"))
        .where("n > 1")
    )
    decided = rows.join(repeated, (F.col("digest") == F.col("of_digest")) & (F.octet_length("payload") == F.col("of_length")), "left")
    refers_to = F.when(~F.col("response.id").eqNullSafe(F.col("id")), F.col("response"))
    date = date or time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, archive, n, made = TaskContext.get().taskAttemptId(), None, 0, []
        for batch in batches:
            for page_id, target, body, digest, response in zip(*(column.to_pylist() for column in batch.columns)):
                if archive is None:
                    archive = _Archive(folder, f"part-{attempt}-{n}.zip")
                    n += 1
                kind = "response" if response is None else "revisit"
                of = None if response is None else (response["id"], _quoted_uri(response["target"]))
                archive.add({"page_id": page_id, "type": kind}, record_bytes(kind, _quoted_uri(target), page_id, body, digest, of, date))
                if archive.at >= archive_bytes:
                    made.append(archive.close())
                    archive = None
        if archive is not None:
            made.append(archive.close())
        columns = list(zip(*made)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["path", "size", "n_records"]
        )

    return written(
        decided.select("id", "uri", "payload", "digest", refers_to.alias("refers_to")).mapInArrow(run, "path string, size long, n_records long")
    )


# ---- reading ---------------------------------------------------------------------

RECORDS = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("uri", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to_record", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)


def _reader(path: str):
    """``read(offset, length)`` of a file, and the file to close."""
    system, local = _open(path)
    file = system.open_input_file(local)
    return (lambda offset, length: file.read_at(length, offset)), file


def read_index(archives: DataFrame) -> DataFrame:
    """One row per run of neighbouring records: ``path``, ``offset``, ``length`` of the bytes, and the records' lengths in turn.

    A task reads an archive's directory and its indexes, line by line, and no record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()))
        for batch in batches:
            for path, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                read, file = _reader(path)
                with file:
                    rows = [(path, start, lengths) for start, lengths in record_runs(read, size)]
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "offset", "lengths"])

    return archives.select("path", "size").repartition(_tasks(archives)).mapInArrow(run, "path string, offset long, lengths array<long>")


def record_runs(read, size: int) -> Iterator[tuple[int, list[int]]]:
    """Where runs of neighbouring records begin in an archive, and the records' lengths, for the records of all indexes.

    A run has no gaps and, unless it is a single record, at most ``READ_BYTES``.
    """
    files = [member for member in members(read, size) if not member.name.endswith("/")]
    data = [member for member in files if member.name.startswith(_DATA_FOLDER)]
    indexes = [member for member in files if member.name.startswith(_INDEX_FOLDER) and not member.name.endswith(".idx")]
    by_name = {member.name.removeprefix(_DATA_FOLDER): i for i, member in enumerate(data)}
    places = [(array("q"), array("q")) for _ in data]
    for member in indexes:
        chunks = _chunks(read, *in_place(read, member))
        for line in _lines(_unpacked(chunks) if member.name.endswith(".gz") else chunks):
            record = _index_line(line, member.name)
            if record is None:
                continue
            name, offset, length = record
            of = by_name.get(name.removeprefix(_DATA_FOLDER)) if name is not None else 0 if len(data) == 1 else None
            if of is None:
                raise ValueError(f"{member.name} has a line about {name or 'no member'}, and there are {sorted(by_name)}")
            if offset < 0 or length <= 0 or offset + length > data[of].size:
                raise ValueError(f"{member.name} has a record outside of {data[of].name}")
            places[of][0].append(offset)
            places[of][1].append(length)
    for member, (offsets, lengths) in zip(data, places):
        if not offsets and member.size:
            raise ValueError(f"no index of the archive is about {member.name}")
        # A record that several lines or indexes list is one record.
        found = np.unique(np.stack([np.asarray(offsets, dtype=np.int64), np.asarray(lengths, dtype=np.int64)], axis=1), axis=0)
        if np.any(found[:-1].sum(axis=1) > found[1:, 0]):
            raise ValueError(f"records of {member.name} overlap")
        at, _ = in_place(read, member)
        start, end, run = 0, 0, []
        for offset, length in found.tolist():
            if run and (offset != end or offset + length - start > READ_BYTES):
                yield at + start, run
                run = []
            if not run:
                start = offset
            run.append(length)
            end = offset + length
        if run:
            yield at + start, run


def _index_line(line: bytes, index: str) -> tuple[str | None, int, int] | None:
    """Archive member, offset and length of a CDXJ line, which may be the bare object; None for a blank line or a head."""
    line = line.strip()
    if not line or line.startswith(b"!"):
        return None
    try:
        record = json.loads(line if line.startswith(b"{") else line.split(b" ", 2)[2])
        return record.get("filename"), int(record["offset"]), int(record["length"])
    except (LookupError, TypeError, ValueError, AttributeError) as error:
        raise ValueError(f"{index} has a line that is not CDXJ with offset and length: {line[:100]!r}") from error


def _tasks(archives: DataFrame) -> int:
    """Tasks that read the archives: one for ``TASK_BYTES``, and no fewer than there are cores.

    The number is given, as adaptive execution would go by the small rows that say what is to be read.
    """
    total = archives.agg(F.sum("size")).first()[0] or 0
    return max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))


def _chunks(read, offset: int, size: int) -> Iterator[bytes]:
    for at in range(0, size, READ_BYTES):
        yield read(offset + at, min(READ_BYTES, size - at))


def _unpacked(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of gzip members, one after the other."""
    inflate = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            yield inflate.decompress(chunk)
            chunk = inflate.unused_data
    if not inflate.eof:
        raise ValueError("an index in gzip ends too early")


def _lines(chunks: Iterable[bytes]) -> Iterator[bytes]:
    held = b""
    for chunk in chunks:
        *whole, held = (held + chunk).split(b"\n")
        yield from whole
    if held:
        yield held


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of the archives, fetched by range. Bytes and digest of a response are those of its payload as
    read; a revisit has no payload and names those of the response, or null where it doesn't say."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, read, file = None, None, None
        for batch in batches:
            for new, offset, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if new != path:
                    if file is not None:
                        file.close()
                    path = new
                    read, file = _reader(path)
                data, at, rows = read(offset, sum(lengths)), 0, []
                for length in lengths:
                    rows.append(_row(_record(data[at : at + length])))
                    at += length
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), _KINDS)], RECORDS.names)
        if file is not None:
            file.close()

    runs = read_index(archives).repartition(_tasks(archives), "path", "offset").sortWithinPartitions("path", "offset")
    return runs.mapInArrow(run, RECORDS)


_KINDS = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.string(), pa.string())


def _record(data: bytes) -> bytes:
    """A record, which is a gzip member or plain."""
    return zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data


def _row(record: bytes) -> tuple:
    warc, http, payload = parse_record(record)
    revisit = warc["warc-type"] == "revisit"
    page, length = warc.get("x-refers-to-page-id", ""), http.get("content-length", "")
    return (
        int(warc["x-page-id"]) if "x-page-id" in warc else None,
        unquote(warc["warc-target-uri"]) if "warc-target-uri" in warc else None,
        warc["warc-type"],
        int(page) if revisit and page.removeprefix("-").isdigit() else None,
        (int(length) if length.isdigit() else None) if revisit else len(payload),
        warc.get("warc-payload-digest", "").removeprefix("sha1:") or None if revisit else hashlib.sha1(payload).hexdigest(),
        None if revisit else payload,
        warc.get("warc-record-id"),
        warc.get("warc-refers-to") if revisit else None,
        warc.get("warc-date"),
    )
