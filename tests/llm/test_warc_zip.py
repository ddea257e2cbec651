import gzip
import hashlib
import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from retailweave.llm import warc_zip
from retailweave.llm.warc_zip import Member, data_offset, members, parse_record, read_index, read_records, record_bytes, stored, write_archives

from conftest import rows
from llm.conftest import as_dict

SCHEMA = "page_id long, url string, html string"


def reader(data):
    reads = []

    def read(offset, length):
        assert offset >= 0 and offset + length <= len(data)
        reads.append(length)
        return data[offset : offset + length]

    return read, reads


def archive(entries, method=zipfile.ZIP_STORED, comment=b"", extra=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as made:
        for name, data in entries:
            info = zipfile.ZipInfo(name)
            info.extra, info.compress_type = extra, method
            made.writestr(info, data)
        made.comment = comment
    return out.getvalue()


ENTRIES = [("a.txt", b"first"), ("dir/é.bin", bytes(range(256)) * 50), ("empty", b"")]


@pytest.mark.parametrize("comment", [b"", b"a comment", b"PK\x05\x06" + b"x" * 30, b"c" * 65_535])
@pytest.mark.parametrize("limit", [None, 3])
def test_directories_with_and_without_zip64(monkeypatch, comment, limit):
    """With a limit of three bytes and members everything that can be is written in ZIP64 form."""
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = archive(ENTRIES, comment=comment, extra=b"\x99\x99\x02\x00ab")
    monkeypatch.undo()
    if limit:
        assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    read, _ = reader(data)
    found = members(read, len(data))
    assert [(x.name, x.size, x.packed, x.method) for x in found] == [(n, len(d), len(d), 0) for n, d in ENTRIES]
    for member, (_, content) in zip(found, ENTRIES):
        at = data_offset(read, member)
        assert data[at : at + member.size] == content


def test_a_member_is_found_without_reading_the_others():
    data = archive([("big", os.urandom(3_000_000)), ("small", b"x" * 10)])
    read, reads = reader(data)
    at, size = stored(read, len(data), "small")
    assert read(at, size) == b"x" * 10 and sum(reads) < 70_000


def test_what_cannot_be_read_in_place_is_an_error():
    packed = archive(ENTRIES, zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        stored(reader(packed)[0], len(packed), "a.txt")
    plain = archive(ENTRIES)
    with pytest.raises(ValueError, match="no member"):
        stored(reader(plain)[0], len(plain), "b")
    for broken in (b"", b"no archive at all", plain[:-1], plain[:-30]):
        with pytest.raises(ValueError, match="directory"):
            members(reader(broken)[0], len(broken))
    with pytest.raises(ValueError, match="local header"):
        data_offset(reader(plain)[0], Member("a", 0, 1, 1, 3))


def test_records_round_trip():
    payload = "<p>é\r\n\r\nx</p>".encode()
    warc, http, body = parse_record(record_bytes("response", "http://x/?a=1", 5, payload, "d" * 40, None))
    assert (warc["warc-type"], warc["x-page-id"], body, http["content-length"]) == ("response", "5", payload, str(len(payload)))
    response = parse_record(record_bytes("response", "v", 9, payload, "d" * 40, None))[0]
    warc, http, body = parse_record(record_bytes("revisit", "u", None, payload, "d" * 40, (9, "v")))
    assert (warc["warc-refers-to"], body, http["content-length"], "x-page-id" in warc) == (response["warc-record-id"], b"", str(len(payload)), False)
    assert (warc["warc-refers-to-target-uri"], warc["warc-refers-to-date"], warc["x-refers-to-page-id"]) == ("v", response["warc-date"], "9")


LONG = "<html>" + "é" * 600 + "</html>"
PAGES = [
    (1, "http://a/?q=%20x y\nz", LONG),
    (2, "http://b", LONG),
    (9, None, LONG),
    (3, "http://c", "short"),
    (4, "http://d", "short"),
    (5, "http://e", None),
    (6, "", ""),
    (7, "http://f", "x" * 999),
    (8, "http://f", "x" * 999),
    (10, "http://g", "y" * 1000),
    (11, "http://g", "y" * 1000),
    (12, "http://h", "single" * 1000),
    (None, "http://i", "y" * 1000),
    (None, "http://j", "only null ids" * 100),
    (13, "http://k", "twice" * 300),
    (13, "http://k", "twice" * 300),
    (14, "http://k", "WARC/1.1\r\n\r\n" * 100),
]


def expected(pages):
    best = {}
    for page, _, html in pages:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            best[data] = max(best.get(data, page), page)
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        other = best.get(data) if best.get(data) != page else None
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other is not None else "response", other))
    return sorted(out, key=repr)


@pytest.mark.parametrize("archive_bytes", [warc_zip.ARCHIVE_BYTES, 1])
def test_archives_give_back_every_page(spark, tmp_path, archive_bytes):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(4)
    archives = write_archives(df, str(tmp_path / "w"), archive_bytes=archive_bytes)
    assert archives.agg(F.sum("n_records")).first()[0] == len(PAGES)
    if archive_bytes == 1:
        assert archives.count() == len(PAGES)
    found = read_records(archives)
    assert rows(found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) == expected(PAGES)
    bodies = {(row.page_id, row.uri): row.payload for row in found.where("record_type = 'response'").collect()}
    for page, url, html in PAGES:
        if (page, url or "") in bodies:
            assert bytes(bodies[page, url or ""]) == (html or "").encode()
    assert (1, PAGES[0][1]) not in bodies and {row.uri for row in found.where("page_id = 1").collect()} == {PAGES[0][1]}


def test_archives_are_plain_zip_files(spark, tmp_path):
    archives = write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), str(tmp_path / "w"))
    (row,) = archives.collect()
    with zipfile.ZipFile(row.path.removeprefix("file://")) as made:
        assert made.testzip() is None and made.namelist() == ["archive/data.warc.gz", "indexes/index.cdxj"]
        assert made.read("indexes/index.cdxj").count(b"\n") == len(PAGES) == row.n_records
        import gzip

        assert gzip.decompress(made.read("archive/data.warc.gz")).count(b"WARC/1.1\r\nWARC-Type") == len(PAGES)
    assert row.size == os.path.getsize(row.path.removeprefix("file://"))


def test_a_record_is_read_with_its_own_range_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc_zip, "READ_BYTES", 1)
    archives = write_archives(spark.createDataFrame(PAGES, SCHEMA).coalesce(1), str(tmp_path / "w"))
    index = read_index(archives).collect()
    # In this process the constant is one byte; tasks read runs of records as they are told by it there.
    assert sum(len(row.lengths) for row in index) == len(PAGES)
    read, file = warc_zip._reader(index[0].path)
    with file:
        import zlib

        data = read(index[0].offset, index[0].lengths[0])
        assert parse_record(zlib.decompress(data, 31))[0]["warc-type"] in ("response", "revisit")


def test_revisit_bound_other_names_clashing_columns_and_no_pages(spark, tmp_path, clashing):
    df = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc")], "id int, link string, body string")
    df = clashing(df, "digest", "payload", "refers_to", "uri", "response")
    found = read_records(write_archives(df, str(tmp_path / "w"), "id", "link", "body", revisit_bytes=3))
    assert as_dict(found, "page_id", "record_type", "refers_to") == {1: ("revisit", 2), 2: ("response", None)}
    empty = read_records(write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "e")))
    assert empty.collect() == []


def test_a_repeated_attempt_leaves_no_record_twice(spark, tmp_path):
    """Archives that no successful attempt made lie in the folder and are not read."""
    folder = str(tmp_path / "w")
    df = spark.createDataFrame(PAGES, SCHEMA)
    write_archives(df.limit(3), folder)
    second = write_archives(df, folder)
    assert read_records(second).count() == len(PAGES)


def test_reading_is_spread_by_size(spark, tmp_path, monkeypatch):
    archives = write_archives(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path / "w"), archive_bytes=1)
    cores = spark.sparkContext.defaultParallelism
    assert warc_zip._tasks(archives) == cores == read_records(archives).rdd.getNumPartitions()
    monkeypatch.setattr(warc_zip, "TASK_BYTES", 100)
    assert warc_zip._tasks(archives) == -(-archives.agg(F.sum("size")).first()[0] // 100) > cores


def package(path, members, indexes, method=zipfile.ZIP_STORED):
    """An archive with gzip records by member, and indexes by name."""
    with zipfile.ZipFile(path, "w", method) as file:
        for name, records in members.items():
            file.writestr(f"archive/{name}", b"".join(records))
        for name, content in indexes.items():
            file.writestr(f"indexes/{name}", content)
    return str(path), os.path.getsize(path), 0


def test_packages_of_several_members_and_indexes(spark, tmp_path, monkeypatch):
    """Standard CDXJ by key, two members, a gap, a plain record, a second index in gzip, a record that two lines list."""
    records = [record_bytes("response", f"http://{i}", i, f"page {i}".encode(), "d" * 40, None) for i in range(6)]
    packed = [gzip.compress(record) for record in records]
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: text/plain\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    data = {"a.warc.gz": [gzip.compress(info), packed[0], packed[1], gzip.compress(info), packed[2]], "b.warc.gz": packed[3:5], "c.warc": [info, records[5]]}

    def line(i, name, before, text=str):
        at = sum(len(x) for x in data[name][:before])
        place = {"url": f"http://{i}", "filename": name, "offset": text(at), "length": text(len(data[name][before]))}
        return f"com,{9 - i})/ 2020010100000{i} {json.dumps(place)}\n".encode()

    first = b"!meta {}\n\n" + line(4, "b.warc.gz", 1) + line(2, "a.warc.gz", 4, int) + line(0, "a.warc.gz", 1) + line(5, "c.warc", 1)
    second = [gzip.compress(line(3, "b.warc.gz", 0) + line(0, "a.warc.gz", 1)), gzip.compress(line(1, "a.warc.gz", 2))]
    made = package(tmp_path / "p.zip", data, {"index.cdxj": first, "more.cdx.gz": b"".join(second), "more.idx": "any"})
    archives = spark.createDataFrame([made], "path string, size long, n_records long")
    assert sorted(len(row.lengths) for row in read_index(archives).collect()) == [1, 1, 2, 2]
    assert rows(read_records(archives).select("page_id", F.col("payload").cast("string"))) == [(i, f"page {i}") for i in range(6)]


@pytest.mark.parametrize(
    "index, what",
    [
        ({}, "no index"),
        ({"index.cdxj": b'{"offset": 0, "length": 5}'}, "no member"),
        ({"index.cdxj": b'k 1 {"filename": "c", "offset": 0, "length": 5}'}, "about c"),
        ({"index.cdxj": b'k 1 {"filename": "a", "offset": 0, "length": 5}'}, "no index .* archive/b"),
        ({"index.cdxj": b'k 1 {"filename": "a", "offset": 3, "length": 5}'}, "outside"),
        ({"index.cdx": b" CDX N b a m s k r M S V g\n"}, "not CDXJ"),
    ],
)
def test_other_layouts_are_errors(tmp_path, index, what):
    path, size, _ = package(tmp_path / "p.zip", {"a": [b"x" * 5], "b": [b"y" * 5]}, index)
    with open(path, "rb") as file, pytest.raises(ValueError, match=what):
        list(warc_zip.record_runs(reader(file.read())[0], size))


def test_every_revisit_resolves_by_its_record_id_alone(spark, tmp_path):
    pages = [(i, f"http://host/{i} ?x=é", LONG if i % 3 else LONG + str(i % 4)) for i in range(-5, 60)]
    found = read_records(write_archives(spark.createDataFrame(pages, SCHEMA).repartition(3), str(tmp_path / "w"), date="2024-01-31T12:00:00Z")).collect()
    responses = {row.record_id: row for row in found if row.record_type == "response"}
    revisits = [row for row in found if row.record_type == "revisit"]
    assert len(revisits) > 50 and len({row.record_id for row in found}) == len(found)
    for row in revisits:
        response = responses[row.refers_to_record]
        assert (response.page_id, response.payload_digest, response.payload_bytes) == (row.refers_to, row.payload_digest, row.payload_bytes)
    assert {row.date for row in found} == {"2024-01-31T12:00:00Z"}
