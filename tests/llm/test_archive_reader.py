"""The archive operator's reader, versions and rejects."""

import io
import time

import pytest

from stratum.llm import archive, storage


def arc(version, *records):
    fields = "URL IP-address Archive-date Content-type " + ("Result-code Checksum Location Offset Filename " if version == 2 else "") + "Archive-length"
    block = f"{version} 0 test\n{fields}\n".encode()
    return f"filedesc://t.arc 0.0.0.0 20240101000000 text/plain {len(block)}\n".encode() + block + b"".join(b"\n" + r for r in records)


def record(line, body):
    return f"{line} {len(body)}\n".encode() + body


def converted(spark, data):
    path = f"{storage.folder(spark, 'arc-test')}/t.arc"
    storage.write_atomic(path, [data])
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    warcs = archive.convert(files, storage.folder(spark, "warc-test"))
    name = warcs.first()["warc"]
    fs, own = storage.filesystem(name)
    with fs.open_input_stream(own, compression=None) as f:
        return files, list(archive.warc_records(f))


def test_version_is_the_files_own(spark):
    """A version 2 line keeps its ten fields whatever its date is."""
    _, found = converted(spark, arc(2, record("http://a/b c 1.2.3.4 00000000000000 text/html 200 - - 0 t.arc", b"HTTP/1.1 200 OK\r\n\r\nx")))
    fields = found[1][0]
    assert (fields["WARC-Target-URI"], fields["WARC-IP-Address"], fields["WARC-Date"]) == ("http://a/b%20c", "1.2.3.4", "1970-01-01T00:00:00Z")


def test_bad_header_lines_are_counted_rejects(spark):
    good = [record(f"http://h/{i} 1.1.1.1 20240101000000 text/html", f"HTTP/1.1 200 OK\r\nX-Page-Id: {i}\r\n\r\nbody {i}".encode()) for i in range(3)]
    data = arc(1, good[0], b"this is no header\nnor this\n" + good[1], b"http://short 1.1.1.1 20240101000000 text/html many\nrest" + b"\n" + good[2], b"tail without end")
    files, found = converted(spark, data)
    assert [r["WARC-Target-URI"] for r, _ in found[1:]] == [f"http://h/{i}" for i in range(3)]
    lost = sorted((r.line, r.size) for r in archive.rejected(archive.list_records(files)).collect())
    assert [x for x, _ in lost] == ["http://short 1.1.1.1 20240101000000 text/html many", "tail without end", "this is no header"]
    assert sum(n for _, n in lost) + sum(map(len, good)) <= len(data)


def test_members_of_any_size():
    parts = [b"a" * n for n in (0, 1, 70_000, 300_000, 5)]
    data = b"".join(map(archive.gzip_member, parts))
    for step in (7, 1 << 10, 1 << 16, 1 << 20):
        assert list(archive.gzip_members(io.BytesIO(data), step)) == parts
    cut = list(archive.gzip_members(io.BytesIO(data[:-3])))
    assert cut[:4] == parts[:4]


@pytest.mark.parametrize("records", [8000])
def test_reading_takes_time_in_proportion(records):
    """Four times the records take some four times as long, not sixteen."""
    import os

    def file(n):
        return b"".join(archive.gzip_member(archive.warc_record("resource", f"<{i}>", "1970-01-01T00:00:00Z", os.urandom(2000), {})) for i in range(n))

    def took(data):
        start = time.process_time()
        assert sum(1 for _ in archive.warc_records(io.BytesIO(data))) > 0
        return time.process_time() - start

    small, large = file(records), file(4 * records)
    assert min(took(large) for _ in range(2)) < 8 * min(took(small) for _ in range(2)) + 0.2
