"""Legacy ARC archives to WARC, with revisit records for repeated payloads.

ARC files begin with a version block that names the fields of the header
lines; each record is such a line and as many bytes as its last field
declares.  Version 1 has URL, IP address, date, type and length; version 2 adds
result code, checksum, location, offset and file name before the length.
WARC records get a name-based UUID of their origin, an ISO timestamp, a type
(``response`` for HTTP, ``resource`` for others, ``revisit`` for a payload that
an earlier record has) and SHA-1 digests of block and payload.

Of records with equal payloads of at least ``min_bytes``, the one with the
smallest key is kept whole and the others revisit it.  The key is a whole
number in an HTTP header (``key_header``).

ARC files may be plain or gzip members, as ``.arc.gz`` has them (one a record,
or any other cut); a task then holds one inflated file.  Offsets are those of
the plain bytes.

Defined cases: records without a key, or with one that is no number, come last
and keep null; ties go to the first by file and offset; an empty payload is a
payload; a record shorter than declared is marked ``WARC-Truncated``; a date
that is none becomes 1970; a last gzip member cut short gives what it has; spaces
in URLs are allowed; no files give no rows.  A line that is no header is a reject
(``rejected``): the bytes up to the next line that is one are skipped and counted.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import storage
from stratum.llm import text as T
from stratum.llm.token_shards import runs

KEY_HEADER = "X-Page-Id"
GZIP = b"\x1f\x8b"
FIELDS = {"1": 5, "2": 10}
RECORD = "file string, at long, line string, body_at long, size long, parts long, key long, payload_bytes long, payload_digest string"
# the start of a header line: URL, address, date of 14 digits, and the length last
_HEADER = re.compile(rb"\n(?=[A-Za-z][A-Za-z0-9+.\-]*:[^\n]* \S+ \d{14} [^\n]* \d+\r?\n)")
_DATE = re.compile(r"(\d{4})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])([01]\d|2[0-3])([0-5]\d)([0-5]\d)$")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc_records(data: bytes):
    """(offset, line, header fields, body offset, declared length) of each record
    after the version block of an ARC file."""
    def line_at(at):
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        return data[at:end].decode("utf-8", "replace").rstrip("\r"), end + 1

    if not data:
        return
    head, at = line_at(0)
    version = data[at:at + 1].decode("ascii", "replace")
    if not head.startswith("filedesc://") or version not in FIELDS:
        raise ValueError(f"not an ARC file of version 1 or 2: {head[:80]!r}")
    at += int(head.rsplit(" ", 1)[1])
    while True:
        while data[at:at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        line, body = line_at(at)
        fields = line.rsplit(" ", FIELDS[version] - 1)
        if len(fields) != FIELDS[version] or not fields[-1].isdigit():
            found = _HEADER.search(data, at)
            end = found.end() if found else len(data)
            yield at, line, [], at, end - at
            at = end
            continue
        yield at, line, fields, body, int(fields[-1])
        at = body + int(fields[-1])


def http_parts(body: bytes) -> tuple[bytes | None, bytes]:
    """(HTTP head or None, payload)."""
    if not body.startswith(b"HTTP/"):
        return None, body
    head, mark, payload = body.partition(b"\r\n\r\n")
    return head + mark, payload


def key_of(head: bytes | None, name: str) -> int | None:
    m = re.search(rb"(?im)^%s:[ \t]*(-?\d{1,18})[ \t]*\r?$" % re.escape(name.encode()), head or b"")
    return int(m[1]) if m else None


def iso_date(date: str) -> str:
    m = _DATE.match(date)
    return "{}-{}-{}T{}:{}:{}Z".format(*m.groups()) if m else "1970-01-01T00:00:00Z"


def record_id(file: str, at: int) -> str:
    """The name of the record at a place in a file: the same in any attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{at}')}>"


def inflated(data: bytes, step: int = 1 << 16) -> bytes:
    """The plain bytes of an ARC file."""
    out, at = [], 0
    while data[at:at + 2] == GZIP:
        z = zlib.decompressobj(wbits=31)
        while at < len(data) and not z.eof:
            part = data[at:at + step]
            out.append(z.decompress(part))
            at += len(part) - len(z.unused_data)
    return b"".join(out) if out else data


def short_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def list_records(arcs: DataFrame, key_header: str = KEY_HEADER) -> DataFrame:
    """A narrow row for each record of ``arcs`` (``path, content``, as Spark's
    ``binaryFile`` reader gives them)."""
    T.prepare(arcs.sparkSession)

    def scan(batches):
        for batch in batches:
            for path, content in zip(*(batch.column(c) for c in ("path", "content"))):
                rows, data = [], inflated(content.as_py())
                for at, line, fields, body_at, size in arc_records(data):
                    if not fields:
                        rows.append((path.as_py(), at, line, body_at, size, 0, None, None, None))
                        continue
                    head, payload = http_parts(data[body_at:body_at + size])
                    rows.append((path.as_py(), at, line, body_at, size, len(fields), key_of(head, key_header), len(payload), base32_sha1(payload)))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(_names(RECORD), r)) for r in rows], _schema(RECORD))

    return arcs.select("path", "content").mapInArrow(scan, RECORD)


def _names(ddl: str) -> list[str]:
    return [f.split()[0] for f in ddl.split(", ")]


def _schema(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def rejected(records: DataFrame) -> DataFrame:
    """``file, at, line, size`` of the lines in ``list_records`` that are no
    header, with the bytes skipped for each."""
    return records.where("parts = 0").select("file", "at", "line", "size")


def decide(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``records`` with ``origin_file, origin_at`` of the record each revisits."""
    place = F.struct(F.col("key").isNull().alias("none"), "key", "file", "at")
    large = F.col("payload_bytes") >= min_bytes
    first = (records.where(large).groupBy("payload_digest", "payload_bytes").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), "origin"))
    joined = records.join(first, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")), "left")
    other = ~((F.col("origin.file") == F.col("file")) & (F.col("origin.at") == F.col("at")))
    return joined.select(*records.columns, F.when(other, F.col("origin.file")).alias("origin_file"), F.when(other, F.col("origin.at")).alias("origin_at"))


def warc_record(kind: str, rid: str, date: str, block: bytes, fields: dict[str, str]) -> bytes:
    head = {"WARC-Type": kind, "WARC-Record-ID": rid, "WARC-Date": date, "WARC-Block-Digest": f"sha1:{base32_sha1(block)}", **fields,
            "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(1, wbits=31)
    return z.compress(data) + z.flush()


def write_warcs(decided: DataFrame, path: str) -> DataFrame:
    """Write ``name.warc.gz`` for each ARC file; the written files as a staged
    table ``warc``.  A record is read at its offset, so of a plain file a task
    holds one."""
    columns = ["file", "at", "line", "body_at", "size", "parts", "payload_bytes", "payload_digest", "origin_file", "origin_at"]

    def members(file, groups, f):
        info = f"format: WARC File Format 1.1\r\nconverted-from: {short_name(file)}\r\n".encode()
        yield gzip_member(warc_record("warcinfo", record_id(file, 0), "1970-01-01T00:00:00Z", info, {"Content-Type": "application/warc-fields"}))
        for batch in groups:
            for r in batch.to_pylist():
                if not r["parts"]:
                    continue
                fields = r["line"].rsplit(" ", r["parts"] - 1)          # as many as the file's version has
                f.seek(r["body_at"])
                body = f.read(r["size"])
                head, payload = http_parts(body)
                more = {"WARC-Target-URI": fields[0].replace(" ", "%20"), "WARC-IP-Address": fields[1],
                        "WARC-Payload-Digest": f"sha1:{r['payload_digest']}", "X-Payload-Length": str(r["payload_bytes"])}
                more["Content-Type"] = "application/http;msgtype=response" if head is not None else fields[3]
                if len(body) < r["size"]:
                    more["WARC-Truncated"] = "length"
                kind = "response" if head is not None else "resource"
                if r["origin_file"] is not None:
                    kind, body = "revisit", head or b""
                    more |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                             "WARC-Refers-To": record_id(r["origin_file"], r["origin_at"])}
                yield gzip_member(warc_record(kind, record_id(r["file"], r["at"]), iso_date(fields[2]), body, more))

    def write(batches):
        held, groups = None, []

        def close():
            fs, name = storage.filesystem(held)
            out = f"{path}/{short_name(held)}.warc.gz"
            with fs.open_input_file(name) as f:
                packed = f.read(2) == GZIP
                f.seek(0)
                storage.write_atomic(out, members(held, groups, io.BytesIO(inflated(f.read())) if packed else f))
            return pa.RecordBatch.from_pydict({"warc": [out]})

        for file, part in runs(batches, "file"):
            if groups and file != held:
                yield close()
                groups = []
            held = file
            groups.append(part)
        if groups:
            yield close()

    ordered = decided.select(*columns).repartition("file").sortWithinPartitions("file", "at")
    return storage.stage(ordered.mapInArrow(write, "warc string"), "warc-files")


def gzip_members(f, step: int = 1 << 16):
    """The plain bytes of each gzip member of a stream, read in steps."""
    z, out, data = zlib.decompressobj(wbits=31), [], f.read(step)
    while data:
        out.append(z.decompress(data))
        data = z.unused_data                                 # less than a step
        if z.eof:
            yield b"".join(out)
            z, out = zlib.decompressobj(wbits=31), []
        data = data or f.read(step)
    if out:
        yield b"".join(out)


def warc_records(f):
    """(header fields, block) of each record of a stream of a gzipped WARC file."""
    for raw in gzip_members(f):
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        yield fields, rest[:int(fields["Content-Length"])]


def read_warcs(files: DataFrame, key_header: str = KEY_HEADER) -> DataFrame:
    """``key, payload_bytes, payload_digest, record_type, record_id,
    refers_to_id`` of each record (but ``warcinfo``) of the files ``warc``.
    Digests of whole payloads are computed anew; a wrong one is an error."""
    ddl = "key long, payload_bytes long, payload_digest string, record_type string, record_id string, refers_to_id string"

    def read(batches):
        for batch in batches:
            for warc in batch.column("warc").to_pylist():
                fs, name = storage.filesystem(warc)
                rows = []
                with fs.open_input_stream(name, compression=None) as f:
                    for fields, block in warc_records(f):
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        head, payload = http_parts(block)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        n = int(fields["X-Payload-Length"])
                        if kind != "revisit" and (base32_sha1(payload) != digest or len(payload) != n):
                            raise ValueError(f"{warc}: payload of {fields['WARC-Record-ID']} does not match its digest")
                        rows.append((key_of(head, key_header), n, digest, kind, fields["WARC-Record-ID"], fields.get("WARC-Refers-To")))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(_names(ddl), r)) for r in rows], _schema(ddl))

    n = max(1, files.count())
    return files.repartition(n).mapInArrow(read, ddl)


def convert(arcs: DataFrame, path: str, key_header: str = KEY_HEADER, min_bytes: int = 0) -> DataFrame:
    """Convert all records of ``arcs`` to WARC files under ``path``; returns the
    files written, as ``warc``."""
    return write_warcs(decide(list_records(arcs, key_header), min_bytes), path)


def resolve(records: DataFrame) -> DataFrame:
    """``records`` of ``read_warcs`` with ``refers_to``, the key of the record
    that each revisits."""
    whole = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("origin_id"), F.col("key").alias("refers_to"))
    return records.join(whole, F.col("refers_to_id") == F.col("origin_id"), "left").drop("origin_id")
