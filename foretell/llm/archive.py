"""WARC records in ZIP packages: written as stored members, read back by ranges without extraction."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.session import cut_lineage, ship_package

#: Compressed bytes after which a task begins another package, and of a range that one task reads.
PACKAGE_BYTES, RANGE_BYTES = 64 << 20, 1 << 20
#: Compressed bytes of a reading task: this many, or more where the session's shuffle partitions would not do.
LEAST_TASK_BYTES, MOST_TASK_BYTES = 2 << 20, 64 << 20
RECORDS_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdxj"
READ_SCHEMA = (
    "path string, offset long, record_id string, record_type string, target_uri string, date string, "
    "payload_digest string, payload_bytes long, payload binary, refers_to string"
)
Reader = Callable[[int, int], bytes]  # bytes, offset


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI, on any store that Arrow knows."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


class Member(NamedTuple):
    name: str
    method: int
    packed: int
    size: int
    header: int


def read_directory(read: Reader, size: int) -> list[Member]:
    """Members of a ZIP file of ``size`` bytes, from its central directory, ZIP64 or not."""
    tail_at = max(0, size - 22 - 0xFFFF)
    tail = read(size - tail_at, tail_at)
    at = len(tail)
    while True:  # the record's comment must end where the file ends
        at = tail.rfind(b"PK\5\6", 0, at + 3 if at < len(tail) else at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file, or cut off")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
        at -= 1
    count, length, offset = struct.unpack_from("<HLL", tail, at + 10)
    end = tail_at + at
    if 0xFFFF == count or 0xFFFFFFFF in (length, offset):
        signature, _, place, _ = struct.unpack("<4sLQL", read(20, end - 20)) if end >= 20 else (b"", 0, 0, 0)
        if signature == b"PK\6\7":
            fields = struct.unpack("<4sQHHLLQQQQ", read(56, place))
            if fields[0] != b"PK\6\6":
                raise ValueError("the ZIP64 end of central directory is not where its locator says")
            count, length, offset = fields[7:10]
    data, members, at = read(length, offset), [], 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, full, n, extra, comment = struct.unpack_from("<LLHHH", data, at + 20)
        header, = struct.unpack_from("<L", data, at + 42)
        name = data[at + 46 : at + 46 + n].decode("utf-8", "replace")
        pos, stop = at + 46 + n, at + 46 + n + extra
        while pos + 4 <= stop:
            tag, width = struct.unpack_from("<HH", data, pos)
            if tag == 1:  # 64-bit values of those fields that overflow, in this order
                wide = pos + 4
                for field in ("full", "packed", "header"):
                    value = {"full": full, "packed": packed, "header": header}[field]
                    if value == 0xFFFFFFFF and wide + 8 <= pos + 4 + width:
                        value, = struct.unpack_from("<Q", data, wide)
                        wide += 8
                    if field == "full":
                        full = value
                    elif field == "packed":
                        packed = value
                    else:
                        header = value
            pos += 4 + width
        members.append(Member(name, method, packed, full, header))
        at = stop + comment
    return members


def data_offset(read: Reader, member: Member) -> int:
    """Where a stored member's bytes begin. A compressed member has no ranges, which is an error."""
    if member.method != 0:
        raise ValueError(f"member {member.name} is compressed; only stored members can be read by ranges")
    head = read(30, member.header)
    if head[:4] != b"PK\3\4":
        raise ValueError(f"no local header of {member.name}")
    n, extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + n + extra


def _digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def pack_record(row: dict) -> bytes:
    """One gzip member with one WARC record; a revisit has HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n"
    body = http.encode() + (row["payload"] if row["record_type"] == "response" else b"")
    uri = re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", row["target_uri"])
    head = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>", f"WARC-Date: {row['date']}",
        f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{_digest(row['sha1'])}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if row["record_type"] == "revisit":
        head.insert(2, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(3, f"WARC-Refers-To: <{row['refers_to']}>")
    data = ("\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"
    packer = zlib.compressobj(4, wbits=31)
    return packer.compress(data) + packer.flush()


def parse_record(data: bytes) -> dict:
    """Fields of one WARC record; a payload with a SHA-1 digest is checked against it.

    Of an HTTP record the payload is what follows its headers, of any other one the whole block.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    missing = [k for k in ("warc-type", "warc-record-id", "content-length") if k not in fields]
    if missing:
        raise ValueError(f"a record without {', '.join(missing)}")
    block = rest[: int(fields["content-length"])]
    http, payload = b"", block
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    kind, _, digest = fields.get("warc-payload-digest", "").rpartition(":")
    if not revisit and kind == "sha1" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    size = re.search(rb"(?i)\ncontent-length: *(\d+)", http)
    return {
        "record_id": fields["warc-record-id"].strip("<>"), "record_type": fields["warc-type"],
        "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "payload_digest": digest or None,
        "payload_bytes": int(size[1]) if size else len(payload), "payload": None if revisit else payload,
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
    }


class _Package:
    """A package that is being written: records first, then their index."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"  # a repeated task writes another file
        store, place = open_store(self.path)
        self.stream = store.open_output_stream(place)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(RECORDS_MEMBER, "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, row: dict) -> None:
        data = pack_record(row)
        self.member.write(data)
        entry = {"url": row["target_uri"], "digest": _digest(row["sha1"]), "offset": self.size, "length": len(data),
                 "filename": RECORDS_MEMBER}
        key = re.sub(r"\s", "+", row["target_uri"]) or "-"
        self.lines.append(f"{key} {re.sub(r'[^0-9]', '', row['date'])} {json.dumps(entry)}")
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        self.member.close()
        self.zip.writestr(INDEX_MEMBER, "".join(f"{x}\n" for x in sorted(self.lines)))
        self.zip.writestr("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines)


def write_packages(records: DataFrame, folder: str, *, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write records as packages below ``folder``; returns ``path``, ``records`` of each, once all are written.

    Columns of ``records``: ``record_id``, ``record_type`` (response or revisit), ``target_uri``,
    ``date``, ``sha1`` (hex), ``payload_bytes``, ``payload``, ``refers_to``. Each task streams its
    rows to packages of its own. Files of attempts that failed are in the folder, but not in the result.
    """
    ship_package(records.sparkSession)
    store, place = open_store(folder)
    store.create_dir(place, recursive=True)

    def run(batches):
        package = None
        for batch in batches:
            done = []
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    package = package or _Package(folder)
                    package.add(row)
                    if package.size >= package_bytes:
                        done.append(package.close())
                        package = None
            if done:
                yield pa.RecordBatch.from_pydict({"path": [d[0] for d in done], "records": [d[1] for d in done]})
        if package:
            path, n = package.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    return cut_lineage(records.mapInArrow(run, "path string, records long"))


def _reader(path: str) -> tuple[Reader, int]:
    store, place = open_store(path)
    file = store.open_input_file(place)
    return lambda n, at: file.read_at(n, at), file.size()


def _scan(read: Reader, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip member between two offsets, for archives without an index."""
    while at < end:
        start, unpack = at, zlib.decompressobj(31)
        while not unpack.eof:
            data = read(min(1 << 16, end - at), at)
            if not data:
                raise ValueError("a record is cut off")
            unpack.decompress(data)
            at += len(data) - len(unpack.unused_data)
        yield start, at - start


def _scan_plain(read: Reader, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Offset and length of each record of an archive that is not compressed, by its Content-Length."""
    while at < end:
        head = b""
        while b"\r\n\r\n" not in head:
            more = read(min(1 << 12, end - at - len(head)), at + len(head))
            if not more:
                raise ValueError("a record is cut off")
            head += more
        head = head[: head.index(b"\r\n\r\n") + 4]
        size = re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)
        if not head.startswith(b"WARC/") or not size:
            raise ValueError("no WARC record where one should begin")
        length = len(head) + int(size[1])
        if at + length > end:
            raise ValueError("a record is cut off")
        yield at, length
        at += length
        while at < end and read(2, at) == b"\r\n":
            at += 2


def _records_of(path: str) -> list[tuple[int, int]]:
    """Offset and length of every record of a package."""
    read, size = _reader(path)
    starts: dict[str, int] = {}
    sizes: dict[str, int] = {}
    indexes = []
    for m in read_directory(read, size):
        if m.name.startswith("archive/") and m.name.endswith((".warc.gz", ".warc")):
            if m.name in starts:
                raise ValueError(f"{path} has two members {m.name}")
            starts[m.name], sizes[m.name] = data_offset(read, m), m.size
        elif m.name.startswith("indexes/") and m.name.endswith(".cdxj"):
            indexes.append(m)
    found, named = [], set()
    for m in indexes:
        for line in read(m.size, data_offset(read, m)).decode().splitlines():
            if not line.strip():
                continue
            entry = json.loads(line.split(" ", 2)[2])
            name = entry["filename"] if entry["filename"] in starts else f"archive/{entry['filename']}"
            if name not in starts:
                raise ValueError(f"{path}: {m.name} names {entry['filename']}, which is no archive of the package")
            named.add(name)
            found.append((starts[name] + int(entry["offset"]), int(entry["length"])))
    for name, start in starts.items():
        if name not in named:
            found += (_scan if name.endswith(".gz") else _scan_plain)(read, start, start + sizes[name])
    return found


def read_index(packages: DataFrame) -> DataFrame:
    """``path``, ``offset``, ``length`` of every record of the packages in ``packages.path``.

    From the package's index members (CDXJ); archives that no index names, compressed or not, are scanned record by
    record. An index that names no archive of the package, a name that comes twice and a compressed ZIP member are
    errors. Offsets count from the start of the package file.
    """
    ship_package(packages.sparkSession)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = _records_of(path)
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([path] * len(found), pa.string()), "offset": pa.array([f[0] for f in found], pa.int64()),
                    "length": pa.array([f[1] for f in found], pa.int64()),
                })

    return packages.select("path").mapInArrow(run, "path string, offset long, length long")


def read_records(index: DataFrame) -> DataFrame:
    """The records at ``path``, ``offset``, ``length``: each is one range read of its package.

    Columns: see ``READ_SCHEMA``. A payload that does not match its digest is an error.
    """
    ship_package(index.sparkSession)
    index = cut_lineage(index)
    # the index is small, what it points at is not: partitions follow the records' bytes
    total = index.agg(F.sum("length")).first()[0] or 0
    usual = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-total // MOST_TASK_BYTES), min(usual, -(-total // LEAST_TASK_BYTES)))
    near = index.repartition(parts, "path", F.floor(F.col("offset") / RANGE_BYTES)).sortWithinPartitions("path", "offset")

    def run(batches):
        path, read = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for entry in batch.slice(start, 256).to_pylist():
                    if entry["path"] != path:
                        path = entry["path"]
                        read, _ = _reader(path)
                    data = read(entry["length"], entry["offset"])
                    data = zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
                    rows.append({"path": path, "offset": entry["offset"], **parse_record(data)})
                yield pa.RecordBatch.from_pylist(rows, schema=_READ_FIELDS)

    return near.mapInArrow(run, READ_SCHEMA)


_READ_FIELDS = pa.schema([
    (name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
    for name, kind in (c.split() for c in READ_SCHEMA.split(", "))
])


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
    least_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Pages as WARC records, for ``write_packages``.

    The payload is the html in UTF-8, null as empty. Of equal payloads (same SHA-1) of at least
    ``least_revisit_bytes``, the page with the largest id is the response and the others are revisits
    that refer to it. Rows that repeat that id are responses too. A null id counts as smallest.

    Which page is the response is settled on ids and digests; whole pages are shuffled once, by page.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.coalesce(url_col, F.lit("")).alias("target_uri"),
        F.encode(F.coalesce(html_col, F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    narrow = rows.where(F.col("payload_bytes") >= least_revisit_bytes).select("id", "sha1")
    owners = narrow.groupBy("sha1").agg(F.max("id").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
    others = narrow.join(owners, "sha1").where(~F.col("id").eqNullSafe(F.col("owner"))).distinct()
    others = others.select(F.col("id").alias("other"), F.col("sha1").alias("other_sha1"), "owner")
    joined = rows.join(others, F.col("id").eqNullSafe(F.col("other")) & (F.col("sha1") == F.col("other_sha1")), "left")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")))
    revisit = F.col("other_sha1").isNotNull()
    return joined.select(
        name("id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.lit(date).alias("date"), "sha1", "payload_bytes", F.when(~revisit, F.col("payload")).alias("payload"),
        F.when(revisit, name("owner")).alias("refers_to"),
    )


def packages_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Packages by their URIs, for ``read_index``."""
    return spark.createDataFrame([(p,) for p in paths], "path string")
