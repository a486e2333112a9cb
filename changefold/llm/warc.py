"""WARC records in ZIP packages: written by Spark tasks, read back by byte ranges without extraction.

A package holds stored (uncompressed) members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one line per record with its offset and length in the archive. The reader parses
the end record, the ZIP64 locator and end record, the central directory with ZIP64 fields, and the local
headers itself, reads the index, and fetches records by ranges.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import open_fs, put_file, utf8, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
IDENTITY = "urn:record:"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records -------------------------------------------------------------------------------------------

def _name(key: str | None) -> str:
    return f"<{IDENTITY}{'none' if key is None else 'id:' + quote(key, safe='')}>"


def _key(name: str) -> str | None:
    own = name.strip("<>").removeprefix(IDENTITY)
    return None if own == "none" else unquote(own.removeprefix("id:"))


def make_record(key: str | None, url: str | None, payload: bytes, refers_to: str | None, revisit: bool, date: str) -> bytes:
    """One WARC 1.1 record; a revisit has the response's HTTP head without the payload."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _name(key), "WARC-Date": date,
        "WARC-Payload-Digest": "sha256:" + hashlib.sha256(payload).hexdigest(),
        "Content-Type": "application/http;msgtype=response",
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")
    if revisit:
        head |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": _name(refers_to)}
    else:
        block += payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers (lower-case names) and payload of one uncompressed record."""
    if not data.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    at = data.index(b"\r\n\r\n")
    head = _headers(data[:at])
    block = data[at + 4:at + 4 + int(head["content-length"])]
    if len(block) != int(head["content-length"]):
        raise ValueError("the record is cut off")
    split = block.index(b"\r\n\r\n")
    return head, _headers(block[:split]), block[split + 4:]


def _headers(data: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in data.decode().split("\r\n")[1:])
    return {k.lower(): v for k, v in pairs}


# -- packages ------------------------------------------------------------------------------------------

class Package:
    """A ZIP package filled record by record."""

    def __init__(self):
        self.archive, self.index = io.BytesIO(), []

    def add(self, key: str | None, url: str | None, record: bytes) -> None:
        body = gzip.compress(record, compresslevel=4, mtime=0)
        line = {"id": key, "url": url, "offset": self.archive.tell(), "length": len(body), "filename": ARCHIVE}
        self.index.append(json.dumps(line, ensure_ascii=True))
        self.archive.write(body)

    def size(self) -> int:
        return self.archive.tell()

    def finish(self) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
            for name, body in ((ARCHIVE, self.archive.getvalue()), (INDEX, "\n".join(self.index).encode())):
                with package.open(zipfile.ZipInfo(name), "w", force_zip64=True) as member:
                    member.write(body)
        return out.getvalue()


@dataclass
class Member:
    """A stored member: where its bytes start in the package, and how many there are."""
    start: int
    length: int


def members(read: Callable[[int, int], bytes], size: int) -> dict[str, Member]:
    """The stored members of a package, from its central directory; ``read(offset, length)`` reads ranges."""
    tail_at = max(0, size - 22 - 65535)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the signature may also stand inside the comment
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = read(tail_at + end - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end64 = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", end64, 32)
    directory, at = read(start, length), 0
    found = {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        stored, full, names, extras, comments = struct.unpack_from("<IIHHH", directory, at + 20)
        offset = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46:at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + names:at + 46 + names + extras]
        stored, full, offset = _zip64(extra, stored, full, offset)
        if not name.endswith("/"):
            if method or stored != full:
                raise ValueError(f"{name} is not stored")
            local = read(offset, 30)
            if local[:4] != b"PK\x03\x04":
                raise ValueError(f"{name} has no local header")
            found[name] = Member(offset + 30 + sum(struct.unpack_from("<HH", local, 26)), stored)
        at += 46 + names + extras + comments
    return found


def _zip64(extra: bytes, stored: int, full: int, offset: int) -> tuple[int, int, int]:
    """Sizes and offset from the ZIP64 extra field, which holds only those that overflow, in fixed order."""
    at = 0
    while at + 4 <= len(extra):
        tag, length = struct.unpack_from("<HH", extra, at)
        if tag == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            full = next(wide) if full == 0xFFFFFFFF else full
            stored = next(wide) if stored == 0xFFFFFFFF else stored
            offset = next(wide) if offset == 0xFFFFFFFF else offset
        at += 4 + length
    return stored, full, offset


def read_package(read: Callable[[int, int], bytes], size: int, span: int = 8 << 20) -> Iterator[tuple[dict, bytes]]:
    """(index entry, uncompressed record) of every indexed record; neighbouring records share a range read."""
    stored = members(read, size)
    for name in sorted(n for n in stored if n.startswith("indexes/")):
        text = read(stored[name].start, stored[name].length).decode()
        entries = [json.loads(line) for line in text.splitlines() if line]
        at, group = 0, []
        for i, entry in enumerate(entries):
            group.append(entry)
            last = i + 1 == len(entries)
            follows = not last and entries[i + 1]["filename"] == entry["filename"] \
                and entries[i + 1]["offset"] == entry["offset"] + entry["length"]
            if not follows or entry["offset"] + entry["length"] - group[0]["offset"] >= span:
                home = stored[entry["filename"]]
                at = group[0]["offset"]
                data = read(home.start + at, entry["offset"] + entry["length"] - at)
                for e in group:
                    body = data[e["offset"] - at:e["offset"] - at + e["length"]]
                    yield e, gzip.decompress(body)
                group = []


# -- Spark ---------------------------------------------------------------------------------------------

def mark_revisits(pages: DataFrame, key: str = "page_id", html: str = "html", least_bytes: int = 100) -> DataFrame:
    """(``key``, ``payload``, other columns) with ``refers_to`` and ``revisit``.

    Of equal payloads of at least ``least_bytes`` bytes, those with the smallest key stay responses and the
    others refer to it. The smallest key is aggregated before the shuffle; a payload that a third of the
    pages share is a skewed join with one row on the other side, which is split.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    digest = F.when(F.octet_length(payload) >= least_bytes, F.sha2(payload, 256))
    own = pages.select(F.col(key).alias("__key"), digest.alias("__digest")).where(F.col("__digest").isNotNull())
    firsts = own.groupBy("__digest").agg(F.min("__key").alias("__first"), F.count(F.lit(1)).alias("__n")) \
        .where("__n > 1").drop("__n")
    joined = pages.withColumn("__digest", digest).join(firsts, "__digest", "left")
    revisit = F.col("__first").isNotNull() & ~F.col(key).eqNullSafe(F.col("__first"))
    return joined.withColumn("revisit", revisit).withColumn(
        "refers_to", F.when(F.col("revisit"), F.col("__first"))).drop("__digest", "__first")


def write_packages(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
                   package_bytes: int = 32 << 20, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Write one record per page; returns the packages that belong to the result (``path``, ``bytes``, ``records``).

    Packages are named anew by every attempt of a task, and only those of the attempt that counts are in
    the returned table, so lost executors and repeated tasks leave no double records. NULL html is an
    empty payload; NULL keys and urls are kept as such; repeated rows are records of their own; an empty
    table gives no package.
    """
    rows = mark_revisits(pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                                      F.col(html).alias("html")), "key")
    rows = rows.select(F.col("key").cast("string").alias("key"), "url", "html",
                       F.col("refers_to").cast("string").alias("refers_to"), "revisit")

    def run(batches):
        package = Package()

        def close():
            body = package.finish()
            path = put_file(folder, f"pages-{uuid.uuid4().hex}.wacz", [body])
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [len(body)], "records": [len(package.index)]})

        for batch in batches:
            for i, payload in enumerate(utf8(batch.column(2))):
                own, address, to, again = (batch.column(c)[i].as_py() for c in (0, 1, 3, 4))
                package.add(own, address, make_record(own, address, payload or b"", to, again, date))
                if package.size() >= package_bytes:
                    yield close()
                    package = Package()
        if package.index:
            yield close()

    schema = StructType([StructField("path", StringType()), StructField("bytes", LongType()), StructField("records", LongType())])
    return written(rows.mapInArrow(run, schema), "warc-packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """Every record of the packages: key, url, type, payload size and digest, the key it refers to, the payload.

    A response's digest is computed from its payload and must be the one in its head. A revisit has no
    payload of its own (NULL); its size and digest are those its head declares.
    """
    schema = "key string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, own = open_fs(path)
                with system.open_input_file(own) as file:
                    rows, held = [], 0
                    for entry, data in read_package(lambda at, n: file.read_at(n, at), file.size()):
                        rows.append(_row(entry, data))
                        held += len(data)
                        if held > 8 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                    yield _batch(rows, names)

    return packages.select("path").repartition(max(1, packages.count()), "path").mapInArrow(run, schema)


def _row(entry: dict, data: bytes) -> tuple:
    head, http, payload = parse_record(data)
    key, declared = _key(head["warc-record-id"]), head["warc-payload-digest"].removeprefix("sha256:")
    if head["warc-type"] == "revisit":
        return (key, entry["url"], "revisit", _key(head["warc-refers-to"]), int(http["content-length"]), declared, None)
    digest = hashlib.sha256(payload).hexdigest()
    if digest != declared:
        raise ValueError(f"the payload of {head['warc-record-id']} is damaged")
    return (key, entry["url"], "response", None, len(payload), digest, payload)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)


