"""WARC archives in ZIP packages: writing, and reading without extraction.

A package is a ZIP file with stored members: ``archive/data.warc.gz`` (one
gzip member per WARC record) and ``indexes/index.cdxj`` (one line per record,
sorted: url key, date, and as JSON the page and record ids, the payload's
digest, the record's type, and its offset and length in the archive member).
``index_rows`` reads only the indexes of packages, and ``read_records`` only
the records that chosen index rows name. A package is written front to back
in one pass by the task that has the pages, with ZIP64 fields throughout, so
neither sizes nor numbers of members are limited.

The reader parses the end record, the ZIP64 end record and locator and the
central directory from the tail of the file, locates stored members, reads
the index and then range-reads single records: nothing is extracted or read
whole. Compressed or encrypted members are refused.

Payloads that occur more than once: of the records with equal payloads of at
least ``MIN_REVISIT`` bytes, that with the smallest id is a response and the
others are revisits that name it. Only digests and ids are shuffled for that,
with partial minimums first, so a payload with very many copies is one small
row per task; payloads themselves never move between tasks unless the table
of repeated digests is too large for Spark to broadcast.

Files go through ``pyarrow.fs`` by URI to the shared stage folder, so any
store that it opens will do; packages are named by full URI. A task attempt writes a file of its own and only
the attempt that Spark keeps reports its name, so a lost executor or a second
attempt leaves at most a file that nobody reads.

Null payloads are empty. Rows with equal payloads and equal smallest ids are
all responses. Null urls are empty. A null id is written as an empty field,
read back as null, and counts as larger than every other. An empty input
writes no package.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaybook.llm.common import pick, prepare
from quaybook.plans.stages import new_stage_path, write_stage

MIN_REVISIT = 100
PACKAGE_BYTES = 1 << 28  # of payload, before the next package is begun
READ_AHEAD = 1 << 20  # neighbouring records are fetched together up to this size
TAIL = 1 << 16
DATE = "1970-01-01T00:00:00Z"  # of records whose table has no date

# Fixed values of the formats.
LOCAL, CENTRAL, END = 0x04034B50, 0x02014B50, 0x06054B50
END64, LOCATOR64 = 0x06064B50, 0x07064B50
STORED, ZIP64_EXTRA, FULL16, FULL32 = 0, 1, 0xFFFF, 0xFFFFFFFF
ROWS = ("page_id string, url string, record_type string, refers_to string, payload_bytes long, "
        "payload_digest string, payload binary")
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def package_uri(folder: str) -> str:
    """A new package's name below ``folder``, with the folder's scheme."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}.wacz"


class Member(NamedTuple):
    name: str
    offset: int  # of the local header
    size: int
    crc: int


class ZipWriter:
    """Stored members, written in sequence; sizes follow the data."""

    def __init__(self, out):
        self.out, self.at, self.members = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.start, self.crc, self.size = name.encode(), self.at, 0, 0
        extra = struct.pack("<HHQQ", ZIP64_EXTRA, 16, 0, 0)
        # Bit 3: sizes and crc stand behind the data. Bit 11: names in UTF-8.
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x0808, STORED, 0, 0x21, 0, FULL32, FULL32, len(self.name), len(extra))
                  + self.name + extra)

    def data(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(struct.pack("<IIQQ", 0x08074B50, self.crc, self.size, self.size))
        self.members.append((self.name, self.start, self.size, self.crc))

    def close(self) -> None:
        first = self.at
        for name, start, size, crc in self.members:
            extra = struct.pack("<HHQQQ", ZIP64_EXTRA, 24, size, size, start)
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x0808, STORED, 0, 0x21, crc, FULL32, FULL32,
                                  len(name), len(extra), 0, 0, 0, 0, FULL32) + name + extra)
        size, n, at64 = self.at - first, len(self.members), self.at
        self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, first))
        self._put(struct.pack("<IIQI", LOCATOR64, 0, at64, 1))
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, 0))


class ZipReader:
    """Stored members of a ZIP file that can seek, by range reads."""

    def __init__(self, file, size: int):
        self.file = file
        tail_at = max(0, size - TAIL - 22)
        tail = self._read(tail_at, size - tail_at)
        where = len(tail) - 22
        while (where := tail.rfind(struct.pack("<I", END), 0, where + 4)) >= 0:
            if where + 22 + struct.unpack_from("<H", tail, where + 20)[0] == len(tail):
                break  # the comment ends with the file
            where -= 1
        if where < 0:
            raise ValueError("no end of central directory")
        n, length, first = struct.unpack_from("<HII", tail, where + 10)
        if n == FULL16 or FULL32 in (length, first):
            sign, _, at64, _ = struct.unpack("<IIQI", self._read(tail_at + where - 20, 20))
            if sign != LOCATOR64:
                raise ValueError("no ZIP64 locator")
            sign, _, _, _, _, _, _, n, length, first = struct.unpack("<IQHHIIQQQQ", self._read(at64, 56))
            if sign != END64:
                raise ValueError("no ZIP64 end of central directory")
        self.members = dict(self._directory(self._read(first, length), n))

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the file is cut off")
        return data

    @staticmethod
    def _directory(data: bytes, n: int) -> Iterator[tuple[str, Member]]:
        at = 0
        for _ in range(n):
            sign, _, _, flags, method, _, _, crc, packed, size, a, b, c, _, _, _, offset = struct.unpack_from(
                "<IHHHHHHIIIHHHHHII", data, at)
            if sign != CENTRAL:
                raise ValueError("damaged central directory")
            name = data[at + 46:at + 46 + a].decode("utf-8" if flags & 0x800 else "cp437")
            extra, end = at + 46 + a, at + 46 + a + b
            while extra + 4 <= end:
                kind, length = struct.unpack_from("<HH", data, extra)
                if kind == ZIP64_EXTRA:
                    wide = iter(struct.unpack_from(f"<{length // 8}Q", data, extra + 4))
                    size = next(wide) if size == FULL32 else size
                    packed = next(wide) if packed == FULL32 else packed
                    offset = next(wide) if offset == FULL32 else offset
                extra += 4 + length
            if flags & 1 or method != STORED or packed != size:
                raise ValueError(f"{name} is not a plain stored member")
            yield name, Member(name, offset, size, crc)
            at = end + c

    def place(self, name: str) -> tuple[int, int]:
        """Where the bytes of a member lie in the file: (offset, size)."""
        m = self.members[name]
        head = self._read(m.offset, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ValueError(f"no local header of {name}")
        a, b = struct.unpack_from("<HH", head, 26)
        return m.offset + 30 + a + b, m.size

    def read(self, name: str, at: int = 0, n: int | None = None) -> bytes:
        start, size = self.place(name)
        n = size - at if n is None else n
        if at < 0 or at + n > size:
            raise ValueError(f"outside of {name}")
        return self._read(start + at, n)


def _clean(value: str) -> str:
    return " ".join(value.split())


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def url_key(url: str) -> str:
    """The host's labels from the last to the first, then the path, so that
    a host and its subdomains stand together in a sorted index."""
    _, found, rest = _clean(url).replace(" ", "%20").partition("://")
    if not found:
        return "-"
    host, slash, path = rest.partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + path


def index_line(page_id, url: str, digest: str, kind: str, offset: int, length: int, date: str = DATE) -> str:
    stamp = "".join(c for c in date if c.isdigit())
    return f"{url_key(url)} {stamp} " + json.dumps({
        "page": None if page_id is None else str(page_id), "record": record_id(page_id, digest), "digest": f"sha256:{digest}",
        "type": kind, "offset": offset, "length": length})


def parse_index(text: str) -> list[dict]:
    """The records that an index names, in archive order."""
    out = []
    for line in text.splitlines():
        key, stamp, rest = line.split(" ", 2)
        out.append({"url_key": key, "stamp": stamp, **json.loads(rest)})
    return sorted(out, key=lambda x: x["offset"])


def warc_record(page_id, url: str, payload: bytes, digest: str, refers_to, kind: str, date: str = DATE) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
              ("WARC-Target-URI", _clean(url)), ("X-Page-Id", "" if page_id is None else str(page_id)),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    body = b""
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("X-Refers-To-Page", str(refers_to))]
    else:
        body = payload
    fields.append(("Content-Length", str(len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", compresslevel=3, mtime=0)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("wrong record length")
    return fields, rest[:n]


def decisions(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(digest, first_id) of the payloads that occur more than once and are
    long enough for revisits."""
    payload = F.encode(F.coalesce(F.col("body"), F.lit("")), "UTF-8")
    digests = pick(pages, page_id=id_col, body=html_col).where(F.octet_length(payload) >= MIN_REVISIT).select(
        F.unhex(F.sha2(payload, 256)).alias("digest"), "page_id")
    return (digests.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
            .where("n > 1").select("digest", "first_id"))


def write_packages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write all pages; returns (path, records, bytes) per package, as written."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or new_stage_path(spark, "packages")
    first = write_stage(decisions(pages, id_col, html_col), "repeated")
    rows = pick(pages, page_id=id_col, url=url_col, body=html_col).select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("body", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.join(first, F.unhex(F.sha2("payload", 256)) == first["digest"], "left").select(
        "page_id", "url", "payload", "first_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(folder)
        fs.create_dir(base, recursive=True)
        package = None
        for batch in batches:
            for page_id, url, payload, first_id in zip(*(c for c in batch.columns), strict=True):
                page_id, first_id, payload = page_id.as_py(), first_id.as_py(), payload.as_py()
                if package is None:
                    path = package_uri(folder)
                    out = fs.open_output_stream(open_store(path)[1])
                    package, lines, held = ZipWriter(out), [], 0
                    package.begin(ARCHIVE)
                revisit = first_id is not None and page_id != first_id
                digest = hashlib.sha256(payload).hexdigest()
                url, kind = url.as_py(), "revisit" if revisit else "response"
                record = warc_record(page_id, url, payload, digest, first_id, kind)
                lines.append(index_line(page_id, url, digest, kind, package.size, len(record)))
                package.data(record)
                held += len(payload)
                if held >= package_bytes:
                    yield _finish(package, out, lines, path)
                    package = None
        if package is not None:
            yield _finish(package, out, lines, path)

    return write_stage(rows.mapInArrow(write, "path string, records long, bytes long"), "package-list")


def _finish(package: ZipWriter, out, lines: list[str], path: str) -> pa.RecordBatch:
    package.end()
    package.begin(INDEX)
    package.data(("\n".join(sorted(lines)) + "\n").encode())
    package.end()
    package.close()
    out.close()
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(lines)], pa.int64()), pa.array([package.at], pa.int64())],
                                      names=["path", "records", "bytes"])


def _runs(lines: list[dict], most: int) -> Iterator[list[dict]]:
    run: list[dict] = []
    for line in lines:
        if run and (line["offset"] != run[-1]["offset"] + run[-1]["length"]
                    or line["offset"] + line["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(line)
    if run:
        yield run


def read_package(file, size: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of a package that its index names, by range reads."""
    package = ZipReader(file, size)
    start, _ = package.place(ARCHIVE)
    lines = parse_index(package.read(INDEX).decode())
    for run in _runs(lines, READ_AHEAD):
        first = run[0]["offset"]
        data = package._read(start + first, run[-1]["offset"] + run[-1]["length"] - first)
        for line in run:
            at = line["offset"] - first
            yield parse_record(data[at:at + line["length"]])


def index_rows(packages: DataFrame) -> DataFrame:
    """(path, page_id, record_id, url_key, digest, record_type, at, length) of
    every record, from the indexes alone; ``at`` counts from the file's start."""
    prepare(packages.sparkSession)
    names = ["path", "page_id", "record_id", "url_key", "digest", "record_type", "at", "length"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, p = open_store(path)
                with fs.open_input_file(p) as file:
                    package = ZipReader(file, file.size())
                    start, _ = package.place(ARCHIVE)
                    lines = parse_index(package.read(INDEX).decode())
                columns = [[path] * len(lines), *([x[k] for x in lines] for k in ("page", "record", "url_key")),
                           [x["digest"].removeprefix("sha256:") for x in lines], [x["type"] for x in lines],
                           [start + x["offset"] for x in lines], [x["length"] for x in lines]]
                kinds = [pa.string()] * 6 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return packages.select("path").mapInArrow(read, "path string, page_id string, record_id string, url_key string, "
                                                    "digest string, record_type string, at long, length long")


def read_records(chosen: DataFrame) -> DataFrame:
    """The records of chosen ``index_rows``, as ``read_packages`` gives them;
    each is one range read, and nothing else of a package is read."""
    prepare(chosen.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, p = open_store(path)
                with fs.open_input_file(p) as file:
                    file.seek(at)
                    yield _batch([_row(*parse_record(file.read(length)))])

    return chosen.select("path", "at", "length").mapInArrow(read, ROWS)


def read_packages(packages: DataFrame) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload) of all records; a revisit's payload is null. A response's length
    and digest are those of the payload read, and must agree with its header."""
    prepare(packages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, p = open_store(path)
                rows: list[tuple] = []
                held = 0
                with fs.open_input_file(p) as file:
                    for fields, payload in read_package(file, file.size()):
                        rows.append(_row(fields, payload))
                        held += len(payload)
                        if held > READ_AHEAD:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return packages.select("path").repartition(max(1, packages.sparkSession.sparkContext.defaultParallelism)).mapInArrow(
        read, ROWS)


def _row(fields: dict[str, str], payload: bytes) -> tuple:
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
    return (fields["X-Page-Id"] or None, fields["WARC-Target-URI"], kind, fields.get("X-Refers-To-Page"),
            int(fields["X-Payload-Length"]), digest, payload if kind == "response" else None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])
