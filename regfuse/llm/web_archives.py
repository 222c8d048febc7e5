"""Pages as WARC records inside ZIP archives, and a reader that takes records out by byte ranges.

An archive is a ZIP file of two members that are stored, not compressed: ``archive/data.warc.gz`` (each record compressed
on its own, as usual for WARC) and ``indexes/index.cdxj`` (a line of JSON per record with its offset and length).  The
reader never extracts an archive: it finds the end record (and, past the 32-bit limits, the ZIP64 locator and end
record), reads the central directory, steps over the member's local header, and from then on reads ranges: the index, then
only the bytes of the records that are wanted.

A task writes its archives straight into the shared folder, a record at a time, under names no other attempt uses; the
written manifest of finished archives is what counts, so files of a lost or repeated attempt are never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfuse.llm.common import BATCH_BYTES, ship, small_batches, written
from regfuse.session import checkpoint_dir, remove

ARCHIVE_BYTES, ARCHIVE_RECORDS, SPAN_BYTES = 256 << 20, 100_000, 1 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "archive string, n_records bigint, n_bytes bigint"
_ENTRY = "archive string, at bigint, length bigint, page_id bigint, record_type string, payload_digest string"
_RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
# --- fixed values: signatures and sizes of the ZIP format ---
END, END64, LOCATOR64, CENTRAL, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
END_SIZE, LOCATOR64_SIZE, END64_SIZE, CENTRAL_SIZE, LOCAL_SIZE, MOST_COMMENT = 22, 20, 56, 46, 30, 65535


# ---- records ---------------------------------------------------------------
def _header_value(text: str) -> str:
    """A header's value on one line of printable ASCII: other characters are percent-encoded."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in text)


def warc_record(record_id: str, page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str,
                first: tuple[str, int | None] | None, date: str = DATE) -> bytes:
    """One WARC record, compressed on its own.  ``size`` and ``digest`` are those of the full payload; ``first``: None for a
    response, else the record's id and page id of the response that this record revisits (without its payload)."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if first else http + payload
    head = {"WARC-Type": "revisit" if first else "response", "WARC-Record-ID": f"<urn:uuid:{record_id}>", "WARC-Date": date}
    if url is not None:
        head["WARC-Target-URI"] = _header_value(url)
    if page_id is not None:
        head["X-Page-Id"] = page_id
    if first:
        head |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:uuid:{first[0]}>"}
        if first[1] is not None:
            head["X-Refers-To-Page-Id"] = first[1]
    head |= {"WARC-Payload-Digest": f"sha1:{digest}", "Content-Type": "application/http; msgtype=response", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return gzip.compress(f"WARC/1.1\r\n{lines}\r\n".encode("ascii") + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> dict:
    """The fields of one compressed record.  A response whose payload does not have its digest is an error."""
    data = zlib.decompress(data, wbits=31)
    top, _, rest = data.partition(b"\r\n\r\n")
    lines = top.decode("ascii").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[: int(head["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    number = lambda k: int(head[k]) if k in head else None
    response = head["WARC-Type"] == "response"
    if response and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
    return {
        "page_id": number("X-Page-Id"), "url": head.get("WARC-Target-URI"), "record_type": head["WARC-Type"], "payload_bytes": size,
        "payload_digest": digest, "refers_to": number("X-Refers-To-Page-Id"), "payload": payload if response else None,
    }


# ---- archives --------------------------------------------------------------
def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path and the path in it: a mounted folder, or any store that Arrow knows by its address."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class ArchiveWriter:
    """Records into one archive; nothing but the index lines is held in memory."""

    def __init__(self, path: str):
        self.path, self.lines, self.at = path, [], 0
        store, inside = _opened(path)
        store.create_dir(inside.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(inside)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)

    def add(self, record: bytes, page_id: int | None, record_type: str, digest: str) -> None:
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.at, "length": len(record), "type": record_type, "digest": digest}))
        self.member.write(record)
        self.at += len(record)

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "".join(x + "\n" for x in self.lines))
        self.zip.close()
        self.out.close()
        return self.path, len(self.lines), self.at


class ArchiveReader:
    """Members of a ZIP archive by byte ranges, from its central directory."""

    def __init__(self, path: str):
        store, inside = _opened(path)
        self.file = store.open_input_file(inside)
        self.size = self.file.size()
        self.members = self._directory()
        self.starts: dict[str, int] = {}

    def close(self) -> None:
        self.file.close()

    def _at(self, offset: int, length: int) -> bytes:
        if offset < 0 or offset + length > self.size:
            raise ValueError("the archive is damaged: a range lies outside of it")
        return self.file.read_at(length, offset)

    def _end(self) -> tuple[int, int, int]:
        """How many members, and size and offset of the central directory."""
        tail_at = max(0, self.size - END_SIZE - MOST_COMMENT)
        tail = self._at(tail_at, self.size - tail_at)
        at = tail.rfind(struct.pack("<I", END))
        while at >= 0 and (at + END_SIZE > len(tail) or at + END_SIZE + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(struct.pack("<I", END), 0, at)  # the signature inside the comment
        if at < 0:
            raise ValueError("not a ZIP archive: it has no end record")
        count, size, offset = struct.unpack_from("<HII", tail, at + 10)
        locator_at = tail_at + at - LOCATOR64_SIZE
        if locator_at >= 0:
            signature, _, end_at, _ = struct.unpack("<IIQI", self._at(locator_at, LOCATOR64_SIZE))
            if signature == LOCATOR64:
                end = self._at(end_at, END64_SIZE)
                if struct.unpack_from("<I", end)[0] != END64:
                    raise ValueError("the archive is damaged: its ZIP64 end record is not where the locator says")
                count, size, offset = struct.unpack_from("<QQQ", end, 32)
        return count, size, offset

    def _directory(self) -> dict[str, tuple[int, int, int]]:
        """Member -> (method, size as stored, offset of its local header)."""
        count, size, offset = self._end()
        central, at, out = self._at(offset, size), 0, {}
        for _ in range(count):
            if at + CENTRAL_SIZE > len(central) or struct.unpack_from("<I", central, at)[0] != CENTRAL:
                raise ValueError("the archive is damaged: its central directory ends early")
            method, stored, whole, name_size, extra_size, comment_size = struct.unpack_from("<10xH8xIIHHH", central, at)
            header_at = struct.unpack_from("<I", central, at + 42)[0]
            name = central[at + CENTRAL_SIZE : at + CENTRAL_SIZE + name_size].decode("utf-8")
            extra = central[at + CENTRAL_SIZE + name_size : at + CENTRAL_SIZE + name_size + extra_size]
            # 64-bit values stand in the extra field, in this order, for those that are all ones here
            wide = self._wide(extra)
            whole = next(wide) if whole == 0xFFFFFFFF else whole
            stored = next(wide) if stored == 0xFFFFFFFF else stored
            header_at = next(wide) if header_at == 0xFFFFFFFF else header_at
            out[name] = (method, stored, header_at)
            at += CENTRAL_SIZE + name_size + extra_size + comment_size
        return out

    @staticmethod
    def _wide(extra: bytes):
        at = 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                yield from struct.unpack_from(f"<{size // 8}Q", extra, at + 4)
            at += 4 + size
        raise ValueError("the archive is damaged: a ZIP64 value is missing")

    def start(self, name: str) -> int:
        """Where a stored member's bytes begin in the archive."""
        if name not in self.starts:
            method, _, header_at = self.members[name]
            if method != 0:
                raise ValueError(f"{name} is compressed: its records cannot be read by ranges")
            head = self._at(header_at, LOCAL_SIZE)
            if struct.unpack_from("<I", head)[0] != LOCAL:
                raise ValueError("the archive is damaged: a local header is missing")
            self.starts[name] = header_at + LOCAL_SIZE + sum(struct.unpack_from("<HH", head, 26))
        return self.starts[name]

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        """A range of a stored member (all of it by default)."""
        size = self.members[name][1]
        length = size - offset if length is None else length
        if offset < 0 or length < 0 or offset + length > size:
            raise ValueError(f"the range lies outside of {name}")
        return self._at(self.start(name) + offset, length)


# ---- jobs ------------------------------------------------------------------
KEY = ["digest", "n_bytes", "check"]


def first_copies(rows: DataFrame) -> DataFrame:
    """Written, for each payload that occurs twice: KEY, first (page_id and url of the row that is the response) and n_first, how
    many rows have just these.

    ``rows``: page_id, url and KEY.  Rows without an id come last."""
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    counted = rows.groupBy(*KEY, "page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    firsts = counted.groupBy(*KEY).agg(F.sum("n").alias("n"), F.min(order).alias("first"), F.min_by("n", order).alias("n_first"))
    return written(firsts.where(F.col("n") > 1).select(*KEY, "first.page_id", "first.url", "n_first").toDF(*KEY, "first_id", "first_url", "n_first"))


def _repeated(tied: DataFrame) -> DataFrame:
    """Rows that repeat id, url and payload, one of them the response: reduced to one, then as many as they were."""
    one = tied.groupBy(*KEY, "page_id", "url", "first_id", "first_url").agg(F.any_value("html").alias("html"), F.count(F.lit(1)).alias("n"))
    size = 10_000  # so that a row repeated very often is spread
    one = one.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / size))))
    one = one.withColumn("html", F.when(F.col("chunk") == 0, F.col("html"))).repartition(*KEY, "page_id", "chunk")
    last = F.least(F.col("n"), (F.col("chunk") + 1) * size)
    copies = one.withColumn("copy", F.explode(F.sequence(F.col("chunk") * size + 1, last)))
    return copies.withColumn("revisit", F.col("copy") > 1).drop("n", "chunk", "copy")


def marked(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html -> the same with KEY, revisit, and first_id and first_url of the payload's response (null where the
    payload has no other copy).

    Payloads are equal if SHA-1, length and a 64-bit hash agree.  Only digests that occur twice are joined back, a row each, so the
    pages are shuffled only where those are many, and a payload of a third of all rows is split like any hot key."""
    p = pages.withColumns({"digest": F.sha1("html"), "n_bytes": F.octet_length("html"), "check": F.xxhash64("html")})
    firsts = first_copies(p.where(F.col("n_bytes") >= min_bytes).select("page_id", "url", *KEY))
    j = p.join(firsts, KEY, "left")
    own = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    j = j.withColumns({"own": own & F.col("n_first").isNotNull(), "revisit": F.col("n_first").isNotNull() & ~own})
    columns = [*pages.columns, *KEY, "first_id", "first_url", "revisit"]
    if firsts.where(F.col("n_first") > 1).isEmpty():
        return j.select(*columns)
    tied = F.col("own") & (F.col("n_first") > 1)
    return j.where(~tied).select(*columns).unionByName(_repeated(j.where(tied)).select(*columns))


def _identity(page_id: int | None, url: str | None, digest: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_OID, json.dumps([page_id, url, digest])))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """A WARC record for every row, in archives under ``folder``, which all executors share; their written manifest (archive,
    n_records, n_bytes of records).

    The payload is the html in UTF-8 (null: empty).  Of rows with equal payloads of at least ``min_bytes`` bytes, the one with
    the smallest id is a response, the others revisit it.  Rows without an id are responses only if no row of their payload
    has one; of rows that repeat an id and a payload one is the response.  A null url leaves the target out; other characters
    than printable ASCII are percent-encoded in it.  Other columns are ignored; an empty table gives no archive.  A very long
    page is one record, held by its task while it is compressed.
    """
    spark = pages.sparkSession
    ship(spark)
    small_batches(spark)
    rows = pages.select(pages[id_col].cast("bigint").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).alias("html"))
    payload = F.when(~F.col("revisit"), F.encode("html", "UTF-8")).alias("payload")
    rows = marked(rows, min_bytes).select("page_id", "url", payload, "n_bytes", "digest", "revisit", "first_id", "first_url")
    schema = pa.schema([("archive", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def write(batches):
        archive = None
        for batch in batches:
            for page_id, url, payload, size, digest, revisit, first_id, first_url in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                archive = archive or ArchiveWriter(f"{folder}/{uuid.uuid4().hex}.zip")
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                first = (_identity(first_id, first_url, digest), first_id) if revisit else None
                # only a response that others refer to needs an id they can work out
                record_id = str(uuid.uuid4()) if revisit or size < min_bytes else _identity(page_id, url, digest)
                archive.add(warc_record(record_id, page_id, url, payload, size, digest, first, date), page_id, "revisit" if first else "response", digest)
                if archive.at >= archive_bytes or len(archive.lines) >= ARCHIVE_RECORDS:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, archive.close(), strict=True))], schema=schema)
                    archive = None
        if archive:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, archive.close(), strict=True))], schema=schema)

    return written(rows.mapInArrow(write, _MANIFEST))


def read_index(manifest: DataFrame) -> DataFrame:
    """A row for each record, from the index members: archive, at and length (its range in the data member), page_id,
    record_type, payload_digest."""
    ship(manifest.sparkSession)
    schema = pa.schema([("archive", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()),
                        ("record_type", pa.string()), ("payload_digest", pa.string())])

    def entries(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                reader = ArchiveReader(path)
                lines = [json.loads(x) for x in reader.read(INDEX).splitlines()]
                reader.close()
                columns = [[x[k] for x in lines] for k in ("offset", "length", "page_id", "type", "digest")]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string())] + [
                    pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns)], schema=schema)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(entries, _ENTRY)


def read_records(index: DataFrame) -> DataFrame:
    """The records of some index rows (all of them, or those a caller has selected): page_id, url, record_type, payload_bytes and
    payload_digest (of the full payload, also for a revisit), refers_to, payload (null for a revisit).

    Ranges that follow each other in an archive are read at once, up to ``SPAN_BYTES``."""
    ship(index.sparkSession)
    small_batches(index.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def spans(batches):
        path, start, lengths = None, 0, []
        for batch in batches:
            for archive, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != path or at != start + sum(lengths) or sum(lengths) >= SPAN_BYTES:
                    if lengths:
                        yield path, start, lengths
                    path, start, lengths = archive, at, []
                lengths.append(length)
                if len(lengths) >= 1000:
                    yield path, start, lengths
                    start, lengths = start + sum(lengths), []
        if lengths:
            yield path, start, lengths

    def records(batches):
        reader, path = None, None
        for archive, start, lengths in spans(batches):
            if archive != path:
                if reader:
                    reader.close()
                reader, path = ArchiveReader(archive), archive
            data, at, out, size = reader.read(DATA, start, sum(lengths)), 0, [], 0
            for length in lengths:
                out.append(parse_record(data[at : at + length]))
                at, size = at + length, size + out[-1]["payload_bytes"]
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if reader:
            reader.close()

    return index.select("archive", "at", "length").mapInArrow(records, _RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Every page written to archives and read back from them, without the payload: page_id, payload_bytes, payload_digest,
    record_type, refers_to.  Edges as in ``write_archives``.  A folder of its own is removed at the end."""
    spark = pages.sparkSession
    own = f"{checkpoint_dir(spark).rstrip('/')}/web-archives-{uuid.uuid4().hex}"
    manifest = write_archives(pages, folder or own, min_bytes=min_bytes)
    records = read_records(read_index(manifest)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    records = written(records)
    remove(manifest)
    if folder is None:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return records
