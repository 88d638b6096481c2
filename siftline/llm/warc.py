"""WARC archives with a two-level capture index.

Archives are gzip members, one record each. The index sorts captures by reversed-host URL key into compressed blocks; a
sparse directory keeps the first key of each block. A lookup bisects the directory, reads one block by range, bisects
its lines, and reads the records by range.

Of records with equal payloads (of at least `min_payload` bytes) the one with the smallest id is a response, the others
are revisits of it. Tasks write files under names of their own and report them; only reported files count, so a
repeated task leaves an unused file and nothing else.

Defined results: a null payload is an empty one; a null url is an empty one, other characters than printable ASCII are
percent-encoded in it; a null id is a response that nothing
refers to; repeated rows of the smallest id are all responses; an empty table gives an archive without records; only
the named columns are read.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass, field
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm.common import map_batches, materialize, new_path

BLOCK_LINES = 1024
FILE_BYTES = 512 << 20
READ_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"  # no capture time is given; a fixed one keeps archives reproducible
PRINTABLE = "".join(map(chr, range(33, 127)))
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def storage(path: str):
    """File system and path, for any store that Arrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def url_key(url: str) -> str:
    """Reversed host, then port, path and query; scheme, fragment, user and letter case of the host are dropped."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")" + quote(url, safe=PRINTABLE)
    if host.startswith("www."):
        host = host[4:]
    port_part = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    query = f"?{parts.query}" if parts.query else ""
    return quote(f"{','.join(reversed(host.split('.')))}{port_part}){parts.path or '/'}{query}", safe=PRINTABLE)


def record_bytes(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url, safe=PRINTABLE)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    url: str
    record_type: str
    refers_to: int | None
    digest: str
    payload_bytes: int
    payload: bytes


_page = re.compile(r"<urn:page:(-?\d*)>")


def parse_record(data: bytes) -> Record:
    """A record; a response's digest and length are those of its payload, checked against its headers."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    stated = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    number = lambda name: int(m[1]) if name in headers and (m := _page.fullmatch(headers[name])) and m[1] else None
    if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != stated):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its headers")
    return Record(number("WARC-Record-ID"), headers["WARC-Target-URI"], kind, number("WARC-Refers-To"), stated, length, payload)


def gzip_member(data: bytes, level: int = 1) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class _Files:
    """Archive files of one task: a new one begins when the last is full."""

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix, self.out, self.at, self.name = folder, suffix, None, 0, ""

    def write(self, data: bytes) -> tuple[str, int]:
        if self.out is None or self.at >= FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}{self.suffix}"
            store, path = storage(self.folder)
            store.create_dir(path, recursive=True)
            self.out, self.at = store.open_output_stream(f"{path}/{self.name}", compression=None), 0
        start = self.at
        self.out.write(data)
        self.at += len(data)
        return self.name, start

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


@dataclass
class Archive:
    """folder: archive and index files. directory: a row per index block (first_key, file, offset, length, n)."""

    folder: str
    directory: DataFrame
    _blocks: list = field(default_factory=list)

    def lookup(self, url: str) -> list[Record]:
        """All captures of a URL. The directory, a row per block, is read once; then one block or few by range."""
        if not self._blocks:
            self._blocks = [tuple(r) for r in self.directory.orderBy("first_key", "last_key").select("first_key", "last_key", "file", "offset", "length").collect()]
        key = url_key(url)
        at = max(bisect.bisect_left(self._blocks, (key,)) - 1, 0)
        found = []
        while at < len(self._blocks) and self._blocks[at][0] <= key:
            if key <= self._blocks[at][1]:
                lines = read_block(self.folder, *self._blocks[at][2:])
                i = bisect.bisect_left(lines, key + " ")
                while i < len(lines) and lines[i].startswith(key + " "):
                    _, file, offset, length = lines[i].rsplit(" ", 3)
                    found.append(parse_record(zlib.decompress(read_range(self.folder, file, int(offset), int(length)), 31)))
                    i += 1
            at += 1
        return found


def read_range(folder: str, file: str, offset: int, length: int) -> bytes:
    store, path = storage(folder)
    with store.open_input_file(f"{path}/{file}") as f:
        return f.read_at(length, offset)


def read_block(folder: str, file: str, offset: int, length: int) -> list[str]:
    return zlib.decompress(read_range(folder, file, offset, length), 31).decode().split("\n")


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_payload: int = 0) -> Archive:
    """Write a record for each row, then the two index levels."""
    folder = new_path(pages.sparkSession, "warc")
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    keyed = pages.select(F.col(id_col).cast("long").alias("id"), F.sha1(body).alias("sha"), F.octet_length(body).alias("n"))
    firsts = keyed.where(F.col("n") >= min_payload).groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("sha", "first")
    revisits = keyed.where(F.col("n") >= min_payload).join(firsts, "sha").where("id > first").select("id", "sha", "first").distinct()
    revisits = materialize(revisits, "revisits")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), body.alias("payload")).withColumn("sha", F.sha1("payload"))
    rows = rows.join(revisits, ["id", "sha"], "left").select("id", "url", "payload", "first")

    def write(batches):
        files = _Files(folder, ".warc.gz")
        try:
            for b in batches:
                out = []
                for i in range(b.num_rows):
                    page, url, payload, first = (b.column(c)[i].as_py() for c in range(4))
                    data = gzip_member(record_bytes(page, url, payload, first))
                    out.append((url_key(url), page, *files.write(data), len(data)))
                if out:
                    cols = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], ["key", "id", "file", "offset", "length"])
        finally:
            files.close()

    captures = materialize(rows.mapInArrow(write, "key string, id long, file string, offset long, length long"), "captures")
    return Archive(folder, _write_index(captures, folder))


def _write_index(captures: DataFrame, folder: str) -> DataFrame:
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def write(batches):
        files, lines, out = _Files(folder, ".cdx.gz"), [], []

        def flush():
            data = gzip_member("\n".join(lines).encode(), 6)
            out.append((lines[0].split(" ", 1)[0], lines[-1].split(" ", 1)[0], *files.write(data), len(data), len(lines)))
            lines.clear()

        try:
            for b in batches:
                for key, file, offset, length in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):
                    lines.append(f"{key} {file} {offset} {length}")
                    if len(lines) == BLOCK_LINES:
                        flush()
            if lines:
                flush()
        finally:
            files.close()
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), *(pa.array(c, pa.int64()) for c in cols[3:])], ["first_key", "last_key", "file", "offset", "length", "n"])

    blocks = ordered.select("key", "file", "offset", "length").mapInArrow(write, "first_key string, last_key string, file string, offset long, length long, n long")
    return materialize(blocks, "directory")


def read_all(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record, found through the index: blocks by range, then their captures in file order, near ones in one read."""
    folder = archive.folder

    def entries():
        def each(b):
            rows = [line.rsplit(" ", 2) for file, offset, length in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True) for line in read_block(folder, file, offset, length)]
            names = [r[0].rsplit(" ", 1)[1] for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array([int(r[1]) for r in rows], pa.int64()), pa.array([int(r[2]) for r in rows], pa.int64())], ["file", "offset", "length"])

        return each

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = archive.directory.select("file", "offset", "length").repartition(parts)
    found = materialize(map_batches(blocks, entries, "file string, offset long, length long"), "entries")
    found = found.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")

    def read():
        def each(b):
            rows = list(zip(*(b.column(c).to_pylist() for c in range(3)), strict=True))
            out, i = [], 0
            while i < len(rows):
                file, start, end, j = rows[i][0], rows[i][1], rows[i][1] + rows[i][2], i + 1
                while j < len(rows) and rows[j][0] == file and rows[j][1] - end < 1 << 16 and rows[j][1] + rows[j][2] - start <= READ_BYTES:
                    end, j = rows[j][1] + rows[j][2], j + 1
                data = read_range(folder, file, start, end - start)
                for _, offset, length in rows[i:j]:
                    r = parse_record(zlib.decompress(data[offset - start : offset - start + length], 31))
                    out.append((r.page_id, r.payload_bytes, r.digest, r.record_type, r.refers_to))
                i = j
            cols = list(zip(*out, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

        return each

    return map_batches(found, read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
