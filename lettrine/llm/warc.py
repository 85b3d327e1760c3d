"""WARC archives: written from pages, made readable record by record, and read back.

* ``write_archives`` writes whole-file gzip streams, one member for many records, as
  crawlers do that pipe their output through gzip. Of pages with equal payloads one
  keeps it, the others are revisit records that name it.
* ``normalise`` inflates each such file once, front to back, writes every record as a
  gzip member of its own, and beside the new archive a sidecar of JSON lines with each
  record's offset and length. Files of many members, and records of any length, are
  taken as well; no block is held whole.
* ``read_records`` goes by that index: stretches of a file are read by different tasks,
  and each record by its offset alone.

Files are written in the shared folder under names that no other attempt of a task
has, and are known by the rows that the task returns, which are stored as a table: what
a lost executor leaves behind is never read. Spark has no writer of such files, so
tasks write them through pyarrow's file systems (local and shared folders, HDFS, S3
and others).

Null payloads are empty ones. Payloads of equal bytes are equal, by SHA-256; of a page
that repeats under the smallest id all rows are responses; rows without page_id come
last, and are responses among themselves. A row without url has no target. Line ends
in a url are escaped. Empty tables give no files and no rows. Columns besides page_id,
url and html are ignored. A file that breaks off or isn't WARC gives the records before
that and one row with the error.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import lean, shared_folder, stored, with_totals

#: Bytes read at once, and inflated at once.
CHUNK = 1 << 18
#: Bytes of a header line and of a record's headers, at most.
LINE, HEADERS = 1 << 16, 1 << 20
#: Bytes of records in an archive, about, and of the members that one task reads.
ARCHIVE, RANGE = 256 << 20, 8 << 20
#: Rows of a batch that a task gives back, at most.
ROWS = 4096
# Names of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Pages have no date; archives of equal pages shall be equal.
DATE = "1970-01-01T00:00:00Z"
PAGE, REFERS_TO = "X-Page-Id", "X-Refers-To-Page-Id"


class Broken(Exception):
    """What was read isn't a whole WARC file."""


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    return fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if path.startswith("file:") else path)


def base32(hex_digest: str) -> str:
    return b32encode(bytes.fromhex(hex_digest)).decode()


def _id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{kind} {page_id} {digest}')}>"


def _headers(fields: list[tuple[str, str]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in fields).encode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    return f"{VERSION}\r\n".encode() + _headers([*fields, ("Content-Length", str(len(block)))]) + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, refers_to: int | None, size: int, sha1: str, payload: bytes | None) -> bytes:
    """A response with its payload, or a revisit that refers to the page that has it."""
    digest, revisit = base32(sha1), refers_to is not None
    target = [] if url is None else [("WARC-Target-URI", "".join(c if ord(c) > 31 and ord(c) != 127 else f"%{ord(c):02X}" for c in url))]
    page = [] if page_id is None else [(PAGE, str(page_id))]
    known = [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to, digest, "response")), (REFERS_TO, str(refers_to))] if revisit else []
    kind = "revisit" if revisit else "response"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _id(page_id, digest, kind)), ("WARC-Date", DATE), *target, ("WARC-Payload-Digest", f"sha1:{digest}"), *page, *known, ("Content-Type", "application/http; msgtype=response")]
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]) + b"\r\n"
    return record(fields, http if revisit else http + payload)


def info_record(name: str) -> bytes:
    block = _headers([("software", "lettrine"), ("format", "WARC File Format 1.1")])
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def _packed(rows: DataFrame) -> DataFrame:
    """Payloads compressed one by one, since they are dealt by their hash: less is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = batch.schema.get_field_index("payload")
            packed = pa.array((pack.compress(p.as_buffer()) for p in batch.column(at)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], packed], schema=batch.schema)

    return rows.mapInArrow(lean(run), rows.schema)


def page_rows(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, n_bytes, sha1, refers_to (NULL for responses) and payload, by zstandard (NULL for revisits).

    Payloads shorter than ``least`` are never revisited. A payload may have any share of the pages.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select("page_id", "url", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("sha1"), F.unhex(F.sha2("payload", 256)).alias("sha"), "payload")
    totals = rows.where(F.col("n_bytes") >= least).groupBy("sha").agg(F.count("*").alias("n"), F.min("page_id").alias("first"))
    both = with_totals(_packed(rows), totals, "sha", "page_id")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return both.select("page_id", "url", "n_bytes", "sha1", refers.alias("refers_to"), F.when(refers.isNull(), F.col("payload")).alias("payload"))


def write_archives(rows: DataFrame, folder: str, level: int = 6, size: int = ARCHIVE) -> DataFrame:
    """Writes ``page_rows`` as whole-file gzip streams of about ``size`` bytes of records each; returns path and records of each file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        sink = path = None
        paths, counts, left, unpack = [], [], 0, zstandard.ZstdDecompressor()
        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "refers_to", "n_bytes", "sha1", "payload")]
            for at in range(batch.num_rows):
                if sink is None:
                    path = f"pages-{uuid.uuid4().hex}.warc.gz"
                    sink, deflate, left = system.open_output_stream(f"{root}/{path}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31), size
                    sink.write(deflate.compress(info_record(path)))
                    paths.append(path)
                    counts.append(0)
                *row, payload = (c[at].as_py() for c in columns)
                data = page_record(*row, None if payload is None else unpack.decompress(payload))
                sink.write(deflate.compress(data))
                counts[-1] += 1
                left -= len(data)
                if left <= 0:
                    sink.write(deflate.flush())
                    sink.close()
                    sink = None
        if sink is not None:
            sink.write(deflate.flush())
            sink.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p}" for p in paths]), pa.array(counts, pa.int64())], ["path", "records"])

    return stored(rows.mapInArrow(lean(run), "path string, records long"), "archives")


class Inflated:
    """The bytes of a gzip file, of one member or many, inflated as they are asked for."""

    def __init__(self, raw):
        self.raw, self.left, self.have, self.at = raw, b"", b"", 0
        self.member, self.inside = zlib.decompressobj(31), False

    def _more(self) -> bool:
        """Inflates the next piece; False at the end of the last member."""
        self.have, self.at = self.have[self.at :], 0
        while True:
            if self.member.eof:
                self.left, self.member, self.inside = self.member.unused_data or self.left, zlib.decompressobj(31), False
            if not self.left:
                self.left = self.raw.read(CHUNK)
            ended = not self.left
            if not self.inside:
                self.left = self.left.lstrip(b"\0")  # padding between members
                if not self.left:
                    if ended:
                        return False
                    continue
            try:
                piece = self.member.decompress(self.left, CHUNK)
            except zlib.error as error:
                raise Broken(f"not gzip: {error}") from error
            self.left, self.inside = self.member.unconsumed_tail, True
            if piece:
                self.have += piece
                return True
            if ended and not self.member.eof:
                raise Broken("the stream ends within a member")

    def line(self) -> bytes:
        """Up to the next line end, which goes with it; empty at the end."""
        while (end := self.have.find(b"\n", self.at)) < 0:
            if len(self.have) - self.at > LINE:
                raise Broken("a header line is too long")
            if not self._more():
                end = len(self.have) - 1
                break
        out, self.at = self.have[self.at : end + 1], end + 1
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next n bytes."""
        while n:
            if self.at == len(self.have) and not self._more():
                raise Broken("the file ends within a record")
            out = self.have[self.at : self.at + n]
            self.at += len(out)
            n -= len(out)
            yield out


def _fields(lines: Iterator[bytes]) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in lines:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        else:
            name, _, value = text.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def head(source: Inflated) -> tuple[bytes, dict[str, str]] | None:
    """The headers of the next record as they stand, and by lower-case name; None at the end."""
    while (line := source.line()) in (b"\r\n", b"\n"):
        pass
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise Broken("no record starts here")
    lines = [line]
    while (line := source.line()) not in (b"\r\n", b"\n"):
        lines.append(line)
        if not line or sum(map(len, lines)) > HEADERS:
            raise Broken("a record's headers don't end")
    fields = {n.lower(): v for n, v in _fields(iter(lines[1:]))}
    if not fields.get("content-length", "").isdigit():
        raise Broken("a record has no length")
    return b"".join(lines) + b"\r\n", fields


def rewritten(source: Inflated, level: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers of each record, and the record as a gzip member."""
    while (found := head(source)) is not None:
        raw, fields = found
        deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
        parts = [deflate.compress(raw)]
        parts += [deflate.compress(p) for p in source.pieces(int(fields["content-length"]))]
        yield fields, b"".join([*parts, deflate.compress(b"\r\n\r\n"), deflate.flush()])


INDEX = "path string, number long, offset long, length long, record_type string, record_id string, error string"


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each file (column path) member by record into ``folder``, with a sidecar ``.index.jsonl``; returns the index, INDEX.

    A gzip stream can't be entered midway, so a file is one task's work, read front to back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            name = f"records-{uuid.uuid4().hex}.warc.gz"
            rows, number, offset = [], 0, 0
            theirs, there = opened(path)
            with theirs.open_input_stream(there, compression=None) as raw, system.open_output_stream(f"{root}/{name}", compression=None) as sink, system.open_output_stream(f"{root}/{name}.index.jsonl", compression=None) as sidecar:
                try:
                    for fields, member in rewritten(Inflated(raw), level):
                        entry = (number, offset, len(member), fields.get("warc-type"), fields.get("warc-record-id"))
                        rows.append((f"{folder}/{name}", *entry, None))
                        sink.write(member)
                        sidecar.write(json.dumps(dict(zip(("number", "offset", "length", "record_type", "record_id"), entry))).encode() + b"\n")
                        number, offset = number + 1, offset + len(member)
                        if len(rows) == ROWS:
                            yield _index(rows)
                            rows = []
                except Broken as problem:
                    rows.append((path, number, None, None, None, None, str(problem)))
            if rows:
                yield _index(rows)

    return stored(files.select("path").repartition(max(1, files.count())).mapInArrow(lean(run), INDEX), "index")


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["path", "number", "offset", "length", "record_type", "record_id", "error"])


RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, intact boolean"


def parsed_record(data: bytes, payload: bool) -> tuple:
    """A record's RECORD row, and its payload if that is asked for.

    A response's payload is measured and digested as it was read, and ``intact`` if
    its header says the same; a revisit has both of the payload it refers to.
    """
    top, _, rest = data.partition(b"\r\n\r\n")
    fields = {n.lower(): v for n, v in _fields(iter(top.split(b"\r\n")[1:]))}
    block = rest[: int(fields["content-length"])]
    body, size = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        size = {n.lower(): v for n, v in _fields(iter(http.split(b"\r\n")[1:]))}.get("content-length")
    given, kind = fields.get("warc-payload-digest", "").rpartition(":")[2] or None, fields.get("warc-type")
    number = lambda v: int(v) if v is not None and v.lstrip("-").isdigit() else None
    if kind == "revisit":
        found, n, intact, body = given, number(size), True, None
    else:
        found, n = b32encode(hashlib.sha1(body).digest()).decode(), len(body)
        intact = given in (None, found)
    row = (number(fields.get(PAGE.lower())), fields.get("warc-target-uri"), kind, number(fields.get(REFERS_TO.lower())), n, found, intact)
    return (*row, body) if payload else row


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """RECORD of each indexed record, with its payload (NULL for revisits) unless that isn't wanted; records are read by offset, a stretch of a file by one task."""
    schema = RECORD + (", payload binary" if payload else "")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source, rows, size = None, None, [], 0
        for batch in batches:
            for there, offset, length in zip(*(batch.column(n).to_pylist() for n in ("path", "offset", "length"))):
                if there != path:
                    if source is not None:
                        source.close()
                    system, at = opened(there)
                    path, source = there, system.open_input_file(at)
                source.seek(offset)
                rows.append(parsed_record(zlib.decompress(source.read(length), 31), payload))
                size += rows[-1][4] or 0
                if len(rows) == ROWS or (payload and size > CHUNK):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        if source is not None:
            source.close()

    there = index.where("error is null").select("path", "offset", "length")
    tasks = (there.agg(F.sum("length")).first()[0] or 0) // RANGE + 1
    return there.repartitionByRange(tasks, "path", "offset").sortWithinPartitions("path", "offset").mapInArrow(lean(run), schema)


def archived(pages: DataFrame, payload: bool = True, least: int = 0, folder: str | None = None) -> DataFrame:
    """Pages written as archives, normalised, and read back: RECORD of each page, with its payload unless that isn't wanted.

    Files go to ``folder``, or to one of their own in the shared folder, and stay there.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    files = write_archives(page_rows(pages, least), f"{folder}/whole")
    index = normalise(files, f"{folder}/records")
    written, read = files.agg(F.sum("records")).first()[0] or 0, index.where("record_type in ('response', 'revisit')").count()
    if written != read:
        raise Broken(f"{read} records of {written} were read back from {folder}")
    return read_records(index.where("record_type in ('response', 'revisit')"), payload)
