"""WARC archives with a two-level capture index.

Archives are real ``.warc.gz`` files (a gzip member for each record) in a shared
folder, written and read in place by the tasks.  The index is sorted by
reversed-host URL keys, in compressed blocks; each index file's sparse directory
has the first key, offset and length of its blocks.  A lookup takes the files whose
key range fits, binary-searches their directory, reads one block and then
the byte range of the record.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pizarra.llm.common import col, scratch_path, ship_code, shuffle_partitions, written

MIN_REVISIT = 100         # smaller payloads are never revisits
BLOCK_LINES = 512         # captures in a compressed index block
FILE_BYTES = 256 << 20    # a task starts a new archive beyond this
LEVEL = 3
SALTS = 8


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (or plain path) and the path in it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.a.org/x?y`` becomes ``org,a,www)/x?y``."""
    url = url or ""
    rest = url.split("://", 1)[-1]
    stop = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    return ",".join(reversed(rest[:stop].lower().split("."))) + ")" + rest[stop:]


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: the last is the smallest page id
    with the same payload, for payloads of ``MIN_REVISIT`` bytes or more that a
    smaller page id has too; else null.

    Only digests are grouped and joined back where they repeat, on the digest and a
    salt, so that a payload of very many pages is dealt to several tasks.  A null html is
    empty; a null page id is neither deduplicated nor referred to; rows that repeat
    a page id and its payload are of one kind.
    """
    base = pages.select(col(id_col).cast("long").alias("page_id"), col(url_col).cast("string").alias("url"),
                        F.coalesce(col(html_col).cast("string"), F.lit("")).alias("payload"))
    base = base.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    seen = base.where((F.octet_length("payload") >= MIN_REVISIT) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = seen.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).drop("last")
    seen = seen.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    revisits = seen.join(first, ["digest", "salt"]).where("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()
    return base.join(revisits.hint("shuffle_hash"), ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def warc_record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, uncompressed.  A revisit has the HTTP head only, whose
    Content-Length is that of the payload left out."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Page-ID: {'' if page_id is None else page_id}"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict, dict, bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, block = raw.split(b"\r\n\r\n", 1)
    warc = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(warc["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return warc, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


CAPTURES = "key string, page_id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write ``pages`` as archives in ``folder``; the captures, as a written table.

    File names are unique for each attempt of a task, and only files of the attempt
    whose captures were committed are ever named, so lost executors do no harm.
    """
    ship_code(pages.sparkSession)

    def write(batches) -> Iterator[pa.RecordBatch]:
        store, top = opened(folder)
        out = name = None
        at = 0
        for batch in batches:
            rows = {k: [] for k in ("key", "page_id", "file", "offset", "length")}
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(top, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                member = _member(warc_record(page_id, url, payload.encode(), digest, refers_to))
                out.write(member)
                for k, v in zip(rows, (url_key(url), page_id, name, at, len(member))):
                    rows[k].append(v)
                at += len(member)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))
        if out is not None:
            out.close()

    return written(classified(pages, **columns).mapInArrow(write, CAPTURES), "captures")


DIRECTORY = "file string, first_key string, last_key string, offset long, length long"


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Sort the captures by key and write them as compressed blocks.  An index file
    ends with its sparse block directory (first key, offset and length of each
    block); the rows returned, one a file, say what keys it spans and where that is."""

    def write(batches) -> Iterator[pa.RecordBatch]:
        store, top = opened(folder)
        name, out, at, blocks, lines, first, last = f"{uuid.uuid4().hex}.cdx.gz", None, 0, [], [], None, None

        def flush():
            nonlocal at, out, lines
            if out is None:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{top}/{name}", compression=None)
            data = _member("\n".join(json.dumps(x) for x in lines).encode())
            out.write(data)
            blocks.append((lines[0][0], at, len(data)))
            at += len(data)
            lines = []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                first, last = row[0] if first is None else first, row[0]
                lines.append(row)
                if len(lines) >= block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            directory = _member(json.dumps(blocks).encode())
            out.write(directory)
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "first_key": [first], "last_key": [last], "offset": [at], "length": [len(directory)]},
                schema=pa.schema([("file", pa.string()), ("first_key", pa.string()), ("last_key", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    ordered = captures.select("key", "page_id", "file", "offset", "length").repartitionByRange(
        shuffle_partitions(captures.sparkSession), "key", "page_id").sortWithinPartitions("key", "page_id")
    return written(ordered.mapInArrow(write, DIRECTORY), "cdx")


FOUND = 4096             # captures found that go on together
READ_RUN = 1 << 20       # archive bytes whose records are read by one task, one after the other


class Reader:
    """Range reads from one folder; keeps the last few files open."""

    def __init__(self, folder: str):
        self.store, self.top = opened(folder)
        self.files: dict[str, pa.NativeFile] = {}

    def __call__(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= 16:
                self.files.pop(next(iter(self.files))).close()
            self.files[name] = self.store.open_input_file(f"{self.top}/{name}")
        return self.files[name].read_at(length, offset)


def blocks_for(directory: list, key: str) -> list:
    """The blocks that can hold ``key``, by binary search: from the last that begins
    below it to the last that begins with it."""
    i = max(bisect.bisect_left(directory, key, key=lambda b: b[0]) - 1, 0)
    return directory[i:bisect.bisect_right(directory, key, key=lambda b: b[0])]


def _captures(read: Reader, name: str, blocks: list) -> Iterator[list]:
    for _, offset, length in blocks:
        for line in gzip.decompress(read(name, offset, length)).decode().split("\n"):
            yield json.loads(line)


def _batch(captures: list) -> pa.RecordBatch:
    types = {"key": pa.string(), "page_id": pa.int64(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in captures], t) for i, t in enumerate(types.values())], names=list(types))


def lookup(directory: DataFrame, folder: str, keys: DataFrame) -> DataFrame:
    """Captures of the url keys in ``keys`` (a column ``key``).  The index files' key
    ranges (one row a file, at most the partitions of the sort) say which files can hold a
    key; in a file, a binary search of its directory finds the blocks to read.  Null
    keys find nothing, repeated keys count once."""
    files = sorted((r["first_key"], r["last_key"], r["file"], r["offset"], r["length"]) for r in directory.collect())
    lasts = [f[1] for f in files]

    def search(batches) -> Iterator[pa.RecordBatch]:
        read = Reader(folder)
        now, blocks, block, lines, out = None, [], None, [], []
        for batch in batches:
            for key in batch.column(0).to_pylist():
                for first, _, name, offset, length in files[bisect.bisect_left(lasts, key):]:
                    if first > key:
                        break
                    if name != now:
                        now, blocks = name, json.loads(gzip.decompress(read(name, offset, length)))
                    for b in blocks_for(blocks, key):
                        if (name, b[1]) != block:
                            block, lines = (name, b[1]), list(_captures(read, name, [b]))
                        out += lines[bisect.bisect_left(lines, key, key=lambda x: x[0]):bisect.bisect_right(lines, key, key=lambda x: x[0])]
                        if len(out) >= FOUND:
                            yield _batch(out)
                            out = []
        yield _batch(out)

    want = keys.select("key").where(F.col("key").isNotNull()).distinct()
    # near keys go to the same task, in order, so that a block is read once; the keys are few bytes, their
    # records are not, so the number of tasks is the session's
    n = shuffle_partitions(keys.sparkSession)
    return want.repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(search, CAPTURES)


def all_captures(directory: DataFrame, folder: str) -> DataFrame:
    """Every capture, read from the index blocks."""

    def scan(batches) -> Iterator[pa.RecordBatch]:
        read = Reader(folder)
        for batch in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                for b in json.loads(gzip.decompress(read(name, offset, length))):
                    yield _batch(list(_captures(read, name, [b])))

    n = shuffle_partitions(directory.sparkSession)
    return directory.select("file", "offset", "length").repartition(n, "file").mapInArrow(scan, CAPTURES)


def read_captures(captures: DataFrame, folder: str) -> DataFrame:
    """The records at the captures' byte ranges: page id, payload length and digest,
    record type and, for revisits, the page referred to.  A response's length and digest
    are taken from the payload itself and must agree with its headers."""

    def read_all(batches) -> Iterator[pa.RecordBatch]:
        read = Reader(folder)
        for batch in batches:
            rows = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                warc, http, payload = parse_record(gzip.decompress(read(name, offset, length)))
                kind, digest, size = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha256:"), int(http["Content-Length"])
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{name} at {offset}: payload and headers disagree")
                page, refers = warc["X-Page-ID"], warc.get("X-Refers-To-Page")
                for k, v in zip(rows, (int(page) if page else None, size, digest, kind, int(refers) if refers else None)):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(
                [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))

    # dealt by place: captures of one key, however many, are read by many tasks, in order
    n = shuffle_partitions(captures.sparkSession)
    dealt = captures.select("file", "offset", "length").repartition(n, "file", F.expr(f"offset div {READ_RUN}")).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(
        read_all, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_report(pages: DataFrame, **columns: str) -> DataFrame:
    """Write ``pages`` as archives with their index, then look up every page's url key
    in the index and read the records found.  One row per page: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``.  Null urls and pages of one url are captures of their
    own; an empty table gives no files and no rows."""
    folder = scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, **columns)
    directory = write_index(captures, f"{folder}-index")
    return read_captures(lookup(directory, f"{folder}-index", captures), folder)


def export_bytes(folder: str, name: str) -> io.BytesIO:
    """One archive file, for other readers."""
    store, top = opened(folder)
    with store.open_input_file(f"{top}/{name}") as f:
        return io.BytesIO(f.read())
