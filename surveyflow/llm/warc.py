"""WARC archives as a PySpark data source: ``format("warc")`` reads and writes them.

Reading plans partitions from the archives' files: small files share one, a large file is one by itself.
Within a file records are met one after the other. A record's headers are parsed first; if a pushed
predicate on the record type or another header refuses it, its block is not decoded: an archive compressed by record
tells the length of each compressed record in its gzip header ('sl', the customary skip lengths), so that the
reader goes straight to the next one; without it, and in archives that are not compressed, the block is passed over.
A block that is wanted is decoded only if payloads are asked for.

Writing makes one or more files per task, under names of their own; a manifest written last, as one
small file, lists those of the tasks that were committed. A task that is repeated, or an
executor that is lost, leaves files that no manifest names, and a reader never looks at those.

Defined results: null payloads are empty ones; null headers are left out and read as null; an empty table
gives an archive without records; what is cut off or no WARC record raises with file and offset (or ends the file's
records with ``on_error="stop"``). Header names are compared without regard to case; the first of a repeated one counts.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from surveyflow.functions.cells import quoted
from surveyflow.llm.common import narrow_side, stored

# Header names of the format, by the column that holds each.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "content_type": "Content-Type",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "refers_to_uri": "WARC-Refers-To-Target-URI",
    "profile": "WARC-Profile",
    "content_length": "Content-Length",
}
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
MANIFEST = "_manifest.json"

#: ``headers`` holds every header line, names in lower case; ``http_headers`` those of the block's HTTP message.
SCHEMA = (
    ", ".join(f"{c} {'long' if c == 'content_length' else 'string'}" for c in HEADERS)
    + ", headers map<string,string>, http_headers map<string,string>, payload binary, file string, position long"
)
READ, BATCH_BYTES, BATCH_ROWS = 1 << 18, 4 << 20, 2000
#: Files of a partition together, and the size at which a writer begins a further file.
PARTITION_BYTES, FILE_BYTES = 64 << 20, 256 << 20
#: Bytes of a record's block that are looked at for its HTTP headers.
HTTP_HEAD = 1 << 16


def located(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path within it, of a URI or a plain path."""
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3a://", "s3://", re.sub(r"^file:/+", "file:///", path)))
    return pyarrow.fs.LocalFileSystem(), path


class BrokenArchive(ValueError):
    """Bytes that are no WARC record."""


# ---- reading ----------------------------------------------------------------------------


class _Source:
    """Bytes of a file from a position on, read in pieces."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size, self.at, self.held = file, size, 0, b""

    def peek(self, count: int) -> bytes:
        """Up to ``count`` bytes from here on, without going on."""
        if len(self.held) < count:
            more = self.file.read_at(min(max(count - len(self.held), READ), self.size - self.at - len(self.held)), self.at + len(self.held))
            self.held += more
        return self.held[:count]

    def skip(self, count: int) -> None:
        self.held = self.held[count:] if count < len(self.held) else b""
        self.at += count


class _Plain:
    """A record of an archive that is not compressed."""

    def __init__(self, source: _Source) -> None:
        self.source, self.begin = source, source.at

    def peek(self, count: int) -> bytes:
        return self.source.peek(count)

    def skip(self, count: int) -> None:
        self.source.skip(count)

    def end(self, rest: int) -> None:
        """Go to the next record, ``rest`` bytes on."""
        self.source.skip(rest)


class _Member:
    """A record that is one gzip member; inflated only as far as somebody looks."""

    def __init__(self, source: _Source) -> None:
        self.source, self.begin, self.held, self.over = source, source.at, b"", False
        self.length = _member_length(source.peek(1024))
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> None:
        piece = self.source.peek(READ if self.length is None else min(READ, self.begin + self.length - self.source.at))
        if not piece:
            raise BrokenArchive("record is cut off")
        self.held += self.inflate.decompress(piece)
        self.over = self.inflate.eof
        self.source.skip(len(piece) - len(self.inflate.unused_data))

    def peek(self, count: int) -> bytes:
        while len(self.held) < count and not self.over:
            self._more()
        return self.held[:count]

    def skip(self, count: int) -> None:
        self.peek(count)
        if len(self.held) < count:
            raise BrokenArchive("record is cut off")
        self.held = self.held[count:]

    def end(self, rest: int) -> None:
        if self.length is not None:
            if self.begin + self.length > self.source.size:
                raise BrokenArchive("record is cut off")
            self.source.skip(self.begin + self.length - self.source.at)
            return
        while not self.over:
            self.held = b""
            self._more()


def _member_length(head: bytes) -> int | None:
    """Compressed length of a gzip member by its skip lengths, if it has any."""
    if len(head) < 12 or not head[3] & 4:
        return None
    extra = head[12 : 12 + int.from_bytes(head[10:12], "little")]
    while len(extra) >= 4:
        size = int.from_bytes(extra[2:4], "little")
        if extra[:2] == b"sl" and size >= 4:
            return int.from_bytes(extra[4:8], "little") or None
        extra = extra[4 + size :]
    return None


def parse_headers(lines: bytes) -> dict[str, str]:
    """Header lines by lower-case name; folded lines continue the one before."""
    text = re.sub(r"\r?\n[ \t]+", " ", lines.decode("utf-8", "replace"))
    found: dict[str, str] = {}
    for line in re.split(r"\r?\n", text):
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def _head(record, most: int = 1 << 24) -> bytes:
    """Everything before the empty line, which is passed over too."""
    size = 4096
    while True:
        seen = record.peek(size)
        at = seen.find(b"\r\n\r\n")
        if at >= 0:
            record.skip(at + 4)
            return seen[:at]
        if len(seen) < size or size > most:
            raise BrokenArchive("headers do not end")
        size *= 4


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of an HTTP message; other blocks are all body."""
    if not re.match(rb"HTTP/\d|[A-Z]+ \S+ HTTP/", block[:HTTP_HEAD]):
        return {}, block
    head, _, body = block.partition(b"\r\n\r\n")
    return parse_headers(head.partition(b"\r\n")[2]), body


def read_file(fs: pyarrow.fs.FileSystem, path: str, wanted, payloads: bool, stop: bool) -> Iterator[dict]:
    """Records of one archive that ``wanted`` (a test of their header columns) accepts."""
    with fs.open_input_file(path) as file:
        source = _Source(file, file.size())
        while source.at < source.size:
            begin = source.at
            try:
                record = (_Member if source.peek(2) == b"\x1f\x8b" else _Plain)(source)
                head = _head(record)
                if not head.startswith(b"WARC/"):
                    raise BrokenArchive("no WARC record")
                headers = parse_headers(head.partition(b"\r\n")[2])
                row = {c: headers.get(name.lower()) for c, name in HEADERS.items()}
                if not re.fullmatch(r"\d+", row["content_length"] or ""):
                    raise BrokenArchive("record without a length")
                length = row["content_length"] = int(row["content_length"])
                rest = length + 4
                if wanted(row):
                    look = length if payloads else min(length, HTTP_HEAD)
                    block = record.peek(look)
                    if len(block) < look:
                        raise BrokenArchive("block is cut off")
                    row["headers"] = headers
                    row["http_headers"], body = _http(block)
                    row["payload"] = body if payloads else None
                    record.end(rest)
                    yield row | {"file": path, "position": begin}
                else:
                    record.end(rest)
            except (BrokenArchive, zlib.error) as error:
                if stop:
                    return
                raise BrokenArchive(f"{path} at {begin}: {error}") from error


def _test(predicate):
    """A test of a row of header columns for one pushed predicate, or None if it cannot be pushed."""
    if isinstance(predicate, Not):
        inner = _test(predicate.child)
        return inner and (lambda row: (r := inner(row)) is not None and not r)
    if len(predicate.attribute) != 1 or predicate.attribute[0] not in HEADERS:
        return None
    name = predicate.attribute[0]
    if isinstance(predicate, IsNull):
        return lambda row: row[name] is None
    if isinstance(predicate, IsNotNull):
        return lambda row: row[name] is not None
    if isinstance(predicate, EqualNullSafe):
        return lambda row: row[name] == predicate.value
    compare = {
        EqualTo: lambda x, y: x == y,
        In: lambda x, y: x in y,
        GreaterThan: lambda x, y: x > y,
        GreaterThanOrEqual: lambda x, y: x >= y,
        LessThan: lambda x, y: x < y,
        LessThanOrEqual: lambda x, y: x <= y,
        StringStartsWith: lambda x, y: x.startswith(y),
        StringEndsWith: lambda x, y: x.endswith(y),
        StringContains: lambda x, y: y in x,
    }.get(type(predicate))
    value = getattr(predicate, "value", None)
    ordered = isinstance(predicate, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual))
    if compare is None or value is None or (ordered and isinstance(value, str)) or (isinstance(predicate, In) and None in value):
        return None  # text is ordered by its bytes in Spark
    return lambda row: None if row[name] is None else compare(row[name], value)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...] = ()


@dataclass
class WarcReader(DataSourceReader):
    path: str
    payloads: bool
    stop: bool
    partition_bytes: int
    predicates: list = field(default_factory=list)

    def partitions(self) -> list[Files]:
        fs, root = located(self.path)
        found = archives(fs, root)
        planned: list[list[str]] = []
        room = 0
        for path, size in sorted(found, key=lambda f: (-f[1], f[0])):
            if not planned or size > room:
                planned.append([])
                room = self.partition_bytes
            planned[-1].append(path)
            room -= size
        return [Files(tuple(paths)) for paths in planned] or [Files()]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = located(self.path)
        tests = [_test(p) for p in self.predicates]
        held: list[dict] = []
        size = 0
        for path in partition.paths:
            for row in read_file(fs, path, lambda r: all(t(r) for t in tests), self.payloads, self.stop):
                held.append(row)
                size += len(row["payload"] or b"") + 500
                if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                    yield _batch(held)
                    held, size = [], 0
        if held:
            yield _batch(held)


class PushingReader(WarcReader):
    """As its base, and takes predicates on header columns from Spark."""

    def pushFilters(self, filters):
        for predicate in filters:
            if _test(predicate) is None:
                yield predicate
            else:
                self.predicates.append(predicate)


TEXT_MAP = pa.map_(pa.string(), pa.string())
ARROW = pa.schema(
    [(c, pa.int64() if c == "content_length" else pa.string()) for c in HEADERS]
    + [("headers", TEXT_MAP), ("http_headers", TEXT_MAP), ("payload", pa.binary()), ("file", pa.string()), ("position", pa.int64())]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    def cell(row: dict, name: str):
        return list(row[name].items()) if name.endswith("headers") else row[name]

    return pa.RecordBatch.from_arrays([pa.array([cell(r, f.name) for r in rows], f.type) for f in ARROW], schema=ARROW)


def archives(fs: pyarrow.fs.FileSystem, root: str) -> list[tuple[str, int]]:
    """(path, size) of the archives: those of the manifest, or where there is none, all ``.warc`` and ``.warc.gz`` files."""
    info = fs.get_file_info(root)
    if info.type == pyarrow.fs.FileType.File:
        return [(root, info.size)]
    if info.type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(root)
    if fs.get_file_info(f"{root}/{MANIFEST}").type == pyarrow.fs.FileType.File:
        with fs.open_input_file(f"{root}/{MANIFEST}") as file:
            return [(f"{root}/{name}", size) for name, size in json.loads(file.read())["files"]]
    found = fs.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
    hidden = re.compile(r"/[_.]")
    return [
        (f.path, f.size)
        for f in found
        if f.type == pyarrow.fs.FileType.File and re.search(r"\.warc(\.gz)?$", f.path) and not hidden.search(f.path[len(root) :])
    ]


# ---- writing ----------------------------------------------------------------------------


def record_bytes(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = [f"{name}: {' '.join(value.split())}" for name, value in headers.items() if value is not None]
    lines.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes, level: int = 6) -> bytes:
    """One gzip member whose header tells its compressed and its full length."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(raw) + squeeze.flush()
    total = 10 + 2 + 12 + len(body) + 8
    lengths = (total, len(raw)) if max(total, len(raw)) < 1 << 32 else (0, 0)
    extra = b"sl\x08\x00" + b"".join(n.to_bytes(4, "little") for n in lengths)
    tail = zlib.crc32(raw).to_bytes(4, "little") + (len(raw) & 0xFFFFFFFF).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + len(extra).to_bytes(2, "little") + extra + body + tail


@dataclass
class Written(WriterCommitMessage):
    files: tuple[tuple[str, int], ...] = ()


@dataclass
class WarcWriter(DataSourceArrowWriter):
    """Rows of (headers map<string,string>, block binary), one record each."""

    path: str
    names: list[str]
    overwrite: bool
    compress: bool
    file_bytes: int

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = located(self.path)
        fs.create_dir(root, recursive=True)
        stem, files, out, size = uuid.uuid4().hex, [], None, 0

        def close() -> None:
            if out is not None:
                out.close()
                files[-1] = (files[-1][0], size)

        for batch in iterator:
            columns = [batch.column(self.names.index(n)) for n in ("headers", "block")]
            for at in range(batch.num_rows):
                headers, block = (c[at].as_py() for c in columns)
                raw = record_bytes(dict(headers or {}), block or b"")
                raw = member(raw) if self.compress else raw
                if out is None or size + len(raw) > self.file_bytes:
                    close()
                    files.append((f"{stem}-{len(files)}.warc{'.gz' if self.compress else ''}", 0))
                    out, size = fs.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                out.write(raw)
                size += len(raw)
        close()
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = located(self.path)
        fs.create_dir(root, recursive=True)
        files = [list(f) for m in messages if m for f in m.files]
        if not self.overwrite and fs.get_file_info(f"{root}/{MANIFEST}").type == pyarrow.fs.FileType.File:
            with fs.open_input_file(f"{root}/{MANIFEST}") as file:
                files = json.loads(file.read())["files"] + files
        # Written beside and moved over, so that a reader finds the old list or the new one.
        beside = f"{root}/_{uuid.uuid4().hex}.json"
        with fs.open_output_stream(beside, compression=None) as out:
            out.write(json.dumps({"files": files}).encode())
        fs.move(beside, f"{root}/{MANIFEST}")

    def abort(self, messages: list[Written | None]) -> None:
        """Files of an aborted write are in no manifest, so nobody reads them."""


class WarcSource(DataSource):
    """Options: path, payloads (true), on_error (raise or stop), partition_bytes; compress (true) and file_bytes to write."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _flag(self, name: str, default: bool) -> bool:
        return str(self.options.get(name, default)).lower() == "true"

    def reader(self, schema) -> WarcReader:
        kind = PushingReader if self._flag("pushdown", False) else WarcReader
        stop = self.options.get("on_error", "raise") == "stop"
        return kind(self.options["path"], self._flag("payloads", True), stop, int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        size = int(self.options.get("file_bytes", FILE_BYTES))
        return WarcWriter(self.options["path"], schema.fieldNames(), overwrite, self._flag("compress", True), size)


@contextmanager
def pushdown(spark: SparkSession):
    """While this holds, Spark hands predicates to Python data sources; the session's own setting comes back after it."""
    before = spark.conf.get(PUSHDOWN, "false")
    spark.conf.set(PUSHDOWN, "true")
    try:
        yield
    finally:
        spark.conf.set(PUSHDOWN, before)


def read(spark: SparkSession, path: str, payloads: bool = True, **options) -> DataFrame:
    """Records below ``path``. Predicates on header columns reach the reader where the session allows it (``pushdown``)."""
    spark.dataSource.register(WarcSource)
    pushing = spark.conf.get(PUSHDOWN, "false").lower() == "true"
    options |= {"payloads": str(payloads).lower(), "pushdown": str(pushing).lower()}
    return spark.read.format("warc").options(**options).load(path)


def write(records: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Write rows of (headers map<string,string>, block binary) as archives below ``path``."""
    spark = records.sparkSession
    spark.dataSource.register(WarcSource)
    records.select("headers", "block").write.format("warc").mode(mode).options(**options).save(path)


# ---- pages ------------------------------------------------------------------------------

# Extension headers that carry the rows' own keys.
PAGE, REFERS_TO_PAGE = "X-Page-Id", "X-Refers-To-Page-Id"
#: Payloads of fewer bytes are always stored in full.
LEAST_REVISIT = 100
#: Payloads met more than once, up to this number, are joined back by broadcast.
FEW_REPEATED = 1_000_000


def uri(page: Column, digest: Column) -> Column:
    """A record id made of a page's id and payload: the same for each run."""
    h = F.md5(F.concat_ws("|", page.cast("string"), digest))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def pages_to_records(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(headers, block) of every page: a response, or a revisit of the first page with an equal payload.

    Only digests and ids are grouped: a payload of very many copies is one row of the groups, and
    what was met once is not joined at all. Of rows that are equal in id and payload one is the response.
    Rows without an id come after those with one; where no row of an equal payload has one, revisits refer to null.
    """
    payload = F.encode(F.coalesce(quoted(html).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(quoted(key).cast("long").alias("page"), quoted(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    large = rows.filter(F.col("bytes") >= LEAST_REVISIT).groupBy("digest", "page").agg(F.count(F.lit(1)).alias("n"))
    large = stored(large, "warc-digests")
    first = large.groupBy("digest").agg(F.min("page").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    first = first.select(F.col("digest").alias("__digest"), "first", F.lit(True).alias("repeated"))
    met = rows.join(narrow_side(first, FEW_REPEATED), F.col("digest") == F.col("__digest"), "left")
    is_first = F.col("page").eqNullSafe(F.col("first"))
    # Several rows of the first id: which of them is met first is the only thing that needs an order.
    twins = large.join(first.drop("repeated"), (F.col("digest") == F.col("__digest")) & is_first).filter("n > 1")
    if twins.limit(1).count():
        met = _one_response(met, is_first)
        is_first = F.col("__one")
    response = F.coalesce(~F.col("repeated"), F.lit(True)) | is_first | (F.col("bytes") < LEAST_REVISIT)
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    headers = {
        HEADERS["record_type"]: F.when(response, "response").otherwise("revisit"),
        HEADERS["record_id"]: uri(F.col("page"), F.col("digest")),
        HEADERS["date"]: F.lit(date),
        HEADERS["target_uri"]: F.col("url"),
        HEADERS["content_type"]: F.lit("application/http; msgtype=response"),
        HEADERS["payload_digest"]: F.concat(F.lit("sha256:"), F.col("digest")),
        HEADERS["refers_to"]: F.when(~response, uri(F.col("first"), F.col("digest"))),
        HEADERS["profile"]: F.when(~response, F.lit(REVISIT_PROFILE)),
        PAGE: F.col("page").cast("string"),
        REFERS_TO_PAGE: F.when(~response, F.col("first").cast("string")),
    }
    pairs = F.create_map(*[x for name, value in headers.items() for x in (F.lit(name), value)])
    block = F.when(response, F.concat(F.encode(http, "UTF-8"), F.col("payload"))).otherwise(F.encode(http, "UTF-8"))
    return met.select(pairs.alias("headers"), block.alias("block"))


def _one_response(met: DataFrame, is_first: Column) -> DataFrame:
    """``__one`` marks one row of each first id and payload: the one of least url, by rank among those rows alone.

    Url and a number of the row decide, which the rows carry from a stored table so that it stays.
    """
    numbered = stored(met.withColumn("__row", F.monotonically_increasing_id()), "warc-rows")
    least = numbered.filter(is_first).groupBy("digest").agg(F.min(F.struct("url", "__row")).alias("least"))
    chosen = least.select(F.col("least.__row").alias("__chosen"))
    return numbered.join(chosen, F.col("__row") == F.col("__chosen"), "left").withColumn("__one", F.col("__chosen").isNotNull())


def page_rows(spark: SparkSession, path: str) -> DataFrame:
    """What archives of pages hold, read back: payloads of responses are measured, revisits give their headers.

    Two reads, each with its record type pushed down: the second decodes no response's payload.
    """
    page = F.col("headers")[PAGE.lower()].cast("long").alias("page_id")
    full = read(spark, path).filter("record_type = 'response'").select(
        page,
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        F.col("payload_digest").alias("stated_digest"),
    )
    again = read(spark, path, payloads=False).filter("record_type = 'revisit'").select(
        page,
        F.col("http_headers")["content-length"].cast("long").alias("payload_bytes"),
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        F.col("headers")[REFERS_TO_PAGE.lower()].cast("long").alias("refers_to"),
        F.col("payload_digest").alias("stated_digest"),
    )
    return full.union(again)
