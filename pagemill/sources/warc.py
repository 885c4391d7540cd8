"""Spark data source ``warc``: a task per archive file (small files share one), records streamed from gzip members.

    spark.dataSource.register(WarcDataSource)
    spark.read.format("warc").load("s3://bucket/crawl/*.warc.gz")

Paths go through ``pyarrow.fs`` (local, ``s3://`` or ``s3a://``, ``gs://``, ``hdfs://``), so a task holds one batch of records
and never a whole file. The option ``recordTypes`` and filters on the header columns work inside the reader: a record
that its archive header rejects is skipped in pieces, payload and all. A narrower ``.schema(...)`` without ``payload``
never reads one either. A file that breaks in whatever way gives the records before the break plus one row with
``error`` set (``onError=skip``, the default) or fails the job (``onError=fail``). Error rows have NULL headers and pass
``recordTypes`` and every filter that the reader takes over, so a broken archive never goes unseen.
"""

from __future__ import annotations

import fnmatch
import io
import posixpath
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
)
from pyspark.sql.types import StructType

SCHEMA = (
    "filename string, rec_type string, url string, raw_date string, http_content_type string, "
    "payload binary, error string"
)
ARCHIVE_COLUMNS = {"rec_type", "url", "raw_date"}
HEADER_COLUMNS = ARCHIVE_COLUMNS | {"http_content_type"}
ARROW_TYPES = {"payload": pa.binary()}
TASK_BYTES = 128 << 20
OPEN_BYTES = 4 << 20
CORE_TASKS, TASK_ARCHIVES = 16, 32
BATCH_BYTES = 16 << 20
BATCH_ROWS = 2000
READ_CHUNK = 1 << 20
MOST_LINE = 1 << 20
INFLATE_CHUNK = 1 << 16


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(dict(self.options), schema.fieldNames())


class ArchiveFiles(InputPartition):
    def __init__(self, uris: list[str]):
        super().__init__(uris)
        self.uris = uris


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.paths = options["path"].split(",")
        options = {name.lower(): value for name, value in options.items()}
        self.on_error = options.get("onerror", "skip")
        self.tasks = int(options.get("tasks", 1))
        self.columns = columns
        types = options.get("recordtypes")
        self.wanted: dict[str, set | None] = {"rec_type": set(types.split(","))} if types else {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            if column not in HEADER_COLUMNS:
                yield f
            elif isinstance(f, EqualTo):
                self._keep(column, {f.value})
            elif isinstance(f, In):
                self._keep(column, set(f.value))
            elif isinstance(f, IsNotNull):
                self.wanted.setdefault(column, None)
            else:
                yield f

    def _keep(self, column: str, values: set) -> None:
        known = self.wanted.get(column)
        self.wanted[column] = values if known is None else known & values

    def partitions(self) -> list[ArchiveFiles]:
        files = [file for path in self.paths for file in list_files(path.strip())]
        return [ArchiveFiles(uris) for uris in pack_files(files, self.tasks)]

    def read(self, partition: ArchiveFiles) -> Iterator[pa.RecordBatch]:
        for uri in partition.uris:
            yield from read_file(uri, self.columns, self.wanted, self.on_error)


def read_archives(
    files: DataFrame,
    path_column: str = "filename",
    schema: str = SCHEMA,
    on_error: str = "skip",
    tasks: int | None = None,
    record_types: list[str] | None = None,
) -> DataFrame:
    """Archive rows for a DataFrame of archive paths (a manifest), without listing them on the driver.

    ``record_types`` leaves other records out inside the reader; error rows stay. The archives are dealt over ``tasks``; unless
    given, a core has up to ``CORE_TASKS`` of them, and more only where a task would have over ``TASK_ARCHIVES``.
    """
    wanted = {"rec_type": set(record_types)} if record_types else {}
    columns = [field.split()[0] for field in schema.split(",")]
    spark = files.sparkSession
    if tasks is None:
        archives = files.count()
        tasks = max(1, min(archives, spark.sparkContext.defaultParallelism * CORE_TASKS), -(-archives // TASK_ARCHIVES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield from read_file(uri, columns, wanted, on_error)

    paths = files.select(F.col(path_column).alias("uri"))
    return paths.repartition(tasks).mapInArrow(read, spark.createDataFrame([], schema).schema)


def pack_files(files: list[tuple[str, int]], tasks: int) -> list[list[str]]:
    """Small files share a task, as in Spark's own file sources; a file of archive size has one for itself."""
    total = sum(size + OPEN_BYTES for _, size in files)
    limit = min(TASK_BYTES, max(OPEN_BYTES, total // tasks))
    packs: list[list[str]] = []
    room = 0
    for uri, size in files:
        cost = size + OPEN_BYTES
        if not packs or cost > room:
            packs.append([])
            room = limit
        packs[-1].append(uri)
        room -= cost
    return packs


def list_files(path: str) -> list[tuple[str, int]]:
    """``(uri, size)`` of a path, folder or pattern, sorted; names starting with ``_`` or ``.`` are no data."""
    path = arrow_uri(path)
    scheme, colon, rest = path.partition("://")
    prefix, local = (scheme + colon, rest) if colon else ("", path)
    cut = next((i for i, c in enumerate(local) if c in "*?["), None)
    base = local if cut is None else local[: local.rfind("/", 0, cut)]
    system, root = file_system(prefix + base)
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    tail = "*" if cut is None else local[len(base) + 1:]
    depth = tail.count("/")
    found = []
    for item in system.get_file_info(fs.FileSelector(root, recursive=cut is None or depth > 0)):
        relative = posixpath.relpath(item.path, root)
        hidden = any(part.startswith(("_", ".")) for part in relative.split("/"))
        matches = cut is None or (relative.count("/") == depth and fnmatch.fnmatchcase(relative, tail))
        if item.type == fs.FileType.File and not hidden and matches:
            found.append((f"{prefix}{base}/{relative}", item.size))
    return sorted(found)


def read_file(
    uri: str, columns: list[str], wanted: dict[str, set | None], on_error: str
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of one archive file, with the filters of ``wanted`` applied to the headers of its records."""
    rows, size = [], 0
    try:
        with open_archive(uri) as stream:
            for row in iter_records(stream, wanted, columns):
                row["filename"] = uri
                rows.append(row)
                size += len(row["payload"] or b"")
                if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield _batch(rows, columns)
                    rows, size = [], 0
    except Exception as problem:  # whatever is wrong with one file must not cost the others
        if on_error == "fail":
            raise
        broken = dict.fromkeys(HEADER_COLUMNS) | {"filename": uri, "payload": None}
        rows.append(broken | {"error": f"{type(problem).__name__}: {problem}"})
    if rows:
        yield _batch(rows, columns)


def _batch(rows: list[dict], columns: list[str]) -> pa.RecordBatch:
    arrays = [pa.array([row.get(c) for row in rows], ARROW_TYPES.get(c, pa.string())) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, columns)


def arrow_uri(uri: str) -> str:
    """Hadoop spellings of a URI as Arrow writes them."""
    scheme, colon, rest = uri.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        return "s3:" + rest
    if scheme == "file" and not rest.startswith("//"):
        return "file://" + rest
    return uri


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    uri = arrow_uri(uri)
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def open_archive(uri: str) -> io.BufferedReader:
    system, path = file_system(uri)
    raw = io.BufferedReader(system.open_input_stream(path, compression=None), READ_CHUNK)
    if raw.peek(2)[:2] == b"\x1f\x8b":
        return io.BufferedReader(GzipMembers(raw), READ_CHUNK)
    return raw


class GzipMembers(io.RawIOBase):
    """Bytes of the gzip members of a file; what comes before a damaged place is handed out before the error."""

    def __init__(self, source: io.BufferedReader):
        self.source = source
        self.pending = b""
        self.inflater = None

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if not self.pending:
                self.pending = self.source.read1(INFLATE_CHUNK)
                if not self.pending and self.inflater is not None:
                    raise EOFError("file ends inside a gzip member")
                if not self.pending:
                    return 0
            if self.inflater is None:
                self.inflater = zlib.decompressobj(31)
            data = self.inflater.decompress(self.pending, len(buffer))
            self.pending = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self.pending = self.inflater.unused_data
                self.inflater = None
            if data:
                buffer[: len(data)] = data
                return len(data)


def passes(row: dict, wanted: dict[str, set | None], columns: set[str]) -> bool:
    """Whether a row has the wanted values in ``columns``; None stands for any value but NULL."""
    return all(row[c] is not None if values is None else row[c] in values for c, values in wanted.items() if c in columns)


def iter_records(stream: io.BufferedReader, wanted: dict[str, set | None], columns: list[str]) -> Iterator[dict]:
    """One dict per record that has the wanted headers. The rest of a record that is not needed is skipped in pieces."""
    while line := stream.readline(MOST_LINE):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not an archive record: {line[:40]!r}")
        headers = _headers(stream)
        body = RecordBody(stream, record_length(headers))
        row = dict.fromkeys(("http_content_type", "payload", "error"))
        row |= {"rec_type": headers.get("warc-type"), "url": headers.get("warc-target-uri"), "raw_date": headers.get("warc-date")}
        if passes(row, wanted, ARCHIVE_COLUMNS):
            http = {}
            needed = "payload" in columns or "http_content_type" in columns or "http_content_type" in wanted
            if needed and headers.get("content-type", "").replace(" ", "").startswith("application/http"):
                body.readline(MOST_LINE)
                http = _headers(body)
                row["http_content_type"] = http.get("content-type")
            if passes(row, wanted, HEADER_COLUMNS):
                if "payload" in columns:
                    row["payload"] = _decoded(b"".join(body.pieces()), http)
                for _ in body.pieces():
                    pass
                yield row
        for _ in body.pieces():
            pass


def record_length(headers: dict[str, str]) -> int:
    """The checked length of a record's body."""
    text = headers.get("content-length", "")
    if not (text.isascii() and text.isdigit()):
        raise ValueError(f"a record's Content-Length is {text!r}")
    return int(text)


class RecordBody:
    """What is left of a record's body. It is read in pieces, so a header that lies about the length costs no memory."""

    def __init__(self, stream: io.BufferedReader, length: int):
        self.stream, self.length, self.left = stream, length, length

    def readline(self, most: int = MOST_LINE) -> bytes:
        return self._taken(self.stream.readline(min(most, self.left))) if self.left else b""

    def pieces(self) -> Iterator[bytes]:
        while self.left:
            yield self._taken(self.stream.read(min(READ_CHUNK, self.left)))

    def _taken(self, data: bytes) -> bytes:
        if not data:
            raise EOFError(f"record ends after {self.length - self.left} of {self.length} bytes")
        self.left -= len(data)
        return data


def _headers(stream: io.BufferedIOBase | RecordBody) -> dict[str, str]:
    """Header block up to the empty line, names in lower case; the first of a repeated name counts."""
    found: dict[str, str] = {}
    name = None
    while True:
        line = stream.readline(MOST_LINE)
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if not text:
            return found
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        found.setdefault(name, value.strip())


def _decoded(body: bytes, http: dict[str, str]) -> bytes:
    """HTTP body without transfer and content encoding; left as stored when it does not decode."""
    if http.get("transfer-encoding", "").lower() == "chunked":
        body = _unchunked(body)
    encoding = http.get("content-encoding", "").lower()
    if encoding in ("gzip", "x-gzip", "deflate"):
        for window in (47, -15):
            try:
                return zlib.decompress(body, window)
            except zlib.error:
                continue
    return body


def _unchunked(body: bytes) -> bytes:
    source, parts = io.BytesIO(body), []
    while True:
        try:
            size = int(source.readline().split(b";")[0], 16)
        except ValueError:
            return b"".join(parts) if parts else body
        if size == 0:
            return b"".join(parts)
        parts.append(source.read(size))
        source.readline()


def read_warc(
    spark: SparkSession, path: str, schema: str = SCHEMA, on_error: str = "skip", record_types: list[str] | None = None
) -> DataFrame:
    """Archive rows of a path, folder, pattern or comma-separated list; of ``record_types`` only, and error rows."""
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").schema(schema).option("onError", on_error)
    if record_types:
        reader = reader.option("recordTypes", ",".join(record_types))
    return reader.option("tasks", spark.sparkContext.defaultParallelism).load(path)
