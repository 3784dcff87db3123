"""WARC archives as a Python data source, and archives of pages with revisit records.

Reading: partitions are groups of whole files. A record's headers are parsed first; pushed down
predicates on record type and headers decide on it, and the payload of a record that is not wanted, or of any
record if the schema has no ``payload``, is skipped without being decoded: archives written here carry each record's compressed
length in an extra field of its gzip header (SL), uncompressed archives have Content-Length. Other gzip archives are decompressed
to find the next record.

Writing: tasks write files of bounded size under ``_temporary``; the commit moves those of successful tasks into place.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

SCHEMA = "record_id string, type string, target_uri string, date string, payload_digest string, refers_to string, content_length long, payload_bytes long, payload binary"
#: Columns that a header decides, by header name.
HEADERS = {"record_id": "warc-record-id", "type": "warc-type", "target_uri": "warc-target-uri", "date": "warc-date", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to"}
PARTITION_BYTES, FILE_BYTES, CHUNK = 128 * 2**20, 2**30, 2**16
BATCH_ROWS, BATCH_BYTES = 1000, 16 * 2**20
GZIP_HEADER = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it; a path without a scheme is local."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Files(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)
        self.names = names


class Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcSource(DataSource):
    """``spark.read.format("warc").load(folder)``; options: ``verify`` (true: check the digests of decoded payloads)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path = options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.columns = schema.fieldNames()
        self.wanted: list[tuple[str, str, tuple[str, ...]]] = []

    def pushFilters(self, filters: list) -> Iterator:
        """Takes equality, membership and prefixes of header columns; returns the rest to Spark."""
        for found in filters:
            name = found.attribute[0] if len(getattr(found, "attribute", ())) == 1 else ""
            if name in HEADERS and isinstance(found, EqualTo):
                self.wanted.append((name, "in", (found.value,)))
            elif name in HEADERS and isinstance(found, In):
                self.wanted.append((name, "in", tuple(found.value)))
            elif name in HEADERS and isinstance(found, StringStartsWith):
                self.wanted.append((name, "starts", (found.value,)))
            else:
                yield found

    def partitions(self) -> list[Files]:
        store, path = _store(self.path)
        infos = store.get_file_info(fs.FileSelector(path, recursive=False)) if store.get_file_info(path).type == fs.FileType.Directory else [store.get_file_info(path)]
        files = sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and i.path.endswith((".warc", ".warc.gz")))
        groups: list[list[str]] = []
        room = 0
        for name, size in files:
            if not groups or size > room:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append(name)
            room -= size
        return [Files(g) for g in groups] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        kinds = {"content_length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        rows: list[list] = []
        held = 0
        for name in partition.names:
            with store.open_input_file(name) as file:
                for row in self._records(file, name.endswith(".gz")):
                    rows.append([row.get(c) for c in self.columns])
                    held += len(row.get("payload") or b"") + 500
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield self._batch(rows, kinds)
                        rows, held = [], 0
        yield self._batch(rows, kinds)

    def _batch(self, rows: list[list], kinds: dict) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(self.columns)
        return pa.record_batch([pa.array(v, kinds.get(c, pa.string())) for c, v in zip(self.columns, columns, strict=True)], self.columns)

    def _fits(self, row: dict) -> bool:
        tests = {"in": lambda v, w: v in w, "starts": lambda v, w: v is not None and v.startswith(w)}
        return all(tests[how](row.get(name), wanted) for name, how, wanted in self.wanted)

    def _records(self, file: pa.NativeFile, zipped: bool) -> Iterator[dict]:
        stream = _Stream(file, zipped)
        while stream.begin():
            head = stream.until(b"\r\n\r\n")
            headers = _headers(head)
            length = int(headers.get("content-length", 0))
            row = {c: _plain(headers.get(h)) for c, h in HEADERS.items()} | {"content_length": length}
            if not self._fits(row):
                stream.skip(length)
                continue
            http = headers.get("content-type", "").startswith("application/http")
            if "payload" not in self.columns and not ("payload_bytes" in self.columns and http):
                row["payload_bytes"] = length
                stream.skip(length)
                yield row
                continue
            inner = stream.until(b"\r\n\r\n") if http else b""
            body = length - len(inner)
            told = _headers(inner).get("content-length")
            row["payload_bytes"] = int(told) if told is not None else body
            if "payload" in self.columns and row["type"] != "revisit":
                row["payload"] = stream.take(body)
                if self.verify and row["payload_digest"] not in (None, digest_of(row["payload"])):
                    raise ValueError(f"payload of {row['record_id']} does not have its digest")
                stream.skip(0)
            else:
                stream.skip(body)
            yield row


def _headers(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line, a version or status, is left out."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _plain(value: str | None) -> str | None:
    """Without angle brackets and the name of the hash function."""
    return None if value is None else value.strip("<>").removeprefix("sha1:")


class _Stream:
    """Bytes of one record after another, decompressed no further than asked for."""

    def __init__(self, file: pa.NativeFile, zipped: bool):
        self.file, self.zipped, self.size = file, zipped, file.size()
        self.at = 0  # start of the next record, if known
        self.next: int | None = 0
        self.ready = b""
        self.coder = None

    def begin(self) -> bool:
        """To the next record; False at the end of the file."""
        if self.next is None:
            self._to_end()
        self.at = self.next
        self.ready, self.next, self.coder = b"", None, None
        if self.at >= self.size:
            return False
        self.file.seek(self.at)
        if self.zipped:
            self.coder = zlib.decompressobj(31)
            head = self.file.read(24)
            if head.startswith(GZIP_HEADER) and head[12:14] == b"SL":
                self.next = self.at + struct.unpack("<I", head[16:20])[0]
            self.file.seek(self.at)
            return self.size - self.at > 20
        return True

    def _more(self) -> bool:
        if self.zipped:
            data = self.coder.unconsumed_tail or self.file.read(CHUNK)
            if not data or self.coder.eof:
                return False
            self.ready += self.coder.decompress(data, CHUNK)
            return True
        data = self.file.read(CHUNK)
        self.ready += data
        return bool(data)

    def until(self, mark: bytes) -> bytes:
        """Up to and with the mark."""
        start = 0
        while (at := self.ready.find(mark, start)) < 0:
            start = max(0, len(self.ready) - len(mark))
            if not self._more():
                raise ValueError("record without an end of its headers")
        return self._cut(at + len(mark))

    def take(self, length: int) -> bytes:
        pieces = [self.ready]
        have = len(self.ready)
        while have < length:
            self.ready = b""
            if not self._more():
                raise ValueError("record shorter than its Content-Length")
            pieces.append(self.ready)
            have += len(self.ready)
        self.ready = b"".join(pieces)
        return self._cut(length)

    def _cut(self, length: int) -> bytes:
        out, self.ready = self.ready[:length], self.ready[length:]
        return out

    def skip(self, length: int) -> None:
        """Over the rest of the record: by its stated length, without decoding."""
        if not self.zipped:
            here = self.file.tell() - len(self.ready)
            self.next = here + length + 4  # and the two line ends after the record

    def _to_end(self) -> None:
        """The end of a gzip member that doesn't state its length."""
        self.ready = b""
        while not self.coder.eof:
            if not self._more():
                break
            self.ready = b""
        self.next = self.file.tell() - len(self.coder.unused_data) if self.coder.eof else self.size


class WarcWriter(DataSourceArrowWriter):
    """Rows with ``record_id, type, target_uri, date, payload_digest, refers_to, payload_bytes, payload``; nulls leave a header out.

    A revisit keeps its HTTP headers, with the length of the payload it stands for, and no payload.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", "3"))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        store, path = _store(self.path)
        store.create_dir(f"{path}/_temporary", recursive=True)
        names: list[str] = []
        out, used = None, FILE_BYTES
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if used >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{len(names):05d}-{uuid.uuid4().hex}.warc.gz")
                        out, used = store.open_output_stream(f"{path}/_temporary/{names[-1]}", compression=None), 0
                    data = member(record(row), self.level)
                    out.write(data)
                    used += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        if self.overwrite:
            for info in store.get_file_info(fs.FileSelector(path, recursive=False)):
                if info.type == fs.FileType.File and info.path.endswith((".warc", ".warc.gz")):
                    store.delete_file(info.path)
        for name in (n for m in messages if m is not None for n in m.names):
            store.move(f"{path}/_temporary/{name}", f"{path}/{name}")
        self._tidy(store, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._tidy(*_store(self.path))

    def _tidy(self, store: fs.FileSystem, path: str) -> None:
        if store.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/_temporary")


def record(row: dict) -> bytes:
    """One WARC record with its HTTP response headers and payload."""
    payload = b"" if row["type"] == "revisit" else row["payload"] or b""
    told = row.get("payload_bytes")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload) if told is None else told}\r\n\r\n".encode()
    named = [
        ("WARC-Type", row["type"]),
        ("WARC-Record-ID", f"<{row['record_id']}>"),
        ("WARC-Target-URI", row.get("target_uri")),
        ("WARC-Date", row.get("date")),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}" if row.get("payload_digest") else None),
        ("WARC-Refers-To", f"<{row['refers_to']}>" if row.get("refers_to") else None),
        ("WARC-Profile", REVISIT_PROFILE if row["type"] == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(payload))),
    ]
    # A line end in a value would begin another header.
    lines = [f"{name}: {' '.join(value.splitlines())}" for name, value in named if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + http + payload + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose header states its length in a field SL: compressed, then plain."""
    coder = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = coder.compress(data) + coder.flush()
    whole = len(GZIP_HEADER) + 2 + 12 + len(body) + 8
    field = b"SL" + struct.pack("<HII", 8, whole & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return GZIP_HEADER + struct.pack("<H", len(field)) + field + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def register(spark: SparkSession) -> None:
    """Makes the format ``warc`` known and lets Spark push filters down to Python data sources."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


#: Most payloads with copies that are sent to all tasks, about 20 MB; more are joined by a shuffle.
BROADCAST_PAYLOADS = 200_000


def with_revisits(pages: DataFrame, id_column: str = "page_id", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Record rows of ``pages`` (id, url, payload text): of equal payloads the one with the largest id is a response, others revisit it.

    Null payloads are empty ones; payloads under ``min_bytes`` bytes are always responses. Equal rows with the largest id are all responses. Rows with a null id are
    the smallest, and get a record id of their own kind. Payloads are told apart by SHA-1 and length.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(id_column).alias("id"), F.col("url").alias("target_uri"), text.cast("binary").alias("payload"), F.sha1(text.cast("binary")).alias("sha1"), F.octet_length(text).cast("long").alias("payload_bytes"))
    copied = rows.where(F.col("payload_bytes") >= min_bytes).groupBy("sha1", "payload_bytes").agg(F.max("id").alias("first_id"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    few = copied.limit(BROADCAST_PAYLOADS + 1).count() <= BROADCAST_PAYLOADS
    joined = rows.join(F.broadcast(copied) if few else copied, ["sha1", "payload_bytes"], "left")
    revisits = F.coalesce(F.col("first_id") != F.col("id"), F.col("first_id").isNotNull() & F.col("id").isNull())
    named = lambda column: F.concat(F.lit(f"urn:{id_column}:"), F.coalesce(column.cast("string"), F.lit("")))
    return joined.select(
        named(F.col("id")).alias("record_id"),
        F.when(revisits, "revisit").otherwise("response").alias("type"),
        "target_uri",
        base32(F.col("sha1")).alias("payload_digest"),
        F.when(revisits, named(F.col("first_id"))).alias("refers_to"),
        "payload_bytes",
        # A revisit's payload isn't sent to the writer.
        F.when(~revisits, F.col("payload")).alias("payload"),
    )


def base32(hexadecimal):
    """Upper-case base32 of a hexadecimal SHA-1: five digits give four letters."""
    letters = F.array(*[F.lit(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"])
    groups = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda g: F.conv(F.substring(hexadecimal, g * 5 + 1, F.lit(5)), 16, 10).cast("int"))
    spelled = lambda v: F.concat(*[F.element_at(letters, F.shiftright(v, s).bitwiseAND(31) + 1) for s in (15, 10, 5, 0)])
    return F.array_join(F.transform(groups, spelled), "")


def write_archives(pages: DataFrame, path: str, date: str, **how) -> None:
    """Writes a record for each row of ``pages`` to ``path``."""
    register(pages.sparkSession)
    with_revisits(pages, **how).withColumn("date", F.lit(date)).write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA, verify: bool = False) -> DataFrame:
    """Records with just these columns; without ``payload`` none is decoded."""
    register(spark)
    return spark.read.format("warc").schema(columns).option("verify", str(verify).lower()).load(path)
