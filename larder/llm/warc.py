"""WARC archives as a Python data source: one gzip member per record, an index of members beside each file.

Writing: each task writes one file and its index; the commit lists the files of successful tasks in a manifest of its
own, so what a lost executor left behind is never read.  A manifest that overwrites names those that it replaces.
Reading: the files of all manifests in force are cut into byte ranges; of each record the headers are read and
inflated first, the pushed predicates (record type and other header columns) are tried on them, and only records that
pass, and only when the payload is asked for, are read and inflated further.

A folder without manifests, or a single file, holds archives of others: `.warc` and `.warc.gz` files, each read by one
task from its beginning, since nothing tells where records start.  Blocks of records that do not pass are skipped in
small pieces.

Folders are opened through `pyarrow.fs`, so any store that it knows a scheme for will do.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from larder.llm.common import cut, new_folder, shuffles_removed, table

SCHEMA = (
    "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, "
    "payload binary"
)
LEAST_SHARED = 1000
_HEAD = 4096
_PIECE = 256 << 10
_RANGE = 64 << 20
_BATCH = 8 << 20
_PAGE = re.compile(r"<urn:page:(-?[0-9]+)>")
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    """The page of a record of our own; other names have none."""
    found = _PAGE.fullmatch(name or "")
    return int(found[1]) if found else None


def _one_line(url: str) -> str:
    """A URL as it is, but for line ends, which would end the header."""
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    """A response or revisit record, uncompressed.  A revisit carries the HTTP header of the payload alone."""
    payload = row["payload"] or b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    block = http + (payload if row["record_type"] == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_name(row['page_id'])}", f"WARC-Date: {_DATE}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {_one_line(row['url'])}")
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(row['payload_digest'])).decode()}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Refers-To: {_name(row['refers_to'])}", f"WARC-Profile: {_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    """The header lines by name in lower case."""
    lines = [x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:]]
    return {name.lower(): value.removeprefix(" ") for name, colon, value in lines if colon}


def _sha1(value: str | None) -> str | None:
    """SHA-1 in hex of a digest header; other kinds of digests are null."""
    kind, _, text = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        return base64.b32decode(text.upper()).hex() if len(text) == 32 else bytes.fromhex(text).hex()
    except ValueError:
        return None


def parsed(head: bytes, http: bytes) -> dict:
    """The header columns of a record."""
    warc, reply = _fields(head), _fields(http)
    length = reply.get("content-length", "").strip()
    return {
        "page_id": _number(warc.get("warc-record-id")),
        "url": warc.get("warc-target-uri"),
        "record_type": warc.get("warc-type"),
        "payload_digest": _sha1(warc.get("warc-payload-digest")),
        "payload_bytes": int(length) if length.isascii() and length.isdigit() else None,
        "refers_to": _number(warc.get("warc-refers-to")),
    }


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    size: int
    records: int


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder, overwrite

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _open(self.folder)
        store.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        offsets = [0]
        with store.open_output_stream(f"{root}/{name}", compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record(row)) + packer.flush()
                    out.write(member)
                    offsets.append(offsets[-1] + len(member))
        with store.open_output_stream(f"{root}/{name}.index", compression=None) as out:
            out.write(np.array(offsets, "<i8").tobytes())
        return Written(name, offsets[-1], len(offsets) - 1)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _open(self.folder)
        store.create_dir(root, recursive=True)
        replaced = list(manifests(self.folder)) if self.overwrite else []
        files = [{"name": m.name, "size": m.size, "records": m.records} for m in messages if m is not None and m.records]
        with store.open_output_stream(f"{root}/manifest-{uuid.uuid4().hex}.json", compression=None) as out:
            out.write(json.dumps({"files": files, "replaces": replaced}).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """What no manifest names is never read."""


def manifests(folder: str) -> dict[str, list[dict]]:
    """The files of each manifest that no other one replaces."""
    store, root = _open(folder)
    found = {}
    for info in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if info.base_name.startswith("manifest-") and info.base_name.endswith(".json"):
            with store.open_input_stream(info.path, compression=None) as f:
                found[info.base_name] = json.loads(f.read())
    gone = {name for x in found.values() for name in x["replaces"]}
    return {name: x["files"] for name, x in sorted(found.items()) if name not in gone}


@dataclass
class Range(InputPartition):
    """Records that start in a byte range of an indexed file; without a range a whole file of others."""

    name: str
    low: int = 0
    high: int | None = None


class _Bytes:
    """The bytes of a file, inflated where they are gzip members."""

    def __init__(self, stream, packed: bool):
        self.stream, self.packed = stream, packed
        self.inflate = zlib.decompressobj(31)
        self.left, self.raw = b"", b""

    def _more(self) -> bool:
        """Get some more; False at the end of the file."""
        while True:
            if self.packed and self.inflate.eof:
                self.raw = self.inflate.unused_data or self.stream.read(_PIECE)
                if not self.raw:
                    return False
                self.inflate = zlib.decompressobj(31)
            else:
                self.raw = (self.inflate.unconsumed_tail if self.packed else b"") or self.stream.read(_PIECE)
            got = self.inflate.decompress(self.raw, _PIECE) if self.packed else self.raw
            self.left += got
            if got or not self.raw:
                return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        """What comes before the next mark, which is dropped too; None where there is no more."""
        start = 0
        while (at := self.left.find(mark, start)) < 0:
            start = max(0, len(self.left) - len(mark))
            if not self._more():
                return None
        got, self.left = self.left[:at], self.left[at + len(mark) :]
        return got

    def past_lines(self) -> bool:
        """Skip line ends; whether something follows."""
        while not (rest := self.left.lstrip(b"\r\n")):
            if not self._more():
                return False
        self.left = rest
        return True

    def take(self, n: int) -> bytes:
        parts = []
        while n > 0 and (self.left or self._more()):
            part, self.left = self.left[:n], self.left[n:]
            parts.append(part)
            n -= len(part)
        return b"".join(parts)

    def skip(self, n: int) -> None:
        while n > 0 and (self.left or self._more()):
            gone = min(n, len(self.left))
            self.left = self.left[gone:]
            n -= gone


class WarcReader(DataSourceReader):
    def __init__(self, folder: str, schema: StructType):
        self.folder, self.schema = folder, schema
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Header columns are tested while reading; the rest goes back to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in (None, "payload"):
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", {f.value}))
            elif isinstance(f, In):
                self.tests.append((column, "in", set(f.value)))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "known", True))
            elif isinstance(f, IsNull):
                self.tests.append((column, "known", False))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, root = _open(self.folder)
        info = store.get_file_info(root)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.folder)
        if info.type == fs.FileType.File:
            return [Range(info.base_name)]
        if own := manifests(self.folder):
            files = [x for part in own.values() for x in part]
            return [Range(x["name"], low, low + _RANGE) for x in files for low in range(0, x["size"], _RANGE)] or [Range("")]
        found = store.get_file_info(fs.FileSelector(root))
        return [Range(x.base_name) for x in found if x.base_name.endswith((".warc", ".warc.gz")) and x.size] or [Range("")]

    def _passes(self, row: dict) -> bool:
        return all(
            row[c] in v and row[c] is not None if kind == "in" else (row[c] is not None) == v for c, kind, v in self.tests
        )

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        rows: list[dict] = []
        size = 0
        found = iter(()) if not partition.name else self._indexed(partition) if partition.high is not None else self._foreign(partition)
        for row in found:
            rows.append(row)
            size += len(row.get("payload") or b"")
            if size > _BATCH or len(rows) >= 4096:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def _indexed(self, partition: Range) -> Iterator[dict]:
        wanted = "payload" in self.schema.names
        store, root = _open(self.folder)
        with store.open_input_stream(f"{root}/{partition.name}.index", compression=None) as f:
            offsets = np.frombuffer(f.read(), "<i8")
        first, last = np.searchsorted(offsets[:-1], [partition.low, partition.high])
        with store.open_input_file(f"{root}/{partition.name}") as f:
            for at, end in zip(offsets[first:last].tolist(), offsets[first + 1 : last + 1].tolist()):
                f.seek(at)
                inflate = zlib.decompressobj(31)
                data = inflate.decompress(f.read(min(_HEAD, end - at)), _HEAD)
                while data.count(b"\r\n\r\n") < 2 and not inflate.eof:  # headers longer than usual
                    packed = inflate.unconsumed_tail or f.read(min(_HEAD, end - f.tell()))
                    more = inflate.decompress(packed, _HEAD)
                    if not packed and not more:
                        break
                    data += more
                head, _, rest = data.partition(b"\r\n\r\n")
                http, _, body = rest.partition(b"\r\n\r\n")
                row = parsed(head, http)
                if not self._passes(row):
                    continue
                if wanted:
                    row["payload"] = None
                    if row["record_type"] == "response":
                        if not inflate.eof:
                            body += inflate.decompress(inflate.unconsumed_tail + f.read(end - f.tell()))
                        row["payload"] = body[: row["payload_bytes"]]
                yield row

    def _foreign(self, partition: Range) -> Iterator[dict]:
        """Records one after the other.  Payloads are those of responses and resources, chunks of HTTP as they are."""
        wanted = "payload" in self.schema.names
        store, root = _open(self.folder)
        path = root if store.get_file_info(root).type == fs.FileType.File else f"{root}/{partition.name}"
        with store.open_input_stream(path, compression=None) as f:
            data = _Bytes(f, partition.name.endswith(".gz"))
            while data.past_lines():
                head = data.until(b"\r\n\r\n") or b""
                fields = _fields(head)
                if not head.startswith(b"WARC/") or not fields.get("content-length", "").strip().isdigit():
                    raise ValueError(f"{path}: not a WARC record")
                length = int(fields["content-length"])
                http = b""
                if fields.get("content-type", "").startswith("application/http"):
                    start = data.take(min(length, _HEAD))
                    while b"\r\n\r\n" not in start and len(start) < length:
                        start += data.take(min(length - len(start), _HEAD))
                    http, _, start = start.partition(b"\r\n\r\n")
                    left = length - len(http) - 4 - len(start) if length > len(http) else 0
                else:
                    start, left = b"", length
                row = parsed(head, http)
                if row["payload_bytes"] is None and row["record_type"] in ("response", "resource"):
                    row["payload_bytes"] = len(start) + left
                if self._passes(row):
                    if wanted:
                        row["payload"] = None
                        if row["record_type"] in ("response", "resource"):
                            row["payload"] = start + data.take(left)
                            left = 0
                    yield row
                data.skip(left)


class WarcSource(DataSource):
    """format("warc"): columns page_id, url, record_type, payload_digest (hex SHA-1), payload_bytes, refers_to and
    payload; a reader's schema may name some of them only."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_SHARED) -> DataFrame:
    """The records of a table of pages, with the columns of `SCHEMA`.

    Of pages with equal payloads of at least `least` bytes the one with the largest id is the response and the
    others revisit it.  Rows that repeat that id with that payload are responses too, and so are rows whose group
    has null ids alone.  Null html is an empty payload; extra columns are left out.
    """
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    # one row for each payload that occurs again; tasks count before anything is moved
    shared = (
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _first is not null")
        .select("payload_digest", "_first")
    )
    # written, so that the join is of two plain scans and can split a payload that very many pages have
    joined = rows.join(cut(shared, "payloads"), "payload_digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("_first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"), "payload_digest",
        "payload_bytes", F.when(revisit, F.col("_first")).alias("refers_to"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write(made: DataFrame, folder: str, mode: str = "append") -> None:
    """Add records to an archive; with mode `overwrite` they are all that is read from then on."""
    register(made.sparkSession)
    with shuffles_removed(made.sparkSession):
        made.write.format("warc").mode(mode).save(folder)


def read(spark: SparkSession, folder: str, columns: str = SCHEMA) -> DataFrame:
    """The records of an archive; name fewer columns to leave payloads packed."""
    register(spark)
    return spark.read.format("warc").schema(columns).load(folder)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to; of responses both figures are taken anew from
    the payload that was read."""
    folder = new_folder(spark, "warc")
    write(records(table(spark, sf_dir, "pages")), folder)
    full = read(spark, folder).where("record_type = 'response'").select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", "refers_to",
    )
    headers = read(spark, folder, SCHEMA.replace(", payload binary", "")).where("record_type = 'revisit'")
    return full.unionByName(headers.select(*full.columns))
