"""WARC archives as a Spark data source (operator 1).

Writing: every task writes gzip members, one per record, to files of bounded size under the target folder, which pyarrow's
file systems reach (local, S3, HDFS and others); the commit on the driver adds a manifest that names the files of successful
tasks, so files of lost or repeated attempts are never read. Reading: files are the partitions. Record-type and header predicates are
pushed into the reader, which parses a record's headers first and skips its block undecoded if they fail or if the payload is
not asked for (option `payload`).

Records: `response` holds an HTTP response and its payload; `revisit` holds the HTTP head only and refers to the response
with the same payload digest.

Defined results of `records`: a null html is an empty payload; payloads under 100 bytes are always responses; of equal longer
ones the rows with the smallest page_id are responses (several if that id repeats), also all of them if every id is null; a null url
leaves out the target header; control characters in header values are percent-encoded; an empty table writes no records and
reads as no rows; html of any length is written whole; columns other than the three named are ignored, whatever their names.

Archives from elsewhere: see `header_fields` and `http_payload`; a record without a content length is an error that names it, since
what follows it cannot be found.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith, WriterCommitMessage

from hexwatch.llm.common import column, stored

MIN_REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
SALTS = 16
#: Digest and id are some 100 bytes.
MAX_BROADCAST_DIGESTS = 200_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "1970-01-01T00:00:00Z"

WRITE_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, refers_to long"
READ_SCHEMA = (
    "record_type string, record_id string, target_uri string, page_id long, payload_bytes long, payload_digest string, "
    "refers_to long, content_length long, payload binary"
)
#: Columns of the reader that come from headers, so that predicates on them need no block.
HEADERS = ("record_type", "record_id", "target_uri", "page_id", "payload_bytes", "payload_digest", "refers_to", "content_length")


def record_id(page_id: int | None, number: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}' if page_id is not None else number)}>"


def header_value(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record(row: dict, number: str) -> bytes:
    """One uncompressed record; `number` names a record without page id."""
    revisit = row["refers_to"] is not None
    payload = b"" if revisit else row["payload"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], number)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", header_value(row["url"]))] if row["url"] is not None else []),
        ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
        *([("WARC-Refers-To", record_id(row["refers_to"], "")), ("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(row["refers_to"]))] if revisit else []),
        *([("X-Page-ID", str(row["page_id"]))] if row["page_id"] is not None else []),
        ("X-Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(payload))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + http + payload + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class RecordStream:
    """Records of one archive file, plain or of any number of gzip members, read forward in pieces of bounded size."""

    def __init__(self, file):
        self.file, self.buffer, self.at = file, bytearray(), 0
        first = file.read(2)
        self.packed = first == b"\x1f\x8b"
        self.raw, self.unpacker, self.over = first, None, False

    def _piece(self) -> bytes:
        """The next decoded bytes; empty at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.file.read(READ_BYTES)
                if not self.raw:
                    if self.unpacker is not None:
                        raise ValueError("archive ends inside a record")
                    return b""
            if not self.packed:
                out, self.raw = self.raw, b""
                return out
            if self.unpacker is None:
                self.unpacker = zlib.decompressobj(31)
            out = self.unpacker.decompress(self.raw, READ_BYTES)
            self.raw = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.raw, self.unpacker = self.unpacker.unused_data, None
            if out:
                return out

    def _more(self) -> bool:
        if self.at:
            del self.buffer[: self.at]
            self.at = 0
        piece = self._piece()
        self.buffer += piece
        return bool(piece)

    def head(self) -> dict[str, str] | None:
        """Headers of the next record by lower-cased name, or None at the end."""
        while True:
            while self.buffer[self.at : self.at + 2] == b"\r\n":  # between records
                self.at += 2
            end = self.buffer.find(b"\r\n\r\n", self.at)
            if end >= 0 and end - self.at > 0:
                break
            if not self._more():
                if bytes(self.buffer[self.at :]).strip():
                    raise ValueError("archive ends inside a header")
                return None
        first, fields = header_fields(bytes(self.buffer[self.at : end]))
        self.at = end + 4
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:80]!r}")
        if not fields.get("content-length", "").isdigit():
            raise ValueError(f"record without a content length: {fields.get('warc-record-id')}")
        return fields

    def block(self, length: int) -> bytes:
        parts, left = [], length
        while left:
            have = min(left, len(self.buffer) - self.at)
            parts.append(bytes(self.buffer[self.at : self.at + have]))
            self.at += have
            left -= have
            if left and not self._more():
                raise ValueError("archive ends inside a block")
        return b"".join(parts)

    def skip(self, length: int) -> None:
        left = length
        while left:
            have = min(left, len(self.buffer) - self.at)
            self.at += have
            left -= have
            if left and not self._more():
                raise ValueError("archive ends inside a block")


def header_fields(block: bytes) -> tuple[str, dict[str, str]]:
    """The first line and the headers by lower-cased name. Bytes that are not UTF-8 are Latin-1; a line that begins with white space goes
    on with the one before it."""
    try:
        text = block.decode("utf-8")
    except UnicodeDecodeError:
        text = block.decode("latin-1")
    first, *lines = re.sub(r"\r?\n[ \t]+", " ", text).replace("\r\n", "\n").split("\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP message as its reader gets it: chunks joined, gzip and deflate undone. A block that does not begin like a message
    is all body, one that does and has no blank line has none. A body in another coding, or damaged, stays as stored."""
    if not block.startswith((b"HTTP/", b"GET ", b"POST ", b"HEAD ", b"PUT ")):
        return block
    end = re.search(rb"\r?\n\r?\n", block)
    if end is None:
        return b""
    _, fields = header_fields(block[: end.start()])
    body = block[end.end() :]
    if fields.get("transfer-encoding", "").lower() == "chunked":
        body = joined_chunks(body)
    if fields.get("content-encoding", "").lower() in ("gzip", "x-gzip", "deflate"):
        for bits in (47, -15):  # with a gzip or zlib head, and bare
            unpacker = zlib.decompressobj(bits)
            try:
                whole = unpacker.decompress(body) + unpacker.flush()
            except zlib.error:
                continue
            if unpacker.eof:
                return whole
            break
    return body


def joined_chunks(body: bytes) -> bytes:
    """A chunked body without its chunk lines; unchanged if it does not have the form of one."""
    parts, at = [], 0
    while (line := body.find(b"\r\n", at)) >= 0:
        size = body[at:line].partition(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return body
        length = int(size, 16)
        if length == 0:
            return b"".join(parts)
        if body[line + 2 + length : line + 4 + length] != b"\r\n":
            return body
        parts.append(body[line + 2 : line + 2 + length])
        at = line + 4 + length
    return body


def from_headers(head: dict[str, str]) -> dict:
    number = lambda k: int(head[k]) if head.get(k, "").lstrip("-").isdigit() else None
    digest = head.get("warc-payload-digest", "")
    return {
        "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"), "target_uri": head.get("warc-target-uri"), "page_id": number("x-page-id"),
        "payload_bytes": number("x-payload-length"), "payload_digest": digest.partition(":")[2] or None, "refers_to": number("x-refers-to-page"),
        "content_length": number("content-length"),
    }


def passes(test: tuple, row: dict) -> bool:
    """One pushed predicate on a record's header columns; a null fails every comparison, as in SQL."""
    kind, name, operand = test
    v = row[name]
    if kind == "null-safe":
        return v == operand
    if v is None:
        return False
    return {"=": lambda: v == operand, "in": lambda: v in operand, ">": lambda: v > operand, ">=": lambda: v >= operand, "<": lambda: v < operand,
            "<=": lambda: v <= operand, "starts": lambda: v.startswith(operand), "some": lambda: True}[kind]()


#: Predicates that the reader takes, and their operand.
TAKEN = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", StringStartsWith: "starts", EqualNullSafe: "null-safe", IsNotNull: "some"}


@dataclass
class WarcFile(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            kind, name = TAKEN.get(type(f)), getattr(f, "attribute", (None,))
            if kind and len(name) == 1 and name[0] in HEADERS:
                operand = tuple(f.value) if kind == "in" else getattr(f, "value", None)
                self.tests.append((kind, name[0], operand))
            else:
                yield f

    def partitions(self) -> list[WarcFile]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        entries = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)) if fs.get_file_info(root).type != pafs.FileType.File else [fs.get_file_info(root)]
        manifests = [e.path for e in entries if e.base_name.startswith("_manifest-")]
        if manifests:
            return [WarcFile(f"{root.rstrip('/')}/{name}") for m in sorted(manifests) for name in json.loads(fs.open_input_stream(m).read())]
        return [WarcFile(e.path) for e in sorted(entries, key=lambda e: e.path) if e.type == pafs.FileType.File and e.base_name.endswith((".warc", ".warc.gz"))]

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        fs, _ = pafs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        with fs.open_input_stream(partition.path, compression=None) as file:
            stream = RecordStream(file)
            while (head := stream.head()) is not None:
                row = from_headers(head)
                length = row["content_length"] or 0
                wanted = all(passes(t, row) for t in self.tests)
                if not wanted or not self.payload or row["record_type"] == "revisit":
                    stream.skip(length)
                else:
                    body = stream.block(length)
                    if "application/http" in head.get("content-type", ""):
                        body = http_payload(body)
                    row["payload"] = body
                    held += len(body)
                if wanted:
                    rows.append(row)
                if len(rows) >= 5000 or held >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
        if rows:
            yield batch_of(rows)


def batch_of(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "content_length": pa.int64(), "payload": pa.binary()}
    names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, level: int):
        self.path, self.level = path, level

    def write(self, batches: Iterator[pa.RecordBatch]) -> WrittenFiles:
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names, out, size, n = [], None, 0, 0
        token = uuid.uuid4().hex[:12]
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None or size >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{task.partitionId():05d}-{len(names):04d}-{token}.warc.gz")
                        out, size = fs.open_output_stream(f"{root.rstrip('/')}/{names[-1]}", compression=None), 0
                    n += 1
                    data = gzip_member(record(row, f"record:{task.partitionId()}:{n}"), self.level)
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return WrittenFiles(names)

    def commit(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with fs.open_output_stream(f"{root.rstrip('/')}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for name in m.names if m is not None else []:
                fs.delete_file(f"{root.rstrip('/')}/{name}")


class WarcSource(DataSource):
    """Format `warc`. Options: path (a URI); payload (`false` leaves blocks undecoded); level (gzip, default 4)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ_SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("level", "4")))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")


def as_uri(path: str) -> str:
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows for the writer: of equal payloads of 100 bytes or more the smallest page id is the response.

    Repeated digests, one row each, are stored and counted: while they are few the pages stay where they are, and beyond that they
    are dealt by digest and salt, so that one payload of a third of all pages does not meet in one task.
    """
    text = F.coalesce(column(pages, html), F.lit(""))
    base = pages.select(column(pages, page_id).cast("long").alias("page_id"), column(pages, url).alias("url"), text.cast("binary").alias("payload"))
    base = base.select("page_id", "url", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))
    long = base.where(F.col("payload_bytes") >= MIN_REVISIT_BYTES)
    first = long.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    first = stored(first.select("payload_digest", "first"), "repeated-digests")
    if first.count() <= MAX_BROADCAST_DIGESTS:
        joined = base.join(F.broadcast(first), "payload_digest", "left")
    else:
        first = first.select("payload_digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        place = F.pmod(F.xxhash64(F.coalesce("page_id", F.xxhash64("url"))), F.lit(SALTS)).cast("int")
        joined = base.withColumn("salt", place).join(first, ["payload_digest", "salt"], "left")
    refers = F.when((F.col("payload_bytes") >= MIN_REVISIT_BYTES) & (~F.col("page_id").eqNullSafe(F.col("first"))), F.col("first"))
    rows = joined.select("page_id", "url", "payload", "payload_bytes", "payload_digest", refers.alias("refers_to"))
    return rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))


def write(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").option("path", as_uri(path)).save()


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("path", as_uri(path)).option("payload", str(payload).lower()).load()


def digests(archive: DataFrame) -> DataFrame:
    """Per record its page, and length and digest of its full payload: of a response as read, of a revisit as its headers say."""
    own = F.col("payload").isNotNull()
    return archive.select(
        "page_id",
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(own, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )
