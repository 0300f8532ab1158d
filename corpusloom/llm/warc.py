"""WARC archives: writing with segmented records, and reading with segment reassembly.

A page becomes an HTTP response with chunked transfer framing. A block longer than ``segment_bytes`` is cut: the first
record carries segment number 1, continuation records name it as their origin, and the last one states the total
length. Reading groups continuation records by origin, orders them by segment number, verifies numbers and total
length, and removes the chunk framing. Pages whose payload another one stores are revisits of it, without payload.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exists, forget, lookup_join, scratch, slices, small_batches, spread, written

CRLF = b"\r\n"
VERSION = b"WARC/1.1"
#: Largest block of one record, bytes of payload in one HTTP chunk, records in one archive.
SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 64 << 10, 8 << 10, 5000
#: Payloads shorter than this are stored with every page.
REVISIT_BYTES = 1000
DATE = b"2000-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID(int=0)


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing of a payload."""
    out = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        out += [b"%x" % len(part), CRLF, part, CRLF]
    return b"".join([*out, b"0", CRLF, CRLF])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            raise ValueError("chunk without size")
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != CRLF:
            raise ValueError("chunk without end")
        out.append(body[at : at + size])
        at += size + 2


def record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"


def _header(fields: list[tuple[str, object]], length: int) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"WARC-Date: " + DATE, b"Content-Length: %d" % length]
    return CRLF.join(lines) + CRLF + CRLF


def _page_record(page_id: int | None, row: int | None) -> str:
    return record_id(f"page {page_id} row {row}")


def records(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, segment_bytes: int = SEGMENT_BYTES, row: int | None = None, refers_row: int | None = None) -> list[bytes]:
    """The records of one page, without the two line ends after each.

    ``row`` tells apart rows with the same page_id, or none; a revisit refers to page ``refers_to`` of row ``refers_row``.
    """
    digest = "sha1:" + hashlib.sha1(payload).hexdigest()
    url = " ".join((url or "").split()) or None
    own = _page_record(page_id, row)
    about = [("WARC-Target-URI", url), ("WARC-Payload-Digest", digest), ("X-Page-ID", page_id)]
    head = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Transfer-Encoding: chunked"]) + CRLF + CRLF
    if refers_to is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), *about, ("WARC-Refers-To", _page_record(refers_to, refers_row)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("Content-Type", "application/http; msgtype=response")]
        return [_header(fields, len(head)) + head]
    block = head + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = []
    for i, part in enumerate(parts):
        fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about, ("Content-Type", "application/http; msgtype=response")]
        if len(parts) > 1:
            if i:
                fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", record_id(f"{own} {i + 1}")), ("WARC-Segment-Origin-ID", own)]
            fields.append(("WARC-Segment-Number", i + 1))
            if i == len(parts) - 1:
                fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_header(fields, len(part)) + part)
    return out


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(sha, bytes, top): payloads of at least ``least`` bytes that rows of several ids hold, with the row of the largest.

    ``pages`` is a written table with row, id, sha and bytes. Rows without id are stored, and so are all of the largest.
    """
    big = pages.filter((F.col("bytes") >= least) & F.col("id").isNotNull())
    return big.groupBy("sha", "bytes").agg(F.max(F.struct("id", "row")).alias("top"), F.min("id").alias("least")).filter("least < top.id").select("sha", "bytes", "top")


class _Archives:
    """The archives of one task: each record is a compressed member of its own, after a first one about the file.

    Names hold a token of the attempt, so a lost task's files never stand where those of the one that counts do.
    """

    def __init__(self, uri: str, part: int, file_records: int):
        self.fs, self.base = pa.fs.FileSystem.from_uri(uri)
        self.fs.create_dir(self.base, recursive=True)
        self.stem, self.most = f"part-{part:05d}-{uuid.uuid4().hex[:12]}", file_records
        self.done: list[tuple[str, int, int]] = []
        self.file = None

    def add(self, records: list[bytes]) -> None:
        """The records of one page; a file is closed between pages."""
        if self.file is None:
            self.name, self.n, self.size = f"{self.stem}-{len(self.done):04d}.warc.gz", 0, 0
            self.file = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None)
            self._write(_info(self.name))
        for r in records:
            self._write(r)
        self.n += len(records)
        if self.n >= self.most:
            self.close()

    def _write(self, record: bytes) -> None:
        member = gzip.compress(record + CRLF + CRLF, 6, mtime=0)
        self.file.write(member)
        self.size += len(member)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.done.append((self.name, self.n, self.size))
            self.file = None


def _info(name: str) -> bytes:
    body = b"software: corpusloom" + CRLF + b"format: WARC File Format 1.1" + CRLF
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(f"file {name}")), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _header(fields, len(body)) + body


_MANIFEST = "name string, records long, bytes long"


def write(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> str:
    """Write a record for every page into compressed archives under ``path``; returns the path.

    Null payloads are empty, null addresses and ids are left out, other columns don't matter. Rows with the same id
    are told apart by a written row number; those with the same id and payload are all stored. An empty table gives no
    archive. The table ``_manifest`` beside the archives names those that count; what lost tasks have left is deleted.
    """
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    uri = _uri(path)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    source = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    source = source.select("*", F.octet_length("payload").cast("long").alias("bytes"), F.sha1(F.col("payload").cast("binary")).alias("sha"), F.monotonically_increasing_id().alias("row"))
    source = written(source, "pages", compression="zstd")
    again = written(revisits(source), "revisits").select(F.col("sha").alias("s"), F.col("bytes").alias("b"), "top")
    joined = lookup_join(source, again, (F.col("sha") == F.col("s")) & (F.col("bytes") == F.col("b")))
    refers = F.col("id") < F.col("top.id")
    joined = joined.select("id", "url", "payload", F.when(refers, F.col("top.id")).alias("refers_to"), "row", F.when(refers, F.col("top.row")).alias("refers_row"))

    def run(batches):
        from pyspark import TaskContext

        out = _Archives(uri, TaskContext.get().partitionId(), file_records)
        for batch in slices(batches, 200):
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                out.add(records(row[0], row[1], row[2].encode("utf-8", "surrogatepass"), row[3], segment_bytes, row[4], row[5]))
        out.close()
        if out.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out.done), (pa.string(), pa.int64(), pa.int64()))], ["name", "records", "bytes"])

    with small_batches(spark):
        joined.mapInArrow(run, _MANIFEST).write.parquet(f"{path}/_manifest")
    _sweep(spark, path)
    forget(source, again)
    return path


def _sweep(spark: SparkSession, path: str) -> None:
    """Delete archives that the manifest doesn't name."""
    uri, manifest = _uri(path), spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")
    if manifest.isEmpty():
        return
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"))

    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs.delete_file(f"{base}/{name}")
            yield batch

    there.join(manifest.select("name"), "name", "left_anti").mapInArrow(run, "name string").count()


def _uri(path: str) -> str:
    return path if "://" in path else "file://" + path.removeprefix("file:")


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of an archive, one at a time."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("record cut short")
        yield fields, block


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """(name) of the archives to read: those of the manifest, or all files of a folder without one."""
    if exists(spark, f"{path}/_manifest"):
        named = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest").select("name")
        return named.repartition(max(1, min(named.count(), 20_000)))
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"))


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path``, each parsed once; ``data`` is the block of a segment, and the payload of a
    whole response (null for revisits). Memory is that of a few records."""
    uri = _uri(path)
    schema = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("refers_to", pa.string()), ("digest", pa.string()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("data", pa.binary())])
    whole = lambda x: int(x) if x is not None else None

    def row(f: dict[str, str], block: bytes) -> tuple:
        segment = whole(f.get("warc-segment-number"))
        data = block if segment is not None else None if f["warc-type"] == "revisit" else payload_of(block)
        return f.get("warc-record-id"), f["warc-type"], whole(f.get("x-page-id")), f.get("warc-target-uri"), f.get("warc-refers-to"), f.get("warc-payload-digest"), f.get("warc-segment-origin-id") or f.get("warc-record-id"), segment, whole(f.get("warc-segment-total-length")), data

    def run(batches):
        fs, base = pa.fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw as stream:
                    for f, block in parse(stream):
                        if f["warc-type"] not in ("response", "revisit", "continuation", "resource"):
                            continue
                        rows.append(row(f, block))
                        size += len(block)
                        if size > 8 << 20 or len(rows) >= 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return _archives(spark, path).mapInArrow(run, "record_id string, type string, page_id long, uri string, refers_to string, digest string, origin string, segment int, total long, data binary")


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block, without chunk framing where it has it."""
    head, _, body = block.partition(CRLF + CRLF)
    if head.startswith(b"HTTP/") and b"transfer-encoding: chunked" in head.lower():
        return dechunked(body)
    return body


def _joined(rows: DataFrame) -> DataFrame:
    """(record_id, page_id, uri, refers_to, digest, type, payload) from rows with ``blocks`` in order and ``total``."""

    def run(batches):
        for batch in slices(batches, 50):
            out = []
            *names, blocks, total, kind = (c.to_pylist() for c in batch.columns)
            for parts, length, what in zip(blocks, total, kind):
                block = b"".join(parts)
                if length is not None and len(block) != length:
                    raise ValueError(f"segments hold {len(block)} of {length} bytes")
                out.append(None if what == "revisit" else payload_of(block))
            arrays = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(len(names) + 2), pa.array(out, pa.binary())], ["record_id", "page_id", "uri", "refers_to", "digest", "type", "payload"])

    return rows.select("record_id", "page_id", "uri", "refers_to", "digest", "blocks", "total", "type").mapInArrow(run, "record_id string, page_id long, uri string, refers_to string, digest string, type string, payload binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All responses and revisits of the archives under ``path``, segments put together.

    Columns: record_id, page_id, uri, refers_to (record id), digest, type, payload (null for revisits). Fails where a
    segment is missing, repeated with other bytes, or the total length is wrong. No archive gives no row. Archives are
    read once, into a written table from which whole records and segments go their ways.
    """
    found = written(_scan(spark, path), "records", compression="zstd")
    single = found.filter("segment is null").select("record_id", "page_id", "uri", "refers_to", "digest", "type", F.col("data").alias("payload"))
    cut = found.filter("segment is not null").groupBy("origin").agg(
        *[F.max(c).alias(c) for c in ("page_id", "uri", "refers_to", "digest", "total")],
        F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("type"),
        F.array_sort(F.array_distinct(F.collect_list(F.struct("segment", F.col("data").alias("block"))))).alias("segments"),
    )
    ordered = F.forall(F.transform("segments", lambda s, i: s.getField("segment") == i + 1), lambda x: x)
    good = F.when(ordered & F.col("type").isNotNull() & F.col("total").isNotNull(), F.transform("segments", lambda s: s.getField("block"))).otherwise(F.raise_error(F.concat(F.lit("segments missing of "), F.col("origin"))))
    return single.unionByName(_joined(cut.select(F.col("origin").alias("record_id"), "type", "page_id", "uri", "refers_to", "digest", "total", good.alias("blocks"))))


def resolve(read_back: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits resolved through the response they name.

    A revisit whose response isn't there has nulls. A response that very many revisits name is broadcast to them. An
    empty table gives an empty table.
    """
    light = read_back.select("record_id", "page_id", "type", "refers_to", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha"))
    light = written(light, "light")
    stored, back = light.filter("type <> 'revisit'"), light.filter("type = 'revisit'")
    named = back.groupBy(F.col("refers_to").alias("r")).agg(F.count("*").alias("n"))
    response = stored.select("record_id", F.col("page_id").alias("response_page"), F.col("bytes").alias("response_bytes"), F.col("sha").alias("response_sha")).dropDuplicates(["record_id"])
    named = written(named.join(response, F.col("r") == F.col("record_id"), "left").drop("record_id"), "named")
    joined = spread(back, named, "refers_to", "r", "n")
    return stored.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("sha").alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        joined.select("page_id", F.col("response_bytes").alias("payload_bytes"), F.col("response_sha").alias("payload_digest"), F.lit("revisit").alias("record_type"), F.col("response_page").alias("refers_to"))
    )
