"""WARC archives: writing with payload deduplication, and a salvaging reader (operator 2).

Archives are gzip files with one member per record, written by the tasks to
the shared folder.  A task reports a file only when it is complete and the list
of files is a written table, so what a lost or repeated task left is not read.

The reader checks each record: gzip checksum, version line, headers, length,
record end and digests (hexadecimal or base32).  Where a check fails it searches the bytes behind
for the next gzip member or version line that starts a valid record, goes on
from there, and reports the bytes between as a quarantined gap with its reason.
"""

from __future__ import annotations

import base64
import hashlib
import io
import logging
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from nextbuy.llm.ship import ship
from nextbuy.session import materialize, scratch_path

#: Payloads of fewer bytes are always stored.
LEAST_SHARED = 100
#: A task begins a new archive beyond this size.
ARCHIVE_BYTES = 64 << 20
#: Unpacked bytes of a gzip member beyond which it is quarantined; one record, or a whole file, is held in memory.
LARGEST_MEMBER = 256 << 20
_START = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.\d+\r\n")
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One uncompressed record; a revisit (``refers_to`` given) carries the length and digest, not the payload."""
    block = _HTTP if refers_to is not None else _HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@dataclass
class Found:
    """A record, or a quarantined gap if ``reason`` is given."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] | None = None
    payload: bytes | None = None


class Damaged(Exception):
    """A check failed."""


def _headers(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/[01]\.\d+", lines[0]):
        raise Damaged("version line")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not out.get("content-length", "").isdigit():
        raise Damaged("content length")
    return out


class Several(Exception):
    """A gzip member holds more than one record; args: its bytes, its packed length."""


class _Memory(io.BytesIO):
    def size(self) -> int:
        return len(self.getbuffer())


def digest_fits(value: str, data: bytes) -> bool | None:
    """Whether a digest field (``algorithm:digest``, hexadecimal or base32, any case) fits the data; None if its algorithm or form is unknown."""
    kind, _, told = value.partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in ("sha1", "sha256", "sha512", "md5"):
        return None
    real = hashlib.new(kind, data).digest()
    if re.fullmatch("[0-9a-fA-F]+", told) and len(told) == 2 * len(real):
        return told.lower() == real.hex()
    packed = base64.b32encode(real).decode().rstrip("=")
    if re.fullmatch("[A-Za-z2-7]+=*", told) and len(told.rstrip("=")) == len(packed):
        return told.upper().rstrip("=") == packed
    return None


def _checked(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of a block, checked by the block's digest or, without one, by the payload's, which a revisit does not hold."""
    whole = digest_fits(headers.get("warc-block-digest", ""), block)
    if whole is False:
        raise Damaged("block digest")
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    if whole is None and headers.get("warc-type") != "revisit" and digest_fits(headers.get("warc-payload-digest", ""), payload) is False:
        raise Damaged("payload digest")
    return payload


def _member_at(source, offset: int) -> Found:
    source.seek(offset)
    unpacker, parts, used, held = zlib.decompressobj(31), [], 0, 0
    while not unpacker.eof:
        chunk = source.read(1 << 16)
        if not chunk:
            raise Damaged("truncated member")
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error as e:
            raise Damaged("gzip member") from e
        used += len(chunk)
        held += len(parts[-1])
        if held > LARGEST_MEMBER:
            raise Damaged("member too large")
    record = b"".join(parts)
    head, end, rest = record.partition(b"\r\n\r\n")
    if not end:
        raise Damaged("header end")
    headers = _headers(head)
    n = int(headers["content-length"])
    if rest[n:n + 4] == b"\r\n\r\n" and rest[n + 4:n + 9] == b"WARC/":
        raise Several(record, used - len(unpacker.unused_data))
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise Damaged("record length")
    return Found(offset, used - len(unpacker.unused_data), None, headers, _checked(headers, rest[:n]))


def _plain_at(source, offset: int) -> Found:
    source.seek(offset)
    head = b""
    while b"\r\n\r\n" not in head:
        chunk = source.read(1 << 13)
        if not chunk or len(head) > 1 << 20:
            raise Damaged("header end")
        head += chunk
    head = head.partition(b"\r\n\r\n")[0]
    headers = _headers(head)
    n = int(headers["content-length"])
    if offset + len(head) + n + 8 > source.size():
        raise Damaged("truncated record")
    source.seek(offset + len(head) + 4)
    rest = source.read(n + 4)
    if rest[n:] != b"\r\n\r\n":
        raise Damaged("record length")
    return Found(offset, len(head) + 8 + n, None, headers, _checked(headers, rest[:n]))


def _next_start(source, offset: int) -> int:
    """Place of the next gzip magic or version line from ``offset`` on; the file's end if none."""
    keep = 16
    source.seek(offset)
    tail, at = b"", offset
    while chunk := source.read(1 << 18):
        window = tail + chunk
        if m := _START.search(window):
            return at - len(tail) + m.start()
        tail, at = window[-keep:], at + len(chunk)
    return source.size()


def salvage(source) -> Iterator[Found]:
    """Records and gaps of an archive (a seekable file with ``size()``), in order; they cover every byte.

    A file, or part of one, that was gzipped as a whole is salvaged within: its
    records and gaps have the member's place, the first of them its length.
    """
    offset, gap, reason, size = 0, None, "", source.size()
    while offset < size:
        source.seek(offset)
        magic = source.read(3)
        try:
            found = _member_at(source, offset) if magic == b"\x1f\x8b\x08" else _plain_at(source, offset) if magic == b"WAR" else None
            if found is None:
                raise Damaged("no record start")
            several, length = [found], found.length
        except Several as e:
            several, length = [Found(offset, 0, x.reason, x.headers, x.payload) for x in salvage(_Memory(e.args[0]))], e.args[1]
            several[0].length = length
        except Damaged as e:
            if gap is None:
                gap, reason = offset, str(e)
            offset = _next_start(source, offset + 1)
            continue
        if gap is not None:
            yield Found(gap, offset - gap, reason)
            gap = None
        yield from several
        offset += length
    if gap is not None:
        yield Found(gap, size - gap, reason)


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, size, refers_to: which rows become revisits, and of which page.

    Null html is the empty payload.  Of equal payloads of ``LEAST_SHARED``
    bytes or more every row with the smallest page_id is a response, the others
    revisit it; without any page_id all are responses.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html").cast("long"))
    first = rows.filter(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).filter(
        "rows > 1 and first is not null").select("digest", "first")
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", "size", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI of the file system that Hadoop would take it from (a path without a scheme lies on the cluster's default one),
    in the spelling that Arrow reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    if scheme not in ("hdfs", "viewfs", "s3a", "s3n", "s3", "gs", "abfs", "abfss"):
        raise ValueError(f"archives cannot be written through the file system of {uri}")
    return {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes archives of ``pages`` (page_id, url, html) and returns the written list: file, records, bytes."""
    ship(pages.sparkSession)
    uri = qualified(pages.sparkSession, folder or scratch_path(pages.sparkSession, f"op2-archives-{uuid.uuid4().hex}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(uri)
        system.create_dir(root, recursive=True)
        out, name, records, size = None, "", 0, 0
        done = []
        for batch in batches:
            for page_id, url, html, digest, n, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                data = member(encode_record(page_id, url, html.encode(), digest, n, refers_to))
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{uri}/{name}", records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{uri}/{name}", records, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["file", "records", "bytes"])

    return materialize(plan_records(pages).mapInArrow(run, "file string, records long, bytes long"), "op2-files")


def read_archives(files: DataFrame) -> DataFrame:
    """Every record and gap of the archives in ``files`` (file: a URI), checked and salvaged.

    file, offset, length, reason (null: a record), headers, payload.  An archive
    is one task's work, a record at a time.
    """
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = fs.FileSystem.from_uri(name)
                with system.open_input_file(path) as source:
                    rows, held = [], 0
                    for x in salvage(source):
                        rows.append((name, x.offset, x.length, x.reason, list((x.headers or {}).items()), x.payload))
                        held += len(x.payload or b"")
                        if held > 8 << 20 or len(rows) >= 2000:
                            yield _rows(rows)
                            rows, held = [], 0
                    yield _rows(rows)

    schema = "file string, offset long, length long, reason string, headers map<string,string>, payload binary"
    # rows of names are small, so adaptive execution would merge them into one task; a given number of partitions stays
    return files.select("file").repartition(max(files.count(), 1)).mapInArrow(run, schema)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      names=["file", "offset", "length", "reason", "headers", "payload"])


def inspected(records: DataFrame) -> DataFrame:
    """What ``read_archives`` found, payloads as length and digest, written once: file, offset, length, reason, headers, payload_bytes, payload_digest."""
    return materialize(records.select("file", "offset", "length", "reason", "headers", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                      F.sha2("payload", 256).alias("payload_digest")), "op2-records")


def gaps(records: DataFrame) -> DataFrame:
    """file, offset, length, reason of the quarantined byte ranges among what ``read_archives`` or ``inspected`` gives."""
    return records.filter("reason is not null").select("file", "offset", "length", "reason")


def log_gaps(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the gap table (to the shared folder if none is named), logs its size and returns it."""
    spark = records.sparkSession
    path = folder or scratch_path(spark, f"op2-gaps-{uuid.uuid4().hex}")
    gaps(records).write.mode("overwrite").parquet(path)
    table = spark.read.schema("file string, offset long, length long, reason string").parquet(path)
    found = table.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    logging.getLogger(__name__).log(logging.WARNING if found["n"] else logging.INFO, "%d gaps of %d bytes quarantined in %s", found["n"], found["b"], path)
    return table


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record that ``read_archives`` or ``inspected`` gives.

    A response's length and digest are taken from the payload read, a revisit's
    from the response that it names; where that one was lost, from its own headers.
    """
    if "payload" in records.columns:
        records = records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn("payload_digest", F.sha2("payload", 256))
    h = lambda name: F.col("headers")[name]
    pages = records.filter("reason is null").select(
        h("x-page-id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", h("x-payload-length").cast("long").alias("told_bytes"),
        F.substring_index(h("warc-payload-digest"), ":", -1).alias("told_digest"), h("warc-type").alias("record_type"), h("x-refers-to-page").cast("long").alias("refers_to"))
    named = pages.filter("record_type = 'response' and page_id is not null").groupBy("page_id").agg(
        F.min(F.struct("payload_digest", "payload_bytes")).alias("held")).withColumnRenamed("page_id", "named_id")
    found = pages.join(named, F.col("refers_to") == F.col("named_id"), "left")
    stored = F.col("record_type") == "response"
    return found.select(
        "page_id", F.when(stored, F.col("payload_bytes")).otherwise(F.coalesce("held.payload_bytes", "told_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("payload_digest")).otherwise(F.coalesce("held.payload_digest", "told_digest")).alias("payload_digest"), "record_type", "refers_to")
