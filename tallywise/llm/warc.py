"""WARC archives: write with revisit records, read by byte ranges (operator 10)."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.operators.skew import attach_totals

MAGIC = b"\x1f\x8b\x08"
#: A gzip member without content. It stands between two records, as the text sink needs a separator.
EMPTY = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAX_TASKS = 1 << 16  # that read ranges
RANGE = 8 << 20
READ = 256 << 10


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for page, url, payload, digest, first in zip(*(batch[c].to_pylist() for c in ("id", "url", "payload", "digest", "first")), strict=True):
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
            block = http + payload if first is None else http
            address = (url or "").replace("\r", "%0D").replace("\n", "%0A")
            lines = [
                "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
                f"WARC-Target-URI: {address}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
                "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            ]
            if first is not None:
                lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{first}>"]
            out.append(_member("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"))
        yield pa.record_batch([pa.array(out, pa.binary())], ["record"])


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100) -> None:
    """Write a gzipped WARC record for each row to files in ``path``, which must not exist.

    Of equal payloads of ``least`` bytes or more, that with the smallest id is a response and the
    others are revisit records, which carry the HTTP header (with the payload's length) and no
    payload. Rows that tie for the smallest id, rows of a group whose ids are all null, and
    rows with a null id outside such a group's revisits refer as any other; a null html is empty. Other
    columns are ignored. Files are concatenated gzip members, a record each, with an empty member between.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    ids = rows.filter(F.octet_length("payload") >= least).select("id", "digest")
    firsts = ids.groupBy("digest").agg(F.count("*").alias("copies"), F.min("id").alias("first")).filter("copies > 1")
    refs = attach_totals(ids, firsts, "digest", "copies").filter(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull())
    refs = refs.select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "first").distinct()
    same = F.col("id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rdigest"))
    joined = rows.join(refs, same, "left").select("id", "url", "payload", "digest", "first")
    records = joined.mapInArrow(_records, "record binary").select(F.col("record").cast("string").alias("value"))
    # The separator's bytes are one character each in this encoding; the records' bytes go out as they are.
    records.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("compression", "none").text(path)


START = b"WARC/1."


def _decode(file, at: int, path: str) -> tuple[bytes, int] | None:
    """The gzip member at a place and where it ends, or None if there is no WARC record. A member that
    begins as a WARC record and can't be read to its end raises."""
    unpack, out, pos = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            file.seek(pos)
            data = file.read(READ if out else 4096)
            if not out and zlib.decompressobj(31).decompress(data, len(START)) != START:
                return None
            if not data:
                raise ValueError(f"the record at byte {at} of {path} is cut off")
            pos += len(data)
            out.append(unpack.decompress(data))
    except zlib.error as error:
        if not out and not _starts(file, at):
            return None
        raise ValueError(f"the record at byte {at} of {path} does not decode: {error}") from error
    return b"".join(out), pos - len(unpack.unused_data)


def _starts(file, at: int) -> bool:
    """Whether the gzip member at a place begins as a WARC record does, as far as it decodes."""
    file.seek(at)
    try:
        return zlib.decompressobj(31).decompress(file.read(4096), len(START)) == START
    except zlib.error:
        return False


def _parse(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    block = rest[: int(fields["content-length"])]
    # Only these have an HTTP header; of all others the whole block is the payload.
    is_http = fields.get("content-type", "").lower().startswith("application/http")
    http, _, payload = block.partition(b"\r\n\r\n") if is_http else (b"", b"", block)
    kind = fields["warc-type"]
    sizes = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    size = sizes[0] if sizes else None if kind == "revisit" else len(payload)
    urn = lambda name: fields[name][len("<urn:page:") : -1] or None if name in fields else None
    stated = fields.get("warc-payload-digest")
    digest = stated and stated.removeprefix("sha256:")
    # Only SHA-256 can be compared: other archives state other digests, or none.
    wrong = stated is not None and stated.startswith("sha256:") and hashlib.sha256(payload).hexdigest() != digest
    if kind == "response" and (len(payload) != size or wrong):
        raise ValueError(f"the payload of record {fields['warc-record-id']} does not fit its digest")
    return urn("warc-record-id"), fields.get("warc-target-uri"), kind, urn("warc-refers-to"), size, digest, payload if kind != "revisit" else None


COLUMNS = ["page", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for path, start, length in zip(*(batch[c].to_pylist() for c in ("path", "start", "length")), strict=True):
            store, name = fs.FileSystem.from_uri(path)
            end, pos, rows, held = min(start + RANGE, length), start, [], 0
            with store.open_input_file(name) as file:
                while pos < end:
                    file.seek(pos)
                    data = file.read(READ + len(MAGIC) - 1)
                    found = data.find(MAGIC)
                    if found < 0:
                        pos += READ
                        continue
                    pos += found
                    record = _decode(file, pos, path) if pos < end else None
                    if record is None:
                        pos += 1
                        continue
                    rows.append(_parse(record[0]))
                    held, pos = held + len(record[0]), record[1]
                    if held > 4 << 20:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], COLUMNS)
                        rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], COLUMNS)


def read_warc(spark: SparkSession, path: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """(page, url, record_type, refers_to, payload_bytes, payload_digest, payload) of the records in
    the files of ``path``; revisits have no payload. A response whose payload does not fit its digest raises, and
    so does a record that is cut off or does not decode, with its file and place. Records of types without
    an HTTP header have their whole block as payload.

    Files are cut into ranges of RANGE bytes. A task looks for gzip's magic in its range, decodes the
    start of each candidate, takes those that begin as a WARC record does, and reads them to their
    end, also beyond the range. So each record belongs to the range it starts in. The files must be in
    a store that Arrow can open.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(RANGE))).alias("start"))
    # A given number of partitions stays one; rows of a few bytes would else all be put into one task.
    ranges = ranges.repartition(max(min(ranges.count(), MAX_TASKS), 1), "path", "start")
    schema = "page string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    return ranges.select("path", F.col("start").cast("long"), "length").mapInArrow(_read, schema)
