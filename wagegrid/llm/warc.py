"""WARC archives: write with an index, then read selected records by byte range.

``write_archives`` puts one record per page into compressed WARC files (one
gzip member a record) and returns the index, a table written beside them:
``file, offset, length, url, digest, page_id, record_type, refers_to``.
``read_records`` sorts the selected index rows by place, joins neighbouring
byte ranges into single reads and parses the records.

Of pages with equal payloads of at least ``min_revisit`` bytes the one with the
largest page id is a ``response``; the others are ``revisit`` records without a
payload that refer to it. Smaller payloads are always responses.

Defined cases: a null payload is empty, a null URL is written as an empty one.
A page with a null id is always a response and nothing refers to it. Rows that
repeat the largest id are all responses. Empty tables give no files and no rows.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from base64 import b32decode, b32encode
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import store

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

INDEX_SCHEMA = ("file string, offset bigint, length bigint, url string, digest string, "
                "page_id bigint, record_type string, refers_to bigint")
SALTS = 16
ROWS = 512  # records taken or given at a time
GZIP_LEVEL = 1
TASK_BYTES = 16 << 20  # compressed records read by one task


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str | None) -> int | None:
    text = (uri or "")[len("<urn:page:"):-1]
    return int(text) if text else None


def encode_record(page_id: int | None, url: str, payload: bytes, digest: str,
                  size: int, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member. A revisit's block is the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {size}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    sha1 = b32encode(bytes.fromhex(digest)).decode()
    odd = any(c <= " " or c == "\x7f" for c in url)  # would break the head's lines
    fields = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}",
              f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {DATE}",
              f"WARC-Target-URI: {quote(url) if odd else url}",
              f"WARC-Payload-Digest: sha1:{sha1}"]
    if odd:
        fields.append("X-Target-URI-Encoding: percent")
    if revisit:
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}",
                   "WARC-Truncated: length"]
    fields += ["Content-Type: application/http; msgtype=response",
               f"Content-Length: {len(block)}"]
    text = "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(text) + packer.flush()


def decode_record(member: bytes) -> dict:
    """The fields of one record: type, page, URL, payload, size, digest, refers_to."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0]!r}")
    field = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                 for line in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(v) for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
                if k == "Content-Length")
    digest = b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = field["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its head")
    url = field["WARC-Target-URI"]
    url = unquote(url) if "X-Target-URI-Encoding" in field else url
    return {"page_id": _page(field["WARC-Record-ID"]), "url": url,
            "record_type": kind, "payload": payload, "payload_bytes": size,
            "payload_digest": digest, "refers_to": _page(field.get("WARC-Refers-To"))}


def _with_types(pages: DataFrame, min_revisit: int) -> DataFrame:
    """Pages with digest, size and, for payloads met again, the response's id."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    # Equal payloads: one row per digest, summed up before the shuffle. Only
    # those met twice are kept, as a stored table whose size Spark knows.
    again = store(rows.where(F.col("size") >= min_revisit).select("digest", "size", "page_id")
                  .groupBy("digest", "size")
                  .agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1 and first is not null").drop("n"), "warc-equal")
    # A payload with very many copies is spread over SALTS keys.
    salted = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keyed = rows.withColumn("salt", F.coalesce(F.pmod(F.col("page_id"), F.lit(SALTS)), F.lit(0))
                            .cast("int"))
    return keyed.join(salted, ["digest", "size", "salt"], "left").drop("salt")


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 1000) -> DataFrame:
    """Write the archives below ``folder``; returns their index.

    Every task attempt writes a file of its own name, and the index holds what
    the committed attempts wrote, so lost executors and repeated tasks leave at
    worst a file that no index row names.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = path = out = None
        offset = 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                rows = whole.slice(at, ROWS).to_pydict()
                if out is None:
                    fs, base = FileSystem.from_uri(folder)
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(path, compression=None)
                found = []
                for page, url, body, digest, size, first in zip(
                        rows["page_id"], rows["url"], rows["payload"], rows["digest"],
                        rows["size"], rows["first"]):
                    revisit = first is not None and page is not None and page != first
                    data = encode_record(page, url, body, digest, size, first, revisit)
                    out.write(data)
                    found.append((path, offset, len(data), url, digest, page,
                                  "revisit" if revisit else "response",
                                  first if revisit else None))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found), (
                        pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(),
                        pa.int64(), pa.string(), pa.int64()))],
                    names=[c.split()[0] for c in INDEX_SCHEMA.split(", ")])
        if out is not None:
            out.close()

    rows = _with_types(pages, min_revisit).select(
        "page_id", "url", "payload", "digest", "size", "first")
    return store(rows.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def coalesced(rows: list[tuple], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple]]]:
    """Join neighbouring ranges ``(file, offset, length, ...)``, sorted by place,
    into reads of at most ``most`` bytes over gaps of at most ``gap``."""
    held: list[tuple] = []
    for row in rows:
        if held and (row[0] != held[0][0] or row[1] > held[-1][1] + held[-1][2] + gap
                     or row[1] + row[2] > held[0][1] + most):
            yield held[0][0], held[0][1], max(r[1] + r[2] for r in held) - held[0][1], held
            held = []
        held.append(row)
    if held:
        yield held[0][0], held[0][1], max(r[1] + r[2] for r in held) - held[0][1], held


def read_records(index: DataFrame, folder: str, gap: int = 65536,
                 most: int = 4 << 20) -> DataFrame:
    """Read the records that ``index`` names, by coalesced byte ranges.

    Returns ``page_id, url, record_type, payload, payload_bytes,
    payload_digest, refers_to``. Ranges are dealt out by place, so that a task
    reads neighbouring records. Digest and size of every payload are verified.
    """
    schema = ("page_id bigint, url string, record_type string, payload binary, "
              "payload_bytes bigint, payload_digest string, refers_to bigint")
    names = [c.split()[0] for c in schema.split(", ")]
    types = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(),
             pa.int64())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = None
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("file", "offset", "length")]
            for file, start, size, rows in coalesced(list(zip(*cols)), gap, most):
                fs = fs or FileSystem.from_uri(folder)[0]
                with fs.open_input_file(file) as source:
                    data = source.read_at(size, start)
                found = [decode_record(data[o - start:o - start + n]) for _, o, n in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in found], t) for c, t in zip(names, types)],
                    names=names)

    # Index rows are small, what they name is not: tasks by the bytes to read.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    placed = (index.select("file", "offset", "length")
              .repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset"))
    return placed.mapInArrow(read, schema)
