"""WARC archives: one gzip member for each record, written with revisits, read in sequence.

An archive is a row of a table, ``(archive, content)``, whose ``content`` is a
whole ``.warc.gz`` file of bounded size; ``export`` writes one out. Archives go
through Spark's committed writer, which any shared store takes and which a lost
executor cannot leave half done.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import sized_join
from ..session import scratch_path
from . import words as W

ARCHIVE_BYTES = 8 << 20  # compressed; a new archive begins beyond
LEAST_REVISIT = 1000  # bytes of payload
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
_READ = 1 << 16


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{key}')}>"


def _line(value: object) -> str:
    """A header value: no line break may enter it."""
    return " ".join(str(value).split())


def write_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: the record of a page, in full or as a revisit of page ``refers_to``."""
    payload_digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url or "")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", payload_digest),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Length", len(block)),
        ("X-Payload-Length", len(payload)),
    ]
    if key is not None:
        fields.append(("X-Page-ID", key))
    if refers_to is not None:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", refers_to),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def members(chunks: Iterable[bytes]) -> Iterator[Iterator[bytes]]:
    """The decompressed pieces of each gzip member of a stream, one member after the other."""
    feed = iter(chunks)
    data = b""

    def one() -> Iterator[bytes]:
        nonlocal data
        machine = zlib.decompressobj(31)
        while not machine.eof:
            if not data:
                data = next(feed, b"")
                if not data:
                    raise ValueError("the archive ends inside a record")
            # A bounded piece at a time, whatever the member expands to.
            part = machine.decompress(data, _READ)
            data = machine.unused_data if machine.eof else machine.unconsumed_tail
            if part:
                yield part

    while True:
        while not data:
            data = next(feed, None)
            if data is None:
                return
        piece = one()
        yield piece
        for _ in piece:  # what the caller has not read
            pass


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """``(headers, block)`` of a member, framed by its content length; both digests are verified."""
    buffer = b""
    while b"\r\n\r\n" not in buffer:
        part = next(pieces, None)
        if part is None:
            raise ValueError("a record without the end of its head")
        buffer += part
    head, _, rest = buffer.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    length = int(fields["Content-Length"])
    parts, have = [rest], len(rest)
    for part in pieces:
        parts.append(part)
        have += len(part)
    body = b"".join(parts)
    if have != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is not its content length")
    block = body[:length]
    if _digest(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if _digest(payload) != fields["WARC-Payload-Digest"] or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    return fields, block


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str | None = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Writes a record for each row of ``pages`` into archives under ``path``.

    Of the rows with equal payloads of ``LEAST_REVISIT`` bytes or more, that with
    the largest id is written in full and the others as revisits of it. A null
    html is an empty payload. A row with a null id is never the one referred to
    if another has an id; if none has, all are written in full, and so are
    repeated rows of the largest id.

    Payloads are told apart by SHA-256; only digests that occur twice are joined
    back, so the html itself is never shuffled.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = W.bounded(pages).select(
        F.col(id_col).alias("__id"),
        (F.col(url_col) if url_col else F.lit("")).cast("string").alias("__url"),
        payload.alias("__html"),
        F.when(F.octet_length(payload) >= LEAST_REVISIT, F.sha2(payload, 256)).alias("__digest"),
    )
    kept = (
        rows.where("__digest IS NOT NULL")
        .groupBy("__digest")
        .agg(F.max("__id").alias("__target"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1 AND __target IS NOT NULL")
        .checkpoint()
    )
    joined = sized_join(rows, kept, kept.count() * 128, "__digest", "__n", ["__id"], "left")
    refers_to = F.when(~F.col("__id").eqNullSafe(F.col("__target")), F.col("__target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, members_, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, members_, size
            name = f"pages-{part:06d}-{number:05d}.warc.gz"
            row = [pa.array([name]), pa.array([b"".join(members_)], pa.binary())]
            number, members_, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(row, ["archive", "content"])

        for rows_ in W.slices(batches, 2):
            keys, urls, refers = (rows_.column(i).to_pylist() for i in (0, 1, 3))
            for key, url, html, target in zip(keys, urls, W.texts_of(rows_.column(2)), refers, strict=True):
                members_.append(write_record(key, url, html, target))
                size += len(members_[-1])
                if size >= archive_bytes:
                    yield flush()
        if members_:
            yield flush()

    (
        joined.select("__id", "__url", "__html", refers_to.alias("__refers_to"))
        .mapInArrow(run, "archive string, content binary")
        .write.option("compression", "none")
        .parquet(path)
    )


def read_archives(archives: DataFrame, id_col: str = "page_id", keep: bool = False) -> DataFrame:
    """``(id, payload_bytes, payload_digest, record_type, refers_to)`` of each record.

    Length and digest of a revisit are those of the full payload. ``keep`` adds
    the record's url and the html of responses (null for revisits).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                view = memoryview(content.as_buffer())
                chunks = (bytes(view[i : i + _READ]) for i in range(0, len(view), _READ))
                rows, held = [], 0
                for pieces in members(chunks):
                    fields, block = read_record(pieces)
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    row = [
                        _number(fields.get("X-Page-ID")), int(fields["X-Payload-Length"]), digest, fields["WARC-Type"],
                        _number(fields.get("X-Refers-To-Page-ID")),
                    ]
                    if keep:
                        full = fields["WARC-Type"] == "response"
                        row += [fields["WARC-Target-URI"], block.partition(b"\r\n\r\n")[2].decode() if full else None]
                        held += len(block)
                    rows.append(row)
                    if held > W.SLICE_BYTES:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    def table(rows: list[list]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names = [id_col, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    if keep:
        names, kinds = [*names, "url", "html"], [*kinds, pa.string(), pa.string()]
    spark_kinds = {pa.int64(): "long", pa.string(): "string"}
    schema = T.StructType()
    for name, kind in zip(names, kinds, strict=True):
        schema.add(name, spark_kinds[kind])
    return archives.select("content").mapInArrow(run, schema)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def export(archives: DataFrame, archive: str, path: str) -> None:
    """Writes one archive as a file of the driver's machine."""
    with open(path, "wb") as f:
        for row in archives.where(F.col("archive") == archive).select("content").toLocalIterator():
            f.write(row.content)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str | None = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    return read_archives(spark.read.parquet(path), id_col)
