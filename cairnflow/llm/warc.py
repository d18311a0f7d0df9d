"""WARC archives: one gzip member per record, written and read back sequentially.

An archive is held as rows (archive, chunk, data): the chunks in order are the bytes of one ``.warc.gz``
file. That form goes through Spark's own writers, so it works in any store Spark can reach;
:func:`export_files` writes real files where a folder is mounted everywhere. Archives of others come in through
:func:`archive_files` (any store, a file at a time in memory) or :func:`mounted_records` (files that every
executor can open, read in pieces); any record type, record id and set of digests is read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import require, weighted_join, written

CHUNK = 1 << 20
_NAME = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+")


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member. Line breaks in a header value become spaces."""
    lines = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in headers)
    raw = b"WARC/1.1\r\n" + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _urn(page_id: int) -> str:
    return f"<urn:x-page:{page_id}>"


def page_record(page_id: int, url: str | None, html: str | None, payload_digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit of the record that has it."""
    payload = (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(refers_to))]
    return record(headers, block)


class DamagedArchive(ValueError):
    """The bytes are not a whole sequence of records with right digests."""


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a stream, one after the other; inflates as chunks arrive."""
    unpack, parts = None, []
    for data in chunks:
        while data:
            unpack = unpack or zlib.decompressobj(31)
            try:
                parts.append(unpack.decompress(data))
            except zlib.error as e:
                raise DamagedArchive(f"gzip: {e}") from e
            data = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = None, []
    if unpack is not None:
        raise DamagedArchive("the archive ends inside a record")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record, framed by Content-Length."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or not version.startswith(b"WARC/1."):
        raise DamagedArchive(f"no record begins with {raw[:20]!r}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.fullmatch(name):
            raise DamagedArchive(f"bad header line {line[:80]!r}")
        headers[name.decode().lower()] = value.decode().strip()
    if not headers.get("content-length", "").isdigit():
        raise DamagedArchive("no Content-Length")
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise DamagedArchive("the block does not end where Content-Length says")
    return headers, rest[:size]


#: Digest algorithms that are verified; others are left as they are.
_HASHES = ("sha1", "sha256", "sha512", "md5")


def _agrees(label: str, data: bytes) -> bool:
    """Whether a labelled digest (base32 or hexadecimal, any case) is that of ``data``; an unknown algorithm agrees."""
    kind, _, want = label.strip().partition(":")
    kind = kind.lower().replace("-", "")
    if kind not in _HASHES:
        return True
    have = hashlib.new(kind, data, usedforsecurity=False)
    return want.lower() == have.hexdigest() or want.upper().rstrip("=") == base64.b32encode(have.digest()).decode().rstrip("=")


def _page_of(uri: str | None) -> int | None:
    """The page_id in a record id of this module's making."""
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def read_record(raw: bytes) -> dict:
    """A record of any type as a row, after the digests it gives have been verified.

    The payload of an HTTP message is what follows its header, of other records the block. A revisit has none of
    its own: payload_bytes is the length its HTTP header tells, payload_digest the one it gives. page_id and
    refers_to are null unless the ids are of this module's making; record_id and refers_to_id always have them as
    written. Where no payload digest is given, it is computed (SHA-1), but for a revisit.
    """
    headers, block = parse(raw)
    name, kind = headers.get("warc-record-id"), headers.get("warc-type", "")
    if "warc-block-digest" in headers and not _agrees(headers["warc-block-digest"], block):
        raise DamagedArchive(f"block digest of {name}")
    http, payload = b"", block
    if headers.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    want = headers.get("warc-payload-digest")
    size = len(payload)
    if kind == "revisit":
        told = re.search(rb"(?im)^content-length:[ \t]*(\d+)", http)
        size = int(told[1]) if told else size
    elif want is not None and not _agrees(want, payload):
        raise DamagedArchive(f"payload digest of {name}")
    refers = headers.get("warc-refers-to")
    return {
        "page_id": _page_of(name),
        "url": headers.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": want.rpartition(":")[2] if want is not None else None if kind == "revisit" else digest(payload),
        "record_type": kind,
        "refers_to": _page_of(refers),
        "record_id": name,
        "refers_to_id": refers,
        "payload": None if kind == "revisit" else payload,
    }


def write_archives(pages: DataFrame, min_bytes: int = 0, archive_pages: int = 20_000) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) as a written table (archive, chunk, data).

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id becomes
    the response, the others revisit it. A null html is an empty payload, a null url leaves its header out,
    rows with a null page_id are left out (a record needs a name); repeated rows of one page_id are each
    written, as responses where theirs is the first. A chunk ends with a record.
    """
    pages = require(pages, ["page_id", "url", "html"], "write_archives").filter("page_id IS NOT NULL")
    raw_sha1 = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    size = F.octet_length(F.coalesce("html", F.lit("")))
    same = (
        pages.select("page_id", raw_sha1.alias("sha"), size.alias("size"))
        .filter(F.col("size") >= min_bytes)
        .groupBy("sha")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    # Only payloads that occur twice meet the pages again; few of them are broadcast, and no page is shuffled then.
    keyed = weighted_join(pages.withColumn("sha", raw_sha1), written(same, "payloads"), "sha", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, archive, chunk, have, held, n = TaskContext.get().partitionId(), 0, 0, [], 0, 0

        def out():
            return pa.RecordBatch.from_pylist([{"archive": f"{place:06d}-{archive:06d}", "chunk": chunk, "data": b"".join(have)}], schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    payload_digest = base64.b32encode(bytes.fromhex(r["sha"])).decode()
                    first = r["first"] is None or r["page_id"] == r["first"]
                    have.append(page_record(r["page_id"], r["url"], r["html"], payload_digest, None if first else r["first"]))
                    held, n = held + len(have[-1]), n + 1
                    if held >= CHUNK or n >= archive_pages:
                        yield out()
                        have, held, chunk = [], 0, chunk + 1
                    if n >= archive_pages:
                        archive, chunk, n = archive + 1, 0, 0
        if have:
            yield out()

    schema = pa.schema([("archive", pa.string()), ("chunk", pa.int32()), ("data", pa.binary())])
    return written(keyed.select("page_id", "url", "html", "sha", "first").mapInArrow(run, "archive string, chunk int, data binary"), "warc")


_FIELDS = (
    ("page_id", "long"), ("url", "string"), ("payload_bytes", "long"), ("payload_digest", "string"), ("record_type", "string"),
    ("refers_to", "long"), ("record_id", "string"), ("refers_to_id", "string"), ("payload", "binary"),
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(pieces: Iterable[bytes], fields: tuple) -> Iterator[pa.RecordBatch]:
    """Records of a stream as batches of bounded size."""
    schema = pa.schema([(n, _ARROW[k]) for n, k in fields])
    rows, held = [], 0
    for raw in members(pieces):
        row = read_record(raw)
        rows.append({n: row[n] for n, _ in fields})
        held += len(raw) if "payload" in schema.names else 0
        if len(rows) >= 5000 or held > 8 << 20:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the archives (a data column), digests verified; a damaged archive raises :class:`DamagedArchive`.

    Chunks end with a record, so each is read where it lies, from its first member to its last; nothing is
    shuffled, and a task never holds more than a record besides its batch. A null chunk has no records.
    """
    fields = _FIELDS if payloads else _FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rows((x.as_py() or b"" for batch in batches for x in batch.column(0)), fields)

    return archives.select("data").mapInArrow(run, ", ".join(map(" ".join, fields)))


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of any store as archives (archive, chunk, data), for :func:`read_archives`; a file is one chunk of at most 2 GB."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("archive"), F.lit(0).alias("chunk"), F.col("content").alias("data"))


def mounted_records(paths: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the files named in the column ``path``, which every executor can open; a file is read in pieces of 1 MB."""
    fields = _FIELDS if payloads else _FIELDS[:-1]

    def pieces(path: str) -> Iterator[bytes]:
        with open(path, "rb") as f:
            while data := f.read(CHUNK):
                yield data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0):
                yield from _rows(pieces(path.as_py()), fields)

    return paths.select("path").filter("path IS NOT NULL").mapInArrow(run, ", ".join(map(" ".join, fields)))


def export_files(archives: DataFrame, folder: str) -> DataFrame:
    """Write each archive as ``folder/<archive>.warc.gz`` (a folder that all executors mount); path and bytes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        path = os.path.join(folder, f"{pdf['archive'].iloc[0]}.warc.gz")
        data = b"".join(pdf.sort_values("chunk")["data"])
        with open(f"{path}.tmp", "wb") as f:
            f.write(data)
        os.replace(f"{path}.tmp", path)
        return pd.DataFrame({"path": [path], "bytes": [len(data)]})

    return archives.groupBy("archive").applyInPandas(run, "path string, bytes long")
