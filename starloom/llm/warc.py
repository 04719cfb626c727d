"""WARC archives: deduplicating writer and sequential reader.

Each record is a gzip member of its own.  Files are written to and read from
the folder that ``spark.checkpoint.dir`` names, through ``pyarrow.fs``, so any
file system that all executors reach will do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.staging import stage, staging_path

ROLL_BYTES = 256 << 20  # a task begins another file beyond this size
_READ = 1 << 16
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, records long, bytes long"
_RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean"
)


def digest_of(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit: bool = False, level: int = 1) -> bytes:
    """One record as a gzip member; a revisit keeps the HTTP head and leaves the payload out."""
    name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"
    head = _HTTP.format(len(payload)).encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("WARC-Refers-To", f"<urn:page:{refers_to}>" if revisit else None),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _members(stream) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one after the other."""
    pending, packer, parts = b"", zlib.decompressobj(31), []
    while True:
        chunk = pending or stream.read(_READ)
        pending = b""
        if not chunk:
            break
        parts.append(packer.decompress(chunk))
        if packer.eof:
            pending = packer.unused_data
            yield b"".join(parts)
            packer, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("archive ends inside a record")


def read_records(stream) -> Iterator[dict]:
    """Records of an archive in order; framing and digests are checked.

    Memory holds one record at a time.
    """
    for data in _members(stream):
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not mark or not lines[0].startswith("WARC/1."):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        block = rest[:size]
        if len(block) != size or rest[size:] != b"\r\n\r\n":
            raise ValueError(f"{fields['WARC-Record-ID']}: wrong Content-Length")
        if f"sha1:{digest_of(block)}" != fields["WARC-Block-Digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']}: wrong block digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = fields["WARC-Type"] == "revisit"
        if not revisit and f"sha1:{digest_of(payload)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']}: wrong payload digest")
        page = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
        yield {
            "page_id": page("WARC-Record-ID"),
            "url": fields.get("WARC-Target-URI"),
            "payload": None if revisit else payload,
            "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To"),
        }


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, first_id``: the smallest page with an equal payload where there are others.

    Payloads are equal if SHA-1 and size are.  Payloads under ``least_bytes``
    and rows without a page id are never revisits.  Only digests with more
    than one page are joined; a frequent one is one row there, after
    map-side aggregation, and its pages are dealt anew by adaptive execution.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    full = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    keyed = full.withColumn("_digest", F.sha1("payload")).withColumn("_size", F.octet_length("payload"))
    groups = (
        keyed.where((F.col("_size") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("_digest", "_size")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return keyed.join(groups, ["_digest", "_size"], "left").select(
        "page_id", "url", "payload", F.when(F.col("page_id").isNotNull(), F.col("first_id")).alias("first_id")
    )


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, level: int = 1) -> DataFrame:
    """Write a record per page; returns the manifest ``path, records, bytes``.

    ``pages``: ``page_id, url, html``.  A missing html is an empty payload, a
    missing url leaves the field out, a page without id gets a random record
    id.  Of pages with equal payloads, those with the smallest id are
    responses (a row repeated with its id stays a response), the others
    revisits.  No pages, no files.

    Every task attempt writes files with names of its own, and only those of
    attempts that Spark committed are in the manifest, so lost executors and
    repeated attempts leave unlisted files at worst.
    """
    spark = pages.sparkSession
    folder = folder or staging_path(spark, "warc")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, top = fs.FileSystem.from_uri(folder)
        place.create_dir(top, recursive=True)
        out, done = None, []

        def close():
            out.close()
            done.append((path, records, size))

        for batch in batches:
            for page_id, url, payload, first in batch.itertuples(index=False):
                if out is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = place.open_output_stream(f"{top}/{path}", compression=None), 0, 0
                page_id = None if pd.isna(page_id) else int(page_id)
                first = None if pd.isna(first) else int(first)
                data = record_bytes(page_id, url, bytes(payload), first, first is not None and first != page_id, level)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= ROLL_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        names = [f"{folder.rstrip('/')}/{p}" for p, _, _ in done]
        yield pd.DataFrame({"path": names, "records": [r for _, r, _ in done], "bytes": [b for _, _, b in done]})

    marked = mark_revisits(pages, least_bytes)
    # Ids as text: a nullable number would pass through a double.
    sent = marked.select(F.col("page_id").cast("string"), "url", "payload", F.col("first_id").cast("string"))
    return stage(sent.mapInPandas(write, _MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record of the listed archives, each file read in sequence by one task."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                place, name = fs.FileSystem.from_uri(path)
                with place.open_input_stream(name, compression=None) as stream:
                    rows = []
                    for r in read_records(stream):
                        rows.append((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], True))
                        if len(rows) >= 10_000:
                            yield _frame(rows)
                            rows = []
                    yield _frame(rows)

    # As many tasks as files: a count keeps adaptive execution from merging these short rows.
    files = manifest.select("path").repartition(max(1, manifest.count()))
    return files.mapInPandas(read, _RECORDS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _RECORDS.split(", ")], dtype=object)
    return frame.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64", "verified": "bool"})
