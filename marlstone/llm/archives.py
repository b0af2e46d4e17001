"""Deduplicated WARC archives: revisit records for payloads that were seen before.

1. Headers only (page_id, payload digest, size) are shuffled by digest, and the
   smallest page_id of each digest is kept with map-side partial minima, so one
   payload on a third of all pages is no hot task.
2. Each page learns by a join on (page_id, digest) whether it is the original or
   revisits it.
3. Tasks write their pages as gzip members, one record each, under file names of
   their own, and return the names.  Files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import new_path, open_folder, partitions, unique_name, written

#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def plan_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Decide for each page what it is written as: adds hex_digest, record_type and refers_to.

    Of the pages with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id is the
    response, the others revisit it; where rows share that page_id, one of them is.  A null html is an empty payload.
    A null page_id is never an original if its payload has another one.
    """
    key = ["id_or_0", "no_id", "hex_digest"]  # joins and windows share one shuffle of the payloads
    pages = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    pages = pages.withColumn("hex_digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    pages = pages.withColumns({"id_or_0": F.coalesce("page_id", F.lit(0)), "no_id": F.col("page_id").isNull()})
    headers = pages.filter(F.col("size") >= min_bytes).select("page_id", *key)
    first = headers.groupBy("hex_digest").agg(F.min("page_id").alias("first_id"))
    known = headers.select(*key).distinct().join(first, "hex_digest").withColumn("known", F.lit(True))
    copy = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("url").asc_nulls_last()))
    original = F.col("known").isNull() | (F.col("page_id").eqNullSafe(F.col("first_id")) & (F.col("copy") == 1))
    return (
        pages.join(known, key, "left")
        .withColumn("copy", copy)
        .withColumn("record_type", F.when(original, "response").otherwise("revisit"))
        .select(
            "page_id",
            "url",
            F.when(original, F.col("payload")).alias("payload"),
            "size",
            "hex_digest",
            "record_type",
            F.when(~original, F.col("first_id")).alias("refers_to"),
        )
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(value: str | None) -> int | None:
    name = value.removeprefix("<urn:page:").removesuffix(">") if value else "null"
    return None if name == "null" else int(name)


def record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """One record; a revisit carries the headers of its response but no payload."""
    revisit = payload is None
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body += payload or b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str, *, min_bytes: int = 0, level: int = 4) -> DataFrame:
    """Write every page under ``folder``; returns the manifest of files (file, n_records)."""
    planned = plan_records(pages, min_bytes).sortWithinPartitions("page_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = None
        count = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    if out is None:
                        fs, base = open_folder(folder)
                        fs.create_dir(base, recursive=True)
                        name = f"{unique_name('pages')}.warc.gz"
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    digest = base64.b32encode(bytes.fromhex(r["hex_digest"])).decode()
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    data = record(r["page_id"], r["url"], r["payload"], r["size"], digest, r["refers_to"])
                    out.write(packer.compress(data) + packer.flush())
                    count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([count], pa.int64())})

    return written(planned.mapInArrow(write, "file string, n_records long"), "archives")


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and body of each record of a gzip stream, with one record in memory at a time."""
    data, unpacker, more = bytearray(), zlib.decompressobj(31), b""
    while more or (more := stream.read(1 << 20)):
        data += unpacker.decompress(more)
        more = unpacker.unused_data
        if unpacker.eof:
            unpacker = zlib.decompressobj(31)
            head, _, body = bytes(data).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield fields, body[: int(fields["Content-Length"])]
            data.clear()


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the files that a manifest names; sizes and digests of responses come from their payloads."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for fields, body in records_of(stream):
                        revisit = fields["WARC-Type"] == "revisit"
                        head, _, payload = body.partition(b"\r\n\r\n")
                        size = int(head.rsplit(b"Content-Length: ", 1)[1]) if revisit else len(payload)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{name}: payload of {fields['WARC-Record-ID']} is damaged")
                        rows.append(
                            {
                                "page_id": _page(fields["WARC-Record-ID"]),
                                "url": fields.get("WARC-Target-URI"),
                                "payload_bytes": size,
                                "payload_digest": digest,
                                "record_type": fields["WARC-Type"],
                                "refers_to": _page(fields.get("WARC-Refers-To")),
                            }
                        )
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in RECORDS.split(", ")]
    )
    files = manifest.select("file").repartition(partitions(manifest.sparkSession))
    return files.mapInArrow(read, RECORDS)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to a new shared folder and return the records read back."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), folder)
