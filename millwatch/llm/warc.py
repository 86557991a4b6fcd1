"""WARC archives by way of an index: records are written with their byte ranges noted, then read by range."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from millwatch.llm.common import table
from millwatch.plans.storage import fresh_path, written
from millwatch.session import ship

#: Bytes after which a task starts another archive.
ARCHIVE_BYTES = 1 << 30
#: Neighbouring ranges are read at once if no more than ``GAP`` bytes lie between them, up to ``RUN`` bytes.
GAP, RUN = 1 << 16, 1 << 23
#: Bytes of an archive that one task reads at least.
STRETCH = 1 << 23
#: Copies of each repeated digest's first id, so that a hot digest meets it in many tasks.
SALTS = 32
#: The profile of revisits whose payload is the same: a fixed value of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, file string, offset long, length long, payload_digest string, record_type string, refers_to long"


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record. A revisit holds the HTTP head only, whose Content-Length is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
              ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else _urn(page_id)[1:-1]),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(refers_to))]
        payload = b""
    fields.append(("Content-Length", str(len(head) + len(payload))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + head + payload + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields, HTTP fields and payload of one record."""
    at = data.index(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in data[:at].decode().split("\r\n")[1:])
    block = data[at + 4:at + 4 + int(fields["Content-Length"])]
    cut = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    return {"fields": fields, "http": http, "payload": block[cut + 4:]}


def _page(urn: str | None) -> int | None:
    found = re.search(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def write(pages: DataFrame, folder: str, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record for each row of (page_id, url, html) and return the index of all records.

    Of records with equal payloads of at least ``least`` bytes, the one with the smallest page_id is
    a response, the others are revisits of it. Each task writes archives of its own, one gzip member
    for each record; the index names only files of tasks that were finished, so what a lost task
    left behind is never read.

    A null html is an empty payload. A null id counts as the largest; a record without a url gets
    one from its id. Rows that repeat the smallest id with its payload are all responses. Other
    columns are not read. No rows, no records. ``folder`` is a path or URI that all executors see.
    """
    spark = ship(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    firsts = (rows.where(F.octet_length("payload") >= least).groupBy("sha1").agg(F.count("*").alias("n"), F.min("page_id").alias("first_id"))
              .where("n > 1").select("sha1", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    rows = rows.join(firsts, ["sha1", "salt"], "left").select("page_id", "url", "payload", "sha1", F.when(
        F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        store.create_dir(at, recursive=True)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                index = []
                for i in range(batch.num_rows):
                    page_id, url, payload, sha1, refers_to = (c[i].as_py() for c in batch.columns)
                    if out is None or offset > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{at}/{name}", compression=None)
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    data = gzip.compress(record(page_id, url, payload, digest, refers_to, date), 6, mtime=0)
                    out.write(data)
                    index.append((page_id, url, name, offset, len(data), digest, "response" if refers_to is None else "revisit", refers_to))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*index) if index else [()] * 8,
                    [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()])],
                    names=["page_id", "url", "file", "offset", "length", "payload_digest", "record_type", "refers_to"])
        finally:
            if out is not None:
                out.close()

    return written(rows.mapInArrow(put, INDEX), "warc-index")


def ranges(offsets: list[int], lengths: list[int]) -> list[tuple[int, int, int, int]]:
    """Coalesced reads of sorted records: first and last+1 record, offset and length of the read."""
    reads = []
    for i, (offset, length) in enumerate(zip(offsets, lengths)):
        if reads and offset - (reads[-1][2] + reads[-1][3]) <= GAP and offset + length - reads[-1][2] <= RUN:
            first, _, start, had = reads[-1]
            reads[-1] = first, i + 1, start, max(had, offset + length - start)
        else:
            reads.append((i, i + 1, offset, length))
    return reads


def read(index: DataFrame, folder: str) -> DataFrame:
    """Read the records that ``index`` selects, each by its byte range.

    Records are dealt to tasks by stretches of ``STRETCH`` bytes of a file, as many tasks as the records
    have such stretches, and sorted by offset; neighbours are read in one go.
    Returns page_id, url, record_type, payload (null for revisits), payload_bytes, payload_digest and
    refers_to, all from the archives; a response whose payload does not match its digest raises.
    """
    def get(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, at = fs.FileSystem.from_uri(folder)
        for part in parts:
            for name, rows in part.groupby("file", sort=False):
                rows = rows.sort_values("offset")
                offsets, lengths = rows.offset.tolist(), rows.length.tolist()
                with store.open_input_file(f"{at}/{name}") as file:
                    for first, last, start, length in ranges(offsets, lengths):
                        data = file.read_at(length, start)
                        yield pd.DataFrame([_row(gzip.decompress(data[offsets[i] - start:offsets[i] - start + lengths[i]])) for i in range(first, last)],
                                           columns=["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]).astype(
                                               {"page_id": "Int64", "refers_to": "Int64"})

    size = index.agg(F.sum("length")).first()[0] or 0
    stretch = F.expr(f"offset div {STRETCH}")
    wanted = (index.select("file", "offset", "length").repartition(max(1, -(-size // STRETCH)), "file", stretch)
              .sortWithinPartitions("file", "offset"))
    return wanted.mapInPandas(get, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def _row(data: bytes) -> tuple:
    found = parse(data)
    fields, kind = found["fields"], found["fields"]["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base64.b32encode(hashlib.sha1(found["payload"]).digest()).decode() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return (_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, found["payload"] if kind == "response" else None,
            int(found["http"]["Content-Length"]), digest, _page(fields.get("WARC-Refers-To")))


def op10_warc(spark, sf_dir):
    folder = fresh_path(spark, "warc")
    index = write(table(spark, sf_dir, "pages"), folder)
    return read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Five hexadecimal digits are four letters of base32.
OP10_SQL = """
WITH rows AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digests AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  (((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest
  FROM rows),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM digests)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM firsts
"""
