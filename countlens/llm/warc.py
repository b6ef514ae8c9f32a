"""WARC archives (operator 4): write records, index first, then read byte ranges.

Writing: each task writes its rows as gzip members, one a record, to archive
files of its own in a shared folder, and returns an index row per record:
file, offset, length, URL and digest. Only a task attempt that succeeds gets
its index rows into the stored index, so files of lost or repeated attempts are
never read. Among records with equal payloads of at least ``min_bytes`` bytes,
found by SHA-1, the one of the largest id carries the payload (``response``);
the others name it (``revisit``).

Reading: the selected index rows are dealt out by file and region and sorted by
offset; neighbouring ranges are joined into single reads of a bounded size, the
records are cut out and parsed.

Defined results: a null payload is empty; a null URL gives no target header;
line breaks in a URL are percent-encoded; rows that repeat the largest id of
their payload are all responses; a null id is below all others, and if a
payload has only null ids they are all responses; an empty table gives an empty
index. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlens.llm.common import parts, stored
from countlens.session import scratch_path

FILE_BYTES = 64 << 20  # an archive file is closed beyond this size
READ_BYTES = 4 << 20  # a joined read stops growing beyond this size
READ_GAP = 64 << 10  # unselected bytes that a joined read may skip over
REGION = 16 << 20  # ranges within a region of a file are read by one task
DATE = "1970-01-01T00:00:00Z"

INDEX = "page_id string, url string, digest string, record_type string, file string, `offset` long, length long"


def payload_digest(payload):
    """Bare upper-case base32 SHA-1 of a binary column, by groups of 20 bits."""
    code = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(code, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*fours)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def record(page_id, url, kind, digest, n_bytes, refers_to, payload: bytes) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {n_bytes}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    if kind == "revisit":
        head += [
            f"WARC-Refers-To: <urn:page:{refers_to}>",
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
        ]
    else:
        body += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    fields["payload"] = block.partition(b"\r\n\r\n")[2]
    return fields


def write_archives(pages: DataFrame, *, id_col="page_id", url_col="url", payload_col="html", min_bytes: int = 0) -> DataFrame:
    """Write every row as a record; the stored index of the archives."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("digest", payload_digest(F.col("payload")))
    large = rows.filter(F.octet_length("payload") >= min_bytes)
    copies = large.groupBy("digest").agg(F.max("id").alias("top"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("top").isNotNull() & ~F.col("id").eqNullSafe(F.col("top"))
    rows = rows.join(copies, "digest", "left").select(
        F.col("id").cast("string").alias("page_id"),
        "url",
        "digest",
        F.when(revisit, F.col("top").cast("string")).alias("refers_to"),
        "payload",
    )

    def write(batches):
        store, base = file_system(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                index = []
                for page_id, url, digest, refers_to, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    kind = "response" if refers_to is None else "revisit"
                    raw = record(page_id, url, kind, digest, len(payload), refers_to, payload)
                    packer = zlib.compressobj(3, wbits=31)
                    member = packer.compress(raw) + packer.flush()
                    out.write(member)
                    index.append((page_id, url, digest, kind, f"{folder}/{name}", at, len(member)))
                    at += len(member)
                    if at >= FILE_BYTES:
                        out.close()
                        out = None
                kinds = [pa.string()] * 5 + [pa.int64()] * 2
                names = ["page_id", "url", "digest", "record_type", "file", "offset", "length"]
                columns = list(zip(*index, strict=True)) or [()] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, *, payload: bool = True) -> DataFrame:
    """The records at the index rows given, parsed: ``page_id`` (text), ``url``, ``payload_bytes``,
    ``payload_digest`` (counted from the payload where there is one), ``record_type``, ``refers_to``
    and, if asked for, ``payload`` (null for revisits)."""
    total = index.agg(F.sum("length")).first()[0] or 0
    region = F.floor(F.col("offset") / REGION)
    wanted = index.select("file", "offset", "length", region.alias("region"))
    wanted = wanted.repartition(parts(total, REGION), "file", "region").sortWithinPartitions("file", "offset")

    def fetch(batches):
        store, path, source, run = None, None, None, []

        def cut():
            """Records of the run of neighbouring ranges, by one read."""
            start = run[0][0]
            data = source.read_at(run[-1][0] + run[-1][1] - start, start)
            for at, length in run:
                yield parse(zlib.decompress(data[at - start : at - start + length], wbits=31))

        def rows(records):
            out = []
            for r in records:
                url, body, of = r.get("WARC-Target-URI"), None, r.get("WARC-Refers-To")
                n, digest = int(r["X-Payload-Length"]), r["WARC-Payload-Digest"].removeprefix("sha1:")
                if r["WARC-Type"] == "response":
                    body = r["payload"]
                    n, digest = len(body), base32(hashlib.sha1(body).digest())
                page = r.get("WARC-Record-ID")
                out.append((page and page[10:-1], url, n, digest, r["WARC-Type"], of and of[10:-1], body if payload else None))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        try:
            for batch in batches:
                for file, at, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    end = run[-1][0] + run[-1][1] if run else 0
                    if run and (file != path or at > end + READ_GAP or end - run[0][0] >= READ_BYTES):
                        yield rows(cut())
                        run = []
                    if file != path:
                        if source is not None:
                            source.close()
                        store, inner = file_system(file)
                        source, path = store.open_input_file(inner), file
                    run.append((at, length))
            if run:
                yield rows(cut())
        finally:
            if source is not None:
                source.close()

    out = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    got = wanted.mapInArrow(fetch, out)
    got = got.withColumn("payload", F.col("payload").cast("string"))
    return got if payload else got.drop("payload")


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()
