"""WARC archives written by Spark tasks and read back by byte ranges.

Writing: every task writes one ``.warc.gz`` file, a gzip member per record, below a folder of the shared file system, and
reports it as a row; the rows are a table that only holds files of tasks that succeeded. Equal payloads are stored once:
the copy with the smallest page id is a ``response``, the others are ``revisit`` records that refer to it.

Reading: a task gets a byte range. It looks for the gzip magic, accepts a candidate only if the member inflates to
``WARC/``, and owns the records that start in its range, reading past the range's end to finish the last one. After a
valid record the next is expected right behind it; bytes that are no record are skipped over.

Folders are opened with ``pyarrow.fs`` (local paths, HDFS, S3, GCS by URI).

Cases: null html is an empty payload; null urls write no target; a null page id is never referred to unless no copy has
an id; repeated rows of the smallest id are all responses; an empty table writes nothing and reads as empty; a member cut
off by the file's end is dropped; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import materialise, shared_folder, shuffle_partitions

VERSION = "WARC/1.1"
SPLIT_BYTES = 32 << 20
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date; a fixed one keeps archives reproducible
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = ("record_type string, record_id string, refers_to string, target_uri string, payload_digest string, "
           "payload_bytes long, digest_ok boolean, payload binary")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: object) -> str:
    return f"<urn:x-page:{'' if page_id is None or page_id is pd.NA else int(page_id)}>"


def record(page_id: object, url: str | None, payload: bytes, refers_to: object = None, revisit: bool = False) -> bytes:
    """One uncompressed record; a revisit holds the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    body = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    uri = re.sub(r"^(\w+):/(?!/)", r"\1:///", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def copies(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload, of at least ``min_bytes``, a smaller page id has too."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = materialise(pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(payload).alias("digest"),
                                    F.octet_length(payload).alias("n")), "payload-digests")
    groups = (rows.where(F.col("n") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("times")).where("times > 1"))
    found = rows.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.select("page_id", "digest", "refers_to").distinct()


def write(spark: SparkSession, pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the archives; rows (path, bytes, records) of the files."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    refer = materialise(copies(pages, min_bytes, id_col, html_col), "payload-copies").select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to", F.lit(True).alias("revisit"))
    joined = rows.join(refer, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, path, size, records = None, "", 0, 0
        for b in batches:
            for page_id, url, body, refers, revisit in zip(
                    b["page_id"].astype("Int64"), b["url"], b["payload"], b["refers_to"].astype("Int64"), b["revisit"],
                    strict=True):
                if out is None:
                    files, top = open_folder(folder)
                    files.create_dir(top, recursive=True)
                    path = f"{top}/part-{uuid.uuid4().hex}.warc.gz"  # a retried task writes another file
                    out = files.open_output_stream(path, compression=None)
                packed = member(record(page_id, url, bytes(body), refers, revisit is True or revisit == True))  # noqa: E712
                out.write(packed)
                size += len(packed)
                records += 1
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [path.rsplit("/", 1)[1]], "bytes": [size], "records": [records]})

    written = joined.select("page_id", "url", "payload", "refers_to", "revisit").mapInPandas(
        run, "path string, bytes long, records long")
    files = written.withColumn("path", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("path")))
    return materialise(files, "archive-files")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of archives that others have written."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz")
    return files.load(folder).select("path", F.col("length").alias("bytes"))


def _inflate(read, at: int) -> tuple[bytes, int] | None:
    """The gzip member at ``at`` if it is a WARC record, and the offset behind it."""
    unpack, parts, position, checked = zlib.decompressobj(31), [], at, False
    while not unpack.eof:
        chunk = read(position, CHUNK)
        if not chunk:
            return None  # cut off
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error:
            return None
        position += len(chunk)
        if not checked and sum(map(len, parts)) >= 5:
            parts = [b"".join(parts)]
            checked = True
            if not parts[0].startswith(b"WARC/"):
                return None
    data = b"".join(parts)
    return (data, position - len(unpack.unused_data)) if data.startswith(b"WARC/") else None


def records_in(read, start: int, end: int) -> Iterator[bytes]:
    """Inflated records that start in [start, end). ``read(offset, length)`` gives bytes, fewer at the file's end."""
    at = start
    while at < end:
        block = read(at, min(CHUNK, end - at) + len(MAGIC) - 1)
        hit = block.find(MAGIC)
        if hit < 0:
            at += max(1, len(block) - len(MAGIC) + 1) if len(block) >= len(MAGIC) else end - at
            continue
        at += hit
        if at >= end:
            return
        found = _inflate(read, at)
        if found is None:
            at += 1
        else:
            yield found[0]
            at = found[1]


def parse(data: bytes) -> dict:
    """A record's fields and payload; a response's digest is computed anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type", "")
    if kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
        size, good, payload = int(length.group(1)) if length else None, None, None
    else:
        size, own = len(payload), digest_of(payload)
        digest, good = own, digest in ("", own)
    return {"record_type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
            "target_uri": fields.get("warc-target-uri"), "payload_digest": digest, "payload_bytes": size,
            "digest_ok": good, "payload": payload}


def read(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """Records of the archives (rows with path and bytes), each file in ranges of ``split_bytes``."""
    ranges = (files.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long")))
        .alias("start")).repartition(max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, size, start in zip(b["path"], b["bytes"].tolist(), b["start"].tolist(), strict=True):
                files, name = open_folder(path)
                with files.open_input_file(name) as f:
                    def part(at: int, n: int, f=f, size=size) -> bytes:
                        return f.read_at(max(0, min(n, size - at)), at) if at < size else b""

                    rows, held = [], 0
                    for data in records_in(part, start, min(size, start + split_bytes)):
                        rows.append(parse(data))
                        if not with_payload:
                            rows[-1]["payload"] = None
                        held += len(data) if with_payload else 500
                        if held > 1 << 24:
                            yield pd.DataFrame(rows).astype({"payload_bytes": "Int64"})
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows).astype({"payload_bytes": "Int64"})

    return ranges.mapInPandas(run, _RECORD)


def page_of(column) -> F.Column:
    """The page id in a record id of ``record_id``; null where there is none."""
    return F.expr("nullif(regexp_extract({0}, '^<urn:x-page:(-?[0-9]+)>$', 1), '')".format(column)).cast("long")


def roundtrip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write the pages to archives in the shared folder and read the records back (without payloads)."""
    files = write(spark, pages, shared_folder(spark, "warc"), min_bytes)
    return read(spark, files, split_bytes, with_payload=False)
