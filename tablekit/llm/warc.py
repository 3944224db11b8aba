"""WARC archives with an index: records are written once, located by offset, and read by coalesced ranges.

Each partition of the pages, sorted by page, goes to files of its own in which
every record is a gzip member.  The index has a row for each record: file,
offset, length, URL and digest.  It is a written table, and only files that it
names count: a task that is run again writes new files, and those of the lost
attempt are named nowhere.  Reading sorts the selected index rows by file and
offset, joins neighbouring ranges into one read, and takes the records apart.

Of records with equal payloads, that with the largest page id is the response;
the others revisit it and hold no payload, only the HTTP header with its length.

Edge cases: a null payload is empty; a null URL is written as an empty one and
stays null in the index; null ids come before all others.  Of equal rows one is
the response and the others revisit it.  Of pages with one payload and one id
but several URLs, the smallest URL is the response.  A page longer than a file
gets a file of its own.  An empty table gives an empty index.  Further columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import scratch, written

#: A file is closed when it has this many bytes.
FILE_BYTES = 64 << 20
#: Ranges of one file less than this apart are read together, up to READ_BYTES at once.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Archives are read by a task for about so many bytes of records, whole files to a task.
TASK_BYTES = 16 << 20
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; executors and driver see the same store."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: str | None, url: str | None, digest: str, copy: int = 0) -> bytes:
    """Of the page, and what tells its records apart; a page without id has another mark before it than one with an empty one."""
    mark = "n" if page is None else "i" + quote(page, safe="")
    return f"<urn:page:{digest}:{base32_sha1((url or '').encode())[:16]}:{copy}:{mark}>".encode()


def _page_of(name: bytes) -> str | None:
    mark = name[1:-1].decode().rsplit(":", 1)[1]
    return unquote(mark[1:]) if mark[0] == "i" else None


def record(name: bytes, url: str, digest: str, size: int, payload: bytes | None, refers_to: bytes | None) -> bytes:
    """One record of that id; without a payload it revisits the one with the id refers_to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    lines = [VERSION, b"WARC-Type: " + (b"revisit" if payload is None else b"response"), b"WARC-Record-ID: " + name, b"WARC-Date: " + DATE, b"WARC-Target-URI: " + quote(url, safe="%:/?#[]@!$&'()*+,;=~").encode(), b"WARC-Payload-Digest: sha1:" + digest.encode()]
    if payload is None:
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + refers_to]
    lines += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of a record: headers, HTTP length and payload (None for a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("no WARC record begins here")
    fields = dict(x.split(b": ", 1) for x in lines[1:])
    block = rest[: int(fields[b"Content-Length"])]
    if len(rest) != len(block) + 4:
        raise ValueError("a record ends where its header doesn't say")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields[b"WARC-Type"].decode()
    return {"type": kind, "size": size, "digest": fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:"), "payload": payload if kind == "response" else None, "page": _page_of(fields[b"WARC-Record-ID"]), "refers_to": _page_of(fields[b"WARC-Refers-To"]) if b"WARC-Refers-To" in fields else None}


_INDEX = "file string, offset long, length long, page string, url string, digest string, type string"


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Writes all pages below `path` and returns the index.

    Payloads of fewer than `least_bytes` bytes never revisit each other.  The
    payloads cross one shuffle; what decides on revisits is ids and digests.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("__payload"))
    rows = rows.withColumn("__sha", F.sha2("__payload", 256))
    groups = rows.select("__id", "__url", "__sha", F.octet_length("__payload").alias("__size")).distinct()
    ids = groups.filter(F.col("__size") >= least_bytes).groupBy("__sha", "__id").agg(F.min("__url").alias("__head_url"))
    heads = ids.groupBy("__sha").agg(F.max(F.struct(F.col("__id").alias("i"), F.col("__head_url").alias("u"))).alias("h"))
    known = heads.select("__sha", F.col("h.i").alias("__head"), F.col("h.u").alias("__head_url"), F.lit(True).alias("__head_found"))
    return _write(rows, groups.join(known, "__sha", "left"), path)


def _write(rows: DataFrame, known: DataFrame, path: str) -> DataFrame:
    is_head = F.col("__id").eqNullSafe(F.col("__head")) & F.col("__url").eqNullSafe(F.col("__head_url"))
    known = known.select(
        F.col("__id").alias("k_id"), F.col("__url").alias("k_url"), F.col("__sha").alias("k_sha"),
        F.coalesce("__head_found", F.lit(False)).alias("shared"),
        (F.col("__head_found").isNull() | is_head).alias("head"),
        F.col("__head").cast("string").alias("head_page"), F.col("__head_url").alias("head_url"),
    )
    met = rows.join(known, rows["__sha"].eqNullSafe(known["k_sha"]) & rows["__id"].eqNullSafe(known["k_id"]) & rows["__url"].eqNullSafe(known["k_url"]))
    met = met.select(F.col("__id").cast("string").alias("page"), F.col("__url").alias("url"), F.col("__sha").alias("sha"), "shared", "head", "head_page", "head_url", F.col("__payload").alias("payload"))
    return met.sortWithinPartitions("sha", "page", "url").mapInArrow(lambda batches: _write_files(batches, path), _INDEX)


def _write_files(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    fs, root = file_system(path)
    out, name, at, last, copy, rows = None, "", 0, None, 0, []
    made = False
    for batch in batches:
        if batch.num_rows and not made:
            fs.create_dir(root, recursive=True)
            made = True
        for page, url, sha, shared, head, head_page, head_url, payload in zip(*(c.to_pylist() for c in batch.columns)):
            key = (page, url, sha)
            copy = copy + 1 if key == last else 0
            first = head and (not shared or not copy)
            last = key
            digest = base32_sha1(payload)
            raw = record(record_id(page, url, digest, copy), url or "", digest, len(payload), payload if first else None, None if first else record_id(head_page, head_url, digest))
            packer = zlib.compressobj(1, wbits=31)
            member = packer.compress(raw) + packer.flush()
            if out is not None and at + len(member) > FILE_BYTES:
                out.close()
                out = None
            if out is None:
                name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(member)
            rows.append((name, at, len(member), page, url, digest, "response" if first else "revisit"))
            at += len(member)
        if out is not None:
            out.flush()
        if rows:
            types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "offset", "length", "page", "url", "digest", "type"])
            rows = []
    if out is not None:
        out.close()


def ranges(places: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, which) of the reads that cover sorted (offset, length) places."""
    start = end = 0
    which: list[int] = []
    for i, (offset, length) in enumerate(places):
        if which and (offset - end > gap or offset + length - start > most):
            yield start, end, which
            which = []
        if not which:
            start = end = offset
        end = max(end, offset + length)
        which.append(i)
    if which:
        yield start, end, which


def read(index: DataFrame, path: str) -> DataFrame:
    """page, url, type, payload_bytes, digest, refers_to and payload of the records that the index rows name.

    The digest of a response is that of the payload as read; that of a revisit is its header's.
    """
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // TASK_BYTES))
    source = index.select("file", "offset", "length", "url").repartition(tasks, "file").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        for batch in batches:
            files, urls = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            places = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            a = 0
            while a < len(files):
                b = next((i for i in range(a, len(files)) if files[i] != files[a]), len(files))
                with fs.open_input_file(f"{root}/{files[a]}") as f:
                    for start, end, which in ranges(places[a:b]):
                        raw = f.read_at(end - start, start)
                        rows = []
                        for i in which:
                            offset, length = places[a + i]
                            got = parse(zlib.decompress(raw[offset - start : offset - start + length], wbits=31))
                            digest = got["digest"] if got["payload"] is None else base32_sha1(got["payload"])
                            size = got["size"] if got["payload"] is None else len(got["payload"])
                            rows.append((got["page"], urls[a + i], got["type"], size, digest, got["refers_to"], got["payload"]))
                        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["page", "url", "type", "payload_bytes", "digest", "refers_to", "payload"])
                a = b

    return source.mapInArrow(run, "page string, url string, type string, payload_bytes long, digest string, refers_to string, payload binary")


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> tuple[DataFrame, str]:
    """Writes the pages into the shared folder; the written index and the path of the archives."""
    path = scratch(pages.sparkSession, "warc")
    return written(write(pages, path, id_col, url_col, payload_col, least_bytes), "warc-index"), path
