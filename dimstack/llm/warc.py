"""WARC archives: one gzip member per record, written by the tasks that hold
the rows, and read back sequentially with verified digests."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HEAVY, materialize, scratch

#: Payloads of fewer bytes are never stored as revisits.
MIN_REVISIT = 1000
#: An archive is closed at this size.
ARCHIVE_BYTES = 64 << 20
#: Compressed bytes read at a time, and bytes inflated at a time.
CHUNK = 1 << 20
LEVEL = 6
CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-dimstack-page:{}>"


class WarcError(ValueError):
    """A record that is cut off, badly framed or fails its digest."""


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def hex_sha1(base32: str) -> str:
    return base64.b32decode(base32).hex()


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None, refers_url: str = "",
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record as a gzip member: a response with its payload, or a
    revisit that names the response.  Both carry the HTTP head with the full
    payload's length."""
    revisit = refers_to is not None
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = head if revisit else head + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", RECORD_ID.format(page_id)),
              ("WARC-Date", date), ("WARC-Target-URI", _clean(url)),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", "sha1:" + base32_sha1(digest)),
              ("WARC-Block-Digest", "sha1:" + base32_sha1(hashlib.sha1(block).hexdigest()))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", RECORD_ID.format(refers_to)),
                   ("WARC-Refers-To-Target-URI", _clean(refers_url))]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + CRLF + CRLF) + pack.flush()


def _members(stream) -> Iterator[bytes]:
    """The inflated content of each gzip member of a stream, in order; holds one
    record and one chunk."""
    raw = b""
    while True:
        raw = raw or stream.read(CHUNK)
        if not raw:
            return
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if not raw:
                raw = stream.read(CHUNK)
                if not raw:
                    raise WarcError("the archive ends inside a record")
            parts.append(member.decompress(raw, CHUNK))
            raw = member.unconsumed_tail or member.unused_data
        yield b"".join(parts)


def _fields(lines: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in lines.decode("utf-8", "replace").split("\r\n") if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse(member: bytes) -> dict:
    """Headers, HTTP head and payload of one record, framed by its
    Content-Length; raises WarcError if a length or digest does not hold."""
    top, blank, rest = member.partition(b"\r\n\r\n")
    if not blank or not top.startswith(b"WARC/"):
        raise WarcError("no WARC header")
    fields = _fields(top)
    length = int(fields.get("content-length", -1))
    block, tail = rest[:length], rest[length:]
    if length < 0 or len(block) != length or tail != CRLF + CRLF:
        raise WarcError("the block is not as long as its Content-Length")
    if hex_sha1(fields["warc-block-digest"].removeprefix("sha1:")) != hashlib.sha1(block).hexdigest():
        raise WarcError("block digest")
    head, _, payload = block.partition(b"\r\n\r\n")
    http = _fields(head)
    digest = hex_sha1(fields["warc-payload-digest"].removeprefix("sha1:"))
    if fields["warc-type"] == "response" and (hashlib.sha1(payload).hexdigest() != digest
                                              or len(payload) != int(http["content-length"])):
        raise WarcError("payload digest")
    return {"fields": fields, "payload": payload if fields["warc-type"] == "response" else None,
            "payload_bytes": int(http["content-length"]), "payload_digest": digest}


def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def assign_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    html_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, refers_to, refers_url)``: of equal
    payloads of MIN_REVISIT bytes or more the largest page_id is the response.

    Digests are counted with partial sums; only those of two pages or more are
    joined back: the few with over a thousandth of the pages by broadcast, the
    others by a shuffle of page ids, not of payloads, to the pages' own side.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    long = F.octet_length("payload") >= MIN_REVISIT
    last = F.max(F.struct("page_id", "url"))
    shared = materialize(rows.filter(long & F.col("page_id").isNotNull()).groupBy("digest")
                         .agg(last.alias("last"), F.count("*").alias("n")).filter("n > 1"), "warc-digests")
    limit = max(1, (shared.agg(F.sum("n")).first()[0] or 0) // HEAVY)
    named = shared.select("digest", F.col("last.page_id").alias("response"), F.col("last.url").alias("response_url"), "n")
    hot = F.broadcast(named.filter(F.col("n") > limit).drop("n"))
    cold = named.filter(F.col("n") <= limit).drop("n").withColumnsRenamed(
        {"digest": "d2", "response": "r2", "response_url": "u2"})
    out = rows.join(hot, "digest", "left")
    # rows that are settled by the broadcast or too short get a key that meets nothing
    open_ = F.when(F.col("response").isNull() & long, F.col("digest")).otherwise(
        F.concat(F.lit("- "), F.monotonically_increasing_id().cast("string")))
    out = out.withColumn("open", open_).join(cold.hint("merge"), F.col("open") == F.col("d2"), "left")
    response = F.coalesce("response", "r2")
    return out.select("page_id", "url", "payload", "digest",
                      F.when(long & (response != F.col("page_id")), response).alias("refers_to"),
                      F.coalesce("response_url", "u2", F.lit("")).alias("refers_url"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``assign_revisits`` rows as ``*.warc.gz`` below ``folder`` (a URI
    that all executors reach) and return the manifest ``(path, n_records, bytes)``.

    Each task writes archives of its own under a temporary name and moves them
    in place when complete; a task that runs again writes others, and the
    manifest, written once all tasks are done, lists only one set.
    """
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(folder)
        store.create_dir(base, recursive=True)
        part, out, name, n, size = TaskContext.get().partitionId(), None, "", 0, 0
        done: list[tuple[str, int, int]] = []

        def close():
            out.close()
            store.move(f"{base}/.{name}", f"{base}/{name}")
            done.append((f"{folder}/{name}", n, size))

        for b in batches:
            cols = [b.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "refers_url")]
            for i in range(b.num_rows):
                page, url, payload, digest, refers, refers_url = (c[i].as_py() for c in cols)
                if out is None:
                    name, n, size = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/.{name}", compression=None)
                raw = record("null" if page is None else page, url, payload, digest, refers, refers_url, date)
                out.write(raw)
                n, size = n + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict(
            {"path": pa.array([d[0] for d in done], pa.string()), "n_records": pa.array([d[1] for d in done], pa.int64()),
             "bytes": pa.array([d[2] for d in done], pa.int64())})

    return materialize(rows.mapInArrow(write, "path string, n_records long, bytes long"), "warc-manifest")


def read_archives(paths: DataFrame) -> DataFrame:
    """Every record of the archives in column ``path``, each read by one task
    from start to end: ``(path, page_id, record_type, url, payload,
    payload_bytes, payload_digest, refers_to)``; payload is NULL for revisits.
    A damaged archive raises WarcError."""
    number = lambda text: None if "null" in text else int(text.rpartition(":")[2].rstrip(">"))
    schema = pa.schema([("path", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()),
                        ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column("path").to_pylist():
                store, name = _filesystem(path)
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for member in _members(stream):
                        r = parse(member)
                        f = r["fields"]
                        rows.append((path, number(f["warc-record-id"]), f["warc-type"], f.get("warc-target-uri", ""),
                                     r["payload"], r["payload_bytes"], r["payload_digest"],
                                     number(f["warc-refers-to"]) if "warc-refers-to" in f else None))
                        size += len(member)
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    # one row per archive: deal them out singly, so that no task gets many
    parts = max(1, paths.count())
    return paths.select("path").repartition(min(parts, 10_000)).mapInArrow(
        read, "path string, page_id long, record_type string, url string, payload binary, "
              "payload_bytes long, payload_digest string, refers_to long")


def archive_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page to archives (in the shared scratch folder by default)
    and return the records read back from them.

    NULL html is an empty payload and NULL urls are empty; a page without an id
    is a response that nothing refers to; rows that share an id and a payload
    are both written (the response's own copy is a second response); other
    columns are ignored; an empty table gives an empty result.
    """
    return read_archives(write_archives(assign_revisits(pages), folder or scratch(spark, "warc")))
