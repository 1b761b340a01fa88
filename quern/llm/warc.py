"""Deterministic sharded WARC writer and reader (operator 2).

Records are range-sorted by page_id, written by one task per range as gzip members,
rolled into a new file when the compressed size passes ``roll_bytes``, and committed
through temporary names and a manifest. Headers, record ids and digests are made anew
from the rows. The ranges (about ``shard_bytes`` of payload each) come from a sample by hash, so equal rows give
equal files, whatever the session's settings and the number and order of input files.

A payload that occurs more than once is stored with its smallest page_id; the others
become ``revisit`` records that carry the full payload's digest and length.

Defined results: a null html is an empty payload. Rows without page_id come last. A
repeated row (equal page_id and payload) is stored as a revisit of its first. An empty
table gives no file and no row. A null url is written as ``urn:page:<page_id>``.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import (SHARD_BYTES, TempFile, commit, file_rows, open_fs, prepare, qualified, ranges, read_manifest,
                              scratch_path, small_side, staged, table)

ROLL_BYTES = 64 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"          # fixed: a rerun writes equal bytes
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Repeated payloads' digests (32 bytes and an id each) that a task may hold: about 12 MB.
MAX_BROADCAST_ROWS = 200_000


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, parts)))}>"


def gzip_member(data: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)       # no time stamp in the header
    return z.compress(data) + z.flush()


def render(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + f"\r\nContent-Length: {len(block)}\r\n\r\n").encode() \
        + block + b"\r\n\r\n"


def http_head(payload_bytes: int) -> bytes:
    return ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {payload_bytes}\r\n\r\n").encode()


def safe_uri(url: str | None, page_id) -> str:
    """A URI on one header line."""
    if not url:
        return f"urn:page:{page_id}"
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def page_record(page_id, url, payload: bytes, first_id, repeats: bool, again: int) -> bytes:
    """One response or revisit record; ``again`` numbers equal rows."""
    digest, head = sha1(payload), http_head(len(payload))
    revisit = repeats and (page_id != first_id or again > 0)
    block = head if revisit else head + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", record_id(page_id, digest, again)),
               ("WARC-Date", DATE), ("WARC-Target-URI", safe_uri(url, page_id)),
               ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{sha1(block)}")]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(first_id, digest, 0))]
        if first_id is not None:
            headers.append(("X-Refers-To-Page-Id", str(first_id)))
    headers.append(("Content-Type", "application/http; msgtype=response"))
    return render(headers, block)


def warcinfo() -> bytes:
    block = b"software: quern\r\nformat: WARC File Format 1.1\r\n"
    return render([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo")), ("WARC-Date", DATE),
                   ("Content-Type", "application/warc-fields")], block)


def page_sizes(pages: DataFrame) -> DataFrame:
    """``(key, tie, digest, bytes)`` of every page, written: ids, digests and lengths only."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digest = F.unhex(F.sha2(payload, 256))
    return staged(pages.select(F.col("page_id").cast("long").alias("key"), F.xxhash64(digest).alias("tie"), digest.alias("digest"),
                               F.octet_length(payload).cast("long").alias("bytes")), "pages")


def first_pages(sizes: DataFrame, min_bytes: int) -> DataFrame:
    """``(digest, first_id)`` of payloads that several rows hold; moves digests and ids only."""
    return sizes.where(F.col("bytes") >= min_bytes) \
        .groupBy("digest").agg(F.count("*").alias("n"), F.min("key").alias("first_id")) \
        .where("n > 1").select("digest", "first_id")


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, min_bytes: int = 0,
               max_broadcast_rows: int = MAX_BROADCAST_ROWS, shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Write ``pages(page_id, url, html)`` as ``folder/part-*.warc.gz``; the manifest's rows."""
    folder = qualified(pages.sparkSession, folder)
    sizes = page_sizes(pages)
    firsts = staged(first_pages(sizes, min_bytes), "payloads")
    shards = ranges(sizes, nulls_first=False, shard_bytes=shard_bytes)
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), payload.alias("payload")) \
        .withColumn("digest", F.unhex(F.sha2("payload", 256))) \
        .join(small_side(firsts.withColumn("repeats", F.lit(True)), firsts.count(), max_broadcast_rows),
              "digest", "left") \
        .withColumn("tie", F.xxhash64("digest")).withColumn("shard", shards.number("page_id", "tie")) \
        .repartitionById(shards.count, "shard") \
        .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "tie", "digest", "url") \
        .select("page_id", "url", "payload", "digest", "first_id", "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, out, files, n, last, again = TaskContext.get().partitionId(), None, [], 0, None, 0

        def close():
            out.close()
            files.append((part, len(files), out.name, n, out.size))

        for rb in batches:
            for page_id, url, payload, digest, first_id, repeats in zip(*(c.to_pylist() for c in rb.columns)):
                again = again + 1 if last == (page_id, digest) else 0
                last = page_id, digest
                if out is None:
                    out, n = TempFile(folder), 0
                    out.write(gzip_member(warcinfo()))
                out.write(gzip_member(page_record(page_id, url, payload, first_id, bool(repeats), again)))
                n += 1
                if out.size >= roll_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        cols = list(zip(*files)) or [()] * 5
        types = pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)],
                              names=["part", "seq", "temp", "records", "bytes"])

    # One row per file: as many as there are tasks, plus one for every roll_bytes written.
    files = rows.mapInArrow(run, "part int, seq int, temp string, records long, bytes long").collect()
    return commit(folder, [f.asDict() for f in sorted(files, key=lambda f: (f["part"], f["seq"]))], ".warc.gz")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one at a time."""
    z, parts, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(chunk):
        parts.append(z.decompress(data))
        rest = z.unused_data
        if z.eof:
            yield b"".join(parts)
            z, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length does not fit")
    return fields, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page record of the archives, digests verified; payload is null for revisits."""
    folder = qualified(spark, folder)
    rows = [(f"{folder}/{f['file']}",) for f in read_manifest(folder)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        types = pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()

        def batch(found):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

        for rb in batches:
            for path in rb.column("path").to_pylist():
                fs, local = open_fs(path)
                found, held = [], 0
                with fs.open_input_stream(local, compression=None) as stream:
                    for record in members(stream):
                        f, block = parse(record)
                        if f["warc-type"] == "warcinfo":
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        n = int(head.rpartition(b"Content-Length: ")[2])
                        digest = f["warc-payload-digest"].removeprefix("sha1:")
                        full = f["warc-type"] == "response"
                        if "sha1:" + sha1(block) != f["warc-block-digest"] or full and (sha1(payload) != digest or len(payload) != n):
                            raise ValueError(f"{path}: digest of {f['warc-record-id']} does not fit")
                        to = f.get("x-refers-to-page-id")
                        own = f.get("x-page-id")
                        found.append((None if own is None else int(own), f["warc-target-uri"], n, digest,
                                      f["warc-type"], None if to is None else int(to), payload if full else None))
                        held += len(payload)
                        if len(found) >= 1000 or held >= 16 << 20:
                            yield batch(found)
                            found, held = [], 0
                if found:
                    yield batch(found)

    return file_rows(spark, rows, "path string").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")


def op2_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to WARC files and read the records back."""
    prepare(spark)
    folder = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).drop("payload", "url")
