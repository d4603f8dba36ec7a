"""WARC archives: written by tasks, read back record by record.

`mark_revisits` finds payloads that occur more than once; the record of the largest page id holds
the payload, the others refer to it. `write_archives` writes each partition as archives with one
gzip member per record, into a folder that all executors share; `read_archives` reads each archive
as a stream: inflate a member piece by piece, frame the record by its Content-Length, verify block
and payload digests. Memory holds one record and one piece of input at a time.

A task writes to names of its own attempt and lists them in its result, which is stored; archives
of lost attempts stay unlisted and are never read. Payload counts are combined per task and slot
before they meet by digest, and rows join them by digest and slot, so a payload that a third of
the pages share fills as many tasks as any other rows.

Defined results: a null page is an empty payload. Payloads below `MIN_REVISIT` bytes are always
responses. Rows that repeat the largest page id of their payload are responses too; a null id is
smaller than any other, and a payload that only rows without id hold is kept in each of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .common import spread

MIN_REVISIT = 1000
#: Bytes after which a task begins another archive, and bytes read at a time.
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, verified boolean"
)


def mark_revisits(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Add payload, payload_bytes, payload_digest and refers_to (null: the record keeps its payload)."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.withColumn("payload", payload).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1("payload"),
            "_slot": spread(spark, F.col(page_id)),
        }
    )
    # one row per digest and slot, then per digest, then back to the slots that are there
    held = (
        rows.filter(F.col("payload_bytes") >= MIN_REVISIT)
        .groupBy("payload_digest", "_slot")
        .agg(F.max(page_id).alias("_largest"), F.count("*").alias("_n"))
        .groupBy("payload_digest")
        .agg(F.max("_largest").alias("_largest"), F.sum("_n").alias("_n"), F.collect_list("_slot").alias("_slots"))
        .filter("_n > 1")
        .select("payload_digest", "_largest", F.explode("_slots").alias("_slot"))
    )
    joined = rows.join(held, ["payload_digest", "_slot"], "left")
    own = F.col(page_id).eqNullSafe(F.col("_largest"))
    return joined.withColumn("refers_to", F.when(~own, F.col("_largest"))).drop("_slot", "_largest")


def _urn(page_id) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    fields = [
        (b"WARC-Type", b"response" if refers_to is None else b"revisit"),
        (b"WARC-Record-ID", _urn(page_id)),
        (b"WARC-Date", b"1970-01-01T00:00:00Z"),
        (b"Content-Type", b"application/http; msgtype=response"),
        (b"WARC-Block-Digest", b"sha1:" + hashlib.sha1(block).hexdigest().encode()),
        (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
    ]
    if url is not None:
        # a URI holds no white space, so a line can't be broken by one
        fields.append((b"WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~").encode()))
    if refers_to is not None:
        fields += [(b"WARC-Refers-To", _urn(refers_to)), (b"WARC-Profile", PROFILE.encode())]
    fields.append((b"Content-Length", str(len(block)).encode()))
    return b"WARC/1.1\r\n" + b"".join(b"%s: %s\r\n" % f for f in fields) + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return packer.compress(data) + packer.flush()


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of `mark_revisits` below `folder`, a URI that all executors reach; gives the archives."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        base = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        out, listed = None, []

        def close():
            out.close()
            listed.append([f"{root}/{name}", records, written])

        for batch in batches:
            for row in range(batch.num_rows):
                if out is not None and written >= archive_bytes:
                    close()
                    out = None
                if out is None:
                    name, records, written = f"{base}-{len(listed):04d}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip_member(record(*(batch.column(c)[row].as_py() for c in range(5))))
                out.write(member)
                records, written = records + 1, written + len(member)
        if out is not None:
            close()
        paths, counts, sizes = zip(*listed) if listed else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
            names=["path", "records", "bytes"],
        )

    return marked.select("page_id", "url", "payload", "payload_digest", "refers_to").mapInArrow(write, MANIFEST)


def members(stream) -> Iterator[bytes]:
    """The inflated content of each gzip member, read sequentially."""
    unpacker, inflated, data = zlib.decompressobj(16 + zlib.MAX_WBITS), [], b""
    while True:
        data = data or stream.read(READ_BYTES)
        if not data:
            if inflated:
                raise ValueError("the archive ends within a record")
            return
        inflated.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            yield b"".join(inflated)
            data, inflated = unpacker.unused_data, []
            unpacker = zlib.decompressobj(16 + zlib.MAX_WBITS)


def parse(content: bytes) -> dict:
    """Fields of a record framed by its Content-Length, with its digests verified."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}
    size = int(fields[b"content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields[b"warc-type"].decode()
    digest = fields[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
    good = hashlib.sha1(block).hexdigest().encode() == fields[b"warc-block-digest"].removeprefix(b"sha1:")
    if kind == "response":
        good = good and len(payload) == length and hashlib.sha1(payload).hexdigest() == digest

    def number(name):
        found = fields.get(name, b"").removeprefix(b"<urn:page:").removesuffix(b">")
        return int(found) if found else None

    return {
        "page_id": number(b"warc-record-id"),
        "url": fields[b"warc-target-uri"].decode() if b"warc-target-uri" in fields else None,
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number(b"warc-refers-to"),
        "verified": good,
    }


def read_archives(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the listed archives, one row each; `payloads=False` leaves the payloads out."""
    kinds = [
        pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_(),
    ]
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for content in members(stream):
                        row = parse(content)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held >= 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.select("path").mapInArrow(read, RECORDS)


def archive(spark: SparkSession, pages: DataFrame) -> tuple[DataFrame, str]:
    """Write all pages below the shared folder; gives the stored list of archives and the folder."""
    folder = work_dir(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    listed = f"{folder}/archives.parquet"
    write_archives(mark_revisits(pages.select("page_id", "url", "html")), f"{folder}/data").write.parquet(listed)
    return spark.read.parquet(listed), folder


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The contract's columns, from the archives read back."""
    listed, folder = archive(spark, pages)
    slots = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return read_archives(listed.repartition(slots, "path"), folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


#: The digest stated for DuckDB.
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM d),
r AS (SELECT *, payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM largest AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN largest END AS refers_to, true AS verified
FROM r
"""
