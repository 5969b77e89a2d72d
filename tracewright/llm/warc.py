"""WARC archives as a table of chunks.

A record's payload is a run of rows (record, chunk number, bytes); neither the
writer nor the reader of an archive ever holds more of it than one chunk, and the
digest grows chunk by chunk.  Archives are gzip files with one member a record,
written to the folder that all executors share; a task writes under a name of its
own and renames when done, so a task that is run again leaves one archive.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, shared_folder, small_batches, table

#: Bytes of a chunk; least bytes of a payload that may be revisited instead of stored; gzip level.
CHUNK, LEAST_REVISIT, LEVEL = 1 << 20, 1000, 1
DATE = "2024-01-01T00:00:00Z"
CHUNKS = "record_id string, page_id {kind}, url string, record_type string, refers_to {kind}, chunk long, last boolean, data binary, payload_bytes long, payload_digest string"


def plan_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``pages`` as (page_id, url, html, bytes, digest, record_type, refers_to).

    Of equal payloads of LEAST_REVISIT bytes or more the largest id is stored, the
    others revisit it.  Only (digest, largest id) of repeated payloads is joined.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("bytes"), F.sha1(html.cast("binary")).alias("digest"))
    often = rows.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest", "bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    often = often.select(F.col("digest").alias("_d"), F.col("bytes").alias("_b"), "first")
    joined = rows.join(often, (rows["digest"] == often["_d"]) & (rows["bytes"] == often["_b"]), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "html", "bytes", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))


def to_chunks(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A row per chunk, those of a record together and in order; the first carries what the headers need."""
    stored = F.col("record_type") == "response"
    count = F.when(stored, F.greatest(F.lit(1), F.ceil(F.col("bytes") / chunk))).otherwise(F.lit(1)).cast("int")
    data = F.col("html").cast("binary")
    rows = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), count - 1)))
    part = F.when(stored, F.substring(data, F.col("chunk") * chunk + 1, F.lit(chunk))).otherwise(F.lit(b""))
    return rows.select(F.col("page_id").cast("string").alias("id"), "url", "bytes", "digest", "record_type", F.col("refers_to").cast("string").alias("refers_to"), "chunk", (F.col("chunk") == count - 1).alias("last"), part.alias("data"))


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _record_id(page_id: str | None) -> str:
    return f"urn:page:{'null' if page_id is None else quote(page_id, safe='-')}"


def _base32(digest: str) -> str:
    return base64.b32encode(bytes.fromhex(digest)).decode()


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write one archive a partition; settled rows (path, records)."""
    target, root = _open(folder)
    target.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = _open(folder)
        draft = f"{base}/.part-{context.partitionId():06d}-{context.taskAttemptId()}.tmp"
        records = 0
        with store.open_output_stream(draft) as out:
            packer = None
            for batch in batches:
                for page_id, url, size, digest, kind, refers, chunk, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if chunk == 0:
                        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
                        length = len(http) + (size if kind == "response" else 0)
                        head = [
                            "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_record_id(page_id)}>", f"WARC-Date: {DATE}",
                            f"WARC-Payload-Digest: sha1:{_base32(digest)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {length}",
                        ]
                        if url is not None:
                            head.insert(3, f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]' + chr(39))}")
                            head.append(f"X-Original-URI: {base64.b64encode(url.encode()).decode()}")
                        if kind == "revisit":
                            head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_record_id(refers)}>"]
                        out.write(packer.compress(("\r\n".join(head) + "\r\n\r\n").encode() + http))
                        records += 1
                    out.write(packer.compress(data))
                    if last:
                        out.write(packer.compress(b"\r\n\r\n") + packer.flush())
        path = f"{base}/part-{context.partitionId():06d}.warc.gz"
        if records:
            store.move(draft, path)
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["path", "records"])
        else:
            store.delete_file(draft)

    return settle(chunks.mapInArrow(run, "path string, records long"))


def _members(stream, step: int = 1 << 18) -> Iterator[Iterator[bytes]]:
    """The gzip members of a file, each as an iterator of unpacked pieces."""
    left = b""

    def pieces() -> Iterator[bytes]:
        nonlocal left
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            if not left:
                left = stream.read(step)
                if not left:
                    raise EOFError("an archive ends inside a record")
            out = unpack.decompress(left, step)
            left = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
            if out:
                yield out

    while left or (left := stream.read(step)):
        yield pieces()


def _headers(buffer: bytearray, pieces: Iterator[bytes]) -> dict[str, str]:
    """The header lines at the start of the buffer, which is refilled and cut behind them."""
    while (end := buffer.find(b"\r\n\r\n")) < 0:
        buffer += next(pieces)
    lines = bytes(buffer[:end]).decode().split("\r\n")
    del buffer[: end + 4]
    return dict(x.split(": ", 1) for x in lines[1:])


def read_archives(archives: DataFrame, folder: str, chunk: int = CHUNK, kind: str = "bigint", with_data: bool = True) -> DataFrame:
    """The table of chunks of these archives: bytes and digest of a record grow from chunk to chunk.

    The last row of a record has the size and digest of the whole payload; those
    of a revisit are what its headers say, as its payload is not stored.
    """
    names = [x.split()[0] for x in CHUNKS.split(", ")]

    def rows_of(path: str) -> Iterator[tuple]:
        store, _ = _open(folder)
        with store.open_input_stream(path, compression=None) as stream:
            for pieces in _members(stream):
                buffer = bytearray()
                head = _headers(buffer, pieces)
                http = _headers(buffer, pieces)
                record = head["WARC-Record-ID"].strip("<>")
                refers = head.get("WARC-Refers-To", "").strip("<>")
                url = base64.b64decode(head["X-Original-URI"]).decode() if "X-Original-URI" in head else None
                named = head["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(http["Content-Length"])
                page = lambda x: None if x in ("", "urn:page:null") else int(x.removeprefix("urn:page:"))
                fixed = (record, page(record), url, head["WARC-Type"], page(refers))
                if head["WARC-Type"] == "revisit":
                    yield *fixed, 0, True, b"", size, base64.b32decode(named).hex()
                    for _ in pieces:
                        pass
                    continue
                digest, done, number = hashlib.sha1(), 0, 0
                while True:
                    want = min(chunk, size - done)
                    while len(buffer) < want:
                        buffer += next(pieces)
                    data = bytes(buffer[:want])
                    del buffer[:want]
                    digest.update(data)
                    done += want
                    yield *fixed, number, done == size, data if with_data else None, done, digest.hexdigest()
                    number += 1
                    if done == size:
                        break
                if base64.b32encode(digest.digest()).decode() != named:
                    raise ValueError(f"{record} in {path} has another digest than its header says")
                for _ in pieces:
                    pass

    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, weight = [], 0
                for row in rows_of(path):
                    held.append(row)
                    weight += len(row[7] or b"") + 256
                    if weight > 4 * chunk:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)
                        held, weight = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=names)

    return archives.select("path").mapInArrow(run, CHUNKS.format(kind=kind))


def round_trip(pages: DataFrame, folder: str, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` to archives in the folder and read them back as chunks, without their data.

    A null html is an empty payload; null urls and ids are kept as null; equal
    rows are records of their own, and if they share the largest id all of them
    are stored; other columns are not archived; an empty table gives no archives
    and no rows.
    """
    small_batches(pages.sparkSession)
    archives = write_archives(to_chunks(plan_records(pages), chunk), folder)
    return read_archives(archives.repartition(max(1, archives.count())), folder, chunk, with_data=False)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back; one row a record."""
    rows = round_trip(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return rows.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM m
"""
