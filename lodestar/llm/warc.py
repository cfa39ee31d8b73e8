"""WARC archives through a chunked record table.

Writing: payloads become rows (record, chunk number, bytes) in the JVM, are
shuffled and sorted as such, and one task streams each record's chunks into a
gzip member of its archive file: neither the shuffle nor the task ever holds a
whole payload as one value.  Reading yields the same table; every chunk row
carries the SHA-256 of the payload up to and including it, so the last chunk
has the record's digest without a further pass.

Payloads of at least ``least`` bytes that occur more than once are stored once;
the other records are ``revisit`` records that name the first one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm.common import materialize, ship
from lodestar.llm.storage import create, open_file
from lodestar.session import scratch_path

CHUNK_BYTES = 1 << 16
REVISIT_LEAST = 100  # payloads below this many bytes are always stored
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(33, 127))).replace("%", "")
_END = b"\r\n\r\n"

CHUNK_SCHEMA = ("record_key string, record_id string, record_type string, target_uri string, refers_to string, "
                "chunk_no int, n_bytes int, data binary, total_bytes long, digest string, is_last boolean")


def chunk_rows(pages: DataFrame, record_key: str, payload: str, uri: str, chunk_bytes: int = CHUNK_BYTES,
               least: int = REVISIT_LEAST) -> DataFrame:
    """The chunked record table of a table of payloads (string or binary column).

    Chunk -1 is a record's head: digest, size, first holder of the same
    payload.  Chunks 0.. carry the bytes.  The table is written once, so record
    numbers cannot change between its uses, whatever the input is."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(record_key).cast("string").alias("key"),
                        F.col(record_key).alias("rank"), F.col(uri).cast("string").alias("uri"), body.alias("body"))
    last = F.greatest(F.ceil(F.octet_length("body") / chunk_bytes) - 1, F.lit(0)).cast("int")
    only = lambda c: F.when(F.col("chunk_no") == 0, c)  # noqa: E731  facts about the record stand on its first chunk
    chunks = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("chunk_no")).select(
        "row", "chunk_no", *[only(F.col(c)).alias(c) for c in ("key", "rank", "uri")],
        only(F.sha2("body", 256)).alias("digest"), only(F.octet_length("body").cast("long")).alias("size"),
        F.substring("body", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))
    path = scratch_path(spark, "warc-chunks")
    chunks.write.option("compression", "zstd").parquet(path)
    chunks = spark.read.parquet(path)
    heads = chunks.filter("chunk_no = 0").drop("data", "chunk_no")
    first = F.struct(F.col("rank").isNull().alias("last"), "rank", "row", "key")
    owners = (heads.filter(F.col("size") >= least).groupBy("digest")
              .agg(F.min(first).alias("first"), F.count("row").alias("n")).filter("n > 1")
              .select("digest", F.col("first.row").alias("owner"), F.col("first.key").alias("owner_key")))
    again = F.coalesce(F.col("owner") != F.col("row"), F.lit(False))
    heads = heads.join(owners, "digest", "left").select(
        "row", F.lit(-1).alias("chunk_no"), "key", "uri", "digest", "size",
        F.when(again, F.col("owner")).alias("owner"), F.when(again, F.col("owner_key")).alias("owner_key"),
        F.lit(None).cast("binary").alias("data"))
    return heads.unionByName(chunks.select("row", "chunk_no", "data"), allowMissingColumns=True)


def _headers(fields: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode("ascii")


def _escape(value: str | None) -> str | None:
    return None if value is None else quote(value, safe=_PRINTABLE)


def _head_bytes(head: dict) -> bytes:
    """WARC header, blank line and HTTP header of one record."""
    revisit = head["owner"] is not None
    http = b"HTTP/1.1 200 OK\r\n" + _headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(head["size"]))]) + b"\r\n"
    length = len(http) + (0 if revisit else head["size"])
    return b"WARC/1.1\r\n" + _headers([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:lodestar:record:{head['row']}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _escape(head["uri"])),
        ("WARC-Payload-Digest", f"sha256:{head['digest']}"),
        ("WARC-Refers-To", f"<urn:lodestar:record:{head['owner']}>" if revisit else None),
        ("WARC-Profile", _PROFILE if revisit else None),
        ("X-Record-Key", _escape(head["key"])),
        ("X-Refers-To-Key", _escape(head["owner_key"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(length)),
    ]) + b"\r\n" + http


def _writer(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = uri = member = head = digest = None
        records = 0

        def finish() -> None:
            if head["owner"] is None and digest.hexdigest() != head["digest"]:
                raise ValueError(f"record {head['key']}: chunks do not make up its payload")
            out.write(member.compress(_END) + member.flush())

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    uri, out = create(folder, TaskContext.get().partitionId(), ".warc.gz")
                if row["chunk_no"] < 0:
                    if head is not None:
                        finish()
                    head, digest = row, hashlib.sha256()
                    member = zlib.compressobj(6, zlib.DEFLATED, 31)  # one gzip member per record
                    out.write(member.compress(_head_bytes(head)))
                    records += 1
                elif head is None or row["row"] != head["row"]:
                    raise ValueError("chunk without its record's head")
                elif head["owner"] is None:
                    digest.update(row["data"])
                    out.write(member.compress(row["data"]))
        if out is not None:
            finish()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [uri], "records": [records]})

    return write


def write_archives(pages: DataFrame, record_key: str, payload: str, uri: str, folder: str | None = None,
                   chunk_bytes: int = CHUNK_BYTES, least: int = REVISIT_LEAST) -> DataFrame:
    """Write one WARC record per row of ``pages``; returns the manifest (path, records).

    Null payloads are empty.  Of equal payloads of at least ``least`` bytes the
    row with the smallest key (nulls last; of repeated keys the first read) is
    the response.  A payload of any length is written chunk by chunk.  Nothing
    is written for an empty table.  Other columns are ignored.
    """
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "warc")
    rows = chunk_rows(pages, record_key, payload, uri, chunk_bytes, least)
    sorted_rows = rows.repartition(F.col("row")).sortWithinPartitions("row", "chunk_no")
    return materialize(sorted_rows.mapInArrow(_writer(folder), "path string, records long"), "warc-manifest")


class _Members:
    """Decompressed bytes of a file of gzip members, read in bounded pieces."""

    def __init__(self, stream, piece: int):
        self.stream, self.piece = stream, piece
        self.raw, self.buffer, self.unzip = b"", bytearray(), None

    def fill(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(self.piece)
            if not self.raw:
                return False
        if self.unzip is None:
            self.unzip = zlib.decompressobj(31)
        self.buffer += self.unzip.decompress(self.raw, self.piece)
        self.raw = self.unzip.unconsumed_tail
        if self.unzip.eof:
            self.raw, self.unzip = self.unzip.unused_data, None
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.buffer.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buffer)
            if not self.fill():
                if self.buffer:
                    raise ValueError("archive ends inside a record")
                return None
        out = bytes(self.buffer[:at])
        del self.buffer[:at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.fill():
                raise ValueError("archive ends inside a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def _fields(block: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in block.decode("ascii").split("\r\n")[1:])


def read_records(stream, chunk_bytes: int, with_data: bool) -> Iterator[dict]:
    """Chunk rows of one archive, in file order; at most two chunks are held at a time."""
    source = _Members(stream, max(chunk_bytes, 1 << 12))
    while (block := source.until(_END)) is not None:
        head = _fields(block)
        http = source.until(_END)
        declared = head["WARC-Payload-Digest"].removeprefix("sha256:")
        left, digest, done, number = int(head["Content-Length"]) - len(http) - len(_END), hashlib.sha256(), 0, 0
        revisit = head["WARC-Type"] == "revisit"
        size = int(_fields(http)["Content-Length"])
        key, uri, refers = (None if (v := head.get(h)) is None else unquote(v)
                            for h in ("X-Record-Key", "WARC-Target-URI", "X-Refers-To-Key"))
        while True:
            data = source.take(min(left, chunk_bytes))
            digest.update(data)
            left, done = left - len(data), done + len(data)
            so_far = digest.hexdigest()
            if not left and not revisit and (so_far != declared or done != size):
                raise ValueError(f"record {key}: payload does not match its digest")
            yield {
                "record_key": key, "record_id": head["WARC-Record-ID"][1:-1], "record_type": head["WARC-Type"],
                "target_uri": uri, "refers_to": refers, "chunk_no": number, "n_bytes": len(data),
                "data": data if with_data else None, "total_bytes": size if revisit else done,
                "digest": declared if revisit else so_far, "is_last": not left}
            number += 1
            if not left:
                break
        source.take(len(_END))


def read_archives(spark: SparkSession, manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES,
                  with_data: bool = True) -> DataFrame:
    """The chunked record table (``CHUNK_SCHEMA``) of the archives in ``manifest``.

    ``total_bytes`` and ``digest`` run along the chunks of a response; a
    revisit is one empty chunk with the size and digest of the payload it
    refers to.  One task reads one file at a time, in pieces of a chunk."""
    ship(spark)
    types = pa.schema([("record_key", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                       ("target_uri", pa.string()), ("refers_to", pa.string()), ("chunk_no", pa.int32()),
                       ("n_bytes", pa.int32()), ("data", pa.binary()), ("total_bytes", pa.int64()),
                       ("digest", pa.string()), ("is_last", pa.bool_())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_file(path) as stream:
                    rows, held = [], 0
                    for row in read_records(stream, chunk_bytes, with_data):
                        rows.append(row)
                        held += row["n_bytes"] if with_data else 0
                        if held >= 1 << 23 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, types)

    files = max(1, manifest.count())  # one row per write task
    return manifest.select("path").repartition(files).mapInArrow(read, CHUNK_SCHEMA)
