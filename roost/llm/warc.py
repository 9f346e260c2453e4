"""WARC archives through a table of chunks.

A payload travels as rows (record, chunk number, bytes): what is written to
and read from an archive is one chunk at a time, and the digest is carried
from chunk to chunk. Writer and reader never hold a whole record, only the
table of pages does, whose rows come that way.

Each task writes one archive of its own name and reports it; only reported
archives are read, so the files of a task that was lost or ran twice do no
harm. Records are gzip members of their own, as WARC readers expect.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers
from roost.sources.stage import new_path, stage

CHUNK_BYTES = 256 * 1024
READ_BYTES = 1 << 20
# Schemes of Spark's addresses, and those that pyarrow knows the same storage by.
SCHEMES = {
    "file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "gs": "gs", "gcs": "gs",
    "s3": "s3", "s3a": "s3", "s3n": "s3", "abfs": "abfs", "abfss": "abfss",
}
# Revisits (about 70 bytes each) that may be broadcast, so that no payload is shuffled.
MAX_BROADCAST_REVISITS = 500_000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def store_address(address: str) -> str:
    """Spark's address of a folder as pyarrow writes it; a ValueError if archives cannot be stored there.

    An absolute path without a scheme is a folder of the local machine, as in Spark's local mode.
    """
    if address.startswith("/"):
        return f"file://{address}"
    scheme, colon, rest = address.partition(":")
    known = SCHEMES.get(scheme.lower())
    if not colon or known is None or not rest.startswith("/"):
        raise ValueError(f"archives need an address of one of {', '.join(SCHEMES)} or an absolute path, not {address!r}")
    # A single slash, as Hadoop prints local addresses, means an empty host.
    return f"{known}:{rest}" if rest.startswith("//") else f"{known}://{rest}"


def with_first(pages: DataFrame, at_least: int = 0, max_broadcast: int = MAX_BROADCAST_REVISITS) -> DataFrame:
    """page_id, url, payload, its length and digest, and ``refers_to``: the page that holds the same payload.

    Of equal payloads of at least ``at_least`` bytes the smallest page_id is
    the response, the others refer to it; repeated rows of that page_id are
    responses too. Null ids refer to the smallest that is not null; if there
    is none, all are responses. A null html counts as empty. The list of
    revisits is stored and counted; up to ``max_broadcast`` rows are broadcast.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("n_bytes"),
        F.sha1(payload).alias("sha1"),
    )
    first = rows.groupBy("sha1", "n_bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Only payloads that occur again are looked up; the rest of the pages need no partner.
    again = first.where((F.col("n") > 1) & (F.col("n_bytes") >= at_least)).drop("n")
    ids = rows.select("page_id", "sha1", "n_bytes").join(again, ["sha1", "n_bytes"])
    revisits = ids.where(~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("_page"), F.col("sha1").alias("_sha1"), F.col("first").alias("refers_to")
    ).distinct()
    revisits = stage(revisits, "revisits")
    if revisits.count() <= max_broadcast:
        revisits = F.broadcast(revisits)
    same = rows["page_id"].eqNullSafe(revisits["_page"]) & (rows["sha1"] == revisits["_sha1"])
    return rows.join(revisits, same, "left").select(*rows.columns, "refers_to")


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, in order: (page_id, url, refers_to, n_bytes, sha1, chunk, last, data).

    Revisits and empty payloads have one chunk without bytes. The rows of a
    record stay together in their partition.
    """
    pieces = F.when(F.col("refers_to").isNotNull(), F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / chunk_bytes)).cast("int")
    )
    rows = records.withColumn("pieces", pieces).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    data = F.when(F.col("refers_to").isNotNull(), F.lit(b"")).otherwise(
        F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    )
    return rows.select(
        "page_id", "url", "refers_to", "n_bytes", "sha1", "chunk", (F.col("chunk") == F.col("pieces") - 1).alias("last"), data.alias("data")
    )


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def bare_digest(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def header(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(row['page_id'])}",
        f"WARC-Target-URI: {' '.join((row['url'] or '').split())}",
        "WARC-Date: 2024-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{bare_digest(row['sha1'])}",
        f"X-Page-ID: {'' if row['page_id'] is None else row['page_id']}",
        f"X-Payload-Length: {row['n_bytes']}",
        f"Content-Length: {len(HTTP_HEAD) + (0 if revisit else row['n_bytes'])}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(row['refers_to'])}",
            f"X-Refers-To-Page-ID: {row['refers_to']}",
        ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8")


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task below ``folder``; returns the stored list (path, n_records)."""
    folder = store_address(folder)
    ready_workers(chunks.sparkSession)
    names = ("page_id", "url", "refers_to", "n_bytes", "sha1", "chunk", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        path = f"{root}/{uuid.uuid4().hex}.warc.gz"
        out, records = None, 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in names]
            data = batch.column("data")
            for i, values in enumerate(zip(*columns, strict=True)):
                row = dict(zip(names, values, strict=True))
                if out is None:
                    out = store.open_output_stream(path, compression=None)
                if row["chunk"] == 0:
                    member = zlib.compressobj(1, zlib.DEFLATED, 31)
                    digest = hashlib.sha1()
                    out.write(member.compress(header(row) + HTTP_HEAD))
                piece = data[i].as_py() or b""
                digest.update(piece)
                out.write(member.compress(piece))
                if row["last"]:
                    if row["refers_to"] is None and digest.hexdigest() != row["sha1"]:
                        raise ValueError(f"page {row['page_id']}: chunks do not add up to the payload")
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    records += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": pa.array([records], pa.int64())})

    return stage(chunks.mapInArrow(run, "path string, n_records bigint"), "archives")


class Unzipped(io.RawIOBase):
    """The bytes of consecutive gzip members, some at a time."""

    def __init__(self, raw) -> None:
        self.raw, self.member, self.rest = raw, zlib.decompressobj(31), b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while True:
            if not self.rest:
                self.rest = self.raw.read(READ_BYTES)
                if not self.rest:
                    return 0
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            made = self.member.decompress(self.rest, len(into))
            self.rest = self.member.unconsumed_tail or self.member.unused_data
            if made:
                into[: len(made)] = made
                return len(made)


def read_records(raw, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of one archive, with the payload's digest so far."""
    source = io.BufferedReader(Unzipped(raw), READ_BYTES)
    while True:
        line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin where one should")
        fields = {}
        while (line := source.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8")
        left = int(fields["content-length"])
        while True:
            line = source.readline()
            left -= len(line)
            if line in (b"\r\n", b""):
                break
        digest, chunk = hashlib.sha1(), 0
        while True:
            data = source.read(min(left, chunk_bytes))
            if len(data) < min(left, chunk_bytes):
                raise ValueError("an archive ends inside a record")
            left -= len(data)
            digest.update(data)
            yield {
                "page_id": int(fields["x-page-id"]) if fields["x-page-id"] else None,
                "record_type": fields["warc-type"],
                "refers_to": int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
                "payload_bytes": int(fields["x-payload-length"]),
                "stated_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
                "chunk": chunk,
                "last": left == 0,
                "data": data,
                "digest_so_far": base64.b32encode(digest.digest()).decode(),
            }
            chunk += 1
            if left == 0:
                break
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")


CHUNK_ROWS = (
    "page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, stated_digest string, "
    "chunk int, last boolean, data binary, digest_so_far string"
)
CHUNK_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("stated_digest", pa.string()),
        ("chunk", pa.int32()),
        ("last", pa.bool_()),
        ("data", pa.binary()),
        ("digest_so_far", pa.string()),
    ]
)


def read_archives(archives: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunk rows of all listed archives; without data, every payload is still read and digested."""
    folder = store_address(folder)
    ready_workers(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as raw:
                    for row in read_records(raw, chunk_bytes):
                        rows.append(row if with_data else row | {"data": None})
                        held += len(row["data"] or b"") if with_data else 0
                        if held >= 8 * READ_BYTES or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=CHUNK_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=CHUNK_ARROW)

    # One archive is one task's work: each goes to a task of its own.
    paths = archives.select("path")
    count = max(1, archives.count())
    return paths.repartition(count, "path").mapInArrow(run, CHUNK_ROWS)


def archive_round_trip(spark: SparkSession, pages: DataFrame, at_least: int = 0) -> DataFrame:
    """Write all pages, read the archives back, and tell what each record holds.

    (page_id, payload_bytes, payload_digest, record_type, refers_to). A
    response's digest is that of the bytes read; if it is not the stated one,
    the record is damaged and that is an error. A revisit has its response's.
    An empty table gives no rows. Storage that archives cannot be written to is
    refused before any work.
    """
    folder = store_address(new_path(spark, "warc"))
    archives = write_archives(chunk_table(with_first(pages, at_least)), folder)
    last = read_archives(archives, folder, with_data=False).where("last")
    digest = F.when(F.col("record_type") == "revisit", F.col("stated_digest")).otherwise(F.col("digest_so_far"))
    sound = F.when(
        (F.col("record_type") == "revisit") | (F.col("stated_digest") == F.col("digest_so_far")), digest
    ).otherwise(F.raise_error(F.concat(F.lit("damaged record of page "), F.col("page_id").cast("string"))))
    return last.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")
