"""WARC archives as chunked record tables.

An archive is a Parquet table of (record_no, chunk_no, data): the data of a record's chunks,
one after the other, is one gzip member that holds one WARC/1.1 record. Payloads pass through
in pieces, and each chunk row carries the count and digest of the payload up to its end, so
neither writer nor reader holds a second copy of a payload, however long. A record is read where
its chunks lie; the reader holds at most ``HELD_BYTES`` of compressed chunks for those it must pass on.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 256 << 10
HELD_BYTES = 16 << 20
_FEED = 256 << 10
_BATCH_BYTES = 4 << 20
CHUNK_DDL = "record_no long, chunk_no long, data binary, payload_bytes long, running_sha1 string"
RECORD_DDL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, n_chunks long"
# a chunk, or the row of a record that is read already; the other columns are null
_PART_DDL = "record_no long, chunk_no long, data binary, bytes_so_far long, running_sha1 string, " + RECORD_DDL
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:wardline:record")


class DamagedArchive(ValueError):
    """A record whose bytes do not give the digest or length that it states."""


def bare_digest(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def mark_revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to) of every row; refers_to is null for responses.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the largest id are
    responses and the others revisit it. Null payloads are empty ones. A null id never is the
    largest, unless all of its group are null: then all are responses, as are rows that repeat
    the largest id. Equal payloads are told by SHA-1 and length.
    """
    payload = F.coalesce(pages[f"`{payload_col}`"], F.lit("")).cast("binary")
    rows = pages.select(
        pages[f"`{id_col}`"].alias("page_id"),
        pages[f"`{url_col}`"].alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("sha1"),
        F.length(payload).alias("_bytes"),
    )
    # one short row per payload that occurs more than once
    groups = (
        rows.where(F.col("_bytes") >= min_bytes)
        .groupBy("sha1", "_bytes")
        .agg(F.max("page_id").alias("_largest"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return rows.join(groups, ["sha1", "_bytes"], "left").select(
        "page_id", "url", "payload", "sha1",
        F.when(~F.col("page_id").eqNullSafe(F.col("_largest")), F.col("_largest")).alias("refers_to"),
    )


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id} {digest}')}>"


def _head(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, f"{digest} revisit" if revisit else digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + (0 if revisit else size))),
    ]
    if page_id is not None:
        fields.append(("WARC-Page-ID", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("WARC-Refers-To-Page-ID", str(refers_to)),
        ]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + http


def _chunks(row: dict, chunk_bytes: int, date: str) -> Iterator[tuple[int, bytes, int, str]]:
    payload = memoryview(row["payload"])
    digest = bare_digest(bytes.fromhex(row["sha1"]))
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    sha1, done, number = hashlib.sha1(), 0, 0
    held = bytearray(packer.compress(_head(row["page_id"], row["url"], digest, len(payload), row["refers_to"], date)))
    sent = payload if row["refers_to"] is None else payload[:0]
    for at in range(0, len(sent), _FEED):
        piece = sent[at : at + _FEED]
        sha1.update(piece)
        done += len(piece)
        held += packer.compress(piece)
        while len(held) >= chunk_bytes:
            yield number, bytes(held[:chunk_bytes]), done, sha1.copy().hexdigest()
            del held[:chunk_bytes]
            number += 1
    held += packer.compress(b"\r\n\r\n") + packer.flush()
    for at in range(0, len(held), chunk_bytes):
        yield number, bytes(held[at : at + chunk_bytes]), done, sha1.hexdigest()
        number += 1


def chunk_table(marked: DataFrame, chunk_bytes: int = CHUNK_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """The chunk rows of the records that ``mark_revisits`` returns, a record's rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CHUNK_DDL.split(", ")]
        record = TaskContext.get().partitionId() << 40
        made: list[tuple] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_buffer() if c == "payload" else batch.column(c)[i].as_py() for c in batch.schema.names}
                for chunk in _chunks(row, chunk_bytes, date):
                    made.append((record, *chunk))
                    size += len(chunk[1]) + 100
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], names=names)
                        made, size = [], 0
                record += 1
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made, strict=True)], names=names)

    return marked.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, CHUNK_DDL)


def write_archive(marked: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write the chunk table; its data is compressed already. A task's files are kept whole or not at all."""
    chunk_table(marked, chunk_bytes).write.option("compression", "none").parquet(folder)


class _Reader:
    """One record, fed with its chunks in order."""

    def __init__(self) -> None:
        self.unpack = zlib.decompressobj(31)
        self.held = bytearray()
        self.warc: dict[str, str] | None = None
        self.http: dict[str, str] | None = None
        self.sha1 = hashlib.sha1()
        self.size = self.left = self.chunks = 0

    def _fields(self) -> dict[str, str] | None:
        end = self.held.find(b"\r\n\r\n")
        if end < 0:
            return None
        lines = bytes(self.held[:end]).decode().split("\r\n")
        del self.held[: end + 4]
        return dict(x.split(": ", 1) for x in lines[1:])

    def feed(self, number: int, data: bytes, size: int, running: str) -> None:
        if number != self.chunks:
            raise DamagedArchive(f"chunk {self.chunks} is missing")
        self.chunks += 1
        while data:
            piece = self.unpack.decompress(data, _FEED)
            data = self.unpack.unconsumed_tail
            self.held += piece
            if self.warc is None and (found := self._fields()):
                self.warc = found
            if self.warc is not None and self.http is None and (found := self._fields()):
                self.http = found
                self.left = int(found["Content-Length"]) if self.warc["WARC-Type"] == "response" else 0
            if self.http is not None and (n := min(self.left, len(self.held))):
                self.sha1.update(memoryview(self.held)[:n])
                del self.held[:n]
                self.left -= n
                self.size += n
            if not piece and not data:
                break
        # the writer's count may be ahead by what its compressor still holds
        if self.size > size or (self.size == size and self.sha1.hexdigest() != running):
            raise DamagedArchive(f"chunk {number} does not give its running digest")

    def record(self) -> tuple:
        if self.warc is None or self.http is None or self.left or bytes(self.held) != b"\r\n\r\n" or not self.unpack.eof:
            raise DamagedArchive("a record is cut short")
        digest = self.warc["WARC-Payload-Digest"].removeprefix("sha1:")
        if self.warc["WARC-Type"] == "response" and digest != bare_digest(self.sha1.digest()):
            raise DamagedArchive(f"{self.warc['WARC-Record-ID']} does not give its digest")
        page, refers = self.warc.get("WARC-Page-ID"), self.warc.get("WARC-Refers-To-Page-ID")
        return (
            int(page) if page else None, self.warc.get("WARC-Target-URI"), self.warc["WARC-Type"], int(self.http["Content-Length"]),
            digest, int(refers) if refers else None, self.chunks,
        )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*((x.as_py() for x in column) for column in batch.columns), strict=True)


def _batches(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``_BATCH_BYTES`` of data."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in (f.split() for f in ddl.split(", "))])
    made: list[tuple] = []
    size = 0
    for row in rows:
        made.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= _BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)
            made, size = [], 0
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)


def _read_in_place(chunks: Iterator[tuple], held_bytes: int) -> Iterator[tuple]:
    """Rows of records whose chunks follow one another here; the chunks of all others, as they are."""
    no_record = (None,) * len(RECORD_DDL.split(", "))
    reader, current, size = None, None, 0
    held: list[tuple] = []
    for row in chunks:
        record, number, data, done, running = row
        if number == 0 or reader is None or record != current or number != reader.chunks or size + len(data) > held_bytes:
            yield from held
            reader, current, held, size = _Reader() if number == 0 else None, record, [], 0
        if reader is None:
            yield *row, *no_record
            continue
        reader.feed(number, data, done, running)
        if reader.unpack.eof:
            yield record, None, None, None, None, *reader.record()
            reader, held = None, []
        else:
            held.append((*row, *no_record))
            size += len(data)
    yield from held


def _read_parts(parts: Iterator[tuple]) -> Iterator[tuple]:
    """Every record's row, from parts by record and chunk; rows of records come before chunks."""
    reader, current = None, None
    for record, number, data, done, running, *found in parts:
        if record != current:
            if reader is not None:
                yield reader.record()
            reader, current = _Reader() if number is not None else None, record
            if reader is None:
                yield tuple(found)
                continue
        elif reader is None:
            raise DamagedArchive(f"record {record} is there twice")
        reader.feed(number, data, done, running)
    if reader is not None:
        yield reader.record()


def read_archive(spark: SparkSession, folder: str, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per record, each payload streamed through its digest and checked.

    A task reads the records whose chunks it meets whole and in order, as they were written, and
    moves their rows only. Chunks of a record that lie otherwise (cut by a split of a file, out of
    order, or of more than ``held_bytes`` compressed) meet in one task in order; it holds one
    chunk at a time. Raises ``DamagedArchive`` in the task where bytes, count or digest do not
    agree, or where a record comes twice. An archive without records gives an empty table; a
    record with an empty payload has one row like any other.
    """
    chunks = spark.read.schema(CHUNK_DDL).parquet(folder)
    parts = chunks.mapInArrow(lambda batches: _batches(_read_in_place(_rows(batches), held_bytes), _PART_DDL), _PART_DDL)
    parts = parts.repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    return parts.mapInArrow(lambda batches: _batches(_read_parts(_rows(batches)), RECORD_DDL), RECORD_DDL)
