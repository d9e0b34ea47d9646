"""Web archives written from and read into a chunked record table.

A payload is a run of rows ``(record_no, chunk_no, data)`` of at most ``CHUNK`` bytes, each with the SHA-1 of the
payload up to its end. Digests are carried from chunk to chunk, so that no step on the Python side ever holds a whole
record: chunks are hashed, shuffled, deflated into the archive, and inflated again one by one. The digest of a record is
that of its last chunk.

Of records with equal payloads of at least ``revisit_from`` bytes the one with the smallest page id (then record number)
is written as ``response``; the others become ``revisit`` records without payload that refer to it. The chunk table and
the archives lie in the shared folder. An archive is written by one task attempt under a name of its own and counts only
once it stands in the stored index (file, offset and length of each record), so lost executors leave no double records.
Each record is a gzip member of its own; the index lets archives be read in pieces.

Defined results: a null payload is empty; a null page id comes after all others and is read back as null; a null url is
replaced by the record's name; rows that share a page id are records of their own; an empty table gives an empty one;
other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isochron.llm.common import NO_ID, shared_folder, stored, tidy

CHUNK = 1 << 18
ARCHIVE = 1 << 30
PIECE = 1 << 26
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:record:"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_chunks(pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", chunk: int = CHUNK) -> DataFrame:
    """``record_no, page_id, url, n_bytes, chunk_no, last, data, sha1``, stored; ``sha1`` covers the payload so far."""
    given = pages.select(
        F.monotonically_increasing_id().alias("record_no"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    last = F.greatest(F.ceil(F.col("n_bytes") / chunk) - 1, F.lit(0)).cast("int")
    numbered = given.select("*", last.alias("last_no")).select("*", F.explode(F.sequence(F.lit(0), "last_no")).alias("chunk_no"))
    cut = numbered.select(
        "record_no", "page_id", "url", "n_bytes", "chunk_no", (F.col("chunk_no") == F.col("last_no")).alias("last"),
        F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("data"),
    )

    @tidy
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = hashlib.sha1()
        for batch in batches:
            made = []
            for no, data in zip(batch["chunk_no"].to_pylist(), batch["data"], strict=True):
                if no == 0:
                    running = hashlib.sha1()
                running.update(data.as_buffer())
                made.append(running.digest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, "sha1"])

    schema = "record_no long, page_id long, url string, n_bytes long, chunk_no int, last boolean, data binary, sha1 binary"
    return stored(cut.mapInArrow(digests, schema), "chunks")


def verdicts(chunks: DataFrame, revisit_from: int) -> DataFrame:
    """``record_no, digest, refers_no``: the record that holds the payload, null for the one that does."""
    records = chunks.where("last").select("record_no", "page_id", "n_bytes", F.col("sha1").alias("digest"))
    order = F.struct(F.coalesce("page_id", F.lit(NO_ID)).alias("page"), "record_no")
    first = (
        records.where(F.col("n_bytes") >= revisit_from)
        .groupBy("digest", "n_bytes")
        .agg(F.min(order)["record_no"].alias("first_no"))
    )
    own = F.col("first_no") == F.col("record_no")
    return records.join(first, ["digest", "n_bytes"], "left").select(
        "record_no", "digest", F.when(~own, F.col("first_no")).alias("refers_no")
    )


def header(fields: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode("utf-8")


class ArchiveWriter:
    """Archives of one task attempt, and the index of their records."""

    def __init__(self, folder: str, date: str, archive_bytes: int):
        self.files, self.root = pafs.FileSystem.from_uri(folder)
        self.files.create_dir(self.root, recursive=True)
        context = TaskContext.get()
        self.name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        self.date, self.archive_bytes = date, archive_bytes
        self.out, self.number, self.at = None, 0, 0
        self.index: list[tuple[str, int, int]] = []

    def write(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.at += len(data)

    def begin(self, row: dict) -> None:
        if self.out is None or self.at >= self.archive_bytes:
            self.close()
            self.path = f"{self.name}-{self.number}.warc.gz"
            self.out = self.files.open_output_stream(f"{self.root}/{self.path}", compression=None)
            self.at, self.number = 0, self.number + 1
        self.start, self.left, self.row = self.at, row["n_bytes"], row
        self.deflate, self.sha1 = zlib.compressobj(6, zlib.DEFLATED, 31), hashlib.sha1()
        revisit = row["refers_no"] is not None
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        url = quote(row["url"] or f"{NAME}{row['record_no']}", safe=":/?#[]@!$&'()*+,;=%~")
        page = [] if row["page_id"] is None else [("X-Page-Id", str(row["page_id"]))]
        refers = [("WARC-Refers-To", f"<{NAME}{row['refers_no']}>"), ("WARC-Profile", PROFILE)] if revisit else []
        fields = [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<{NAME}{row['record_no']}>"),
            ("WARC-Date", self.date),
            ("WARC-Target-URI", url),
            ("WARC-Payload-Digest", f"sha1:{base32(row['digest'])}"),
            *page,
            *refers,
            ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(http) + (0 if revisit else row["n_bytes"]))),
        ]
        self.write(self.deflate.compress(header(fields) + http))

    def chunk(self, data: bytes, last: bool) -> None:
        if self.row["refers_no"] is None:
            self.sha1.update(data)
            self.left -= len(data)
            self.write(self.deflate.compress(data))
        if last:
            if self.row["refers_no"] is None and (self.left or self.sha1.digest() != self.row["digest"]):
                raise ValueError(f"record {self.row['record_no']}: its chunks are not its payload")
            self.write(self.deflate.compress(b"\r\n\r\n") + self.deflate.flush())
            self.index.append((self.path, self.start, self.at - self.start))

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def write_archives(
    chunks: DataFrame, folder: str, revisit_from: int = 0, date: str | None = None, archive_bytes: int = ARCHIVE
) -> DataFrame:
    """Write the records below ``folder``; the stored index ``file, start, length`` of every record."""
    date = date or dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    kept = chunks.join(verdicts(chunks, revisit_from), "record_no").withColumn(
        "data", F.when(F.col("refers_no").isNull(), F.col("data")).otherwise(F.lit(b""))
    )
    rows = kept.where(F.col("refers_no").isNull() | F.col("last")).drop("sha1")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, current = None, None
        names = ["record_no", "page_id", "url", "n_bytes", "digest", "refers_no"]
        for batch in batches:
            writer = writer or ArchiveWriter(folder, date, archive_bytes)
            columns = [batch[n].to_pylist() for n in names]
            for *values, last, data in zip(*columns, batch["last"].to_pylist(), batch["data"], strict=True):
                if values[0] != current:
                    current = values[0]
                    writer.begin(dict(zip(names, values, strict=True)))
                writer.chunk(data.as_py(), last)
            yield index_batch(writer)
        if writer:
            writer.close()

    def index_batch(writer: ArchiveWriter) -> pa.RecordBatch:
        files, starts, lengths = zip(*writer.index, strict=True) if writer.index else ((), (), ())
        writer.index.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(files, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())],
            names=["file", "start", "length"],
        )

    ordered = rows.repartition("record_no").sortWithinPartitions("record_no", "chunk_no")
    return stored(ordered.mapInArrow(run, "file string, start long, length long"), "warc-index")


class RecordReader:
    """Records of a run of gzip members, chunk by chunk."""

    def __init__(self, stream, length: int):
        self.stream, self.left = stream, length
        self.raw, self.buffer, self.inflate = b"", bytearray(), None

    def fill(self) -> bool:
        """More bytes of the record at hand; False at its end."""
        while True:
            if self.inflate is not None and self.inflate.eof:
                return False
            if not self.raw:
                self.raw = self.stream.read(min(CHUNK, self.left))
                self.left -= len(self.raw)
                if not self.raw:
                    raise ValueError("an archive ends within a record")
            if more := self.inflate.decompress(self.raw, CHUNK):
                self.buffer += more
            self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if more:
                return True

    def until(self, mark: bytes) -> bytes:
        while (at := self.buffer.find(mark)) < 0:
            if not self.fill():
                raise ValueError("a record ends within its header")
        found = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return found

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.fill():
            pass
        if len(self.buffer) < n:
            raise ValueError("a record is shorter than it says")
        found = bytes(self.buffer[:n])
        del self.buffer[:n]
        return found

    def records(self) -> Iterator[tuple[dict[str, str], int, Iterator[bytes]]]:
        """Header fields, payload length, payload chunks of each record; chunks must be read before the next record."""
        while self.raw or self.left:
            self.inflate, self.buffer = zlib.decompressobj(31), bytearray()
            version, *lines = self.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
            if version != "WARC/1.1":
                raise ValueError(f"no record begins here: {version[:20]!r}")
            fields = dict(line.split(": ", 1) for line in lines)
            block = int(fields["Content-Length"])
            block -= len(self.until(b"\r\n\r\n")) + 4
            yield fields, block, (self.take(min(CHUNK, block - at)) for at in range(0, block, CHUNK))
            if self.take(4) != b"\r\n\r\n" or self.buffer or self.fill():
                raise ValueError("a record does not end where it should")


def read_archives(index: DataFrame, folder: str, with_data: bool = True, piece: int = PIECE) -> DataFrame:
    """``record_no, page_id, url, record_type, refers_no, payload_digest, chunk_no, last, payload_bytes[, data]``.

    One row for each chunk as written; without ``data`` one for each record. ``payload_bytes`` counts to the chunk's
    end. Payloads are hashed on the way and must have the digest that the record names.
    """
    pieces = (
        index.withColumn("piece", F.floor(F.col("start") / piece))
        .groupBy("file", "piece")
        .agg(F.min("start").alias("start"), F.sum("length").alias("length"))
    )
    # a row is small but stands for a whole piece, so the rows are not left to be merged by their size
    pieces = pieces.repartition(max(1, index.select("file", F.floor(F.col("start") / piece)).distinct().count()))
    schema = "record_no long, page_id long, url string, record_type string, refers_no long, payload_digest string, "
    schema += "chunk_no int, last boolean, payload_bytes long" + ", data binary" * with_data
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        rows, size = [], 0
        for given in batches:
            for row in given.to_pylist():
                with files.open_input_file(f"{root}/{row['file']}") as stream:
                    stream.seek(row["start"])
                    for fields, block, chunks in RecordReader(stream, row["length"]).records():
                        for out in record_rows(fields, block, chunks):
                            rows.append(out if with_data else out[:-1])
                            size += len(out[-1]) if with_data else 0
                            if len(rows) >= 4096 or size > 1 << 24:
                                yield batch(rows)
                                rows, size = [], 0
        if rows:
            yield batch(rows)

    def record_rows(fields: dict[str, str], block: int, chunks: Iterator[bytes]) -> Iterator[tuple]:
        number = lambda key: int(fields[key].strip("<>").removeprefix(NAME)) if key in fields else None
        named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        head = (
            number("WARC-Record-ID"), int(fields["X-Page-Id"]) if "X-Page-Id" in fields else None,
            fields["WARC-Target-URI"], fields["WARC-Type"], number("WARC-Refers-To"),
        )
        sha1, seen, no = hashlib.sha1(), 0, 0
        for data in chunks:
            sha1.update(data)
            seen += len(data)
            if seen == block and fields["WARC-Type"] == "response" and base32(sha1.digest()) != named:
                raise ValueError(f"record {head[0]}: its payload has another digest")
            if with_data or seen == block:
                yield (*head, named, no, seen == block, seen, data)
            no += 1
        if not block:
            yield (*head, named, 0, True, 0, b"")

    return pieces.mapInArrow(run, schema)


def archived_pages(
    pages: DataFrame, id_col="page_id", url_col="url", payload_col="html", revisit_from: int = 0, folder: str | None = None
) -> DataFrame:
    """Write all pages to archives, read them back, and resolve the revisits.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` as the archives have them.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    index = write_archives(record_chunks(pages, id_col, url_col, payload_col), folder, revisit_from)
    read = read_archives(index, folder, with_data=False)
    records = stored(read.select("record_no", "page_id", "record_type", "refers_no", "payload_digest", "payload_bytes"), "records")
    responses = records.where("record_type = 'response'").select(
        F.col("record_no").alias("refers_no"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes")
    )
    return records.join(responses, "refers_no", "left").select(
        "page_id", F.coalesce("full_bytes", "payload_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
