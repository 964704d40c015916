"""Web archives of individually compressed records that share a dictionary.

An archive begins with a skippable Zstandard frame that holds the dictionary. Every record after it
is a frame of its own, so a record can be read alone with its offset and the dictionary.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.llm.batches import steps
from carelayers.sources.layers import shared_folder

#: Payloads of at least so many bytes are stored once.
LEAST_SHARED = 100
#: A payload with more than one in so many of all pages joins by broadcast; at most so many do.
HOT_SHARE = 1000
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
#: The dictionary learns from at most so many records, of at most so many bytes each.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 32 << 10
DICTIONARY_BYTES = 32 << 10

# Fixed values of the formats.
_DICTIONARY_FRAME = 0x184D2A5D
_VERSION = b"WARC/1.1\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = "urn:page:"
_CHUNK = 1 << 16
#: Records are dated by the caller; a fixed date keeps archives the same from run to run.
DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"{_PAGE}{page_id}" if page_id is not None else uuid.uuid5(uuid.NAMESPACE_OID, digest).urn


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to=None, date: str = DATE) -> bytes:
    """One WARC record: the HTTP response, or for a revisit only its head."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_record_id(page_id, digest)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # a target never breaks out of its line
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: <{_record_id(refers_to, digest)}>"]
    return _VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: Iterable[bytes]) -> dict[str, str]:
    pairs = (line.decode().partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _head(stream: BinaryIO) -> list[bytes]:
    lines = []
    while line := stream.readline():
        if line == b"\r\n":
            break
        lines.append(line)
    return lines


def _frames(raw: BinaryIO) -> Iterator[bytes]:
    """What each frame of an archive holds, without the dictionary's; ValueError if one is cut short."""
    held = raw.read(8)
    options = {}
    if len(held) == 8 and struct.unpack("<I", held[:4])[0] == _DICTIONARY_FRAME:
        options["dict_data"] = zstandard.ZstdCompressionDict(raw.read(struct.unpack("<I", held[4:])[0]))
        held = b""
    reader = zstandard.ZstdDecompressor(**options)
    while held := held or raw.read(_CHUNK):
        frame = reader.decompressobj()
        out = [frame.decompress(held)]
        while not frame.eof:
            held = raw.read(_CHUNK)
            if not held:
                raise ValueError("an archive is cut short")
            out.append(frame.decompress(held))
        held = frame.unused_data
        yield b"".join(out)


def read_records(raw: BinaryIO) -> Iterator[dict]:
    """The records of one archive, one at a time: page id, type, length, digest, refers-to, payload.

    Raises ValueError if a record is cut short or its payload does not have its digest.
    """
    for frame in _frames(raw):
        stream = io.BytesIO(frame)
        if (version := stream.readline()) != _VERSION:
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = _fields(_head(stream))
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size or stream.read() != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"wrong digest of {fields['warc-record-id']}")

        def page(name: str) -> int | None:
            value = fields.get(name, "").strip("<>")
            return int(value.removeprefix(_PAGE)) if value.startswith(_PAGE) else None

        yield {
            "page_id": page("warc-record-id"),
            "payload_bytes": int(_fields(head.split(b"\r\n")[1:])["content-length"]),
            "payload_digest": digest,
            "record_type": fields["warc-type"],
            "refers_to": page("warc-refers-to"),
            "payload": payload,
        }


def train_dictionary(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> bytes:
    """A dictionary learned from the records with the smallest hash of their id; empty if too few.

    At most ``SAMPLE_RECORDS`` whole records of at most ``SAMPLE_BYTES`` reach the driver.
    """
    length = F.octet_length(F.coalesce(html_col, F.lit("")))
    short = pages.where(F.col(id_col).isNotNull() & length.between(1, SAMPLE_BYTES))
    ids = short.select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_RECORDS)
    rows = short.join(F.broadcast(ids.distinct()), id_col, "left_semi").select(id_col, url_col, html_col)
    samples = []
    for row in rows.limit(SAMPLE_RECORDS).collect():
        payload = row[2].encode()
        samples.append(record(row[0], row[1], payload, hashlib.sha256(payload).hexdigest()))
    # A dictionary needs about ten times its size to learn from.
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes() if size else b""
    except zstandard.ZstdError:  # too little to learn from
        return b""


class _Archive:
    """An archive being written; counts its compressed bytes."""

    def __init__(self, uri: str, dictionary: bytes):
        self.uri, self.records = uri, 0
        filesystem, path = pafs.FileSystem.from_uri(uri)
        self.out = filesystem.open_output_stream(path, compression=None)
        self.bytes = 0
        options = {}
        if dictionary:
            self._write(struct.pack("<II", _DICTIONARY_FRAME, len(dictionary)) + dictionary)
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, **options)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> int:
        """Append a record; its offset."""
        offset = self.bytes
        self._write(self.compressor.compress(data))
        self.records += 1
        return offset


def assign_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id, url, html, digest, refers_to)``; a page refers to the smallest one with its payload.

    Only payloads of at least ``LEAST_SHARED`` bytes are shared; of pages with such a payload those
    with the smallest id, however many rows, are not revisits, and neither are pages without an id.
    A payload that more than one in ``HOT_SHARE`` pages have joins by broadcast: that is fewer than
    ``HOT_SHARE`` rows at any size. The others go by their digest, and pages that cannot be revisits
    by a key of their own.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "utf-8"), 256))
    shared = F.octet_length("html") >= LEAST_SHARED
    groups = rows.where(shared & F.col("id").isNotNull()).groupBy("digest")
    groups = groups.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    folder = shared_folder(pages.sparkSession, "warc-groups")
    groups.write.parquet(folder)
    groups = pages.sparkSession.read.parquet(folder)
    total = pages.count()
    hot = groups.where(F.col("n") * HOT_SHARE > total).select("digest", F.col("first").alias("hot"))
    cold = groups.where(F.col("n") * HOT_SHARE <= total).select(F.col("digest").alias("key"), "first")
    rows = rows.join(F.broadcast(hot), "digest", "left")
    alone = F.col("hot").isNotNull() | ~shared | F.col("id").isNull()
    own_key = F.concat(F.lit("page "), F.coalesce(F.col("id").cast("string"), F.hex(F.rand(7) * 2**40)))
    rows = rows.withColumn("key", F.when(alone, own_key).otherwise(F.col("digest")))
    rows = rows.join(cold, "key", "left")
    first = F.when(shared, F.coalesce("hot", "first"))
    return rows.select("id", "url", "html", "digest", F.when(F.col("id") > first, first).alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date: str = DATE,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every page as a record; the index ``(id, uri, offset)`` of records.

    Archives go below ``folder``, which all executors must share (a local, HDFS or S3 URI). Their
    names hold the attempt that wrote them, and only archives of attempts that Spark has committed
    are in the index, so a lost task leaves a file that nobody reads. NULL html is an empty payload;
    repeated rows are records of their own; an empty table gives an empty index and no archive.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(train_dictionary(pages, id_col, url_col, html_col))
    rows = assign_revisits(pages, id_col, url_col, html_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = f"{folder}/records-{task.partitionId():05d}-{task.taskAttemptId()}"
        archive, n = None, 0
        for part in steps(batches):
            index = []
            for i in range(part.num_rows):
                page, url, html, digest, first = (c[i].as_py() for c in part.columns)
                if archive is None or archive.bytes >= archive_bytes:
                    if archive is not None:
                        archive.out.close()
                    archive, n = _Archive(f"{base}-{n:05d}.warc.zst", shared.value), n + 1
                index.append((page, archive.uri, archive.add(record(page, url, html.encode(), digest, first, date))))
            ids, uris, offsets = zip(*index)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).cast(pa.int64()), pa.array(uris), pa.array(offsets, pa.int64())],
                names=["id", "uri", "offset"],
            )
        if archive is not None:
            archive.out.close()

    pafs_folder, path = pafs.FileSystem.from_uri(folder)
    pafs_folder.create_dir(path, recursive=True)
    index = rows.mapInArrow(run, "id bigint, uri string, offset bigint")
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(index: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all records.

    Each archive that the index names is read once, whole, record by record. Digests are taken from
    the payload that was read; a revisit's are those of its head, as it holds no payload. An archive
    that is damaged or lacks records of the index fails the read.
    """
    names = [f.split()[0] for f in _READ.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                filesystem, path = pafs.FileSystem.from_uri(uri)
                with filesystem.open_input_stream(path, compression=None) as raw:
                    held, n = [], 0
                    for row in read_records(raw):
                        held.append([row[c] for c in names])
                        n += 1
                        if len(held) == 4096:
                            yield _rows(held, names, types)
                            held = []
                    if n != expected:
                        raise ValueError(f"{uri} holds {n} records, the index {expected}")
                    if held:
                        yield _rows(held, names, types)

    return index.groupBy("uri").agg(F.count(F.lit(1)).alias("records")).mapInArrow(run, _READ)


def _rows(held: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*held), types)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives, shared by the executors."""
    return shared_folder(spark, "warc")
