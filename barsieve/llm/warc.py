"""WARC archives of web pages, each record compressed by itself with a dictionary made from the archive's records.

An archive is a Zstandard file: a skippable frame with the dictionary, then a frame for every WARC record, each followed
by an empty skippable frame. So a reader can start at any record once it has the dictionary, and standard tools take the
file as one stream. Of pages with equal payloads the one with the largest page_id is written as a `response` record,
the others as `revisit` records, which name that page and have its digest and length but no payload.

A payload is the page's html in UTF-8; a null is empty, and empty payloads are equal like any others. Rows that share a
page_id and a payload are all response records if that page_id is the largest. Rows without a page_id come before all
others: they are response records where no row with that payload has one, and revisit it otherwise. A page without a url
has no target URI; characters that would end a header line are percent-encoded there. An empty table gives no archive.
Further columns are not written.

Executors write archives through Spark's text writer, so they can be in any store that Spark reaches: the empty frame
after each record is its line separator. A task writes archives of `ARCHIVE_BYTES` of records, or one longer record, and
holds one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsieve.llm.common import staged

#: Bytes of records in an archive, of its dictionary, and of the records, evenly spaced, that the dictionary is made from.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 20, 32 << 10, 4 << 20
LEVEL = 3
#: Payloads from this size on are written once.
LEAST_BYTES = 0
#: Bytes of payloads that the reader hands on at a time.
READ_BYTES = 4 << 20

# The magic numbers of the dictionary frame and of an empty frame that readers skip, and the names in records.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_PAGE = "<urn:page:{}>"
_PAGE_ID = re.compile(r"<urn:page:(-?\d+|none)>")


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def planned(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """`page_id`, `url`, `html` and, for pages whose payload another record has, that record's page: `refers_to`.

    Payloads are told apart by their SHA-256 and length. Only those of several pages are joined, and a payload that many
    pages share has one row there, so Spark can split its pages.
    """
    payload = F.coalesce("html", F.lit(""))
    size = F.octet_length(payload)
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("key"), size.alias("size"))
    heads = rows.where(size >= least_bytes).groupBy("key", "size")
    heads = heads.agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    heads = staged(heads.select("key", "size", "head"), "payloads")
    other = ~F.col("page_id").eqNullSafe(F.col("head"))
    found = rows.join(heads, ["key", "size"], "left")
    return found.select("page_id", "url", "html", F.when(other, F.col("head")).alias("refers_to"))


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{name}: {value}".encode() for name, value in fields], b"Content-Length: %d" % len(block)]
    return b"\r\n".join([*lines, b"", block, b"", b""])


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def page_record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit of the page that `refers_to` names."""
    payload = (html or "").encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit")]
    fields += [("WARC-Record-ID", _PAGE.format("none" if page_id is None else page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _PAGE.format(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}")]
    fields.append(("Content-Type", "application/http; msgtype=response"))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    return _record(fields, head + payload if refers_to is None else head)


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES) -> bytes:
    """A dictionary trained on the records, or on evenly spaced ones of about `sample` bytes in all.

    Where there is too little to train on, it is the beginning of the records themselves.
    """
    step = max(1, -(-sum(map(len, records)) // sample))
    try:
        return zstandard.train_dictionary(size, records[::step]).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:size]


def frames(records: list[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The frames of an archive: its dictionary, then each record."""
    made = dictionary(records)
    yield struct.pack("<II", DICTIONARY_MAGIC, len(made)) + made
    compressor = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(made))
    for record in records:
        yield compressor.compress(record)


def write_archives(pages: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the planned pages as archives `archive=<task>-<number>.warc.zst` below a new folder."""

    def batch(name: str, records: list[bytes]) -> Iterator[pa.RecordBatch]:
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", date)]
        info += [("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
        made = list(frames([_record(info, b"format: WARC File Format 1.1\r\n"), *records]))
        columns = [pa.array([name] * len(made)), pa.array(range(len(made)), pa.int64()), pa.array(made, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["archive", "place", "frame"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for rows in batches:
            columns = [rows.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for values in zip(*columns, strict=True):
                record = page_record(*[v.as_py() for v in values], date)
                if held and size + len(record) > archive_bytes:
                    yield from batch(f"{task:06d}-{number:05d}.warc.zst", held)
                    number, held, size = number + 1, [], 0
                held.append(record)
                size += len(record)
        if held:
            yield from batch(f"{task:06d}-{number:05d}.warc.zst", held)

    made = pages.select("page_id", "url", "html", "refers_to").mapInArrow(run, "archive string, place long, frame binary")
    # the frames of an archive come in order from one task
    ordered = made.sortWithinPartitions("archive", "place")
    rows = ordered.select("archive", F.col("frame").cast("string").alias("value"))
    rows.write.option("lineSep", EMPTY_FRAME.decode()).partitionBy("archive").text(path)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one after the other: header fields by lower-case name, and block."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive without a dictionary")
    known = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    plain = zstandard.ZstdDecompressor(dict_data=known).stream_reader(content, read_across_frames=True)
    stream = io.BufferedReader(plain, 1 << 20)
    while line := stream.readline():
        if line.rstrip(b"\r\n") != VERSION:
            raise ValueError(f"no record begins with {line[:20]!r}")
        fields = _fields(stream)
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield fields, block


def _fields(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().rstrip("\r\n").partition(": ")
        found[name.lower()] = value
    return found


def _page(fields: dict[str, str], name: str) -> int | None:
    found = _PAGE_ID.fullmatch(fields.get(name, ""))
    return int(found[1]) if found and found[1] != "none" else None


def read_page(fields: dict[str, str], block: bytes) -> dict[str, object]:
    """What a response or revisit record says; a response's length and digest are taken from its payload and checked."""
    stream = io.BytesIO(block)
    stream.readline()
    length = int(_fields(stream)["content-length"])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    payload = stream.read() if fields["warc-type"] == "response" else None
    if payload is not None and (len(payload), payload_digest(payload)) != (length, digest):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its header")
    return {
        "page_id": _page(fields, "warc-record-id"),
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "refers_to": _page(fields, "warc-refers-to"),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload,
    }


_READ = [
    ("page_id", pa.int64()),
    ("url", pa.string()),
    ("record_type", pa.string()),
    ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()),
    ("payload", pa.binary()),
]


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for every page record of the archives below a folder, with its payload if wanted; a revisit has none.

    An archive is one task's work; records come out in batches of `READ_BYTES` of payloads.
    """
    schema = pa.schema(_READ if payloads else _READ[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for fields, block in records(content.as_buffer().to_pybytes()):
                    if fields["warc-type"] not in ("response", "revisit"):
                        continue
                    held.append(read_page(fields, block))
                    size += len(block)
                    if size > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return files.mapInArrow(run, ", ".join(f"{f.name} {names[f.type]}" for f in schema))
