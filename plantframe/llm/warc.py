"""Web archives with dictionary-compressed records (.warc.zst).

A Zstandard dictionary is trained on archived records and stands in a skippable frame at the start of each archive;
every record is a frame of its own, compressed with it, so one record can be read without the others. Payloads that
equal an earlier page's are written as revisits.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import staged, with_group

#: Fixed values of the formats: magic number of the dictionary's frame, profile of revisits.
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records the dictionary is trained on, bytes taken of each, size of the dictionary; bytes after which an archive ends.
SAMPLE, SAMPLE_BYTES, DICTIONARY, ARCHIVE = 1024, 4096, 1 << 16, 16 << 20
LEVEL = 3


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, place: str, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC/1.1 record with an HTTP response; a revisit has its header only, whose length field is the payload's."""
    revisit, digest = refers_to is not None, payload_digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{place}")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {date}"]
    head += [f"WARC-Target-URI: {_field(url)}"] if url else []
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head += [f"Page-ID: {page_id}"] if page_id is not None else []
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}"] + [f"Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says, with its payload checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    number = lambda n: int(fields[n]) if n in fields else None
    return {"page_id": number("Page-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("Refers-To-Page-ID"), "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload}


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary from sample records; empty if there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    scheme, sep, rest = folder.partition("://")
    return fs.FileSystem.from_uri(folder if sep else f"file://{folder.removeprefix('file:')}")


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of one archive, each frame decompressed by itself."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        size = struct.unpack_from("<I", data, 4)[0]
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        at = 8 + size
    reader, view = zstandard.ZstdDecompressor(dict_data=dictionary), memoryview(data)
    while at < len(data):
        one = reader.decompressobj()
        # A frame ends where its decompressor leaves bytes over.
        end = min(len(data), at + (1 << 14))
        out = [one.decompress(view[at:end])]
        while not one.eof and end < len(data):
            more = min(len(data), end + (1 << 20))
            out.append(one.decompress(view[end:more]))
            end = more
        if not one.eof:
            raise ValueError("archive ends within a record")
        at = end - len(one.unused_data)
        yield b"".join(out)


def _write(folder: str, dictionary, date: str, archive_bytes: int, level: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _store(folder)
        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store.create_dir(root, recursive=True)
        raw = dictionary.value
        writer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None, write_content_size=True)
        number, parts, held, records, written = 0, [], 0, 0, []

        def close():
            nonlocal number, parts, held, records
            name, aside = f"{root}/pages-{task:06d}-{number:06d}.warc.zst", f"{root}/_{task}-{number}-{attempt}"
            with store.open_output_stream(aside) as out:
                if raw:
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
                for x in parts:
                    out.write(x)
            # Whole under its final name or not at all; another attempt writes the same bytes.
            store.move(aside, name)
            written.append((f"pages-{task:06d}-{number:06d}.warc.zst", records, held))
            number, parts, held, records = number + 1, [], 0, 0

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
                frame = writer.compress(record(page_id, f"{task}:{number}:{records}", url, html.encode(), refers_to, date))
                parts.append(frame)
                held, records = held + len(frame), records + 1
                if held >= archive_bytes:
                    close()
        if parts:
            close()
        names, counts, sizes = zip(*written) if written else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["archive", "records", "bytes"])

    return of


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z", archive_bytes: int = ARCHIVE, level: int = LEVEL,
) -> DataFrame:
    """Write a record per row of ``pages`` to archives in ``folder`` (any store that pyarrow can open): archive, records, bytes.

    Of equal payloads of at least ``min_revisit_bytes`` bytes the row with the smallest id is the response and the
    others revisit it; smaller ones are all responses. Rows that share that id are all responses. A null id revisits any
    other, a null payload is empty, a null url is left out. Without enough records to train
    on there is no dictionary and frames are plain. An empty table writes no archive.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"))
    # About twice the sample passes the hash, so what tasks send does not grow with the table.
    share = 2 * SAMPLE / max(1, pages.count())
    by_hash = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 40))
    sample = rows.filter(by_hash <= F.lit(int(share * (1 << 40)))).select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html"), by_hash.alias("h"))
    sample = sample.orderBy("h", "page_id", "html").limit(SAMPLE).select("page_id", "url", "html").collect()
    samples = [record(i, "", url, text.encode(), None, date) for i, url, text in sample]
    dictionary = spark.sparkContext.broadcast(train(samples))
    rows = rows.withColumn("sha", F.sha1("html"))
    keys = staged(rows.select("page_id", "sha", F.octet_length("html").alias("size")))
    groups = with_group(keys.filter(F.col("size") >= min_revisit_bytes), ["sha", "size"], {"first": F.min("page_id")}, {"first": F.min("first")})
    again = groups.filter("first is not null and not page_id <=> first").select(F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), F.col("first").alias("refers_to")).distinct()
    marked = rows.join(staged(again), F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left")
    return marked.select("page_id", "url", "html", "refers_to").mapInArrow(_write(folder, dictionary, date, archive_bytes, level), "archive string, records long, bytes long")


def read_archives(spark, folder: str) -> DataFrame:
    """All records of the archives in ``folder``: page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload."""
    kind = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for one in read_archive(data.as_py()):
                    rows.append(parse(one))
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(of, kind)


SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def archive_folder(spark) -> str:
    return f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
