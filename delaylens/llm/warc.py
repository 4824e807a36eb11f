"""Dictionary-compressed WARC archives.

Pages become WARC records, each compressed on its own with a Zstandard
dictionary that was trained on a bounded sample of the records; every archive
starts with a skippable frame that holds the dictionary, so it can be read alone.
Pages with equal payloads become one response and revisits of it. Each task
writes its partition's archives to the shared folder, under names that a repeated
attempt writes again; pages are not shuffled. Reading goes through Spark's
binary-file source.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm.common import lean, text_batches, unit_hash
from delaylens.session import shared_dir, stage

#: Bytes of a compressed archive before the next one starts.
ARCHIVE_BYTES = 8 * 1024 * 1024
DICTIONARY = 64 * 1024
LEVEL = 3
#: Bounds of the dictionary's sample: records, and bytes of each.
SAMPLE_RECORDS = 500
SAMPLE_BYTES = 64 * 1024
#: Repeated payloads whose first page is broadcast at most.
BROADCAST_REPEATED = 500_000
# Frame numbers of the format, and the date that archives carry.
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_FRAME = b"\x28\xb5\x2f\xfd"
DATE = "1970-01-01T00:00:00Z"
FOUND_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the payload's
    length, but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url else []),
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        *([f"WARC-Refers-To: {record_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes]) -> bytes:
    """Empty if there is too little to train on: archives then have none."""
    try:
        return zstandard.train_dictionary(DICTIONARY, [r[:SAMPLE_BYTES] for r in records], level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def leading_frame(dictionary: bytes) -> bytes:
    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE_DICTIONARY, len(packed)) + packed if dictionary else b""


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data)


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Each record's WARC headers (lower-case names) and block."""
    at, dictionary = 0, b""
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == SKIPPABLE_DICTIONARY:
        at = 8 + struct.unpack_from("<I", archive, 4)[0]
        dictionary = archive[8:at]
        if dictionary[:4] == ZSTD_FRAME:
            dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    whole = io.BytesIO(archive)
    whole.seek(at)
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=data).stream_reader(whole, read_across_frames=True))
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = {}
        while line := stream.readline().rstrip(b"\r\n"):
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        stream.read(4)
        yield headers, block


def revisits(pages: DataFrame, key: str, text: str, least: int) -> tuple[DataFrame, int]:
    """(payload_hash, first_page) of the payloads of at least `least` bytes that
    several rows have, and the number of all rows."""
    hashed = pages.select(key, F.octet_length(F.coalesce(text, F.lit(""))).alias("bytes"), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("payload_hash"))
    groups = stage(hashed.groupBy("payload_hash").agg(F.min(key).alias("first_page"), F.count("*").alias("rows"), F.min("bytes").alias("bytes")), "payloads")
    total = groups.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return groups.where((F.col("rows") > 1) & (F.col("bytes") >= least)).select("payload_hash", "first_page"), total


def write(pages: DataFrame, key: str, url: str, text: str, folder: str, least: int = 0) -> DataFrame:
    """Writes the archives below `folder` and returns (archive, records, bytes).

    Null payloads are empty ones. Of rows with equal payloads of at least `least`
    bytes those with the smallest key are responses (a repeated row is archived
    again), the others revisits; rows without a key revisit if any row of the
    payload has one. Null urls have no target. An empty table has no archives.
    Other columns are not read."""
    repeated, total = revisits(pages, key, text, least)
    few = repeated.count() <= BROADCAST_REPEATED
    rows = text_batches(pages).select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(text, F.lit("")).alias("html"))
    sampled = rows.where(unit_hash(F.col("page_id")) * total < SAMPLE_RECORDS).orderBy(unit_hash(F.col("page_id")), "html").limit(2 * SAMPLE_RECORDS)
    sample = sampled.select("page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html")).collect()
    dictionary = train_dictionary([record(r.page_id, r.url, r.html.encode(), None, False) for r in sample])
    hashed = rows.withColumn("payload_hash", F.sha2(F.col("html").cast("binary"), 256))
    marked = hashed.join(F.broadcast(repeated) if few else repeated, "payload_hash", "left").select("page_id", "url", "html", "first_page")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = arrow_fs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        packer = compressor(dictionary)
        parts, size, count, number = [], 0, 0, 0

        def close() -> pa.RecordBatch:
            name = f"{root}/part-{task.partitionId():06d}-{number:05d}.warc.zst"
            draft = f"{root}/_draft-{task.taskAttemptId()}-{number}"
            with fs.open_output_stream(draft) as out:
                out.write(leading_frame(dictionary))
                for p in parts:
                    out.write(p)
            if fs.get_file_info(name).type != arrow_fs.FileType.NotFound:
                fs.delete_file(name)  # of an earlier attempt
            fs.move(draft, name)
            return pa.RecordBatch.from_pydict({"archive": [name.rsplit("/", 1)[1]], "records": [count], "bytes": [size]})

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for page_id, link, html, first in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns), strict=True):
                    again = first is not None and page_id != first
                    parts.append(packer.compress(record(page_id, link, html.encode("utf-8", "surrogatepass"), first, again)))
                    size, count = size + len(parts[-1]), count + 1
                    if size >= ARCHIVE_BYTES:
                        yield close()
                        parts, size, count, number = [], 0, 0, number + 1
        if parts:
            yield close()

    return stage(marked.mapInArrow(lean(pack), "archive string, records long, bytes long"), "archives")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives below `folder`: page_id, payload_bytes,
    payload_digest, record_type, refers_to. A response's figures are those of the
    payload read back, and must agree with its header."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [found(h, b) for h, b in read_records(content.as_buffer().to_pybytes())]
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(lean(unpack), FOUND_SCHEMA)


def found(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    sha1 = headers["warc-payload-digest"].removeprefix("sha1:")
    kind = headers["warc-type"]
    if kind == "response" and (len(payload), digest(payload)) != (length, sha1):
        raise ValueError(f"record {headers['warc-record-id']} is damaged")
    refers_to = page_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return page_of(headers["warc-record-id"]), length, sha1, kind, refers_to


def round_trip(pages: DataFrame, key: str, url: str, text: str, least: int = 0) -> DataFrame:
    """Archives the pages in a fresh shared folder and reads them back."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    if write(pages, key, url, text, folder, least).isEmpty():
        return spark.createDataFrame([], FOUND_SCHEMA)
    return read(spark, folder)
