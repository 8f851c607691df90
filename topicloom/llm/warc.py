"""WARC archives compressed with a Zstandard dictionary.

One archive is a file of this shape: a skippable frame (magic 0x184D2A5D) that holds the dictionary,
then one Zstandard frame per record, so that a reader who knows an offset needs the first frame and
one other. The dictionary is built from the records of the archive itself: a task gathers records
up to ``ARCHIVE_BYTES``, trains on them, writes the file and goes on with the next.

Records of equal payloads are stored once: the one with the least id is a response, the others are
revisits that refer to it and carry the HTTP header alone.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.llm.texts import bound_batches
from topicloom.session import cut_lineage, scratch_path

SKIPPABLE = 0x184D2A5D
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 64 << 10
# Training reads each record's first bytes; records stay whole in the archive.
SAMPLE_BYTES = 16 << 10
LEVEL = 6
# Bytes that the reader takes at a time; what lies behind a frame's end is read again.
FEED = 8 << 10
# Shorter payloads are always stored.
MIN_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. The HTTP header keeps the payload's length in revisits too."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = " ".join((url or "").split())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        *([f"WARC-Target-URI: {target}"] if target else []),
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(b": ", 1) for line in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload does not match its digest")

    def number(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("WARC-Refers-To"),
        "target": fields.get("WARC-Target-URI"),
        "payload": payload if kind == "response" else None,
    }


def pack(records: list[bytes]) -> bytes:
    """A whole archive. Too few or too uniform records leave the dictionary empty."""
    samples = [r[:SAMPLE_BYTES] for r in records]
    try:
        content = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        content = b""
    options = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **options)
    out = io.BytesIO()
    out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
    for r in records:
        out.write(packer.compress(r))
    return out.getvalue()


def unpack(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one by one."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    content, at = data[8 : 8 + size], 8 + size
    reader = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}))
    view = memoryview(data)
    while at < len(data):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            given = view[at : at + FEED]
            if not given:
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(given))
            at += len(given)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def with_revisits(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, html, digest, refers_to): which records repeat an earlier payload."""
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("html"), F.sha2(body, 256).alias("digest"))
    first = rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    # Only digests that occur again; written, so that a payload with very many copies can be split in the join.
    first = cut_lineage(first.where("_n > 1 and _first is not null").select("digest", "_first"))
    refers_to = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("_first")), F.col("_first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", refers_to.alias("refers_to"))


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write archives below ``path`` (any URI of a store that all executors reach): one row per file
    (file, records, bytes).

    Null html is an empty payload, a null url has no target. Rows that repeat an id with the same
    payload are responses alike. The row table is written down before it is returned: if a task is
    run again, its first file stays behind unlisted, and readers go by the list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)

        def write(records: list[bytes]) -> pa.RecordBatch:
            name = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            data = pack(records)
            with store.open_output_stream(name + ".part", compression=None) as out:
                out.write(data)
            store.move(name + ".part", name)
            uri = f"{path.rstrip('/')}/{name.rsplit('/', 1)[1]}"
            return pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([len(records)], pa.int64()), pa.array([len(data)], pa.int64())], names=["file", "records", "bytes"])

        gathered, size = [], 0
        for batch in batches:
            for i, u, body, digest, refers_to in zip(*batch.columns, strict=True):
                one = record(i.as_py(), u.as_py(), body.as_py().encode("utf-8", "surrogatepass"), digest.as_py(), refers_to.as_py())
                gathered.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield write(gathered)
                    gathered, size = [], 0
        if gathered:
            yield write(gathered)

    return cut_lineage(with_revisits(pages, key, url, html).mapInArrow(run, "file string, records long, bytes long"))


def read_warc(spark: SparkSession, files: DataFrame, payload: bool = True) -> DataFrame:
    """All records of the listed files (column ``file``); payloads are verified, and left out of the
    rows unless asked for."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, name = FileSystem.from_uri(uri)
                with store.open_input_stream(name, compression=None) as source:
                    data = source.read()
                rows, size = [], 0
                for r in unpack(data):
                    rows.append(parse(r))
                    size += len(r)
                    if not payload:
                        rows[-1]["payload"] = None
                    if size >= ARCHIVE_BYTES // 4 or len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return files.select("file").mapInArrow(run, RECORD)


def archive_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages as archives in a fresh shared folder and read them back."""
    bound_batches(pages)
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    if "://" not in path:  # a plain path of a local master
        path = f"file://{path.removeprefix('file:')}"
    files = write_warc(pages, path)
    return read_warc(spark, files.repartition("file"), payload=False)
