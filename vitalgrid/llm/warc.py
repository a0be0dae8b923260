"""WARC archives compressed record by record with a Zstandard dictionary, written and read by tasks.

A task gathers about ``ARCHIVE_BYTES`` of records, trains a dictionary on them, and writes one
``.warc.zst`` file: the dictionary in a leading skippable frame, then every record as a frame of its
own. A file keeps nothing in memory but its own records. Names are unique to the attempt, and only
files listed in the manifest the job returns are read, so failed attempts leave no second copies.

Of pages with equal payloads the one with the largest page_id is stored, the others are revisit
records, whose HTTP headers keep the payload's length. Payloads shorter than ``least`` bytes are all
stored. Equal payloads are found on digests only; the join back is one Spark can split where a
payload is very common.

Spark reads archives, but has no writer for such files: tasks write through Arrow's file systems.
``native_uri`` names a Hadoop path as these do. They take credentials and endpoints from the
executors' environment; a cluster that keeps them elsewhere gives its own ``open_folder``.

Results: null html is an empty payload. Repeated rows of one page are records each, all of them
stored if theirs is the largest page_id. A null page_id counts as smaller than any other; a group
without any page_id is stored throughout. A null url leaves out the target header. An empty table
gives no archive and no row. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, saved
from vitalgrid.session import scratch_dir

ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
LEVEL = 3
# Fixed values of the format.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
# Schemes under which Hadoop names stores that Arrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def native_uri(path: str) -> str:
    """The folder ``path``, as Spark names it, as a URI of Arrow's file systems."""
    scheme, colon, rest = path.partition(":")
    if not colon or not re.fullmatch(r"[A-Za-z][A-Za-z0-9+.-]*", scheme):
        return f"file://{path}"
    if scheme == "dbfs":  # executors see it as a mounted folder
        return "file:///dbfs/" + rest.lstrip("/")
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    return fs.FileSystem.from_uri(native_uri(path))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit without payload where ``refers_to`` is given."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{base32(hashlib.sha1(payload).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes:
    """A dictionary from records spread over the archive; too few to train on serve as they are."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(r[:DICTIONARY_BYTES] for r in samples)[-DICTIONARY_BYTES:]


def archive(records: list[bytes]) -> bytes:
    dictionary = train(records)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_checksum=True)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    out = [struct.pack("<II", DICTIONARY_FRAME, len(packed)), packed]
    return b"".join(out + [press.compress(r) for r in records])


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a dictionary-compressed archive."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start of the archive")
    frame = content[8 : 8 + size]
    if frame[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary may itself be compressed
        frame = zstandard.ZstdDecompressor().decompress(frame)
    inflate = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame))
    stream = inflate.stream_reader(io.BytesIO(memoryview(content)[8 + size :]), read_across_frames=True)
    text = io.BufferedReader(stream, 1 << 20)
    while line := text.readline():
        if line.rstrip() != VERSION:
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := text.readline()) != b"\r\n":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = text.read(int(headers["content-length"]))
        if text.read(4) != b"\r\n\r\n":
            raise ValueError("record without its end")
        yield headers, block


def write_archives(
    pages: DataFrame,
    folder: str,
    least: int = 0,
    opened: Callable[[str], tuple[fs.FileSystem, str]] = open_folder,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives below ``folder``; the manifest of files.
    ``opened`` gives, in a task, the file system of a folder and the folder's path in it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "*", F.sha1("html").alias("sha"), F.octet_length("html").alias("size")
    )
    equal = (
        rows.where(F.col("size") >= least)
        .groupBy("sha", "size")
        .agg(F.max("page_id").alias("stored"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND stored IS NOT NULL")
        .select("sha", "size", "stored")
    )
    marked = rows.join(equal, ["sha", "size"], "left").select(
        "page_id", "url", "html",
        F.when(~F.col("page_id").eqNullSafe(F.col("stored")), F.col("stored")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        waiting, size, files = [], 0, []

        def flush() -> None:
            name = f"part-{task.partitionId():06d}-{len(files):04d}-{uuid.uuid4().hex}.warc.zst"
            data = archive(waiting)
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            files.append((name, len(waiting), len(data)))
            waiting.clear()

        for batch in batches:
            for row in zip(*(c for c in batch.columns), strict=True):
                page_id, url, html, refers_to = (v.as_py() for v in row)
                waiting.append(record(page_id, url, html.encode(), refers_to))
                size += len(waiting[-1])
                if size >= ARCHIVE_BYTES:
                    flush()
                    size = 0
        if waiting:
            flush()
        yield pa.RecordBatch.from_pylist(
            [{"file": f, "records": n, "bytes": b} for f, n, b in files],
            schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return saved(marked.mapInArrow(write, "file string, records long, bytes long"), "manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, file) of all records;
    the payload of each stored record must match its digest."""
    columns = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string, file string"
    )
    if not manifest.head(1):
        return spark.createDataFrame([], columns)
    names = columns.replace(" long", "").replace(" string", "").split(", ")
    kinds = [pa.int64() if " long" in c else pa.string() for c in columns.split(", ")]
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
        .withColumn("file", F.element_at(F.split("path", "/"), -1))
        .join(manifest.select("file"), "file", "left_semi")
    )

    def page(uri: str | None) -> int | None:
        number = (uri or "").strip("<>").rpartition(":")[2]
        return int(number) if number else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                out = []
                for head, block in read_archive(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    kind = head["warc-type"]
                    if kind == "response" and base32(hashlib.sha1(payload).digest()) != digest:
                        raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                    own, other = page(head["warc-record-id"]), page(head.get("warc-refers-to"))
                    out.append((own, size, digest, kind, other, head.get("warc-target-uri"), file))
                    if len(out) == 4096:
                        yield _batch(out, names, kinds)
                        out = []
                yield _batch(out, names, kinds)

    return files.select("file", "content").mapInArrow(parse, columns)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def archive_round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages to archives in the cluster's shared folder and read them back."""
    bound_batches(pages.sparkSession)
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    return read_archives(spark, folder, write_archives(pages, folder, least))
