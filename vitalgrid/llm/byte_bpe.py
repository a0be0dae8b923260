"""Byte-level BPE encoding and decoding of whole texts by overlapping chunks.

A text longer than ``chunk`` characters is cut into chunks that overlap by ``overlap`` characters.
Tasks pre-tokenise chunks independently; each reports the pre-token boundaries it found in the two
overlaps. Neighbours are stitched at the first boundary both found: from there on the pattern, which
looks ahead at most one character and never back, goes the same way in both. The piece of a chunk
between its two stitches is encoded by itself, and pieces are joined by text. Where neighbours have
no boundary in common (a pre-token longer than the overlap), the whole text is encoded in one task.
Shorter texts are encoded where they are read, without a shuffle. Decoding concatenates the bytes
of the ids.

Results: null counts as empty text, which has no ids and decodes to no bytes. Repeated rows each
give a row. A null doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import bound_batches, saved, text_slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CHUNK = 1 << 16
OVERLAP = 1 << 10


@lru_cache(maxsize=4)
def encoding(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoding of a rank file; read once in each Python worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, path: str = RANKS) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(encoding(path).encode_ordinary(text), dtype="<u4").tobytes()


def decode(ids: bytes, path: str = RANKS) -> bytes:
    return encoding(path).decode_bytes(np.frombuffer(ids, "<u4").tolist())


def boundaries(text: str, start: int, overlap: int, last: bool) -> tuple[list[int], list[int]]:
    """Pre-token ends of a chunk within its first and its last ``overlap`` characters, as positions
    in the whole text. Where the text goes on behind the chunk, its last two pre-tokens may change
    and their ends do not count."""
    ends = [m.end() for m in regex.finditer(public_tokenizers.PATTERN, text)]
    sure = ends if last else ends[:-2]
    head = [start + e for e in ends if e <= overlap]
    tail = [start + e for e in sure if e >= len(text) - overlap]
    return head, tail


def _result(doc_ids: pa.Array, ids: list[bytes], path: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            doc_ids,
            pa.array([len(i) // 4 for i in ids], pa.int64()),
            pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
            pa.array([hashlib.sha256(decode(i, path)).hexdigest() for i in ids], pa.string()),
        ],
        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _ids(doc_ids: pa.Array, ids: list[bytes], path: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def encode_rows(
    docs: DataFrame, path: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP, digests: bool = False
) -> DataFrame:
    """(doc_id, ids binary) of every row; with ``digests`` the ids are decoded in the same tasks and
    the rows are those of ``decode_rows``, which keeps a second Python worker out of each task."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            ids = [encode(t, path) for t in batch.column("text").to_pylist()]
            yield finish(batch.column("doc_id"), ids, path)

    finish, columns = (_result, DIGESTS) if digests else (_ids, "ids binary")
    schema = f"doc_id {kind}, {columns}"
    here = rows.where(F.length("text") <= chunk).mapInArrow(short, schema)
    long = rows.where(F.length("text") > chunk)
    return here.unionByName(_encode_long(long, path, chunk, overlap, finish, schema))


def _encode_long(
    rows: DataFrame, path: str, chunk: int, overlap: int, finish: Callable[..., pa.RecordBatch], schema: str
) -> DataFrame:
    step = chunk - overlap
    n = F.ceil((F.length("text") - overlap) / step).cast("int")
    # Equal texts are encoded once; rows are told apart by doc_id and a digest of the text.
    texts = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"))
    chunks = texts.withColumn("chunks", n).select(
        "digest",
        F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substring(F.col("text"), k * step + 1, F.lit(chunk)))).alias("no", "part"),
        "chunks",
    )
    spread = chunks.repartition("digest", "no")

    def pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads, tails = [], []
            for no, part, count in zip(*(batch.column(k).to_pylist() for k in ("no", "part", "chunks")), strict=True):
                head, tail = boundaries(part, no * step, overlap, no + 1 == count)
                heads.append(head)
                tails.append(tail)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "head", "tail"],
            )

    cut = saved(
        spread.mapInArrow(
            pre_tokenise,
            "digest string, no int, part string, chunks int, head array<bigint>, tail array<bigint>",
        ),
        "chunks",
    )
    text_order = Window.partitionBy("digest").orderBy("no")
    stitched = cut.drop("part").withColumn(
        "stitch", F.array_min(F.array_intersect("tail", F.lead("head").over(text_order)))
    )
    pieces = stitched.select(
        "digest", "no", "chunks",
        F.coalesce(F.lag("stitch").over(text_order), F.when(F.col("no") == 0, F.lit(0))).alias("begin"),
        "stitch",
    )
    broken = F.max((F.col("no") > 0) & F.col("begin").isNull()).over(Window.partitionBy("digest"))
    pieces = pieces.withColumn("broken", broken)

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for no, part, begin, end in zip(*(batch.column(k).to_pylist() for k in ("no", "part", "begin", "stitch")), strict=True):
                at = no * step
                ids.append(encode(part[begin - at : None if end is None else end - at], path))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("no"), pa.array(ids, pa.binary())],
                names=["digest", "no", "ids"],
            )

    ready = cut.select("digest", "no", "part").join(pieces.where("NOT broken"), ["digest", "no"])
    encoded = ready.select("digest", "no", "part", "begin", "stitch").mapInArrow(
        encode_pieces, "digest string, no int, ids binary"
    )
    whole = texts.join(pieces.where("broken AND no = 0").select("digest"), "digest", "left_semi")
    single = whole.selectExpr("digest", "0 AS no", "text AS part", "CAST(0 AS BIGINT) AS begin", "CAST(NULL AS BIGINT) AS stitch")
    encoded = encoded.unionByName(single.mapInArrow(encode_pieces, "digest string, no int, ids binary"))
    joined = encoded.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("no", "ids"))).alias("parts"))
    by_row = rows.select("doc_id", F.sha2("text", 256).alias("digest")).join(joined, "digest")

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(p["ids"] for p in parts) for parts in batch.column("parts").to_pylist()]
            yield finish(batch.column("doc_id"), ids, path)

    return by_row.select("doc_id", "parts").mapInArrow(join_ids, schema)


def decode_rows(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded rows."""
    kind = dict(encoded.dtypes)["doc_id"]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids"):
            yield _result(batch.column("doc_id"), batch.column("ids").to_pylist(), path)

    return encoded.select("doc_id", "ids").mapInArrow(
        digests, f"doc_id {kind}, {DIGESTS}"
    )
